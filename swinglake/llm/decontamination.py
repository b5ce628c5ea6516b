"""Benchmark decontamination: BM25 over the test items, queried by every training passage.

Test items are the indexed side.  Scores are normalised by what an item scores with all
its own terms, so one threshold serves items of any length.  Posting lists are cut into
blocks that know their largest impact; block-max WAND leaves out what cannot reach
the threshold and returns every item that does.  A hit counts when the passage holds
enough of the item's question and of its answer, or of the whole item where the
benchmark does not say what its answers are.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swinglake.llm.common import give_back

K1, B = 1.2, 0.75
THRESHOLD = 0.7       # of an item's own score
OVERLAP = 0.6         # of the n-grams of question and answer, or of an item without an answer
NGRAM = 3
BLOCK = 2             # postings' item numbers per block
ESSENTIAL_DF = 40     # terms in more items only add to scores, they do not open passages
INDEX_BYTES = 8 << 20     # item text in one index; more items make more indexes
CHUNK = 200_000       # words bounded at a time

_words = re.compile(r"[^\W_]+").findall


@dataclass
class Index:
    """Posting lists over item numbers 0, 1, ... in blocks of ``BLOCK`` numbers."""

    items: list[tuple[int, list[str], list[str]]]     # id, question words, answer words
    terms: dict[str, int] = field(default_factory=dict)
    postings: list[list[tuple[int, float]]] = field(default_factory=list)
    upper: list[float] = field(default_factory=list)
    block_max: list[dict[int, float]] = field(default_factory=list)
    whole: bool = False       # items are judged as one part; question and answer are told for information

    def __post_init__(self) -> None:
        counts = [Counter(q + a) for _, q, a in self.items]
        df = Counter(t for c in counts for t in c)
        n, mean = len(counts), sum(sum(c.values()) for c in counts) / max(len(counts), 1)
        idf = {t: math.log(1 + (n - d + 0.5) / (d + 0.5)) for t, d in df.items()}
        lists: dict[str, list[tuple[int, float]]] = defaultdict(list)
        common = 0.0
        for i, c in enumerate(counts):
            norm = K1 * (1 - B + B * sum(c.values()) / mean)
            impact = {t: idf[t] * tf * (K1 + 1) / (tf + norm) for t, tf in c.items()}
            own = sum(impact.values())
            for t, x in impact.items():
                lists[t].append((i, x / own))
            common = max(common, sum(x for t, x in impact.items() if df[t] > ESSENTIAL_DF) / own)
        self.common = common
        self.blocks = -(-n // BLOCK)
        for t, posting in lists.items():
            self.terms[t] = len(self.postings)
            self.postings.append(posting)
            self.upper.append(max(x for _, x in posting))
            best: dict[int, float] = {}
            for i, x in posting:
                best[i // BLOCK] = max(best.get(i // BLOCK, 0.0), x)
            self.block_max.append(best)
        self.longest = max((sum(c.values()) for c in counts), default=1)
        # essential terms' block maxima, flat: entries of term t are at[t]:at[t + 1]
        kept = [sorted(b.items()) if len(p) <= ESSENTIAL_DF else []
                for b, p in zip(self.block_max, self.postings, strict=True)]
        self.at = np.cumsum([0, *map(len, kept)])
        self.entry_block = np.array([k for e in kept for k, _ in e], dtype=np.int64)
        self.entry_max = np.array([x for e in kept for _, x in e])


def search(index: Index, terms: list[int], threshold: float) -> list[tuple[int, float]]:
    """Block-max WAND: every (item number, score) with a score of ``threshold`` or more."""
    cursors = [[0, t] for t in terms]      # position in the list, term
    postings, upper, block_max = index.postings, index.upper, index.block_max
    found = []

    def move(cursor: list[int], item: int) -> None:
        """To the first posting at ``item`` or after."""
        posting, at = postings[cursor[1]], cursor[0]
        while at < len(posting) and posting[at][0] < item:
            at += 1
        cursor[0] = at

    threshold -= 1e-9
    while True:
        cursors = [c for c in cursors if c[0] < len(postings[c[1]])]
        cursors.sort(key=lambda c: postings[c[1]][c[0]][0])
        total, pivot = 0.0, None
        for k, (_, t) in enumerate(cursors):
            total += upper[t]
            if total >= threshold:
                pivot = k
                break
        if pivot is None:
            return found
        item = postings[cursors[pivot][1]][cursors[pivot][0]][0]
        while pivot + 1 < len(cursors) and postings[cursors[pivot + 1][1]][cursors[pivot + 1][0]][0] == item:
            pivot += 1
        block = item // BLOCK
        here = sum(block_max[t].get(block, 0.0) for _, t in cursors[:pivot + 1])
        if here < threshold:
            # nothing up to the end of the block, or the next list's item, can score enough
            after = (block + 1) * BLOCK
            if pivot + 1 < len(cursors):
                after = min(after, postings[cursors[pivot + 1][1]][cursors[pivot + 1][0]][0])
            for c in cursors[:pivot + 1]:
                move(c, max(after, item + 1))
            continue
        for c in cursors[:pivot + 1]:
            move(c, item)
        score = 0.0
        for c in cursors[:pivot + 1]:
            posting = postings[c[1]]
            if c[0] < len(posting) and posting[c[0]][0] == item:
                score += posting[c[0]][1]
                c[0] += 1
        if score >= threshold:
            found.append((item, score))


def overlap(part: list[str], passage: list[str]) -> float:
    """Share of the part's word n-grams that the passage holds; shorter parts are one n-gram."""
    n = min(NGRAM, len(part))
    if n == 0:
        return 1.0
    there = set(zip(*(passage[i:] for i in range(n))))
    grams = list(zip(*(part[i:] for i in range(n))))
    return sum(g in there for g in grams) / len(grams)


def passages_to_search(index: Index, ids: np.ndarray, first: np.ndarray, stride: int,
                       threshold: float) -> np.ndarray:
    """Segments k whose passage, segments k and k + 1, may hold an item above the threshold.

    ``ids``: term of each word or -1; ``first``: segment of each word.  Bounds add the block
    maxima of the essential terms and the most that other terms give any item.
    """
    n = int(first[-1]) + 2 if len(first) else 0
    hit = ids >= 0
    pairs = np.unique(first[hit] * len(index.postings) + ids[hit])
    segment, term = np.divmod(pairs, max(len(index.postings), 1))
    sizes = index.at[term + 1] - index.at[term]
    entry = np.repeat(index.at[term] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    cell = np.repeat(segment, sizes) * index.blocks + index.entry_block[entry]
    bound = np.bincount(cell, weights=index.entry_max[entry], minlength=n * index.blocks)
    bound = bound.reshape(n, index.blocks)
    both = (bound[:-1] + bound[1:]).max(axis=1, initial=0.0)
    return np.flatnonzero(both + index.common >= threshold - 1e-9)


def hits(index: Index, texts: list[str | None], threshold: float = THRESHOLD,
         least: float = OVERLAP) -> list[tuple[int, int, float, float, float]]:
    """(row, item id, score, question overlap, answer overlap): an item's best passage of a text.

    Passages are twice the longest item and begin every longest item, so each stretch
    of an item's length lies whole in one of them.
    """
    if not index.items:
        return []
    stride, found = index.longest, {}
    get = index.terms.get
    rows: list[tuple[int, list[str], int]] = []     # row, words, first segment
    held, segments = 0, 0

    def flush() -> None:
        nonlocal rows, held, segments
        if not rows:
            return
        ids = np.fromiter((get(w, -1) for _, words, _ in rows for w in words), dtype=np.int64, count=held)
        first = np.concatenate([base + np.arange(len(words)) // stride for _, words, base in rows])
        bases = np.array([base for _, _, base in rows])
        for segment in passages_to_search(index, ids, first, stride, threshold):
            row, words, base = rows[int(np.searchsorted(bases, segment, side="right")) - 1]
            start = (int(segment) - base) * stride
            passage = words[start:start + 2 * stride]
            terms = sorted({t for t in map(get, passage) if t is not None})
            for item, score in search(index, terms, threshold):
                item_id, question, answer = index.items[item]
                q, a = overlap(question, passage), overlap(answer, passage)
                holds = overlap(question + answer, passage) >= least if index.whole else q >= least and a >= least
                if holds and (row, item) not in found or \
                        (row, item) in found and (score, q + a) > (found[row, item][2], sum(found[row, item][3:])):
                    found[row, item] = (row, item_id, min(score, 1.0), q, a)
        rows, held, segments = [], 0, 0

    for row, text in enumerate(texts):
        words = _words((text or "").lower())
        if not words:
            continue
        rows.append((row, words, segments))
        held += len(words)
        segments += -(-len(words) // stride) + 1      # an empty segment ends each text
        if held >= CHUNK or segments * index.blocks >= 4_000_000:
            flush()
    flush()
    return sorted(found.values())


def split_item(words: list[str]) -> tuple[list[str], list[str]]:
    """Question and answer of an item given as one text: the answer is its last quarter."""
    at = len(words) - max(1, len(words) // 4)
    return words[:at], words[at:]


def build_indexes(items: DataFrame) -> Iterator[Index]:
    """Indexes over ``item_id`` and ``text``, or ``question`` and ``answer``, of ``INDEX_BYTES`` each.

    Every index is of bounded size; a larger benchmark is searched in several.
    Items without words or without id are left out: nothing can hold them.
    """
    parts = ("question", "answer") if {"question", "answer"} <= set(items.columns) else ("text",)
    held, size = [], 0
    for r in items.select("item_id", *parts).where("item_id is not null").orderBy("item_id", *parts).toLocalIterator():
        words = [_words((x or "").lower()) for x in r[1:]]
        question, answer = split_item(words[0]) if len(parts) == 1 and words[0] else (words[0], words[-1])
        if not question + answer:
            continue
        held.append((r["item_id"], question, answer))
        size += sum(len(x or "") for x in r[1:])
        if size >= INDEX_BYTES:
            yield Index(held, whole=len(parts) == 1)
            held, size = [], 0
    if held:
        yield Index(held, whole=len(parts) == 1)


def contamination(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD,
                  least: float = OVERLAP) -> DataFrame:
    """``doc_id, item_id, score, question_overlap, answer_overlap``: a row per document and item it holds.

    Null and empty texts hold nothing; repeated rows are judged each; a null doc_id is
    carried along; other columns play no part.  Without items there are no rows.
    """
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, item_id long, score double, " \
             "question_overlap double, answer_overlap double"
    out = None
    for index in build_indexes(items):
        def find(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                got = hits(index, batch.column(1).to_pylist(), threshold, least)
                columns = list(zip(*got)) if got else [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(columns[0], pa.int64())), pa.array(columns[1], pa.int64()),
                     *(pa.array(c, pa.float64()) for c in columns[2:])],
                    names=["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])
            give_back()
        part = docs.select("doc_id", "text").mapInArrow(find, schema)
        out = part if out is None else out.union(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def without_contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD,
                         least: float = OVERLAP) -> DataFrame:
    """``docs`` less every row that holds an item; columns and the other rows stay as they are."""
    at = docs.columns.index("text")
    for index in build_indexes(items):
        def keep(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                mask = np.ones(len(batch), dtype=bool)
                mask[[h[0] for h in hits(index, batch.column(at).to_pylist(), threshold, least)]] = False
                yield batch.filter(pa.array(mask))
            give_back()
        docs = docs.mapInArrow(keep, docs.schema)
    return docs
