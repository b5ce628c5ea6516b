"""Scoring texts by a weighted backoff automaton.

States are the word sequences of the training texts shorter than the model's order; an
arc reads a word that followed its state in training, a failure arc leads to the
state's longest suffix.  A text is read once, left to right, carrying the state and
adding the arcs' log-probabilities; the texts of a block are read side by side.

Every order is interpolated with the next lower one:
``P(w|h) = (1 - b) c(hw) / c(h) + b P(w|h')``.  ``b`` starts from the share of the training
sequences of that order that occur once (what would be unseen if left out) and rises
for rare histories: ``b(h) = b + 0.8 (1 - b) / c(h)^2``.  Words alone have add-one estimates.

The counts are those of the whole corpus.  No task holds them all: a block of texts gets
the exact counts of its own sequences (``counts``), which is every arc it can follow.
A block is packed once, its words as numbers into the block's own list of word hashes, and
asks for its counts in ``PARTS`` ranges of keys, one after the other, so that only one
range is being shuffled at a time.  A block's own keys are sorted in ``PIECES`` of a range
for the same reason, and numbers of a block's words, keys and states take 32 bits.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swinglake.llm.common import give_back, lower_ascii, staged
from swinglake.llm.counts import Layout, answers, block_of, large, layout, small, tallied, totals

ORDER = 3
BLOCK_BYTES = 4 << 20
PARTS = 2             # ranges of keys that are counted one after the other
PIECES = 2            # of such a range that a block sorts one after the other
RARE = 0.8            # of what is left to a history seen once, the share that goes to lower orders
_END = 0x5851F42D4C957F2D
_MIX = np.uint64(0x9E3779B97F4A7C15)
_ORDER_BITS = np.uint64(3)


def _scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _pack(texts: pa.Table) -> pa.Table:
    """The texts of a block in one row: word hashes, sorted, and each word's number among them."""
    normal = texts["normal"].to_pylist()
    lengths = np.array([t.count(" ") + 2 if t else 1 for t in normal], dtype="<u4")
    met: dict[str, int] = {}
    said = np.array([met.setdefault(w, len(met)) for t in normal if t for w in t.split(" ")], dtype=np.int64)
    hashed = np.array([*(xxhash.xxh64_intdigest(w.encode()) for w in met), _END], dtype=np.uint64)
    kinds, number = np.unique(hashed, return_inverse=True)
    ends = np.zeros(int(lengths.sum(dtype=np.int64)), dtype=bool)
    ends[np.cumsum(lengths, dtype=np.int64) - 1] = True
    numbers = np.empty(len(ends), dtype="<u4")
    numbers[ends], numbers[~ends] = number[-1], number[said]
    held = texts["held_out"].to_numpy().astype(np.uint8)
    ids = texts["doc_id"].combine_chunks()
    return pa.table({
        "block": texts["block"].slice(0, 1).combine_chunks(),
        "doc_ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
        **{name: pa.array([small(values)], pa.binary()) for name, values in (
            ("held", held), ("lengths", lengths), ("kinds", np.diff(kinds, prepend=np.uint64(0))), ("numbers", numbers))}})


class Block:
    """The texts of a block as keys: of each position the sequences of 1..order words that end there.

    A key's two lowest bits are its order less one.  ``whole[m]`` marks positions with
    ``m`` words of their text before and at them; other positions have no key of that order.
    """

    def __init__(self, held: bytes, lengths: bytes, kinds: bytes, numbers: bytes, order: int):
        self.lengths = large(lengths, "<u4").astype(np.int64)
        n = int(self.lengths.sum())
        hashed = np.cumsum(large(kinds, "<u8"), dtype=np.uint64)[large(numbers, "<u4")]
        place = np.concatenate([[0], np.cumsum(self.lengths)[:-1]]).astype(np.int64)
        self.first = place
        self.held_out = large(held, "u1").astype(bool)
        within = np.arange(n) - np.repeat(place, self.lengths)
        self.trains = np.repeat(~self.held_out, self.lengths)
        self.whole, self.keys = [], []
        mixed = np.zeros(n, np.uint64)
        for m in range(1, order + 1):
            back = np.roll(mixed, 1)          # sequence of m - 1 words that ends one before
            mixed = hashed.copy() if m == 1 else back * _MIX + hashed + np.uint64(m)
            self.whole.append(within >= m - 1)
            self.keys.append((_scrambled(mixed) & ~_ORDER_BITS) | np.uint64(m - 1))

    def _sorted(self, part: int, parts: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Distinct keys in one of equal ranges, sorted, where each key of it stands among them, and per order its positions."""
        low, high = (part << 64) // parts, ((part + 1 << 64) // parts) - 1
        own = [np.flatnonzero(w & (k >= np.uint64(low)) & (k <= np.uint64(high))) for k, w in zip(self.keys, self.whole)]
        keys, place = np.unique(np.concatenate([k[o] for k, o in zip(self.keys, own)]), return_inverse=True)
        return keys, place, own

    def distinct(self, part: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct keys in one of equal ranges, sorted, and how often each occurs in training texts."""
        found = []
        for piece in range(part * PIECES, (part + 1) * PIECES):
            keys, place, own = self._sorted(piece, parts * PIECES)
            trains = np.concatenate([self.trains[o] for o in own])
            found.append((keys, np.bincount(place[trains], minlength=len(keys))))
        return np.concatenate([k for k, _ in found]), np.concatenate([n for _, n in found])

    def count(self, total: np.ndarray) -> None:
        """Per order: number of each position's sequence, -1 where there is none, and corpus counts.

        The keys are not needed after this and are dropped."""
        self.number = [np.full(len(w), -1, dtype=np.int32) for w in self.whole]
        before = 0
        for piece in range(PARTS * PIECES):
            keys, place, own = self._sorted(piece, PARTS * PIECES)
            at = 0
            for number, o in zip(self.number, own):
                number[o] = place[at:at + len(o)] + before
                at += len(o)
            before += len(keys)
        self.total = total
        del self.keys, self.whole

    def counts(self, m: int) -> np.ndarray:
        return np.where(self.number[m - 1] >= 0, self.total[np.maximum(self.number[m - 1], 0)], 0)

    def history(self, m: int) -> np.ndarray:
        """Corpus count of the ``m`` words before each position."""
        before = np.roll(self.counts(m), 1)
        return np.where(self.number[m] >= 0, before, 0)


class Automaton:
    """States, arcs and failure arcs for the sequences of a block.

    State 0 has read nothing it knows.  Its arcs come first, one for each word of the
    block; other arcs follow in order of their ``code``, state and word in one number.
    """

    def __init__(self, block: Block, order: int, backoff: list[float], known: int, distinct: int):
        total = block.total
        used = _marked(block.number[0], len(total))
        word_keys = np.flatnonzero(used)
        self.word = (np.cumsum(used, dtype=np.int32) - 1)[block.number[0]]
        self.words = len(word_keys)
        self.count = total[word_keys]
        probability = (self.count + 1.0) / (known + distinct + 1.0)
        # a state for each sequence below the full order that training has
        state_of = np.zeros(len(total), dtype=np.int32)
        n = 1
        for m in range(1, order):
            ids = np.flatnonzero(_marked(block.number[m - 1][block.counts(m) > 0], len(total)))
            state_of[ids] = n + np.arange(len(ids))
            n += len(ids)
        self.fail_weight, self.fail_target = np.zeros(n), np.zeros(n, dtype=np.int32)
        codes, weights, targets = [], [], []           # of all arcs but those of state 0

        def arcs(m: int, lower: np.ndarray) -> np.ndarray:
            """Adds the arcs that follow ``m`` words; probabilities given ``m`` words from those given ``m - 1``."""
            history, count = block.history(m), block.counts(m + 1)
            b = backoff[m] + RARE * (1 - backoff[m]) / np.maximum(history, 1).astype(float) ** 2
            seen, context = history > 0, np.roll(block.number[m - 1], 1)
            p = np.where(seen, (1 - b) * count / np.maximum(history, 1) + b * lower, lower)
            at = _firsts(context, seen)
            states = state_of[context[at]]
            self.fail_weight[states] = np.log10(b[at])
            if m > 1:
                self.fail_target[states] = state_of[np.roll(block.number[m - 2], 1)[at]]
            at = _firsts(block.number[m], count > 0)
            codes.append(state_of[context[at]].astype(np.int64) * self.words + self.word[at])
            weights.append(np.log10(p[at]))
            targets.append(state_of[block.number[m - 1 if m + 1 == order else m][at]])
            return p

        reduce(lambda lower, m: arcs(m, lower), range(1, order), probability[self.word])
        code = _joined(codes, np.int64)
        by_code = np.argsort(code)
        self.code = np.append(code[by_code], np.iinfo(np.int64).max)
        del code
        self.weight = np.concatenate([np.log10(probability), _joined(weights, np.float64)[by_code]])
        self.target = np.concatenate([state_of[word_keys], _joined(targets, np.int32)[by_code]])

    def read(self, first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Log10 probabilities of texts, read side by side: each carries its state from word to word."""
        longest_first = np.argsort(-lengths, kind="stable")
        start = first[longest_first]
        reading = np.searchsorted(-lengths[longest_first], -np.arange(int(lengths.max(initial=0))), side="left")
        state, score = np.zeros(len(start), dtype=np.int64), np.zeros(len(start))
        for step, active in enumerate(reading):
            word = self.word[start[:active] + step]
            at = state[:active].copy()
            arc = word.astype(np.int64)                # those of state 0
            todo = np.flatnonzero(at)
            while len(todo):
                code = at[todo] * self.words + word[todo]
                place = np.searchsorted(self.code, code)
                hit = self.code[place] == code
                arc[todo[hit]] = self.words + place[hit]
                todo = todo[~hit]
                score[todo] += self.fail_weight[at[todo]]
                at[todo] = self.fail_target[at[todo]]
                todo = todo[at[todo] > 0]
            score[:active] += self.weight[arc]
            state[:active] = self.target[arc]
        out = np.empty(len(start))
        out[longest_first] = score
        return out


def _joined(parts: list[np.ndarray], kind: type) -> np.ndarray:
    """The arrays as one; their list is emptied, so that they don't lie beside it."""
    out = np.concatenate([np.empty(0, kind), *parts])
    parts.clear()
    return out


def _marked(numbers: np.ndarray, size: int) -> np.ndarray:
    mark = np.zeros(size, dtype=bool)
    mark[numbers] = True
    return mark


def _firsts(numbers: np.ndarray, use: np.ndarray) -> np.ndarray:
    """A position for each distinct number among those in use."""
    positions = np.flatnonzero(use)
    chosen = np.full(int(numbers.max(initial=-1)) + 1, -1, dtype=np.int32)
    chosen[numbers[positions]] = positions
    return chosen[chosen >= 0]


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: CRC-32 of its id as text, modulo 7, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def scores(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``: a row per row.

    Trained on the rows that are not held out.  A null text is empty and has its end only;
    a row without id trains; repeated rows count each; other columns play no part.
    """
    normal = F.trim(F.regexp_replace(lower_ascii(F.coalesce("text", F.lit(""))), "[\\x20\\x09-\\x0D]+", " "))
    at = layout(docs, order, BLOCK_BYTES)
    at = Layout(at.blocks, -(-at.buckets // PARTS) * PARTS)          # no bucket in two ranges
    kind = dict(docs.dtypes)["doc_id"]
    texts = (docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), normal.alias("normal"))
             .withColumn("block", block_of(F.xxhash64("doc_id", F.length("normal"), F.substring("normal", 1, 64)), at))
             .repartition(at.blocks, "block"))
    parts = ("held", "lengths", "kinds", "numbers")
    blocks = staged(texts.groupBy("block").applyInArrow(
        _pack, f"block int, doc_ids array<{kind}>, " + ", ".join(f"{p} binary" for p in parts)), "packed-texts")

    def tally(keys: np.ndarray, total: np.ndarray) -> list[int]:
        """Distinct words, and per order the training sequences and those that occur once."""
        level, sums = keys & _ORDER_BITS, [int(((keys & _ORDER_BITS == 0) & (total > 0)).sum())]
        for m in range(order):
            own = total[level == m]
            sums += [int(own.sum()), int((own == 1).sum())]
        return sums

    def keys_of(part: int):
        return lambda frame: Block(*frame[list(parts)].iloc[0], order).distinct(part, PARTS)

    ranges = [staged(totals(blocks.select("block", *parts), keys_of(part), at, tally, whole=True), "ngram-counts")
              for part in range(PARTS)]
    counted = reduce(DataFrame.unionAll, ranges)
    distinct, *sums = tallied(counted, 1 + 2 * order)
    known = sums[0]
    backoff = [min(max(once / max(every, 1), 0.01), 0.99) for every, once in zip(sums[::2], sums[1::2])]
    by_block = counted.where("block >= 0").drop("tally")

    def score(packed: pa.Table, answer: pa.Table) -> pa.Table:
        block = Block(*(packed[p][0].as_py() for p in parts), order)
        block.count(answers(answer.to_pandas()))
        automaton = Automaton(block, order, backoff, known, distinct)
        count = automaton.count[automaton.word]
        base = np.log10((count + 1.0) / (known + distinct + 1.0))
        read = {
            "n_tokens": block.lengths, "n_known": np.add.reduceat(count > 0, block.first, dtype=np.int64),
            "train_tokens": np.full(len(block.lengths), known), "base_score": np.add.reduceat(base, block.first),
            "score": automaton.read(block.first, block.lengths)}
        give_back()
        return pa.table({"doc_id": packed["doc_ids"][0].values, "held_out": pa.array(block.held_out),
                         **{name: pa.array(values) for name, values in read.items()}})

    return blocks.groupBy("block").cogroup(by_block.groupBy("block")).applyInArrow(
        score, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
               "base_score double, score double")
