"""N-gram Jaccard join by signature trees.

Texts with the same words count once.  A text can only have a partner if it shares one
of its rarest shingles (prefix filter, in order of exact corpus counts), so the texts
that are left are few and meet in small groups.  In a group the texts are the leaves of
a tree whose nodes hold OR-combined token bitmaps and size ranges; a dual traversal
leaves out node pairs whose largest possible overlap is too small, or whose leaves are
all linked already, and compares whole shingle sets at the leaves.

Groups are formed twice.  First by two min-hashes, which link most copies cheaply: a
large group is cut into pieces, and the other min-hash ties the pieces together.  Then
by families: texts tied together by rare shingles that different components still
share; large families are cut into pieces that meet in pairs.  The second round makes
the result exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swinglake.llm.common import free_names, give_back, lower_ascii, staged
from swinglake.llm.components import components
from swinglake.llm.counts import answers, block_of, layout, totals

WORDS = 5
PERCENT = 80
FANOUT = 16
PIECE = 1_000     # texts of a group that one task joins, or one side of a pair of pieces
CACHE_BYTES = 40 << 20
BLOCK_BYTES = 6 << 20     # of text that one task compares with the corpus counts
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = (np.uint64(0xD1B54A32D192ED03), np.uint64(0x8CB92BA72F3D8DD7))


class _WordHashes(dict):
    """Hashes of words, kept up to a number of bytes."""

    held = 0

    def forget(self) -> None:
        self.clear()
        self.held = 0

    def __missing__(self, word: str) -> int:
        self.held += 200 + len(word)      # with the number and their place in the table
        if self.held > CACHE_BYTES:
            self.forget()
        value = self[word] = xxhash.xxh64_intdigest(word.encode())
        return value


_hashes = _WordHashes()


def _scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(normal: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a normalised text."""
    if not normal:
        return np.empty(0, np.uint64)
    words = normal.split(" ")
    h = np.fromiter(map(_hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    n = min(WORDS, len(words))
    total = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        total = total * _MIX + h[i:len(words) - n + 1 + i]
    return np.unique(_scrambled(total + np.uint64(n)))


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets reach the similarity, in whole numbers."""
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < PERCENT * len(b):
        return False
    at = np.searchsorted(b, a)
    common = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return 100 * common >= PERCENT * (len(a) + len(b) - common)


class Forest:
    """Union-find over the leaves of a group; leaf numbers are positions."""

    def __init__(self, labels: list[int]):
        self.parent = list(labels)

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def unite(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)


class Tree:
    """Levels of nodes over leaves in order of size; level 0 are the leaves themselves."""

    def __init__(self, sets: list[np.ndarray], leaves: list[int], bits: int):
        order = sorted(leaves, key=lambda i: (len(sets[i]), sets[i][0] if len(sets[i]) else 0))
        maps = np.zeros((len(order), bits), np.uint8)
        for row, i in enumerate(order):
            maps[row, (sets[i] & np.uint64(bits - 1)).astype(np.int64)] = 1
        size = np.array([len(sets[i]) for i in order])
        self.order = order
        # bitmap, least and largest size, most tokens that share bits with others of their text
        self.levels = [(np.packbits(maps, axis=1), size, size, size - maps.sum(axis=1))]
        while len(self.levels[-1][0]) > 1:
            low = self.levels[-1]
            cut = np.arange(0, len(low[0]), FANOUT)
            self.levels.append((np.bitwise_or.reduceat(low[0], cut, axis=0), np.minimum.reduceat(low[1], cut),
                                np.maximum.reduceat(low[2], cut), np.maximum.reduceat(low[3], cut)))

    def children(self, level: int, node: int) -> np.ndarray:
        return np.arange(node * FANOUT, min((node + 1) * FANOUT, len(self.levels[level - 1][0])))

    def leaves(self, level: int, node: int) -> list[int]:
        width = FANOUT ** level
        return self.order[node * width:(node + 1) * width]


def possible(a: tuple, i: np.ndarray, b: tuple, j: np.ndarray) -> np.ndarray:
    """Which node pairs may hold a linked pair, by sizes and largest possible overlap.

    Texts x and y share at most the tokens of x that fall on common bits: the bits that
    both nodes have, plus the tokens of x that share a bit with another of x.
    """
    both = np.bitwise_count(a[0][i] & b[0][j]).sum(axis=1, dtype=np.int64)
    most = np.minimum(both + np.minimum(a[3][i], b[3][j]), np.minimum(a[2][i], b[2][j]))
    need = -(-PERCENT * (a[1][i] + b[1][j]) // (100 + PERCENT))
    near = (100 * a[2][i] >= PERCENT * b[1][j]) & (100 * b[2][j] >= PERCENT * a[1][i])
    return near & (most >= need)


def tree_join(sets: list[np.ndarray], forest: Forest, left: list[int], right: list[int] | None = None) -> None:
    """Unites all linked leaves of ``left`` (and ``right``) that are not united yet."""
    largest = max((len(sets[i]) for i in left + (right or [])), default=0)
    if not largest:
        return
    bits = 1 << min(max(9, (4 * largest - 1).bit_length()), 15)
    a = Tree(sets, left, bits)
    b = a if right is None else Tree(sets, right, bits)
    one = [{} for _ in range(2)]

    def single(tree: Tree, side: int, level: int, node: int) -> int:
        """The component of all leaves below, or -1; once single, a node stays so."""
        known = one[side].get((level, node))
        if known is None:
            roots = {forest.root(x) for x in tree.leaves(level, node)}
            if len(roots) > 1:
                return -1
            known = one[side][level, node] = roots.pop()
        return forest.root(known)

    other = 0 if right is None else 1
    stack = [(len(a.levels) - 1, 0, len(b.levels) - 1, 0)]
    while stack:
        la, i, lb, j = stack.pop()
        if la == lb == 0:
            x, y = a.order[i], b.order[j]
            if forest.root(x) != forest.root(y) and linked(sets[x], sets[y]):
                forest.unite(x, y)
            continue
        s = single(a, 0, la, i)
        if s >= 0 and s == single(b, other, lb, j):
            continue
        down_a, down_b = la >= lb and la > 0, lb >= la and lb > 0
        ia = a.children(la, i) if down_a else np.array([i])
        jb = b.children(lb, j) if down_b else np.array([j])
        p, q = (x.ravel() for x in np.meshgrid(ia, jb, indexing="ij"))
        na, nb = la - down_a, lb - down_b
        if right is None and na == nb:
            keep = p <= q if na else p < q
            p, q = p[keep], q[keep]
        if len(p):
            ok = possible(a.levels[na], p, b.levels[nb], q)
            stack.extend((na, int(x), nb, int(y)) for x, y in zip(p[ok], q[ok]))


def _group_edges(frame: pd.DataFrame) -> pd.DataFrame:
    """``u, v``: new links of a group, as a text per component and the least text it is now linked with.

    Rows of side 0 meet each other, or those of side 1 where there are any; texts with
    the same ``label`` are linked already.
    """
    frame = frame.sort_values("key", ignore_index=True)
    sets = [np.frombuffer(s, np.uint64) for s in frame["shingles"]]
    number: dict[str, int] = {}
    forest = Forest([number.setdefault(label, i) for i, label in enumerate(frame["label"])])
    first = [i for i, parent in enumerate(forest.parent) if parent == i]
    side = frame["side"].to_numpy()
    tree_join(sets, forest, np.flatnonzero(side == 0).tolist(), np.flatnonzero(side == 1).tolist() or None)
    keys = frame["key"]
    del sets
    give_back()
    return pd.DataFrame([(keys[i], keys[r]) for i in first if (r := forest.root(i)) != i], columns=["u", "v"])


def normal_text(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_normal``, its words in lower case with single blanks, and ``_key``, its MD5."""
    words = F.regexp_replace(lower_ascii(F.coalesce("text", F.lit(""))), "[\\x20\\x09-\\x0D]+", " ")
    return docs.withColumn("_normal", F.trim(words)).withColumn("_key", F.md5("_normal"))


def _first_of_task(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per text among those of a task, so a text sent in thousands of copies is not one task's load."""
    seen: set[str] = set()
    for frame in frames:
        fresh = ~frame["key"].duplicated() & ~frame["key"].isin(seen)
        seen.update(frame["key"][fresh])
        yield frame[fresh]


def _block_sets(frame: pd.DataFrame) -> tuple[list[str], list[np.ndarray]]:
    one = frame.drop_duplicates("key")
    return one["key"].tolist(), [shingle_set(t) for t in one["normal"]]


def _block_keys(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(np.concatenate(_block_sets(frame)[1]), return_counts=True)


def _with_rare_shingles(texts: pd.DataFrame, counted: pd.DataFrame) -> pd.DataFrame:
    """Of each text the set's size; of one that may have a partner also the set and its shared rare shingles.

    In order of corpus counts, a partner shares one of the first ``n - ceil(0.8 n) + 1``.
    """
    keys, sets = _block_sets(texts)
    place = np.unique(np.concatenate([np.empty(0, np.uint64), *sets]), return_inverse=True)[1]
    every, rows = answers(counted)[place], []
    ends = np.cumsum([len(s) for s in sets]).tolist()
    for key, s, end in zip(keys, sets, ends):
        n, row = len(s), (key, len(s), None, None, None)
        if n:
            count = every[end - n:end]
            first = n - -(-PERCENT * n // 100) + 1
            if (count == 1).sum() < first:
                rare = np.lexsort((s, count))[:first]
                shared = s[rare][count[rare] > 1]
                least = [int(_scrambled(s ^ seed).min().view(np.int64)) for seed in _SEEDS]
                row = (key, n, s.tobytes(), least, shared.view(np.int64).tolist())
        rows.append(row)
    del sets, place, every
    _hashes.forget()
    give_back()
    return pd.DataFrame(rows, columns=["key", "n", "shingles", "least", "shared"])


def _by_group(rows: DataFrame, group: list[str], sets: DataFrame, paired: bool) -> DataFrame:
    """New links among ``rows`` (``group``, ``key``, ``label``, ``members``: rows of the group).

    Groups larger than ``PIECE`` are cut by a hash; ``paired``: each piece meets every other.
    """
    pieces = F.ceil(F.col("members") / PIECE).cast("int")
    cut = rows.withColumn("_pieces", pieces).withColumn(
        "_piece", F.pmod(F.xxhash64("key", *group), F.col("_pieces")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("_pieces") - 1)) if paired else F.col("_piece")
    met = cut.withColumn("_other", other).select(
        *group, F.least("_piece", "_other").alias("_a"), F.greatest("_piece", "_other").alias("_b"),
        (F.col("_piece") > F.col("_other")).cast("int").alias("side"), "key", "label")
    return met.join(sets, "key").groupBy(*group, "_a", "_b").applyInPandas(_group_edges, "u string, v string")


def text_components(docs: DataFrame) -> DataFrame:
    """``key, n, component`` for every distinct normalised text: set size, and least key linked with it.

    ``docs`` has ``text``, and ``_key`` and ``_normal`` of ``normal_text``.
    """
    at = layout(docs, block_bytes=BLOCK_BYTES)
    texts = (docs.select(F.col("_key").alias("key"), F.col("_normal").alias("normal"))
             .mapInPandas(_first_of_task, "key string, normal string")
             .withColumn("block", block_of(F.xxhash64("key"), at)).repartition(at.blocks, "block"))
    counted = totals(texts, _block_keys, at)
    sized = staged(texts.groupBy("block").cogroup(counted.groupBy("block")).applyInPandas(
        _with_rare_shingles, "key string, n long, shingles binary, least array<long>, shared array<long>"), "shingles")
    candidates = sized.where("shingles is not null")
    sets = candidates.select("key", "shingles")

    hashed = candidates.select("key", F.posexplode("least").alias("_turn", "_least"))
    group = ["_turn", "_least"]
    groups = hashed.groupBy(*group).agg(F.count("*").alias("members")).where("members > 1")
    first = staged(_by_group(hashed.join(groups, group).withColumn("label", F.col("key")), group, sets, False),
                   "links")
    label = components(first)

    shared = staged(candidates.select("key", F.explode("shared").alias("_shingle"))
                    .join(label, F.col("key") == F.col("node"), "left")
                    .select("key", "_shingle", F.coalesce("component", "key").alias("label")), "shared")
    mixed = (shared.groupBy("_shingle")
             .agg(F.min("label").alias("_from"), F.max("label").alias("_to"), F.min("key").alias("v"))
             .where("_from <> _to").select("_shingle", "v"))
    # texts that such shingles tie together meet once, not once for each shingle
    family = components(shared.join(mixed, "_shingle").select(F.col("key").alias("u"), "v"))
    sizes = family.groupBy("component").agg(F.count("*").alias("members"))
    rows = (family.join(sizes, "component").join(shared.select(F.col("key").alias("node"), "label").distinct(), "node")
            .select(F.col("component").alias("_family"), F.col("node").alias("key"), "label", "members"))
    second = staged(_by_group(rows, ["_family"], sets, True), "links")
    final = components(first.union(second))
    return sized.select("key", "n").join(final, F.col("key") == F.col("node"), "left").select(
        "key", "n", F.coalesce("component", "key").alias("component"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id``: a row per row of ``docs``, exact.

    Texts are linked when their sets of distinct five-word shingles have a Jaccard
    similarity of 0.8 or more; a shorter text is one shingle.  Texts without words are
    linked with nothing.  The component's id is its least doc_id; a null id never is the
    least, and a component of null ids has none.  Repeated rows are rows of one text.
    """
    named = normal_text(docs.select("doc_id", "text"))
    texts = staged(text_components(named), "texts")
    members = staged(named.select("doc_id", F.col("_key").alias("key")), "members")
    least = (members.groupBy("key").agg(F.min("doc_id").alias("_id")).join(texts, "key"))
    of = least.groupBy("component").agg(F.min("_id").alias("component_id"))
    by_text = staged(texts.join(of, "component").select("key", "n", "component_id"), "text-components")
    return members.join(by_text, "key").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component, that of the least doc_id; texts without words all stay.

    Of the rows with that id the one with the least content hash stays, a null id comes last, and of
    rows that repeat each other one stays.  Columns keep their names and values, whatever they are called.

    The row to stay is found by id and hashes alone.  Documents then meet a narrow table
    of those, and only rows that were there several times are grouped.
    """
    id_, content_, copies = free_names(docs.columns, "id", "content", "copies")
    content = F.xxhash64("text")
    named = normal_text(docs.select("doc_id", "text"))
    texts = staged(text_components(named), "texts")
    members = named.select("doc_id", content.alias("content"), F.col("_key").alias("key"))
    alike = members.groupBy("key", "doc_id", "content").agg(F.count("*").alias("copies"))
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "content", "copies"))
    least = alike.groupBy("key").agg(best.alias("best")).join(texts.where("n > 0"), "key")
    stay = staged(least.groupBy("component").agg(F.min("best").alias("best")).select(
        F.col("best.doc_id").alias(id_), F.col("best.content").alias(content_), F.col("best.copies").alias(copies)), "stay")
    wordless = ~F.coalesce("text", F.lit("")).rlike("[^\\x20\\x09-\\x0D]")
    met = docs.where(~wordless).join(stay, F.col("doc_id").eqNullSafe(F.col(id_)) & (content == F.col(content_)))
    several = met.where(F.col(copies) > 1).groupBy(id_, content_).agg(
        F.first(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias(copies)).select(f"{copies}.*")
    return met.where(F.col(copies) == 1).select(*docs.columns).union(several).union(docs.where(wordless))
