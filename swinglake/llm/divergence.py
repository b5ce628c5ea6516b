"""Audit of how far the sources of each language are from each other, over k-squared quadtrees.

Counts of terms form a matrix of groups (language and source) by terms.  It lies in tiles
of some hundred terms by some dozen groups; each is kept as a k-squared tree (k = 2), level by
level one bit for every quadrant, set where the quadrant holds a count.  Two tiles over the same terms are
traversed jointly for all pairs of their groups at once: where neither has a count a
quadrant's terms all have one price, known from the groups' totals alone, and is added without going
down; the leaves that are left are priced from their counts.  All of it in whole numbers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swinglake.llm.common import staged

LEAST_DOCUMENTS = 3
TERMS = 900            # terms in a tile, about
GROUPS = 64            # groups in a tile, at most
TOP_TERMS = 200
UNIT = 1_000_000_000   # what the shares of a group add up to, about
HELD = 600_000         # counts that a task keeps before it hands them on

# bytes that belong to terms are kept, A-Z in lower case; all others separate
_TO_TERMS = bytes(b if chr(b).isalpha() and b < 128 or b >= 128 else 32 for b in bytes(range(256)).lower())


# --- counts ----------------------------------------------------------------

def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, documents``: occurrences in a group, and rows of it with the term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: dict[tuple[str, str], Counter[bytes]] = {}
        rows: dict[tuple[str, str], Counter[bytes]] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, source), counts in n.items():
                seen, size = rows[lang, source], len(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * size, pa.string()), pa.array([source] * size, pa.string()),
                     pa.array(list(counts), pa.binary()).cast(pa.string()), pa.array(counts.values(), pa.int64()),
                     pa.array([seen[t] for t in counts], pa.int64())],
                    names=["lang", "source", "term", "n", "documents"])
            n.clear()
            rows.clear()

        held = 0
        for batch in batches:
            for lang, source, text in zip(*(batch.column(i).to_pylist() for i in range(2)), batch.column(2)):
                terms = text.as_py().translate(_TO_TERMS).split()
                counts = n.setdefault((lang, source), Counter())
                before = len(counts)
                counts.update(terms)
                rows.setdefault((lang, source), Counter()).update(set(terms))
                held += len(counts) - before
                if held >= HELD:
                    yield from flush()
                    held = 0
        yield from flush()

    texts = docs.select(*_group(), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    # added up by the tasks already; all groups of a term come to one place, so that later sums need no exchange
    parts = texts.mapInArrow(count, "lang string, source string, term string, n long, documents long").repartition(
        "lang", "term")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))


def _group() -> tuple[Column, Column]:
    return tuple(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))


def kept_counts(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """``lang, source, term, n, n_lang``: counts of the terms that enough documents of the language hold."""
    over = Window.partitionBy("lang", "term")
    return (term_counts(docs).withColumns({
        "n_lang": F.sum("n").over(over), "in_documents": F.sum("documents").over(over)})
        .where(F.col("in_documents") >= least_documents).drop("documents", "in_documents"))


def group_totals(docs: DataFrame, counts: DataFrame) -> DataFrame:
    """``lang, source, number, total, lang_total, terms``: every group that occurs, numbered within its language."""
    every = docs.select(*_group()).distinct()
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    terms = counts.groupBy("lang", "term").agg(F.first("n_lang").alias("n_lang")).groupBy("lang").agg(
        F.count("*").alias("terms"), F.sum("n_lang").alias("lang_total"))
    none = F.lit(0).cast("long")
    return every.join(totals, ["lang", "source"], "left").join(terms, "lang", "left").select(
        "lang", "source", (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).alias("number"),
        *(F.coalesce(c, none).alias(c) for c in ("total", "lang_total", "terms")))


# --- shares and prices -----------------------------------------------------

def shares(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """1 + floor(UNIT * (count + 1) / total), by long division in base 1000 so that nothing overflows."""
    rest, out = counts + 1, np.zeros(np.broadcast(counts, totals).shape, np.int64)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, totals)
        out = out * 1000 + digit
    return 1 + out


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _share(count: str, total: str) -> Column:
    """As :func:`shares`; a product beyond 63 bits is made as a decimal."""
    wide = f"(CAST({count} + 1 AS DECIMAL(20,0)) * CAST({UNIT} AS DECIMAL(10,0))) div CAST({total} AS DECIMAL(20,0))"
    return F.expr(f"1 + CASE WHEN {count} < 9000000000 THEN ({count} + 1) * {UNIT}L div {total} ELSE {wide} END")


# --- trees -----------------------------------------------------------------

class QuadTree:
    """A k-squared tree (k = 2) over a square of ``1 << depth`` groups by as many terms.

    ``bits[level]`` has four bits for each node of the level, set where a quadrant holds a count; the n-th
    set bit of a level is node n of the next one, and of the last level it is leaf n, whose share is kept.
    """

    def __init__(self, rows: np.ndarray, columns: np.ndarray, counts: np.ndarray, totals: np.ndarray, depth: int):
        codes = np.zeros(len(rows), np.int64)
        for level in range(depth - 1, -1, -1):        # two bits a level: the quadrant's row and column
            codes = codes << 2 | (rows >> level & 1) << 1 | columns >> level & 1
        order = np.argsort(codes)
        codes, self.shares = codes[order], shares(counts[order], totals[rows[order]])
        self.bits, self.rank = [], []
        parents = np.zeros(min(1, len(codes)), np.int64)
        for level in range(depth):
            nodes = np.unique(codes >> 2 * (depth - 1 - level))
            bits = np.zeros(4 * len(parents), bool)
            bits[4 * np.searchsorted(parents, nodes >> 2) + (nodes & 3)] = True
            self.bits.append(bits)
            self.rank.append(np.cumsum(bits) - 1)
            parents = nodes

    def down(self, level: int, node: np.ndarray, quadrant: np.ndarray) -> np.ndarray:
        """Children of nodes; -1 stands for an all-zero quadrant, as node and as child."""
        if not len(self.shares):
            return np.full(len(node), -1)
        at = 4 * np.maximum(node, 0) + quadrant
        return np.where((node >= 0) & self.bits[level][at], self.rank[level][at], -1)


def pair_prices(a: QuadTree, b: QuadTree, depth: int, width: int, totals_a: np.ndarray,
                totals_b: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Sums of prices over ``width`` terms for each group of ``a`` against each of ``b``, and the other way round.

    ``totals``: occurrences plus terms of each group.  ``same``: both trees are one, and only pairs of
    two groups count.
    """
    zero_a, zero_b = shares(np.int64(0), totals_a), shares(np.int64(0), totals_b)
    ab = np.zeros((len(totals_a), len(totals_b)), np.int64)
    ba = np.zeros_like(ab)
    uniform = price(zero_a[:, None], zero_b[None, :]), price(zero_b[None, :], zero_a[:, None])
    here = np.zeros(1, np.int64)
    node_a, node_b, row_a, row_b, column = (np.full(1, 0 if len(a.shares) else -1), np.full(1, 0 if len(b.shares) else -1),
                                            here, here, here)
    quadrants = np.array([(i, j, c) for i in (0, 1) for j in (0, 1) for c in (0, 1)])
    for level in range(depth + 1):
        side = 1 << (depth - level)
        empty = (node_a < 0) & (node_b < 0)
        # all-zero on both sides: as many terms as the quadrant has, at the groups' own price
        spans = np.minimum((column + 1) * side, width) - column * side
        blocks = Counter()
        for i, j, n in zip(row_a[empty].tolist(), row_b[empty].tolist(), spans[empty].tolist()):
            blocks[i, j] += n
        for (i, j), n in blocks.items():
            where = np.s_[i * side:(i + 1) * side, j * side:(j + 1) * side]
            ab[where] += n * uniform[0][where]
            ba[where] += n * uniform[1][where]
        node_a, node_b, row_a, row_b, column = (x[~empty] for x in (node_a, node_b, row_a, row_b, column))
        if level == depth:
            break
        n = len(node_a)
        i, j, c = (np.tile(quadrants[:, k], n) for k in range(3))
        node_a, node_b, row_a, row_b, column = (np.repeat(x, 8) for x in (node_a, node_b, row_a, row_b, column))
        node_a, node_b = a.down(level, node_a, 2 * i + c), b.down(level, node_b, 2 * j + c)
        row_a, row_b, column, side = 2 * row_a + i, 2 * row_b + j, 2 * column + c, side // 2
        inside = (row_a * side < len(totals_a)) & (row_b * side < len(totals_b)) & (column * side < width)
        if same:
            inside &= row_a <= row_b
        node_a, node_b, row_a, row_b, column = (x[inside] for x in (node_a, node_b, row_a, row_b, column))
    p, q = (np.where(node >= 0, known[node], zero[row]) if len(known) else zero[row] for node, known, zero, row in (
        (node_a, a.shares, zero_a, row_a), (node_b, b.shares, zero_b, row_b)))
    square = ((p - q) * (p - q)).view(np.uint64)
    np.add.at(ab, (row_a, row_b), (square // q.view(np.uint64)).view(np.int64))
    np.add.at(ba, (row_a, row_b), (square // p.view(np.uint64)).view(np.int64))
    if same:      # each pair was met once, from its smaller side; within a uniform block from both
        low = np.tril_indices(len(totals_a))
        ab[low] = ba[low] = 0
    return ab, ba


def _tile_prices(frame: pd.DataFrame, per_block: int) -> pd.DataFrame:
    """Price sums of one tile of terms for the groups of blocks ``a`` and ``b``, and how many terms these are.

    Rows without a term name the groups of both blocks.
    """
    named = frame["term"].isna()
    lang, first, second = frame["lang"].iat[0], int(frame["a"].iat[0]), int(frame["b"].iat[0])
    groups = frame[named].sort_values("number")
    counted = frame[~named]
    column, terms = pd.factorize(counted["term"])
    sides = []
    depth = max(len(terms) - 1, per_block - 1, 1).bit_length()
    for block in dict.fromkeys((first, second)):
        own = groups[groups["number"] // per_block == block]
        mine = (counted["number"] // per_block == block).to_numpy()
        rows = counted["number"].to_numpy()[mine] % per_block
        totals = (own["total"] + own["terms"]).to_numpy()
        sides.append((QuadTree(rows, column[mine], counted["n"].to_numpy()[mine], totals, depth), totals,
                      own["number"].to_numpy()))
    (tree_a, totals_a, rows_a), (tree_b, totals_b, rows_b) = sides[0], sides[-1]
    ab, ba = pair_prices(tree_a, tree_b, depth, len(terms), totals_a, totals_b, first == second)
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(rows_a)), np.arange(len(rows_b)), indexing="ij"))
    if first == second:
        i, j = i[i < j], j[i < j]
    return pd.DataFrame({
        "lang": lang, "left": np.concatenate([rows_a[i], rows_b[j]]), "right": np.concatenate([rows_b[j], rows_a[i]]),
        "value": np.concatenate([ab[i, j], ba[i, j]]), "columns": np.int64(len(terms))})


def pair_values(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, left, right, value``: sums over all kept terms, for each two groups (numbers) of a language with terms."""
    per_block = GROUPS
    tiles = F.ceil(F.col("terms") / TERMS)
    blocks = groups.groupBy("lang").agg((F.floor(F.max("number") / per_block) + 1).cast("int").alias("blocks"))
    sized = groups.where("terms > 0").join(blocks, "lang").withColumn("block", F.floor(F.col("number") / per_block).cast("int"))
    own = ("lang", "number", "total", "terms")
    entries = counts.join(sized, ["lang", "source"]).select(
        *own, "term", "n", F.pmod(F.xxhash64("term"), tiles).alias("tile"), "block", "blocks")
    # each tile has all its groups, also those without any of its terms
    names = sized.select(*own, F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("n"),
                         F.explode(F.sequence(F.lit(0).cast("long"), tiles - 1)).alias("tile"), "block", "blocks")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    met = entries.unionByName(names).withColumn("other", other).select(
        *own, "term", "n", "tile", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"))
    sums = met.groupBy("lang", "tile", "a", "b").applyInPandas(
        lambda frame: _tile_prices(frame, per_block), "lang string, left int, right int, value long, columns long")
    summed = sums.groupBy("lang", "left", "right").agg(F.sum("value").alias("value"), F.sum("columns").alias("columns"))
    side = {s: groups.select("lang", F.col("number").alias(s), "terms", (F.col("total") + F.col("terms")).alias(f"{s}_total"))
            for s in ("left", "right")}
    # terms that no group of either block holds: one more all-zero quadrant
    p, q = (F.expr(f"1 + {UNIT} div {s}_total") for s in ("left", "right"))
    rest = (F.col("terms") - F.col("columns")) * F.expr("(p - q) * (p - q) div q")
    return (summed.join(side["left"], ["lang", "left"]).join(side["right"].drop("terms"), ["lang", "right"])
            .withColumns({"p": p, "q": q}).select("lang", "left", "right", (F.col("value") + rest).alias("value")))


def audit(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, top_terms: int = TOP_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank``: divergences of each group of documents.

    A group is a language and a source.  Part ``pair``: for every other source of the language the sum of
    ``floor((p - q)^2 / q)`` over the language's terms, p and q being the smoothed shares of the
    group and of the other one.  Part ``term``: the group's terms with a larger share than in the whole language,
    by the same measure against it, the first ``top_terms``.  Terms are runs of letters and
    characters beyond ASCII, A-Z in lower case, in at least ``least_documents`` rows of the language.

    Null text, language and source are empty texts; repeated rows count each; a language
    without terms has pairs of value 0; other columns play no part.  Ties go to the lesser item.
    """
    docs = docs.select("text", "lang", "source")
    counts = staged(kept_counts(docs, least_documents), "term-counts")
    groups = staged(group_totals(docs, counts), "groups")
    names = groups.select("lang", "number", "source")
    valued = staged(pair_values(counts, groups), "pair-values")
    left, right = (names.toDF("lang", side, name) for side, name in (("left", "source"), ("right", "item")))
    pairs = valued.join(left, ["lang", "left"]).join(right, ["lang", "right"]).select("lang", "source", "item", "value")
    bare = groups.where("terms = 0").select("lang", "source")
    none = bare.join(bare.withColumnRenamed("source", "item"), "lang").where("source <> item").withColumn(
        "value", F.lit(0).cast("long"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order)
    by_pair = pairs.unionByName(none).withColumn("rank", rank)
    priced = (counts.join(groups, ["lang", "source"])
              .withColumns({"p": _share("n", "(total + terms)"), "q": _share("n_lang", "(lang_total + terms)")})
              .where("p > q").select("lang", "source", F.col("term").alias("item"),
                                     F.expr("(p - q) * (p - q) div q").alias("value")))
    by_term = priced.withColumn("rank", rank).where(F.col("rank") <= top_terms)
    shown = lambda part, df: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
    return shown("pair", by_pair).unionByName(shown("term", by_term))
