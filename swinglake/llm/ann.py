"""Nearest neighbours by an inverted multi-index.

Vectors are cut in halves and each half is quantised by its own centroids, so K centroids
a half make K x K cells.  A query visits cells by the sum of its distances to
the two centroids, drawn from a heap, until they hold a given share of all distinct
vectors; what it meets there is ranked by the exact inner product.

Centroids are fitted on at most ``FIT`` vectors; every vector is indexed.  Cells lie in
parts of bounded size (a large cell is cut into several) and queries in blocks, and a
part meets a block in one group.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from swinglake.llm.common import staged

FIT = 20_000          # vectors the centroids are fitted on, at most
CENTROIDS = 32        # per half
SHARE = 0.6           # of the distinct vectors, in the cells a query visits
PART = 8_192          # vectors in a part
BLOCK = 1_024         # queries in a block
ROUNDS = 12


def usable(rows: DataFrame, length: int | None = None, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """``vec_id, v``: rows with an id and a finite, non-zero vector of ``length``, or of the commonest length.

    Null vectors, zero vectors and those with null or non-finite components take no part.
    """
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    kept = (rows.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("vec_id"), v.alias("v"))
            .where(F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0)))
    if length is not None:
        return kept.where(F.size("v") == length)
    lengths = kept.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), "n").limit(1).collect()
    return kept.where(F.size("v") == (lengths[0]["n"] if lengths else 0))


def kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Centroids by Lloyd's rounds from distinct rows spread over the sample; empty ones stay where they are."""
    start = np.unique(x, axis=0)
    centroids = start[np.linspace(0, len(start) - 1, min(k, len(start))).astype(int)].copy()
    for _ in range(rounds):
        near = nearest(x, centroids)
        for c in range(len(centroids)):
            if (near == c).any():
                centroids[c] = x[near == c].mean(axis=0)
    return centroids


def nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return ((centroids ** 2).sum(axis=1) - 2 * x @ centroids.T).argmin(axis=1)


class MultiIndex:
    """Centroids of both halves and, by cell, how many distinct vectors it holds."""

    def __init__(self, first: np.ndarray, second: np.ndarray):
        self.first, self.second, self.half = first, second, first.shape[1]
        self.weight = np.zeros(len(first) * len(second), dtype=np.int64)     # distinct vectors of each cell
        self.rows = np.zeros_like(self.weight)

    def cells(self, x: np.ndarray) -> np.ndarray:
        return nearest(x[:, :self.half], self.first) * len(self.second) + nearest(x[:, self.half:], self.second)

    def visit(self, q: np.ndarray, wanted: float, least: int = 0) -> Iterator[int]:
        """Cells by summed distance to both centroids until their distinct vectors reach ``wanted``
        and their rows ``least``.

        Distance is the negative inner product.  The heap holds the pairs next to those
        taken: (i, j) enters once its neighbours before it in both orders are out.
        """
        a, b = -(self.first @ q[:self.half]), -(self.second @ q[self.half:])
        order_a, order_b = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
        a, b = a[order_a].tolist(), b[order_b].tolist()
        taken = [0] * len(a)          # of row i, pairs taken so far
        heap, met, rows = [(a[0] + b[0], 0, 0)], 0, 0
        while heap and (met < wanted or rows < least):
            _, i, j = heapq.heappop(heap)
            taken[i] = j + 1
            cell = int(order_a[i]) * len(b) + int(order_b[j])
            if self.weight[cell]:
                met += int(self.weight[cell])
                rows += int(self.rows[cell])
                yield cell
            if i + 1 < len(a) and taken[i + 1] == j:
                heapq.heappush(heap, (a[i + 1] + b[j], i + 1, j))
            if j + 1 < len(b) and (i == 0 or taken[i - 1] > j + 1):
                heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))


def fit(vectors: DataFrame, limit: int = FIT, k: int = CENTROIDS) -> MultiIndex | None:
    """Centroids of at most ``limit`` vectors, taken in order of a hash of their ids; None without vectors."""
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(limit).select("v").toPandas()["v"]
    if not len(sample):
        return None
    x = np.array(sample.tolist())
    half = x.shape[1] // 2
    return MultiIndex(kmeans(x[:, :half], k), kmeans(x[:, half:], k))


def _parts(index: MultiIndex, rows: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """By cell, its first part and its number of parts; small cells share one."""
    first, pieces = np.zeros(len(index.weight), dtype=np.int64), np.ones(len(index.weight), dtype=np.int64)
    part, held = 0, 0
    for cell in range(len(index.weight)):
        n = rows.get(cell, 0)
        if held and held + n > PART:
            part, held = part + 1, 0
        first[cell], pieces[cell] = part, max(1, -(-n // PART))
        held += n
        if pieces[cell] > 1:
            part, held = part + int(pieces[cell]), 0
    return first, pieces


def _rank(entries: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """The ``k`` best of a part for each query of a block, by exact scores."""
    if not len(entries) or not len(queries):
        return pd.DataFrame(columns=["query_id", "vec_id", "score"])
    e, ids, cell = np.array(entries["v"].tolist()), entries["vec_id"].to_numpy(), entries["cell"].to_numpy()
    cells, column = np.unique(cell, return_inverse=True)
    out = []
    for at in range(0, len(queries), 128):
        some = queries.iloc[at:at + 128]
        q, own = np.array(some["v"].tolist()), some["vec_id"].to_numpy()
        visits = np.zeros((len(some), len(cells)), dtype=bool)
        for i, wanted in enumerate(some["cells"]):
            visits[i] = np.isin(cells, wanted)
        rough = np.where(visits[:, column] & (ids[None, :] != own[:, None]), q @ e.T, -np.inf)
        least = np.partition(rough, -k, axis=1)[:, -k] if rough.shape[1] > k else np.full(len(some), -np.inf)
        # products of matrices round by place; all that may tie are scored again, each alike
        slack = 1e-9 * (1 + np.abs(np.where(np.isfinite(least), least, 0)))
        for i in range(len(some)):
            near = np.flatnonzero((rough[i] >= least[i] - slack[i]) & np.isfinite(rough[i]))
            score = (e[near] * q[i]).sum(axis=1)
            best = np.lexsort((ids[near], -score))[:k]
            out.append(pd.DataFrame({"query_id": own[i], "vec_id": ids[near][best], "score": score[best]}))
    return pd.concat(out) if out else pd.DataFrame(columns=["query_id", "vec_id", "score"])


def search(rows: DataFrame, queries: DataFrame, k: int = 20, share: float = SHARE) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` largest inner products found, ties to the smaller id.

    ``rows`` and ``queries`` have ``vec_id`` and ``embedding``.  A query's own id is no candidate.  Of
    repeated queries one counts; repeated rows are candidates each.  A query visits cells until they
    hold ``share`` of the distinct vectors and ``k`` rows besides its own, or all cells.
    """
    spark = rows.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    vectors = usable(rows)
    index = fit(vectors)
    if index is None:
        return spark.createDataFrame([], schema)

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                yield frame.assign(cell=index.cells(np.array(frame["v"].tolist())))

    placed = staged(vectors.mapInPandas(assign, "vec_id long, v array<double>, cell int"), "cells")
    # a row per cell, of which there are as many as pairs of centroids
    held = (placed.groupBy("cell", F.xxhash64("v").alias("h")).agg(F.count("*").alias("n"))
            .groupBy("cell").agg(F.count("*").alias("distinct"), F.sum("n").alias("n")).collect())
    for r in held:
        index.weight[r["cell"]], index.rows[r["cell"]] = r["distinct"], r["n"]
    first, pieces = _parts(index, {r["cell"]: r["n"] for r in held})
    layout = spark.createDataFrame([(c, int(first[c]), int(pieces[c])) for c in range(len(first))],
                                   "cell int, first int, pieces int")
    wanted = share * float(index.weight.sum())

    def route(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for query, v, block in frame.itertuples(index=False):
                by_part: dict[int, list[int]] = {}
                for cell in index.visit(np.asarray(v), wanted, k + 1):
                    for piece in range(pieces[cell]):
                        by_part.setdefault(int(first[cell]) + piece, []).append(cell)
                out += [(query, v, block, part, cells) for part, cells in by_part.items()]
            yield pd.DataFrame(out, columns=["vec_id", "v", "block", "part", "cells"])

    asked = usable(queries, index.half + index.second.shape[1]).dropDuplicates(["vec_id"])
    blocks = max(1, -(-asked.count() // BLOCK))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    routed = asked.mapInPandas(route, "vec_id long, v array<double>, block int, part int, cells array<int>")
    entries = (placed.join(F.broadcast(layout), "cell")
               .withColumn("part", (F.col("first") + F.pmod(F.xxhash64("vec_id"), F.col("pieces"))).cast("int"))
               .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
               .select("vec_id", "v", "cell", "part", "block"))
    found = entries.groupBy("part", "block").cogroup(routed.groupBy("part", "block")).applyInPandas(
        lambda e, q: _rank(e, q, k), "query_id long, vec_id long, score double")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
