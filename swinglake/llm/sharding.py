"""Sharding by fixed virtual slots.

A record's keys hash to one of thousands of slots; a versioned map says which shard
has which slot.  Rebalancing weighs the slots by their bytes and edits the map:
slots leave shards that are too full, records are never hashed anew.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SLOTS = 8192


@dataclass(frozen=True)
class SlotMap:
    """``shard_of[slot]``; each edit makes a map of the next version."""

    version: int
    shards: int
    shard_of: np.ndarray

    @staticmethod
    def even(shards: int, slots: int = SLOTS) -> SlotMap:
        """The map before any byte is known: slots dealt out in turn."""
        return SlotMap(1, shards, np.arange(slots) % shards)

    def rebalanced(self, weights: np.ndarray, shards: int | None = None) -> SlotMap:
        """The next version, with shard weights as equal as slots allow.

        Shards above the mean give up slots, largest first, and these go to the
        lightest shards.  Then the heaviest and lightest shard settle by a move or a
        swap as long as that narrows the gap between them.
        """
        n = shards or self.shards
        of, mean = self.shard_of.copy(), weights.sum() / n
        homeless = list(np.flatnonzero(of >= n))
        load = np.bincount(of[of < n], weights=weights[of < n], minlength=n)
        for shard in np.flatnonzero(load > mean):
            for slot in sorted(np.flatnonzero(of == shard), key=lambda s: (-weights[s], s)):
                if 0 < weights[slot] <= load[shard] - mean:
                    load[shard] -= weights[slot]
                    homeless.append(slot)
        heap = [(float(x), shard) for shard, x in enumerate(load)]
        heapq.heapify(heap)
        for slot in sorted(homeless, key=lambda s: (-weights[s], s)):
            light, shard = heap[0]
            of[slot] = shard
            heapq.heapreplace(heap, (light + float(weights[slot]), shard))
        _settle(of, weights, n)
        return SlotMap(self.version + 1, n, of)

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [(slot, int(shard)) for slot, shard in enumerate(self.shard_of)]
        return spark.createDataFrame(rows, "virtual_slot int, shard int").coalesce(1)

    def save(self, spark: SparkSession, path: str) -> None:
        """Versions lie side by side and are never overwritten."""
        (self.frame(spark).withColumn("shards", F.lit(self.shards))
         .write.mode("errorifexists").parquet(f"{path}/version={self.version}"))

    @staticmethod
    def load(spark: SparkSession, path: str, version: int) -> SlotMap:
        rows = spark.read.parquet(f"{path}/version={version}").orderBy("virtual_slot").collect()
        return SlotMap(version, rows[0]["shards"], np.array([r["shard"] for r in rows]))


def _settle(of: np.ndarray, weights: np.ndarray, n: int, steps: int = 2000) -> None:
    """Moves or swaps slots between the heaviest and lightest shard, in place."""
    load = np.bincount(of, weights=weights, minlength=n)
    for _ in range(steps):
        heavy, light = int(load.argmax()), int(load.argmin())
        gap = load[heavy] - load[light]
        mine, theirs = np.flatnonzero(of == heavy), np.flatnonzero(of == light)
        gives = weights[mine]
        order = np.argsort(weights[theirs], kind="stable")
        theirs = np.append(theirs[order], -1)      # -1: nothing comes back
        takes = np.append(weights[theirs[:-1]], 0.0)
        rank = np.argsort(takes, kind="stable")
        theirs, takes = theirs[rank], takes[rank]
        at = np.clip(np.searchsorted(takes, gives - gap / 2), 0, len(takes) - 1)
        best = min(((abs(gives[i] - takes[j] - gap / 2), i, j)
                    for i in range(len(mine)) for j in {int(at[i]), max(int(at[i]) - 1, 0)}),
                   default=None)
        if best is None:
            return
        _, i, j = best
        moved = gives[i] - takes[j]
        if not 0 < moved < gap:
            return
        of[mine[i]] = light
        if theirs[j] >= 0:
            of[theirs[j]] = heavy
        load[heavy] -= moved
        load[light] += moved


def with_slots(docs: DataFrame, keys: tuple[str, ...] = ("doc_id",), slots: int = SLOTS) -> DataFrame:
    """Adds ``virtual_slot``, ``size`` (UTF-8 bytes of the text, plus 8) and ``text_crc32``.

    Rows without any key are told apart by their text; a null text counts as empty.
    """
    text = F.coalesce("text", F.lit(""))
    missing = F.lit(True)
    for k in keys:
        missing = missing & F.col(k).isNull()
    hashed = F.when(missing, F.xxhash64(text)).otherwise(F.xxhash64(*keys))
    return (docs
            .withColumn("virtual_slot", F.pmod(hashed, F.lit(slots)).cast("int"))
            .withColumn("size", (F.octet_length(text) + 8).cast("long"))
            .withColumn("text_crc32", F.crc32(text.cast("binary"))))


def slot_weights(slotted: DataFrame, slots: int = SLOTS) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and rows by slot: as many numbers as there are slots, whatever the input."""
    weights, rows = np.zeros(slots), np.zeros(slots, dtype=np.int64)
    for r in slotted.groupBy("virtual_slot").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect():
        weights[r["virtual_slot"]], rows[r["virtual_slot"]] = r["b"], r["n"]
    return weights, rows


def place(slotted: DataFrame, slot_map: SlotMap, rows: np.ndarray) -> DataFrame:
    """Adds ``shard`` and ``slot``, a row's place in its shard, counted from 0.

    Rows are numbered inside their virtual slot and start where the slot starts, so
    no task sorts a whole shard.  The map has one row per slot and is broadcast.
    """
    start, seen = np.zeros(len(rows), dtype=np.int64), np.zeros(slot_map.shards, dtype=np.int64)
    for slot, shard in enumerate(slot_map.shard_of):
        start[slot] = seen[shard]
        seen[shard] += rows[slot]
    spark = slotted.sparkSession
    starts = spark.createDataFrame(
        [(s, int(slot_map.shard_of[s]), int(start[s])) for s in range(len(rows))],
        "virtual_slot int, shard int, slot_start long")
    order = [F.col(c) for c in ("doc_id", "text_crc32", "size")]
    within = F.row_number().over(W.partitionBy("virtual_slot").orderBy(*order)) - 1
    return (slotted.withColumn("_within", within)
            .join(F.broadcast(starts), "virtual_slot")
            .withColumn("slot", F.col("slot_start") + F.col("_within"))
            .drop("slot_start", "_within"))
