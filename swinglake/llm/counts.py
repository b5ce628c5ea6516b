"""Exact counts of many hashed keys over a corpus, returned to where the keys occur.

The corpus lies in blocks.  A block sends its distinct keys, sorted, in one row per
bucket (a range of key values); a bucket adds up the counts of all blocks and answers
each block with the totals in the order asked.  Rows carry compressed arrays, so a key
costs a few bytes in the executors too, and blocks and buckets have bounded size however
large the corpus.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swinglake.llm.common import give_back

BLOCK_BYTES = 8 << 20     # text in a block
BUCKET_KEYS = 1_500_000   # keys that a bucket is asked for, about
WORD_BYTES = 6            # of text per word, for the number of buckets only

Keys = Callable[[pd.DataFrame], tuple[np.ndarray, np.ndarray]]


@dataclass(frozen=True)
class Layout:
    blocks: int
    buckets: int


def layout(docs: DataFrame, keys_per_word: int = 1, block_bytes: int = BLOCK_BYTES) -> Layout:
    """Blocks and buckets for the bytes of ``text``."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    return Layout(max(1, math.ceil(size / block_bytes)),
                  max(1, math.ceil(size * keys_per_word / WORD_BYTES / BUCKET_KEYS)))


def block_of(hashed: Column, at: Layout) -> Column:
    return F.pmod(hashed, F.lit(at.blocks)).cast("int")


def small(values: np.ndarray) -> bytes:
    """Bytes of equal weight together, compressed, after their size: the high ones are mostly zero."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()
    return len(planes).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def large(data: bytes, kind: str) -> np.ndarray:
    size, width = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    planes = pa.decompress(memoryview(data)[8:], size, codec="zstd")
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(width, -1).T).view(kind).ravel()


def _edges(buckets: int) -> np.ndarray:
    return np.array([(i << 64) // buckets for i in range(1, buckets)], dtype=np.uint64)


def totals(blocks: DataFrame, keys: Keys, at: Layout,
           tally: Callable[[np.ndarray, np.ndarray], list[int]] | None = None, whole: bool = False) -> DataFrame:
    """``block, bucket, totals`` for a table with a column ``block``.

    ``keys`` turns the rows of a block into distinct keys (sorted uint64) and their counts
    there (uint32); it is run once more where the totals are used, see ``answers``.
    ``tally`` makes some numbers of a bucket's distinct keys and totals; they come as rows
    of blocks -1, -2, ... with a column ``tally``, see ``tallied``.  With ``whole`` each row is a block, and none is shuffled.
    """
    edges = _edges(at.buckets)

    def ask(frame: pd.DataFrame) -> pd.DataFrame:
        distinct, counts = keys(frame)
        cuts = np.concatenate([[0], np.searchsorted(distinct, edges), [len(distinct)]])
        rows = []
        for bucket in np.flatnonzero(cuts[:-1] < cuts[1:]).tolist():
            a, b = cuts[bucket], cuts[bucket + 1]
            steps = np.diff(distinct[a:b], prepend=np.uint64(0))
            rows.append((bucket, frame["block"].iat[0], small(steps), small(counts[a:b].astype("<u4"))))
        give_back()
        return pd.DataFrame(rows, columns=["bucket", "block", "keys", "counts"])

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        parts = [np.cumsum(large(k, "<u8"), dtype=np.uint64) for k in frame["keys"]]
        every = np.concatenate(parts)
        distinct, place = np.unique(every, return_inverse=True)
        counts = np.concatenate([large(c, "<u4") for c in frame["counts"]])
        total = np.zeros(len(distinct), np.uint64)
        np.add.at(total, place, counts.astype(np.uint64))
        answer = total.astype("<u8")[place]
        ends = np.cumsum([len(p) for p in parts])
        out = pd.DataFrame({"block": frame["block"], "bucket": frame["bucket"],
                            "totals": [small(a) for a in np.split(answer, ends[:-1])]})
        if tally is not None:
            numbers = [int(number) for number in tally(distinct, total)]
            out = pd.concat([out.assign(tally=0), pd.DataFrame({
                "block": [-1 - i for i in range(len(numbers))], "bucket": frame["bucket"].iat[0],
                "totals": b"", "tally": numbers})], ignore_index=True)
        give_back()
        return out

    def ask_each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for i in range(len(frame)):
                yield ask(frame.iloc[i:i + 1])

    shape = "bucket int, block int, keys binary, counts binary"
    asked = blocks.mapInPandas(ask_each, shape) if whole else blocks.groupBy("block").applyInPandas(ask, shape)
    answered = "block int, bucket int, totals binary" + ", tally long" * (tally is not None)
    return asked.groupBy("bucket").applyInPandas(add, answered)


def answers(frame: pd.DataFrame) -> np.ndarray:
    """Totals of a block's keys, in the order of the sorted keys, from its rows of ``totals``."""
    parts: Iterable[bytes] = frame.sort_values("bucket")["totals"]
    return np.concatenate([np.empty(0, "<u8"), *(large(p, "<u8") for p in parts)]).view(np.int64)


def tallied(counted: DataFrame, numbers: int) -> list[int]:
    """Sums of the buckets' tallies; they are added up where they lie, and no totals are read for them."""
    rows = counted.where("block < 0").groupBy("block").agg(F.sum("tally").alias("n")).collect()
    found = {-1 - r["block"]: r["n"] for r in rows}
    return [found.get(i, 0) for i in range(numbers)]
