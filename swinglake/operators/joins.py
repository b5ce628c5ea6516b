"""The three joins of the silver layer; inputs may be batch tables or streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILTER_BITS = 1 << 26     # of a key filter: a million 64-bit words at most, some 16 MB


def possible_matches(wide: DataFrame, keys: Sequence[str], narrow: DataFrame, narrow_keys: Sequence[str],
                     bits: int = FILTER_BITS) -> DataFrame:
    """``wide`` rows whose ``keys`` may be among those of ``narrow``; nearly all others are left out.

    A Bloom filter with one hash goes to the scan of the wide rows, before they are shuffled.
    It is made on Spark as 64-bit words of set bits, of which there are at most ``bits / 64``, so
    what is broadcast is bounded whatever the number of keys; beyond some ten million keys
    more and more rows pass that match nothing, which the join drops afterwards.
    Both tables are batch tables; keys are compared as the types of ``wide``.
    """
    kinds = dict(wide.dtypes)

    def slot(columns: Sequence[Column]) -> Column:
        return F.pmod(F.xxhash64(*columns), F.lit(bits))

    set_bits = narrow.select(slot([F.col(n).cast(kinds[k]) for k, n in zip(keys, narrow_keys)]).alias("_bit"))
    words = set_bits.groupBy(F.expr("_bit div 64").alias("_word")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(_bit % 64 AS INT)))").alias("_mask"))
    own = slot([F.col(k) for k in keys])
    probed = wide.withColumn("_slot", own)
    hit = (F.expr("_slot div 64") == words["_word"]) & F.expr("getbit(_mask, CAST(_slot % 64 AS INT)) = 1")
    return probed.join(F.broadcast(words), hit, "left_semi").drop("_slot")


def match_key_frames(key_frames: DataFrame, motion: DataFrame) -> DataFrame:
    """Key frames with the motion rows at the same rounded time of the same swing.

    Inner, and many-to-many: several key frames may fall on one motion row.  The
    key holds the time as well as the event, so a long event is spread over tasks.
    """
    kf = key_frames.withColumnRenamed("input_event", "input_event_kf")
    on = (kf["input_event_kf"] == motion["input_event"]) & (
        kf["KeyFrameIndicesAdjusted"] == motion["TimestampRounded"])
    return kf.join(motion, on, "inner").drop("input_event_kf")


def align_frames(frames: DataFrame, motion: DataFrame) -> DataFrame:
    """Tracker frames with the motion rows in the same place of the same swing."""
    fr = frames.withColumnsRenamed(
        {"input_event": "input_event_fr", "row_number": "row_number_fr"})
    on = (fr["input_event_fr"] == motion["input_event"]) & (
        fr["row_number_fr"] == motion["row_number"])
    return fr.join(motion, on, "inner").drop("input_event_fr", "row_number_fr")


def enrich(df: DataFrame, params: DataFrame, salts: int = 1) -> DataFrame:
    """Left join of the per-event game parameters.

    The parameter table has a row per event, so it grows with the data and is not
    forced to be broadcast: Spark does so below its size limit, and beyond it AQE
    splits an over-long event of a batch join.  A stream has no AQE; there
    ``salts`` > 1 spreads each event over that many tasks, at the price of that
    many copies of the (narrow) parameter rows.
    """
    bps = params.withColumnRenamed("input_event", "input_event_bps")
    on = df["input_event"] == bps["input_event_bps"]
    if salts > 1:
        spread_by = [c for c, kind in df.dtypes if not kind.startswith(("map", "array", "struct"))]
        df = df.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
        copies = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
        bps = bps.withColumn("_salt_bps", copies)
        on = (df["input_event"] == bps["input_event_bps"]) & (df["_salt"] == bps["_salt_bps"])
    return df.join(bps, on, "left").drop("input_event_bps", "_salt", "_salt_bps")
