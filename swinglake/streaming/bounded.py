"""A stream-stream join whose state ends, with a side table for rows that find no partner.

Both streams carry a time, best that of arrival.  A row waits for its partner until the
watermark says that none can come any more, and then leaves the state: through a full outer
join, so it is written and not lost.  At any moment

    matched + side table + waiting = what has come in

where waiting rows are read from the state itself.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swinglake.streaming.sinks import read_batches

OUTCOME = "outcome"
MATCHED, LEFT, RIGHT = "matched", "left", "right"
_AT = "_at"


@dataclass(frozen=True)
class BatchState:
    """What a micro-batch left behind."""
    batch_id: int
    watermark: str | None
    rows_in_state: int
    late: int


def _side(stream: DataFrame, side: str, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """Keys, time and the whole row of one side, rows without a time left out."""
    timed = stream.where(F.col(event_time).isNotNull()).withWatermark(event_time, delay)
    return timed.select(F.struct(*stream.columns).alias(side), F.col(event_time).alias(side + _AT),
                        *[F.col(k).alias(f"{side}_{i}") for i, k in enumerate(keys)])


def paired(left: DataFrame, right: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """``outcome, left, right``: rows of two streams with equal ``keys`` whose times are at most
    ``delay`` apart; each pair once, and each row without a partner once, when none can come any more.

    ``left`` and ``right`` are whole rows, so their columns may have the same names.  A null key has no
    partner.  A row without a time has none either, and is told at once.  Repeated rows pair
    each with each.
    """
    a, b = _side(left, LEFT, keys, event_time, delay), _side(right, RIGHT, keys, event_time, delay)
    span = F.expr(f"INTERVAL {delay}")
    on = (F.col(LEFT + _AT) >= F.col(RIGHT + _AT) - span) & (F.col(LEFT + _AT) <= F.col(RIGHT + _AT) + span)
    for i in range(len(keys)):
        on = on & (F.col(f"{LEFT}_{i}") == F.col(f"{RIGHT}_{i}"))
    # a side that is there has its time; whole rows are null where they are missing
    outcome = F.when(F.col(RIGHT + _AT).isNull(), LEFT).when(F.col(LEFT + _AT).isNull(), RIGHT).otherwise(MATCHED)
    rows = a.join(b, on, "full_outer").select(outcome.alias(OUTCOME), LEFT, RIGHT)
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    for stream, side, other in ((left, LEFT, RIGHT), (right, RIGHT, LEFT)):
        row, none = F.struct(*stream.columns).cast(kinds[side]), F.lit(None).cast(kinds[other])
        sides = {side: row, other: none}
        rows = rows.unionByName(stream.where(F.col(event_time).isNull()).select(
            F.lit(side).alias(OUTCOME), sides[LEFT].alias(LEFT), sides[RIGHT].alias(RIGHT)))
    return rows


def drain_paired(rows: DataFrame, path: str, checkpoint: str) -> list[BatchState]:
    """Take what has arrived and write it by outcome; tell the state after each micro-batch.

    A batch owns its folder and is written in one pass, so a batch that is run again leaves
    its rows once.  Spark drops rows that come behind the watermark; that is an error
    here, raised with their number after the run.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy(OUTCOME).parquet(f"{path}/batch_id={batch_id}")

    query = (rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    seen: dict[int, BatchState] = {}
    ended = False
    while not ended:                     # Spark keeps the last hundred reports only
        ended = query.awaitTermination(1)
        for progress in query.recentProgress:
            for join in progress["stateOperators"]:
                seen[progress["batchId"]] = BatchState(
                    progress["batchId"], progress.get("eventTime", {}).get("watermark"),
                    join["numRowsTotal"], join.get("numRowsDroppedByWatermark", 0))
    late = sum(s.late for s in seen.values())
    if late:
        raise RuntimeError(f"{late} rows came behind the watermark and were not joined: allow a longer delay")
    return [seen[i] for i in sorted(seen)]


def waiting(spark: SparkSession, checkpoint: str, side: str) -> DataFrame:
    """Rows of a side that are in the state and have no partner so far."""
    # the store of the rows themselves, where Spark also marks those that met a partner
    state = spark.read.format("statestore").option("storeName", f"{side}-keyWithIndexToValue").load(checkpoint)
    return state.select("value.*").where(~F.col("matched")).select(f"{side}.*")


def matches(spark: SparkSession, path: str) -> DataFrame:
    """``left, right`` of all pairs."""
    return read_batches(spark, path).where(F.col(OUTCOME) == MATCHED).select(LEFT, RIGHT)


def unmatched(spark: SparkSession, path: str, side: str) -> DataFrame:
    """The side table: rows of a side that no partner came for in time."""
    return read_batches(spark, path).where(F.col(OUTCOME) == side).select(f"{side}.*")
