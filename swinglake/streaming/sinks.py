"""Checkpointed sinks.  All of them take what has arrived and then stop."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter
from pyspark.sql.types import StructType

BATCH = "batch_id"


def checkpoint_for(base: str, layer: str, table: str) -> str:
    """One progress folder per table."""
    return f"{base.rstrip('/')}/{layer}/{table}_checkpoint"


def drain(writer: DataStreamWriter) -> StreamingQuery:
    """Run until everything available is processed; failures are raised here."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def write_stream(df: DataFrame, table: str, checkpoint: str, fmt: str = "parquet") -> StreamingQuery:
    """Append a stream to a table folder, each row once; or to a catalog table, when
    ``table`` is a name and not a path."""
    writer = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if "/" in table:
        return drain(writer.option("path", table))
    query = writer.trigger(availableNow=True).toTable(table)
    query.awaitTermination()
    return query


def for_each_batch(df: DataFrame, fn: Callable[[DataFrame, int], None],
                   checkpoint: str) -> StreamingQuery:
    return drain(df.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint))


def write_stream_batches(df: DataFrame, fn: Callable[[DataFrame, int], DataFrame | Iterable[DataFrame]],
                         path: str, checkpoint: str) -> StreamingQuery:
    """Transform each micro-batch and append the result to a table folder.

    A batch owns the ``batch_id=N`` folder and overwrites it, so a batch that is
    run again after a failure leaves its rows once.  A result may come in pieces, written one after the
    other; a failure between them leaves some, until the batch is run again.
    """
    def append(batch: DataFrame, batch_id: int) -> None:
        made, mode = fn(batch, batch_id), "overwrite"
        for rows in [made] if isinstance(made, DataFrame) else made:
            rows.write.mode(mode).parquet(f"{path}/{BATCH}={batch_id}")
            mode = "append"

    return for_each_batch(df, append, checkpoint)


def read_batches(spark: SparkSession, path: str, empty: StructType | None = None,
                 keep: str | None = None) -> DataFrame:
    """The table :func:`write_stream_batches` wrote; columns of all batches, ``keep`` being
    :data:`BATCH` to have their numbers too.  While there is no batch the table is empty
    and has the columns ``empty``, where these are given."""
    try:
        rows = spark.read.option("mergeSchema", True).parquet(path)
        return rows if keep else rows.drop(BATCH)
    except AnalysisException as missing:
        if empty is None or missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], StructType([*empty.fields]).add(keep, "integer") if keep else empty)


def drain_to_batch(stream: DataFrame, staging: str, checkpoint: str) -> DataFrame:
    """Everything a stream has, as a batch table in ``staging``."""
    write_stream(stream, staging, checkpoint)
    return stream.sparkSession.read.schema(stream.schema).parquet(staging)


def union_batches(batches: Iterable[DataFrame]) -> DataFrame:
    """UNION ALL by position."""
    return reduce(DataFrame.union, batches)


def within(left: DataFrame, right: DataFrame, event_time: str,
           delay: str) -> tuple[DataFrame, DataFrame, Column]:
    """Bound the state of a stream-stream join: watermarks for both sides, and the
    condition that joined rows arrived at most ``delay`` apart.  Rows further apart
    are not joined, so this is off unless asked for."""
    name = f"{event_time}_other"
    left = left.withWatermark(event_time, delay)
    right = right.withColumnRenamed(event_time, name).withWatermark(name, delay)
    span = F.expr(f"INTERVAL {delay}")
    close = (left[event_time] >= right[name] - span) & (left[event_time] <= right[name] + span)
    return left, right, close
