"""Reading tables and staging results for the corpus operators."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from swinglake.session import scratch_dir

# Spark setting: an execution's shuffle files go when it ends, not when the driver
# happens to collect garbage.
_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    A later pass reads the files instead of repeating the work, whichever executors
    are lost meanwhile, and the shuffles behind them are dropped at once.
    """
    spark = df.sparkSession
    at = scratch_dir(spark, name)
    before = spark.conf.get(_TIDY, None)
    spark.conf.set(_TIDY, "true")
    try:
        df.write.options(**options).parquet(at)
    finally:
        spark.conf.unset(_TIDY) if before is None else spark.conf.set(_TIDY, before)
    return spark.read.schema(df.schema).parquet(at)


def give_back() -> None:
    """Hand memory that a Python worker has freed back to the system; workers are used again by
    later stages, and what one stage needed would otherwise count beside the needs of the next."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc has it
    if trim is not None:
        trim(0)


def free_names(taken: Iterable[str], *stems: str) -> list[str]:
    """Column names made of ``stems`` that clash with none of ``taken``, whatever their case."""
    used, out = {c.lower() for c in taken}, []
    for stem in stems:
        name = f"_{stem}"
        while name in used:
            name += "_"
        used.add(name)
        out.append(name)
    return out


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    only_ascii = F.octet_length(text) == F.char_length(text)      # then lower() does the same, faster
    return F.when(only_ascii, F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def unit_hash(*parts: Column) -> Column:
    """A number in [0, 1) decided by the parts: 52 bits of their MD5."""
    digits = F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13)
    return F.conv(digits, 16, 10).cast("bigint").cast("double") / F.lit(float(2 ** 52))
