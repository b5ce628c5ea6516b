"""Column profiles that are kept up: sketches of each batch in a table, merged on reading.

A run reads the batches that are new and no others.  Counts, least and largest values are exact;
distinct values are estimated by HyperLogLog (relative standard error 1.6 % at 4096
registers) and percentiles by KLL (a rank is off by less than 1.4 % of the rows, in 99 of 100 cases).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, NumericType, StructField

KEPT = ("column string, type string, n long, n_missing long, min_number double, max_number double, "
        "min_text string, max_text string, values binary, ranks binary, upto long")
_REGISTERS, _K = 12, 200


def _sketched(field: StructField) -> Column:
    c = F.col(f"`{field.name}`")
    numeric = isinstance(field.dataType, NumericType)
    number, words = (c.cast("double"), F.lit(None).cast("string")) if numeric else (F.lit(None).cast("double"), c.cast("string"))
    return F.struct(
        F.lit(field.name).alias("column"), F.lit(field.dataType.simpleString()).alias("type"),
        F.count(c).alias("n"), F.count(F.when(c.isNull(), 1)).alias("n_missing"),
        F.min(number).alias("min_number"), F.max(number).alias("max_number"),
        F.min(words).alias("min_text"), F.max(words).alias("max_text"),
        F.hll_sketch_agg(c.cast("string"), F.lit(_REGISTERS)).alias("values"),
        (F.kll_sketch_agg_double(number, _K) if numeric else F.lit(None).cast("binary")).alias("ranks"))


def _kept(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(KEPT).parquet(path)
    except AnalysisException as missing:      # the first run
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], KEPT)


def extend_profile(rows: DataFrame, path: str, batch: str) -> int | None:
    """Sketch the batches that came after the last run; the number of the last one, None if nothing is new.

    ``rows`` has the number of its batch as a partition column, so older batches are not
    read.  A run's rows are a folder named after the last batch they reach to; a run that failed before
    it was whole does it again.  Columns of plain types only; they may be more in later batches.
    """
    last = _kept(rows.sparkSession, path).agg(F.max("upto")).first()[0]
    new = rows if last is None else rows.where(F.col(batch) > last)
    reached = new.select(batch).agg(F.max(batch)).first()[0]
    plain = [f for f in rows.schema.fields
             if f.name != batch and isinstance(f.dataType, AtomicType) and f.dataType.typeName() != "binary"]
    if reached is None or not plain:
        return None
    sketches = new.agg(F.array(*map(_sketched, plain)).alias("s")).select(F.inline("s"))
    sketches.write.mode("overwrite").parquet(f"{path}/upto={reached}")
    return reached


def read_profile(spark: SparkSession, path: str, percentiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """``column, type, n, n_missing, n_distinct, min, max, p25, ...`` of all batches so far.

    Values are told apart as text.  Numbers are compared as doubles, other types as text; ``min`` and
    ``max`` are text, percentiles are NULL for columns that are not numbers or have none.
    """
    ranks = F.kll_merge_agg_double("ranks", _K)
    merged = _kept(spark, path).groupBy("column", "type").agg(
        F.sum("n").alias("n"), F.sum("n_missing").alias("n_missing"),
        F.hll_sketch_estimate(F.hll_union_agg("values")).alias("n_distinct"),
        F.coalesce(F.min("min_number").cast("string"), F.min("min_text")).alias("min"),
        F.coalesce(F.max("max_number").cast("string"), F.max("max_text")).alias("max"),
        F.count("min_number").alias("_numbers"), ranks.alias("_ranks"))
    at = [F.when(F.col("_numbers") > 0, F.kll_sketch_get_quantile_double("_ranks", F.lit(float(p)))).alias(f"p{round(p * 100)}")
          for p in percentiles]
    return merged.select("column", "type", "n", "n_missing", "n_distinct", "min", "max", *at)
