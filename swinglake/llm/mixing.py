"""Mixing sources to target weights by Poisson replication.

A source's mean repetition rate is its share of the mixture over its share of the
bytes.  Each document inverts the Poisson distribution with that mean at a number its
id and the seed decide, is repeated as often, and all copies are shuffled by a hash.
Above ``MAX_RATE`` a document adds up independent draws of equal parts of the rate,
whose sum has the Poisson distribution of the whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swinglake.llm.common import staged, unit_hash

MAX_RATE = 500.0      # of one draw; exp(-rate) loses digits from 708 on
PART_RATE = 100.0     # of each draw where one is not enough
STRETCH = 10_000      # copies listed at a time
ADDED = ("rate", "copies", "copy", "shuffle_key", "mix_source", "cdf", "draws")


def source_bytes(docs: DataFrame, source: str = "source") -> DataFrame:
    """``mix_source``, ``mix_bytes`` (UTF-8): a row per source, null being a source."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return docs.groupBy(F.col(source).alias("mix_source")).agg(F.sum(size).alias("mix_bytes"))


def root_weights(sizes: DataFrame) -> DataFrame:
    """``mix_weight``: whole square root of a source's bytes, which lifts small sources."""
    return sizes.select("mix_source", F.floor(F.sqrt("mix_bytes")).cast("long").alias("mix_weight"))


def repetition_rates(sizes: DataFrame, weights: DataFrame, epochs: float = 1.0) -> DataFrame:
    """``mix_source``, ``rate``, ``draws`` and ``cdf``, the Poisson distribution of ``rate / draws``.

    ``weights`` has ``mix_source`` and ``mix_weight`` (whole numbers, any scale).  A source
    without weight has rate 0; one without bytes has rate 1.  Distributions are listed
    until what is left is below a double's precision.
    """
    given = weights.select(F.col("mix_source").alias("_source"), "mix_weight")
    both = sizes.join(given, F.col("mix_source").eqNullSafe(F.col("_source")), "left").select(
        "mix_source", "mix_bytes", F.coalesce("mix_weight", F.lit(0)).alias("mix_weight"))
    totals = both.agg(F.sum("mix_bytes").alias("all_bytes"), F.sum("mix_weight").alias("all_weight"))
    rate = F.when(F.col("mix_bytes") == 0, F.lit(1.0)).otherwise(
        F.lit(float(epochs)) * F.col("mix_weight").cast("double") * F.col("all_bytes").cast("double")
        / (F.col("all_weight").cast("double") * F.col("mix_bytes").cast("double")))
    draws = F.when(F.col("rate") > MAX_RATE, F.ceil(F.col("rate") / PART_RATE)).otherwise(F.lit(1)).cast("int")
    # both sides of the join have a row per source, totals a single row
    rates = both.join(F.broadcast(totals), F.lit(True)).select("mix_source", rate.alias("rate")).withColumn(
        "draws", draws).withColumn("part", F.col("rate") / F.col("draws"))
    terms = F.expr("sequence(1, cast(ceil(part + 12 * sqrt(part) + 30) as int))")
    start = F.expr("struct(exp(-part) AS p, exp(-part) AS c, array(exp(-part)) AS cdf)")
    step = F.expr("""aggregate(terms, first, (s, i) -> struct(
        s.p * part / i AS p, s.c + s.p * part / i AS c, concat(s.cdf, array(s.c + s.p * part / i)) AS cdf),
        s -> s.cdf)""")
    return (rates.select("mix_source", "rate", "draws", "part", terms.alias("terms"), start.alias("first"))
            .select("mix_source", "rate", "draws", step.alias("cdf")))


def replicate(docs: DataFrame, rates: DataFrame, *, source: str = "source", seed: str = "mix") -> DataFrame:
    """``docs`` repeated and shuffled, with ``rate``, ``copies``, ``copy`` (from 1) and ``shuffle_key``.

    Rows with equal ids draw the same number; a row without id draws by its text.
    ``rates`` has a row per source and is read from files, whose size decides: Spark
    broadcasts it below its limit, else the adaptive join splits large sources.  The shuffle key is uniform, so
    hash partitions sorted by it are a random order of the whole.  ``copies`` is an int.
    """
    name = F.coalesce(F.col("doc_id").cast("string"), F.col("text"), F.lit(""))
    drawn = docs.drop(*ADDED).withColumn("_name", name).withColumn("_u", unit_hash(F.lit(seed), F.col("_name")))
    joined = drawn.join(rates, F.col(source).eqNullSafe(F.col("mix_source"))).drop("mix_source")
    drawn_once = F.expr("size(filter(cdf, c -> c <= _u))")
    summed = F.aggregate(F.transform(F.sequence(F.lit(1), F.col("draws")), lambda i: unit_hash(
        F.lit(seed), F.col("_name"), F.lit("draw"), i.cast("string"))), F.lit(0),
        lambda n, u: n + F.size(F.filter("cdf", lambda c: c <= u)))
    counted = (joined.withColumn("copies", F.when(F.col("draws") == 1, drawn_once).otherwise(summed))
               .where("copies > 0").drop("cdf", "draws", "_u"))
    stretches = counted.withColumn("_stretch", F.explode(F.expr(f"sequence(0, cast((copies - 1) div {STRETCH} as int))")))
    copies = stretches.withColumn("copy", F.explode(F.expr(
        f"sequence(_stretch * {STRETCH} + 1, least(copies - _stretch * {STRETCH}, {STRETCH}) + _stretch * {STRETCH})"))).drop("_stretch")
    keyed = copies.withColumn("shuffle_key", F.md5(F.concat_ws(":", F.lit(seed), "_name", F.col("copy").cast("string"))))
    return keyed.drop("_name").repartition("shuffle_key").sortWithinPartitions("shuffle_key")


def mix(docs: DataFrame, weights: DataFrame | None = None, *, source: str = "source",
        epochs: float = 1.0, seed: str = "mix") -> DataFrame:
    """``replicate`` with rates for ``weights``, or for ``root_weights`` where none are given.

    Nulls: a null source is a source, a null text has no bytes.  Empty input, empty output.
    Columns of ``docs`` with the names of ``ADDED`` give way to these.
    """
    sizes = source_bytes(docs, source)
    rates = repetition_rates(sizes, root_weights(sizes) if weights is None else weights, epochs)
    return replicate(docs, staged(rates, "mix-rates"), source=source, seed=seed)
