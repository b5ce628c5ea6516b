"""Small documents with every awkward case, for the tests of the corpus operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(40_000))
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog again", "en", "a"),
    (2, "The quick  brown FOX jumps over the lazy dog again", "en", "a"),
    (2, "The quick  brown FOX jumps over the lazy dog again", "en", "a"),      # a repeated row
    (3, "", "en", None),
    (4, None, None, None),
    (None, "text without an id but with words in it", "en", "b"),
    (None, None, None, None),
    (5, " \t\n ", "de", "b"),
    (6, LONG, "en", "c"),
    (7, LONG + " end", "en", "c"),
    (8, "Straße Ünïcode naïve 日本語 😀 It's x² 12.5 <|endoftext|>", "de", "c"),
    (9, "one two", "en", "b"),
    (10, "ONE  two", "en", "b"),
]
SCHEMA = "doc_id long, text string, lang string, source string"
CLASHING = ("key", "n", "rate", "copies", "shard", "slot", "label", "block", "component", "ids", "p_toxic", "size", "cdf")


def awkward(spark: SparkSession) -> DataFrame:
    """The rows above, with columns that have the operators' own names."""
    df = spark.createDataFrame(ROWS, SCHEMA).withColumn("n_chars", F.length("text").cast("long"))
    return df.withColumns({c: F.lit("mine") for c in CLASHING})


def nothing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA + ", n_chars long")


def words_of(text: str | None) -> list[str]:
    """Words by the contract: A-Z in lower case, split at ASCII white space."""
    import re
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    table = str.maketrans(upper, upper.lower())
    return [w for w in re.split("[\x20\x09-\x0d]+", (text or "").translate(table)) if w]
