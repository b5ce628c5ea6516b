"""Plain batch readers and the directory listing."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from swinglake.functions import now_text
from swinglake.operators.numbering import FILE


def below(reader, path: str) -> tuple:
    """Reader and path for ``folder/**``, all files below a folder; other paths stay as they are.

    A pattern that names each folder, or each file, is looked up by the driver, which keeps a path for everything
    that it matches beside the listing; here it keeps the listing only.
    """
    return (reader.option("recursiveFileLookup", True), path[:-3]) if path.endswith("/**") else (reader, path)


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Path, modification time and length of every file; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
        .load(path).drop("content")
    )


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table, or a parquet folder when ``name`` is a path."""
    return spark.read.parquet(name) if "/" in name else spark.read.table(name)


def stream_table(spark: SparkSession, name: str, schema: StructType | None = None,
                 max_files: int | None = None, pattern: str | None = None) -> DataFrame:
    """A catalog table, or a parquet folder, as a stream of its files."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if "/" not in name:
        return reader.table(name)
    return reader.schema(schema or spark.read.parquet(name).schema).parquet(name)


def read_delimited(spark: SparkSession, path: str, delimiter: str = " ",
                   schema: StructType | str | None = None) -> DataFrame:
    """Delimited files with a header; all columns are text unless typed.  A file whose
    header is not the schema's is an error, not columns by position."""
    reader = spark.read.option("header", True).option("delimiter", delimiter).option("enforceSchema", False)
    return (reader.schema(schema) if schema else reader).csv(path)


def read_text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def literal_rows(spark: SparkSession, rows: Iterable[tuple],
                 schema: StructType | str) -> DataFrame:
    """A small table written down in the program."""
    return spark.createDataFrame(list(rows), schema)


def read_json_stream(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Delivered JSON payloads, one object per line."""
    return spark.readStream.schema(schema).json(path)


def with_input_file(df: DataFrame) -> DataFrame:
    """Add the path of the file each row was read from."""
    return df.select("*", F.col("_metadata.file_path").alias(FILE))


def with_ingestion_ts(df: DataFrame, fmt: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """Add the time of ingestion as text."""
    return df.withColumn("ingestion_timestamp", now_text(fmt))
