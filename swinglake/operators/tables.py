"""Layers, typed tables, appends and compaction."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from swinglake.functions.sqltext import ident, text
from swinglake.joints import CLUSTER_KEYS
from swinglake.operators.numbering import total_before
from swinglake.session import staged
from swinglake.sources.files import list_files

LAYERS = {
    "landing": "files as delivered",
    "bronze": "landed rows with their origin and a rescue column",
    "silver": "clean, joined and typed tables for analysis",
    "gold": "aggregates for applications",
}
TARGET_FILE_BYTES = 256 * 1024 * 1024
CURVE_BITS = 6            # of a key in a place on the curve: its values are cut into 64 pieces
VERSIONS = "_versions"


def ensure_layers(spark: SparkSession, prefix: str = "", root: str | None = None,
                  layers: Mapping[str, str] = LAYERS) -> list[str]:
    """Create the namespaces that are missing; returns their names."""
    names = []
    for layer, comment in layers.items():
        name = f"{prefix}{layer}"
        at = f" LOCATION {text(f'{root}/{name}')}" if root else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` COMMENT {text(comment)}{at}")
        names.append(name)
    return names


def drop_layers(spark: SparkSession, prefix: str, layers: Mapping[str, str] = LAYERS) -> None:
    """Forget the namespaces and their tables; files of external tables stay."""
    for layer in layers:
        spark.sql(f"DROP DATABASE IF EXISTS `{prefix}{layer}` CASCADE")


def ensure_external(spark: SparkSession, name: str, path: str) -> None:
    """Make a folder of Parquet files known to the catalog, with all partitions it has by now."""
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path, "parquet")
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)


def ensure_table(spark: SparkSession, name: str, schema: StructType,
                 keys: Sequence[str] = CLUSTER_KEYS, comment: str = "",
                 fmt: str = "parquet") -> None:
    """Create a typed table with comment and clustering keys if it is missing."""
    columns = ", ".join(f"{ident(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    cluster = f" CLUSTER BY ({', '.join(keys)})" if keys else ""
    remark = f" COMMENT {text(comment)}" if comment else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {fmt}{cluster}{remark}")


def append_merge(df: DataFrame, path: str) -> DataFrame:
    """Append a batch whose columns may differ from the ones before; returns the
    table, in which a column a batch lacked is NULL."""
    df.write.mode("append").parquet(path)
    return read_merged(df.sparkSession, path)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(path)


def _key_bounds(df: DataFrame, key: str, pieces: int) -> list:
    """Least values of the key's quantile pieces but the first: ``pieces - 1`` values at most, of any type.

    Values are counted before they are put in order, in range partitions, so a hot value is one row.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    ranked = total_before(counts, [key], "_n", "_before")
    total = ranked.agg(F.sum("_n")).first()[0] or 1
    piece = F.floor(F.col("_before") * pieces / total)
    bounds = ranked.groupBy(piece.alias("_piece")).agg(F.min(key).alias("_least")).where("_piece > 0")
    return [r["_least"] for r in bounds.orderBy("_piece").select("_least").collect()]


def _piece_of(df: DataFrame, key: str, bounds: list) -> Column:
    """Number of the key's quantile piece, by halving; nulls are in the first one."""
    kind = df.schema[key].dataType

    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high + 1) // 2
        return F.when(F.col(key) >= F.lit(bounds[middle - 1]).cast(kind), between(middle, high)).otherwise(between(low, middle - 1))

    return between(0, len(bounds))


def curve_position(df: DataFrame, keys: Sequence[str], bits: int = CURVE_BITS) -> Column:
    """Place on a space-filling curve: the bits of each key's quantile piece interleaved.

    Rows near each other on it are near in every key, so a run of it holds narrow ranges of all of
    them, not only of the first.  What is read of the keys are ``2 ** bits`` bounds each.
    """
    place = F.lit(0).cast("long")
    for k, key in enumerate(keys):
        piece = _piece_of(df, key, _key_bounds(df, key, 1 << bits))
        for bit in range(bits):
            one = F.shiftright(piece, bit).bitwiseAND(F.lit(1)).cast("long")
            place = place.bitwiseOR(F.shiftleft(one, bit * len(keys) + len(keys) - 1 - k))
    return place


def compact(spark: SparkSession, source: str, target: str,
            keys: Sequence[str] = CLUSTER_KEYS,
            file_bytes: int = TARGET_FILE_BYTES, curve: bool = False) -> DataFrame:
    """Rewrite a table into few files, ordered by ``keys``.

    Row groups then hold narrow key ranges, so filters on the first key skip most of
    the table; with ``curve`` files follow :func:`curve_position`, and a filter on any one of the keys
    skips files.  The remaining plain columns break ties in the range partitioning,
    so that one key with much of the data is still spread over many files.
    """
    df = read_merged(spark, source)
    size = list_files(spark, source).agg(F.sum("length")).first()[0] or 0
    files = max(1, -(-size // file_bytes))
    plain = [f.name for f in df.schema.fields
             if f.name not in keys and not isinstance(f.dataType, (MapType, ArrayType, StructType))]
    ties = [F.xxhash64(*plain)] if plain else []
    if curve:
        placed = df.select("*", curve_position(df, keys).alias("_place"))
        ordered = placed.repartitionByRange(files, "_place", *keys, *ties).sortWithinPartitions("_place", *keys).drop("_place")
    else:
        ordered = df.repartitionByRange(files, *keys, *ties).sortWithinPartitions(*keys)
    ordered.write.parquet(target)
    return spark.read.parquet(target)


# --- versions of a table ---------------------------------------------------
# A version is a list of files.  Lists and packed files lie in hidden folders of the table, so
# whoever appends to the folder need not know about them.

def _versions(spark: SparkSession, table: str) -> DataFrame | None:
    """``version, path, length, replaced`` of all versions; nothing before the first."""
    try:
        return spark.read.parquet(f"{table}/{VERSIONS}")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def files_of(spark: SparkSession, table: str) -> DataFrame:
    """``path, length`` of the files that make up the table: those of its last version, and
    those that no version knows, which were appended since."""
    listed, versions = list_files(spark, table, "*.parquet").select("path", "length"), _versions(spark, table)
    if versions is None:
        return listed
    last = versions.agg(F.max("version")).first()[0]
    kept = versions.where((F.col("version") == last) & ~F.col("replaced")).select("path", "length")
    return kept.unionByName(listed.join(versions.select("path"), "path", "left_anti"))


def read_current(spark: SparkSession, table: str) -> DataFrame:
    """The table as of its last version, with what was appended since; for tables without
    partition columns.  Its list of files is what Spark's own file index holds on the driver too."""
    paths = [r["path"] for r in files_of(spark, table).select("path").collect()]
    return spark.read.option("mergeSchema", True).parquet(*paths)


def compact_small(spark: SparkSession, table: str, file_bytes: int = TARGET_FILE_BYTES) -> int:
    """Pack a table's small files together; returns how many were rewritten.

    Files of less than half of ``file_bytes`` are packed, in order of their paths, into bins of
    ``file_bytes``; larger files and bins of one file stay as they are, so a second call has nothing
    to do.  A packed file counts with the bytes that went into it.  Packed files are seen once the
    list of the new version is written, in place of those they were made of and at once; a run that fails
    before leaves the table as it was.  Replaced files stay for those who still read them.
    """
    versions = _versions(spark, table)
    version = 1 if versions is None else versions.agg(F.max("version")).first()[0] + 1
    files = staged(files_of(spark, table), "files")
    small = total_before(files.where(F.col("length") * 2 < file_bytes), ["path"], "length", "_before")
    binned = small.withColumn("_bin", F.floor(F.col("_before") / file_bytes))
    full = binned.groupBy("_bin").agg(F.count("*").alias("_files"), F.sum("length").alias("_bytes")).where("_files > 1")
    moved = staged(binned.join(full, "_bin").select("path", "length", "_bin", "_bytes"), "small-files")
    paths = [r["path"] for r in moved.select("path").collect()]
    if not paths:
        return 0
    folder = f"{table}/_packed-{version}-{uuid.uuid4().hex}"
    # rows name their file as a URI, the listing as a path
    plain = "regexp_replace({}, '^([a-z0-9]+):/+', '$1:/')"
    uri = "url_decode(replace(_metadata.file_path, '+', '%2B'))"
    rows = spark.read.option("mergeSchema", True).parquet(*paths).select("*", F.expr(plain.format(uri)).alias("_path"))
    binned = rows.join(moved.select(F.expr(plain.format("path")).alias("_path"), "_bin"), "_path").drop("_path")
    (binned.repartition(moved.select("_bin").distinct().count(), "_bin").sortWithinPartitions("_bin")
           .write.partitionBy("_bin").parquet(folder))
    packed = list_files(spark, folder, "*.parquet").select(
        "path", F.regexp_extract("path", "/_bin=([0-9]+)/", 1).cast("long").alias("_bin"))
    made = packed.join(moved.groupBy("_bin").agg(F.first("_bytes").alias("length")), "_bin").select("path", "length")
    kept = files.join(moved.select("path"), "path", "left_anti").unionByName(made)
    listed = kept.withColumn("replaced", F.lit(False)).unionByName(
        moved.select("path", "length", F.lit(True).alias("replaced")))
    listed.write.mode("overwrite").parquet(f"{table}/{VERSIONS}/version={version}")
    return len(paths)
