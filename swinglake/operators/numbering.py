"""Row numbers in file order and per event, safe when one event is huge.

A plain ``row_number() over (partition by event)`` sorts a whole event in one
task.  Here rows are numbered in slices of bounded size (file splits, or ranges of
event and order), and the number of rows in earlier slices is added from a small
table of slice counts.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from swinglake.functions.paths import input_event
from swinglake.session import staged

FILE, BLOCK = "input_file", "_file_block"


def with_file_position(df: DataFrame) -> DataFrame:
    """Keep where each row comes from; works on batch and streaming file scans."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(BLOCK),
    )


def _before(n: str, window: WindowSpec) -> Column:
    earlier = window.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(n).over(earlier), F.lit(0))


def total_before(df: DataFrame, order: Sequence[str], n: str, name: str) -> DataFrame:
    """Sum of ``n`` over all rows earlier in ``order``.  Range partitions are summed
    apart; one task only sees a row per partition."""
    ranged = staged(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranged")
    parts = ranged.groupBy("_part").agg(F.sum(n).alias("_all")).select(
        F.col("_part"), _before("_all", Window.orderBy("_part")).alias("_earlier"))
    within = _before(n, Window.partitionBy("_part").orderBy(*order))
    return ranged.withColumn("_within", within).join(F.broadcast(parts), "_part").withColumn(
        name, F.col("_earlier") + F.col("_within")).drop("_part", "_within", "_earlier")


def file_offsets(files: DataFrame, key: str, index: bool) -> DataFrame:
    """Rows before each file: of its key (``_key_before``) and, with ``index``, of all
    (``_all_before``).  ``files`` has a row per file: key, path and number of rows ``_rows``."""
    out = files.withColumn("_key_before", _before("_rows", Window.partitionBy(key).orderBy(FILE)))
    return total_before(out, [key, FILE], "_rows", "_all_before") if index else out


def with_file_numbers(rows: DataFrame, file_row: str = "file_row", key: str = "input_event",
                      name: str = "row_number", index: str | None = None,
                      offsets: DataFrame | None = None) -> DataFrame:
    """Row numbers per key, in file order, out of each row's place in its file.

    They depend on the files alone: not on the batches the files came in, nor on
    a batch that was run again.  ``index`` adds a dense 0-based index over all rows, by key and file.
    The table of files is read from storage, whose size decides whether it is broadcast.
    ``offsets`` is such a table that was made before, see :func:`extend_ledger`.
    """
    if offsets is None:
        offsets = staged(file_offsets(_file_sizes(rows, file_row, key), key, index is not None).drop(key, "_rows"),
                         "file-offsets")
    front = [(F.col("_all_before") + F.col(file_row) - 1).alias(index)] if index else []
    number = (F.col("_key_before") + F.col(file_row)).alias(name)
    wanted = offsets.select(FILE, "_key_before", *(["_all_before"] if index else []))
    return rows.join(wanted, FILE).select(*front, *[number if c == file_row else F.col(c) for c in rows.columns])


def _file_sizes(rows: DataFrame, file_row: str, key: str) -> DataFrame:
    return rows.groupBy(key, FILE).agg(F.max(file_row).cast("long").alias("_rows"))


def extend_ledger(rows: DataFrame, ledger: str, batch: str, file_row: str = "file_row",
                  key: str = "input_event") -> DataFrame:
    """Offsets of files in their order of arrival; those of earlier runs stay as they are.

    ``rows`` has the number of its batch as a partition column.  The ledger is a folder with a
    table for each run, named after the last batch it reaches to.  A run reads the batches after that only,
    and lets their files, in order of key and path, follow all earlier ones: in the whole
    table and within each key.  A run that failed before its table was whole does it again.
    """
    spark = rows.sparkSession
    reached = rows.agg(F.max(batch)).first()[0]
    kept = spark.createDataFrame([], f"{key} string, {FILE} string, _rows long, _key_before long, _all_before long, upto int")
    try:
        kept = spark.read.schema(kept.schema).parquet(ledger)
    except AnalysisException as missing:      # the first run
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
    last, total = kept.agg(F.max("upto"), F.coalesce(F.sum("_rows"), F.lit(0))).first()
    if reached is not None and (last is None or reached > last):
        new = rows if last is None else rows.where(F.col(batch) > last)
        arrived = file_offsets(_file_sizes(new, file_row, key), key, True)
        earlier = kept.groupBy(key).agg(F.sum("_rows").alias("_earlier"))
        (arrived.join(earlier, key, "left")
         .select(key, FILE, "_rows", (F.col("_key_before") + F.coalesce("_earlier", F.lit(0))).alias("_key_before"),
                 (F.col("_all_before") + F.lit(total)).cast("long").alias("_all_before"))
         .write.mode("overwrite").parquet(f"{ledger}/upto={reached}"))
        kept = spark.read.schema(kept.schema).parquet(ledger)
    return kept


def number_in_file_order(df: DataFrame, key: str = "input_event", name: str = "row_number",
                         skip: int = 0, index: str | None = None, per_file: bool = False,
                         header: Callable[[Column], Column] | None = None) -> DataFrame:
    """1-based row number in file order, per ``key`` (the folder of the file) or ``per_file``.

    ``df`` holds the ``value`` of text lines and comes from
    :func:`with_file_position` (inside ``foreachBatch`` when it is a stream).  The
    first ``skip`` lines of every file do not count and have no number.
    ``index`` adds a dense 0-based index over all counted rows, ordered by key and file.
    ``header`` makes a column ``_header`` out of the last skipped line, wherever in the
    file its split is, to be had by every row of the file; it is NULL where there is
    nothing to say about the header.

    Lines are neither shuffled nor sorted.  A scan gives the lines of a split ascending
    ids, so a line's place is its id less the split's least one, plus the lines of the
    file's earlier splits.  These come from a table with one row per split, made by a
    scan of its own and read from storage, whose size decides whether it is broadcast.  With ``skip`` 1
    that scan brings the first lines along, else headers are looked up by another one.
    """
    numbered = df.withColumn("_seq", F.monotonically_increasing_id())
    top = [F.min_by("value", "_seq").alias("_top")] if header and skip == 1 else []
    splits = (
        numbered.groupBy(FILE, BLOCK).agg(F.min("_seq").alias("_first"), F.count("*").alias("_n"), *top)
        .withColumn("_lines_before", _before("_n", Window.partitionBy(FILE).orderBy(BLOCK)))
        .withColumn("_shift", F.col("_lines_before") - F.col("_first") + 1 - skip)
    )
    if per_file:
        splits = splits.withColumn("_key_before", F.lit(0).cast("long"))
    else:
        splits = staged(splits, "counted")       # read twice, and lines once
        files = splits.groupBy(FILE).agg(F.greatest(F.sum("_n") - skip, F.lit(0)).alias("_rows")).withColumn(
            key, input_event(FILE))
        splits = splits.join(file_offsets(files, key, index is not None).drop(key, "_rows"), FILE)
    brought = ["_shift", "_key_before", *(["_all_before"] if index else [])]
    if top:      # the first line of a file is that of its first split with lines
        first = F.first("_top").over(Window.partitionBy(FILE).orderBy(BLOCK))
        splits = splits.withColumn("_line", first).withColumn("_header", header(F.col("_line")))
        brought.append("_header")
    splits = staged(splits.select(FILE, BLOCK, *brought), "splits")
    if header and not top:
        at_header = numbered.join(splits, [FILE, BLOCK]).where(F.col("_seq") + F.col("_shift") == 0)
        headers = at_header.select(FILE, header(F.col("value")).alias("_header")).where("_header IS NOT NULL")
        splits = staged(splits.join(staged(headers, "headers"), FILE, "left"), "splits")
        brought.append("_header")

    in_file = F.col("_seq") + F.col("_shift")
    columns = [input_event(FILE).alias(key),
               F.when(in_file > 0, F.col("_key_before") + in_file).alias(name)]
    if index:
        columns.append(F.when(in_file > 0, F.col("_all_before") + in_file - 1).alias(index))
    if header:
        columns.append(F.col("_header"))
    return numbered.join(splits, [FILE, BLOCK]).select(*df.columns, *columns)


def first_lines(df: DataFrame, line: int = 1) -> DataFrame:
    """Line ``line`` of every file, wherever its split begins; other lines stay where they are."""
    numbered = number_in_file_order(df, name="_at", per_file=True)
    return numbered.where(F.col("_at") == line).select(*df.columns)


def with_row_number(df: DataFrame, key: str | Sequence[str], order_by: str | Sequence[str],
                    name: str = "row_number") -> DataFrame:
    """1-based row number per key, ascending by ``order_by``; rows that tie are in no order.

    Rows are dealt by ranges of key, order and a hash of the row, so a key of any size
    spreads over as many partitions as its rows fill, whatever its order columns
    are.  They are numbered inside their partition and shifted by the key's rows in
    earlier ones, a table with a row per partition and key there.  The dealt rows are
    written once, so a retry cannot deal them anew between the two passes.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    ties = F.xxhash64(*[c for c, kind in df.dtypes if "map<" not in kind])
    rows = staged(
        df.withColumn("_tie", ties).repartitionByRange(*keys, *order, "_tie")
        .sortWithinPartitions(*keys, *order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_seq", F.monotonically_increasing_id()), "row-number")

    by_key = Window.partitionBy(*[f"{k}__o" for k in keys]).orderBy("_part__o")
    shifts = (
        rows.groupBy(*[F.col(k).alias(f"{k}__o") for k in keys], F.col("_part").alias("_part__o"))
        .agg(F.count("*").alias("_n"), F.min("_seq").alias("_first"))
        .withColumn("_before", F.coalesce(
            F.sum("_n").over(by_key.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .select(*[f"{k}__o" for k in keys], "_part__o", (F.col("_before") - F.col("_first") + 1).alias("_shift"))
    )
    same = F.col("_part") == F.col("_part__o")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"{k}__o"))
    return rows.join(shifts, same).select(*df.columns, (F.col("_seq") + F.col("_shift")).alias(name))


def with_row_index(df: DataFrame, order_by: str | Sequence[str] | None = None,
                   name: str = "row_index") -> DataFrame:
    """Dense 0-based index over the whole table, as the first column.

    Without ``order_by`` the rows keep the order they are read in.  The rows are
    written once with their partition and position, so a lost executor cannot
    renumber them between the two passes; the second pass adds the number of rows
    in earlier partitions, a table with one row per partition.
    """
    if order_by is not None:
        order = [order_by] if isinstance(order_by, str) else list(order_by)
        # ties, which have no order among them, are spread by a hash
        ties = [c for c, kind in df.dtypes if not kind.startswith("map")]
        df = df.repartitionByRange(*order, F.xxhash64(*ties)).sortWithinPartitions(*order)
    rows = staged(df.select(
        "*",
        F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().alias("_seq"),
    ), "row-index")

    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy("_part").agg(F.count("*").alias("_n"), F.min("_seq").alias("_first"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .select("_part", (F.col("_before") - F.col("_first")).alias("_shift"))
    )
    return (
        rows.join(F.broadcast(starts), "_part")
        .select((F.col("_seq") + F.col("_shift")).alias(name), *df.columns)
    )
