"""Landing files written from ``events`` and ``customer``, read back every way."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from swinglake.catalog import fixtures as fx
from swinglake.catalog.registry import query
from swinglake.functions import event_folder, parse_json, path_game
from swinglake.operators.numbering import with_file_numbers
from swinglake.operators.shaping import clean
from swinglake.operators.tables import drop_layers
from swinglake.plans.ingest import Lake, ingest_csv, ingest_report, ingest_xml
from swinglake.plans.validate import validate
from swinglake.session import scratch_dir, staged
from swinglake.sources.delimited import (
    parse_lines, pinned_schema, promote_rescued, read_csv_stream, read_report, rescue_csv, text_line_stream,
    widen_schema,
)
from swinglake.sources.files import (
    list_files, literal_rows, read_delimited, read_json_stream, read_text, with_input_file,
)
from swinglake.sources.xml import read_xml, read_xml_stream
from swinglake.streaming.sinks import for_each_batch, read_batches, write_stream, write_stream_batches

CSV_SCHEMA = StructType().add("frame", "integer").add("cents", "long").add("kind", "string")
XML_SCHEMA = (StructType().add("GamePK", "long").add("ID", "long")
              .add("PlayID", "string").add("Weight", "long"))


def _glob(root: str) -> str:
    """All files below the events' folders, which hold nothing else than files to be read.  Spark lists them in
    parallel; a pattern for the files would be looked up in one folder after the other by the driver."""
    return f"{root}/all_games/*/event_type=batting/**"


def _event(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(event_folder("input_file").alias("event"),
                     path_game("input_file").alias("game"), *columns)


# --- CSV with misfits ------------------------------------------------------

CSV_SQL = f"""WITH {fx.EV},
raw AS (
  SELECT *, {fx.FOLDER_SQL} AS event, 'game' || (user_id % 5) AS game,
    user_id % 5 = 0 AS other_order, event_id % 19 = 0 AS short,
    event_id % 13 = 0 AS bad, event_id % 17 = 0 AS long FROM ev),
parts AS (
  SELECT *,
    CASE WHEN bad AND NOT short THEN '"cents":"bad' || event_id || '"' END AS r1,
    CASE WHEN other_order AND NOT short THEN '"note":"n' || event_id || '"' END AS r2,
    CASE WHEN long AND NOT short THEN '"_extra_0":"e' || event_id || '"' END AS r3 FROM raw)
SELECT event, game,
  CASE WHEN short AND other_order THEN NULL ELSE rn::INT END AS frame,
  CASE WHEN short OR bad THEN NULL ELSE round(value * 100)::BIGINT END AS cents,
  CASE WHEN short AND NOT other_order THEN NULL ELSE event_type END AS kind,
  CASE WHEN coalesce(r1, r2, r3) IS NOT NULL
       THEN '{{' || concat_ws(',', r1, r2, r3) || '}}' END AS _rescued_data,
  rn AS row_number
FROM parts"""


@query("rescue_csv", CSV_SQL)
def rescue_csv_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rescue_csv(spark, _glob(fx.land_csv(spark, sf_dir)), CSV_SCHEMA, ";")
    return _event(rows, "frame", "cents", "kind", "_rescued_data", "row_number")


@query("ingest_csv", CSV_SQL)
def ingest_csv_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fx.land_csv(spark, sf_dir)
    lake = Lake(scratch_dir(spark, "lake"), root)
    # a long swing is several files here, and they come in several batches
    rows = ingest_csv(spark, lake, "motion", "batting", ";", CSV_SCHEMA, stamp=True,
                      max_files=_third(spark, root), files=_glob(root))
    return _event(rows, "frame", "cents", "kind", "_rescued_data", "row_number")


def _third(spark: SparkSession, root: str) -> int:
    """A third of the landing files, so that batches cut events."""
    return -(-list_files(spark, root + "/all_games", "part-*").count() // 3)


@query("named_lake", f"""SELECT 'bronze' AS layer, 'batting_motion' AS "table", count(*) AS n_rows,
  count(DISTINCT event) AS n_events FROM ({CSV_SQL})
UNION ALL SELECT 'silver', 'batting_motion', count(*), count(DISTINCT event)
FROM ({CSV_SQL}) WHERE _rescued_data IS NULL""")
def named_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files landed, cleaned and counted by the names of their tables."""
    root, at = fx.land_csv(spark, sf_dir), scratch_dir(spark, "lake")
    lake = Lake(at, root, namespaces=f"lake_{at[-8:]}_")
    ingest_csv(spark, lake, "motion", "batting", ";", CSV_SCHEMA, max_files=_third(spark, root), files=_glob(root))
    bronze = spark.read.table(lake.name("bronze", "batting", "motion"))
    clean(bronze).write.saveAsTable(lake.name("silver", "batting", "motion"))
    found = staged(validate(spark, [f"{lake.namespaces}bronze", f"{lake.namespaces}silver"]), "layers")
    drop_layers(spark, lake.namespaces)
    return found.withColumn("layer", F.substring_index("layer", "_", -1))


@query("ingest_row_index", f"""SELECT event, row_number,
  row_number() OVER (ORDER BY game, event, row_number) - 1 AS row_index FROM ({CSV_SQL})""")
def ingest_row_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index over all rows of a table that came in three batches."""
    root = fx.land_csv(spark, sf_dir)
    rows = ingest_csv(spark, Lake(scratch_dir(spark, "lake"), root), "motion", "batting", ";", CSV_SCHEMA,
                      max_files=_third(spark, root), files=_glob(root))
    return _event(rows, "row_number", "row_index").drop("game")


@query("late_files", f"""WITH {fx.EV},
placed AS (SELECT *, {fx.FOLDER_SQL} AS event, 'game' || (user_id % 5) AS game, rn % 3 AS run FROM ev)
SELECT event, game, rn::INT AS frame, round(value * 100)::BIGINT AS cents,
  row_number() OVER (PARTITION BY user_id ORDER BY run, rn) AS row_number,
  row_number() OVER (ORDER BY run, game, event, rn) - 1 AS row_index
FROM placed""")
def late_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs, and before each a file more for every event, whose name may sort before the
    earlier ones.  The rows of all runs with their numbers at the time: a number that moved
    would make a row of its own."""
    at = scratch_dir(spark, "late-files")
    lake, published = Lake(f"{at}/lake", at), []
    for run in range(3):
        fx.append_csv(spark, sf_dir, at, F.col("row_number") % 3 == run)
        rows = ingest_csv(spark, lake, "motion", "batting", ";", CSV_SCHEMA, files=_glob(at))
        published.append(staged(_event(rows, "frame", "cents", "row_number", "row_index"), "published"))
    return reduce(DataFrame.union, published).distinct()


@query("promoted_columns", CSV_SQL.replace("rn AS row_number", "substr(r2, 9, length(r2) - 9) AS note").replace(
    "coalesce(r1, r2, r3)", "coalesce(r1, r3)").replace("r1, r2, r3)", "r1, r3)"))
def promoted_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the files land before the schema has a column ``note`` and half of them after: the rows
    are those of all files read with that column."""
    root = fx.land_csv(spark, sf_dir)
    lake = Lake(scratch_dir(spark, "lake"), root)
    location, note = lake.schema("batting", "motion"), StructType().add("note", "string")
    pinned_schema(spark, root, location, infer=lambda: CSV_SCHEMA)
    ingest_csv(spark, lake, "motion", "batting", ";", files=f"{root}/{fx.LANDING_GLOB}_Home")
    widen_schema(spark, location, note)
    rows = promote_rescued(ingest_csv(spark, lake, "motion", "batting", ";", files=_glob(root)), note)
    return _event(rows, "frame", "cents", "kind", "note", "_rescued_data")


@query("replayed_batches", CSV_SQL)
def replayed_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every batch is written twice, as after a failure between write and commit."""
    root, at = fx.land_csv(spark, sf_dir), scratch_dir(spark, "replayed")
    lines = text_line_stream(spark, _glob(root), max_files=_third(spark, root))

    def rows(batch: DataFrame, batch_id: int) -> DataFrame:
        parsed = parse_lines(batch, CSV_SCHEMA, ";", file_row="file_row")
        parsed.write.mode("overwrite").parquet(f"{at}/table/batch_id={batch_id}")
        return parsed

    write_stream_batches(lines, rows, f"{at}/table", f"{at}/checkpoint")
    numbered = with_file_numbers(read_batches(spark, f"{at}/table"))
    return _event(numbered, "frame", "cents", "kind", "_rescued_data", "row_number")


@query("list_files", """SELECT 'game' || (user_id % 5) AS game, count(DISTINCT user_id) AS n_events
FROM events GROUP BY 1""")
def landing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = list_files(spark, fx.land_csv(spark, sf_dir) + "/all_games", "part-*")
    return (files.where(F.col("length") > 0)
            .groupBy(path_game(F.col("path")).alias("game"))
            .agg(F.count_distinct(event_folder(F.col("path"))).alias("n_events")))


# --- reports ---------------------------------------------------------------

REPORT_SQL = f"""WITH {fx.REPORT}
SELECT {fx.FOLDER_SQL} AS event, 'game' || (user_id % 5) AS game,
  event_type AS "Measure", n::VARCHAR AS "Reading", NULL::VARCHAR AS _rescued_data
FROM report"""


@query("report_files", REPORT_SQL)
def report_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_report(spark, _glob(fx.land_reports(spark, sf_dir)))
    return _event(rows, "Measure", "Reading", "_rescued_data")


@query("ingest_report", REPORT_SQL)
def ingest_report_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fx.land_reports(spark, sf_dir)
    lake = Lake(scratch_dir(spark, "lake"), root)
    rows = ingest_report(spark, lake, "report", "batting", files=_glob(root))
    return _event(rows, "Measure", "Reading", "_rescued_data")


# --- XML -------------------------------------------------------------------

XML_SQL = f"""SELECT {fx.FOLDER_SQL} AS event, 'game' || (user_id % 5) AS game,
  700000 + user_id % 5 AS "GamePK", user_id AS "ID", 'P' || user_id AS "PlayID",
  CASE WHEN user_id % 11 <> 0 THEN 180 + user_id % 60 END AS "Weight",
  CASE WHEN user_id % 11 = 0 THEN '{{"Weight":"heavy"}}' END AS _rescued_data
FROM (SELECT DISTINCT user_id FROM events)"""


@query("xml_files", XML_SQL)
def xml_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_xml(spark, _glob(fx.land_xml(spark, sf_dir)), "BatterParameterSet", XML_SCHEMA)
    return _event(rows, *XML_SCHEMA.fieldNames(), "_rescued_data")


@query("ingest_xml", XML_SQL)
def ingest_xml_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fx.land_xml(spark, sf_dir)
    lake = Lake(scratch_dir(spark, "lake"), root)
    rows = ingest_xml(spark, lake, "batter_parameter_set", "batting", "BatterParameterSet",
                      "Sets", XML_SCHEMA, stamp=True, files=_glob(root))
    return _event(rows, *XML_SCHEMA.fieldNames(), "_rescued_data")


@query("xml_unknown_elements", """WITH found AS (
  SELECT c_custkey, c_name,
    CASE WHEN c_custkey % 5 = 0 THEN '"Phone":"n' || c_nationkey || '","Phone_1":"p' || c_custkey || '"' END AS r1,
    CASE WHEN c_custkey % 3 = 0 THEN '"Segment":"' || c_mktsegment || '"' END AS r2 FROM customer)
SELECT c_custkey AS "ID", c_name AS "Name", 'game' || (c_custkey % 4) AS game,
  CASE WHEN coalesce(r1, r2) IS NOT NULL THEN '{' || concat_ws(',', r1, r2) || '}' END AS _rescued_data
FROM found""")
def xml_unknown_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with elements that the schema does not know, some of them twice, as a stream."""
    at, key = scratch_dir(spark, "landing-unknown"), F.col("c_custkey")
    phones = F.when(key % 5 == 0, F.array(*[F.concat(F.lit(p), F.col(c)) for p, c in (("n", "c_nationkey"), ("p", "c_custkey"))]))
    records = fx.table(spark, sf_dir, "customer").select(
        F.when(key % 3 == 0, F.col("c_mktsegment")).alias("Segment"), key.alias("ID"),
        phones.alias("Phone"), F.col("c_name").alias("Name"), F.concat(F.lit("game"), key % 4).alias("game"))
    records.write.partitionBy("game").format("xml").option("rowTag", "Customer").save(f"{at}/landing")
    rows = read_xml_stream(spark, f"{at}/landing/*/part-*", "Customer", StructType().add("ID", "long").add("Name", "string"))
    folder = F.element_at(F.split("input_file", "/"), -2)
    rows = rows.select("ID", "Name", F.substring_index(folder, "=", -1).alias("game"), "_rescued_data")
    write_stream(rows, f"{at}/table", f"{at}/checkpoint")
    return spark.read.schema(rows.schema).parquet(f"{at}/table")


# --- well-formed delimited files, JSON lines -------------------------------

CUSTOMER_SQL = """SELECT c_custkey, c_name, c_mktsegment, 'nation=' || c_nationkey AS folder
FROM customer"""


def _land_customers(spark: SparkSession, sf_dir: str, delimiter: str) -> str:
    at = scratch_dir(spark, "landing-customer")
    customers = fx.table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_mktsegment", F.col("c_nationkey").alias("nation"))
    customers.write.partitionBy("nation").options(header=True, sep=delimiter).csv(at)
    return f"{at}/*/part-*"


def _with_folder(df: DataFrame) -> DataFrame:
    folder = F.element_at(F.split("input_file", "/"), -2)
    return df.withColumn("folder", folder).drop("input_file")


@query("csv_stream", CUSTOMER_SQL)
def csv_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    files, at = _land_customers(spark, sf_dir, " "), scratch_dir(spark, "csv-stream")
    schema = pinned_schema(spark, files, f"{at}/schema", delimiter=" ")
    stream = _with_folder(with_input_file(read_csv_stream(spark, files, " ", schema)))
    write_stream(stream, f"{at}/table", f"{at}/checkpoint")
    return spark.read.schema(stream.schema).parquet(f"{at}/table").withColumn(
        "c_custkey", F.col("c_custkey").cast("long"))


@query("delimited_files", CUSTOMER_SQL)
def delimited_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _land_customers(spark, sf_dir, "\t")
    schema = "c_custkey long, c_name string, c_mktsegment string"
    return _with_folder(with_input_file(read_delimited(spark, files, "\t", schema)))


@query("text_lines", """SELECT 'nation=' || c_nationkey AS folder,
  c_custkey || ' ' || c_name || ' ' || c_mktsegment AS value FROM customer
UNION ALL
SELECT DISTINCT 'nation=' || c_nationkey, 'c_custkey c_name c_mktsegment' FROM customer""")
def text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _land_customers(spark, sf_dir, " ")
    return _with_folder(with_input_file(read_text(spark, files))).select("folder", "value")


@query("json_stream", """SELECT event_id, event_type,
  (json_extract_string(props, '$.k'))::INTEGER AS k FROM events""")
def json_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivered payloads as files of JSON lines; ``props`` is JSON within JSON."""
    at = scratch_dir(spark, "json-stream")
    fx.table(spark, sf_dir, "events").select(
        "event_id", "event_type", "props").write.json(f"{at}/landing")
    schema = "event_id long, event_type string, props string"
    stream = read_json_stream(spark, f"{at}/landing", schema)
    rows = stream.select("event_id", "event_type", parse_json("props", "k int").getField("k").alias("k"))
    write_stream(rows, f"{at}/table", f"{at}/checkpoint")
    return spark.read.schema(rows.schema).parquet(f"{at}/table")


@query("batch_callback", """SELECT user_id, count(*) AS n_rows, sum(round(value * 100)::BIGINT)::BIGINT AS cents
FROM events GROUP BY user_id""")
def batch_callback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A callback per micro-batch that keeps partial sums, added up at the end."""
    at = scratch_dir(spark, "batch-callback")
    events = fx.table(spark, sf_dir, "events").select("user_id", "value")
    events.repartition("user_id", "value").write.parquet(f"{at}/landing")
    stream = (spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1)
              .parquet(f"{at}/landing"))

    def partial(batch: DataFrame, batch_id: int) -> None:
        sums = batch.groupBy("user_id").agg(
            F.count("*").alias("n"), F.sum(F.round(F.col("value") * 100).cast("long")).alias("c"))
        sums.write.mode("overwrite").parquet(f"{at}/table/batch_id={batch_id}")

    for_each_batch(stream, partial, f"{at}/checkpoint")
    return read_batches(spark, f"{at}/table").groupBy("user_id").agg(
        F.sum("n").alias("n_rows"), F.sum("c").alias("cents"))


@query("literal_lookup", """SELECT o_orderpriority,
  CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 END AS rank, count(*) AS n_rows
FROM orders GROUP BY 1, 2""")
def literal_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lookup written in the program, two rows long and therefore broadcast."""
    lookup = literal_rows(spark, [("1-URGENT", 1), ("2-HIGH", 2)],
                          "o_orderpriority string, rank int")
    orders = fx.table(spark, sf_dir, "orders").select("o_orderpriority")
    return (orders.join(F.broadcast(lookup), "o_orderpriority", "left")
            .groupBy("o_orderpriority", "rank").agg(F.count("*").alias("n_rows")))
