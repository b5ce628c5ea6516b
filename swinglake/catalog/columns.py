"""Column functions and row numbering over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from swinglake.catalog import fixtures as fx
from swinglake.catalog.motion import _ms_sql
from swinglake.catalog.registry import query
from swinglake.functions import (
    decode_utf8, event_metadata, extract_metadata, from_xml, lower_all, now_text, parse_json,
    path_part, round_frame_ms, to_double,
)
from swinglake.functions.paths import EVENT_PATTERN
from swinglake.operators.numbering import with_row_index, with_row_number
from swinglake.operators.shaping import rename_at
from swinglake.sources.delimited import rescue_cast

ROW_NUMBER_SQL = """SELECT event_id, user_id, value,
  row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS row_number FROM events"""


@query("row_number_per_event", ROW_NUMBER_SQL)
def row_number_per_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fx.table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    return with_row_number(events, "user_id", "event_id")


@query("row_number_hot_events", """SELECT event_id, event_type,
  row_number() OVER (PARTITION BY event_type ORDER BY lpad(event_id::VARCHAR, 12, '0')) AS row_number FROM events""")
def row_number_hot_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few keys with much of the table each, a constant leading column and text behind it."""
    events = fx.table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.lit(1).alias("same"), F.lpad(F.col("event_id").cast("string"), 12, "0").alias("text"))
    return with_row_number(events, "event_type", ["same", "text"]).drop("same", "text")


@query("row_index_global", """SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS row_index,
  o_orderkey, o_custkey, o_totalprice FROM orders""")
def row_index_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return with_row_index(orders, "o_orderkey")


_MS = "(CASE WHEN l_linenumber <> 7 THEN (l_extendedprice - 40000) / l_quantity END)"


@query("round_frame_time", f"""SELECT l_orderkey, l_partkey, l_linenumber,
  {_ms_sql(_MS)} AS ms FROM lineitem""")
def round_frame_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    ms = F.when(F.col("l_linenumber") != 7,
                (F.col("l_extendedprice") - 40000) / F.col("l_quantity"))
    return fx.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", round_frame_ms(ms).alias("ms"))


_K_SQL = """SELECT event_id, user_id, value, event_type,
  CASE WHEN event_id % 11 = 0 THEN 'k' || json_extract_string(props, '$.k')
       ELSE json_extract_string(props, '$.k') END AS k FROM events"""


@query("rescue_cast", f"""SELECT event_id, TRY_CAST(k AS INTEGER) AS k, event_type,
  CASE WHEN TRY_CAST(k AS INTEGER) IS NULL AND k IS NOT NULL THEN '{{"k":"' || k || '"}}' END
    AS _rescued_data
FROM ({_K_SQL})""")
def rescue_cast_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    texts = fx.table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event_id"), "event_type",
        F.when(F.col("event_id") % 11 == 0, F.concat(F.lit("k"), k)).otherwise(k).alias("k"))
    schema = StructType().add("event_id", "long").add("k", "integer").add("event_type", "string")
    return rescue_cast(texts, schema)


# --- paths -----------------------------------------------------------------

_SEGMENTS = """SELECT c_custkey, 'game' || (c_nationkey % 5) AS game,
  CASE WHEN c_custkey % 2 = 0 THEN 'batting' ELSE 'pitching' END AS event_type,
  '2023_04_' || lpad((c_custkey % 28 + 1)::VARCHAR, 2, '0') || '_19_10_' ||
  lpad((c_custkey % 60)::VARCHAR, 2, '0') || '_' ||
  CASE c_custkey % 3 WHEN 0 THEN 'Comets' WHEN 1 THEN 'River_Otters' ELSE 'North_Bay_Gulls' END ||
  '_' || (c_custkey % 90) || '_' ||
  CASE WHEN c_custkey % 4 = 0 THEN 'Ann_Mary_Doe' ELSE 'Jo_' || c_mktsegment END || '_' ||
  CASE WHEN c_custkey % 2 = 0 THEN 'Home' ELSE 'Away' END AS folder FROM customer"""


def _metadata_sql(first: str, second: str) -> str:
    return f"""SELECT c_custkey, game, event_type,
  replace(regexp_extract(folder, '{EVENT_PATTERN}', 1), '_', '-') AS date,
  replace(regexp_extract(folder, '{EVENT_PATTERN}', 1) || '-' ||
          regexp_extract(folder, '{EVENT_PATTERN}', 2), '_', '-') AS date_time,
  replace(regexp_extract(folder, '{EVENT_PATTERN}', 3), '_', ' ') AS team,
  regexp_extract(folder, '{EVENT_PATTERN}', 4) AS jersey_num,
  replace(regexp_extract(folder, '{EVENT_PATTERN}', 5), '_', ' ') AS player_name,
  regexp_extract(folder, '{EVENT_PATTERN}', 6) AS location,
  '/lake/all_games/' || {first} || '/' || {second} || '/' || folder AS input_event
FROM ({_SEGMENTS})"""


def _paths(spark: SparkSession, sf_dir: str, first: str, second: str) -> DataFrame:
    c = F.col("c_custkey")
    customer = fx.table(spark, sf_dir, "customer")
    teams = F.array(F.lit("Comets"), F.lit("River_Otters"), F.lit("North_Bay_Gulls"))
    player = F.when(c % 4 == 0, F.lit("Ann_Mary_Doe")).otherwise(
        F.concat(F.lit("Jo_"), F.col("c_mktsegment")))
    folder = F.concat_ws(
        "_", F.lit("2023_04"), F.lpad((c % 28 + 1).cast("string"), 2, "0"), F.lit("19_10"),
        F.lpad((c % 60).cast("string"), 2, "0"), F.get(teams, (c % 3).cast("int")),
        (c % 90).cast("string"), player,
        F.when(c % 2 == 0, F.lit("Home")).otherwise(F.lit("Away")))
    parts = customer.select(
        "c_custkey", F.concat(F.lit("game"), (F.col("c_nationkey") % 5).cast("string")).alias("game"),
        F.when(c % 2 == 0, F.lit("batting")).otherwise(F.lit("pitching")).alias("event_type"),
        folder.alias("folder"))
    return parts.select("c_custkey", F.concat_ws(
        "/", F.lit("/lake/all_games"), first, second, "folder", F.lit("motion.csv")).alias("path"))


@query("path_metadata", _metadata_sql("game", "event_type"))
def path_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = _paths(spark, sf_dir, "game", "event_type")
    return paths.select("c_custkey", event_metadata("path").alias("m")).select("c_custkey", "m.*")


@query("path_metadata_old_layout", _metadata_sql("event_type", "game"))
def path_metadata_old_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = _paths(spark, sf_dir, "event_type", "game")
    entities = ("game", "event_type", "date", "date_time", "team", "jersey_num", "player_name",
                "location", "input_event")
    return paths.select("c_custkey", *[
        extract_metadata("path", e, "type/game").alias(e) for e in entities])


@query("path_parts", f"""SELECT c_custkey, game || '/' || event_type AS place,
  folder || '/motion.csv' AS tail FROM ({_SEGMENTS})""")
def path_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = _paths(spark, sf_dir, "game", "event_type")
    return paths.select("c_custkey", path_part("path", 4, 2).alias("place"),
                        path_part("path", -2, 2).alias("tail"))


# --- projections -----------------------------------------------------------

@query("rename_drop_lower", """SELECT lower(p_partkey::VARCHAR) AS id, lower(p_name) AS label,
  lower(p_brand) AS brand, lower(floor(p_retailprice)::BIGINT::VARCHAR) AS price,
  'part' AS kind FROM part""")
def rename_drop_lower(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = fx.table(spark, sf_dir, "part")
    whole = part.withColumn("p_retailprice", F.floor("p_retailprice"))
    named = rename_at(whole, {0: "id", 1: "label"}).withColumnsRenamed(
        {"p_brand": "brand", "p_retailprice": "price"})
    texts = named.drop("p_type", "P_SIZE", "no_such_column")
    return lower_all(texts).select("*", F.lit("part").alias("kind"))


@query("decode_bytes", "SELECT doc_id, text FROM documents")
def decode_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = fx.table(spark, sf_dir, "documents")
    coded = documents.select("doc_id", F.encode("text", "UTF-8").alias("bytes"))
    return coded.select("doc_id", decode_utf8("bytes").alias("text"))


@query("json_column", """SELECT event_id, (json_extract_string(props, '$.k'))::INTEGER AS k,
  NULL::VARCHAR AS missing FROM events""")
def json_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = fx.table(spark, sf_dir, "events").select(
        "event_id", parse_json("props", "k int, missing string").alias("p"))
    return parsed.select("event_id", "p.*")


@query("xml_column", """SELECT event_id, (json_extract_string(props, '$.k'))::INTEGER AS k,
  event_type AS kind FROM events""")
def xml_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    xml = F.concat(F.lit("<event><k>"), k, F.lit("</k><kind> "), F.col("event_type"),
                   F.lit(" </kind></event>"))
    parsed = fx.table(spark, sf_dir, "events").select("event_id", xml.alias("body")).select(
        "event_id", from_xml("body", "k int, kind string", {"rowTag": "event"}).alias("p"))
    return parsed.select("event_id", "p.*")


@query("cast_text", """SELECT event_id,
  TRY_CAST(CASE WHEN event_id % 7 = 0 THEN 'n/a' ELSE (event_id * 3)::VARCHAR END AS DOUBLE) AS x,
  (event_id * 3)::VARCHAR AS text FROM events""")
def cast_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = (F.col("event_id") * 3).cast("string")
    raw = F.when(F.col("event_id") % 7 == 0, F.lit("n/a")).otherwise(text)
    return fx.table(spark, sf_dir, "events").select(
        "event_id", to_double(raw).alias("x"), text.alias("text"))


@query("ingestion_stamp", """SELECT event_type, 19 AS stamp_length, count(*) AS n_rows
FROM events GROUP BY event_type""")
def ingestion_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stamp itself changes with every run, so its form is reported."""
    stamped = fx.table(spark, sf_dir, "events").select(
        "event_type", F.length(now_text()).alias("stamp_length"))
    return stamped.groupBy("event_type", "stamp_length").agg(F.count("*").alias("n_rows"))
