from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from swinglake.joints import key_frames_schema, master_schema
from swinglake.operators.kept_profile import extend_profile, read_profile
from swinglake.operators.profile import event_count, profile_layer, row_count, stage_counts, summarize
from swinglake.operators.tables import (
    append_merge, compact, compact_small, ensure_layers, ensure_table, files_of, read_current,
)
from swinglake.plans.validate import validate
from swinglake.sources.files import list_files, read_table, stream_table
from swinglake.streaming import write_stream


def test_layers_and_typed_tables(spark, tmp_path):
    prefix = f"t{uuid.uuid4().hex[:8]}_"
    names = ensure_layers(spark, prefix, str(tmp_path))
    assert names == [prefix + n for n in ("landing", "bronze", "silver", "gold")]
    assert ensure_layers(spark, prefix, str(tmp_path)) == names
    silver = f"{prefix}silver"
    ensure_table(spark, f"{silver}.kf", key_frames_schema(), comment="it's \\ typed")
    ensure_table(spark, f"{silver}.ms", master_schema())
    ensure_table(spark, f"{silver}.ms", master_schema())
    assert len(spark.table(f"{silver}.kf").columns) == 475
    assert spark.catalog.getTable(f"{silver}.kf").description == "it's \\ typed"
    rows = [(1, 2, "p", 3, 0.5, e) + ({"r11": 1.0},) * 29 for e in ("a", "a", None)]
    spark.createDataFrame(rows, master_schema()).write.insertInto(f"{silver}.ms")
    spark.range(3).write.saveAsTable(f"{silver}.plain")
    got = {r["table"]: (r["n_rows"], r["n_events"]) for r in profile_layer(spark, silver).collect()}
    # NULL is one more event, as in a distinct count of rows
    assert got == {"kf": (0, 0), "ms": (3, 2), "plain": (3, None)}
    assert validate(spark, names).count() == 3
    assert profile_layer(spark, f"{prefix}gold").count() == 0


def test_profiles_are_kept_up(spark, tmp_path):
    at, profile = f"{tmp_path}/t", f"{tmp_path}/p"
    assert read_profile(spark, profile).count() == 0
    kinds = "batch_id int, x double, s string, e int"
    assert extend_profile(spark.createDataFrame([], kinds), profile, "batch_id") is None
    rows = {0: [(1.0, "b", None), (None, "b", None)], 3: [(5.0, None, None), (3.0, "a", None), (3.0, "a", None)]}
    for batch, some in rows.items():
        spark.createDataFrame(some, "x double, s string, e int").write.parquet(f"{at}/batch_id={batch}")
        assert extend_profile(spark.read.parquet(at), profile, "batch_id") == batch
    # an older batch that changes is not read again
    spark.range(100).selectExpr("id / 1.0D AS x", "'q' AS s", "1 AS e").write.mode("overwrite").parquet(f"{at}/batch_id=0")
    assert extend_profile(spark.read.parquet(at), profile, "batch_id") is None
    got = {r["column"]: tuple(r)[2:] for r in read_profile(spark, profile, [0.5]).collect()}
    assert got == {"x": (4, 1, 3, "1.0", "5.0", 3.0), "s": (4, 1, 2, "a", "b", None), "e": (0, 5, 0, None, None, None)}


def test_appends_merge_columns(spark, tmp_path):
    append_merge(spark.range(2), f"{tmp_path}/t")
    merged = append_merge(spark.range(1).withColumn("x", F.lit(5)), f"{tmp_path}/t")
    assert sorted((r["id"], r["x"]) for r in merged.fillna(0).collect()) == [(0, 0), (0, 5), (1, 0)]


def test_compaction_keeps_rows_and_spreads_a_hot_key(spark, tmp_path):
    df = spark.range(0, 20_000, 1, 40).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 100).alias("ID"),
        F.lit(1).alias("GamePK"), F.lit("p").alias("PlayID"), F.col("id").alias("x"))
    df.write.parquet(f"{tmp_path}/in")
    size = list_files(spark, f"{tmp_path}/in", "*.parquet").agg(F.sum("length")).first()[0]
    out = compact(spark, f"{tmp_path}/in", f"{tmp_path}/out", file_bytes=size // 6)
    assert out.exceptAll(df).count() == 0 and out.count() == 20_000
    files = out.groupBy(F.input_file_name().alias("f")).agg(
        F.count("*").alias("n"), F.min("ID").alias("lo"), F.max("ID").alias("hi")).collect()
    assert 2 <= len(files) < 40
    assert max(f["n"] for f in files) < 20_000 / 3
    by_low = sorted(files, key=lambda f: (f["lo"], f["hi"]))
    assert all(a["hi"] <= b["lo"] for a, b in zip(by_low, by_low[1:]))


def test_counts_and_summary(spark):
    df = spark.range(1, 101).select((F.col("id") * 1.0).alias("x"), F.lit("t").alias("input_event"))
    assert row_count(df).first()[0] == 100 and event_count(df).first()[0] == 1
    s = summarize(df).first()
    assert (s["column"], s["n"], s["mean"], s["min"], s["max"]) == ("x", 100, 50.5, 1.0, 100.0)
    assert (s["p25"], s["p50"], s["p75"]) == (25.0, 50.0, 75.0)
    stages = stage_counts({"a": df, "b": df.limit(3)})
    assert {r["stage"]: r["n_rows"] for r in stages.collect()} == {"a": 100, "b": 3}


def test_streams_between_catalog_tables(spark, tmp_path):
    name = ensure_layers(spark, f"t{uuid.uuid4().hex[:8]}_", str(tmp_path))[1]
    spark.range(5).write.saveAsTable(f"{name}.source")
    for _ in range(2):  # the second run finds nothing new
        stream = stream_table(spark, f"{name}.source").where("id > 1")
        write_stream(stream, f"{name}.target", f"{tmp_path}/checkpoint")
    assert sorted(r[0] for r in read_table(spark, f"{name}.target").collect()) == [2, 3, 4]
    spark.range(7, 8).write.insertInto(f"{name}.source")
    write_stream(stream_table(spark, f"{name}.source"), f"{name}.target", f"{tmp_path}/checkpoint")
    assert read_table(spark, f"{name}.target").count() == 4


def test_curve_skips_files_by_every_key(spark, tmp_path):
    """A key with a third of the rows, nulls, and a text key."""
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.xxhash64("id") % 1000).alias("ID"),
        F.when(F.col("id") % 11 != 0, F.xxhash64("id", F.lit(1)) % 1000).alias("GamePK"),
        F.md5(F.col("id").cast("string")).alias("PlayID"), F.rand(3).alias("x"))
    rows.write.parquet(f"{tmp_path}/in")
    size = sum(f.stat().st_size for f in (tmp_path / "in").glob("part-*"))
    out = compact(spark, f"{tmp_path}/in", f"{tmp_path}/out", file_bytes=size // 120, curve=True)
    assert out.exceptAll(spark.read.parquet(f"{tmp_path}/in")).count() == 0 and out.count() == 30_000
    files = out.groupBy(F.input_file_name().alias("f")).agg(
        F.count("*").alias("n"), *[g(c).alias(f"{c}_{g.__name__}") for c in ("ID", "GamePK", "PlayID") for g in (F.min, F.max)]).collect()
    assert len(files) >= 100 and max(f["n"] for f in files) < 30_000 / 20
    for key, value in (("ID", 300), ("GamePK", -200), ("PlayID", "8")):
        assert sum(f[f"{key}_min"] is not None and f[f"{key}_min"] <= value <= f[f"{key}_max"] for f in files) <= len(files) / 3


def test_small_files_are_packed_once(spark, tmp_path):
    table = f"{tmp_path}/some table"
    for i in range(6):
        spark.range(i * 10, i * 10 + 10).withColumn(f"c{i % 2}", F.lit(i)).coalesce(1).write.mode("append").parquet(table)
    spark.range(100, 50_000).withColumn("c0", F.rand()).select("id", F.lit(None).cast("int").alias("c0")).coalesce(1).write.mode(
        "append").parquet(table)
    lengths = sorted(r["length"] for r in files_of(spark, table).collect())
    large = [r["path"] for r in files_of(spark, table).collect() if r["length"] == lengths[-1]]
    want = sorted(map(tuple, read_current(spark, table).select("id", "c0", "c1").collect()), key=str)
    limit = sum(lengths[:3]) + 1
    assert lengths[-1] > limit and compact_small(spark, table, limit) == 6
    now = {r["path"] for r in files_of(spark, table).collect()}
    assert len(now) == 3 and set(large) < now
    assert compact_small(spark, table, limit) == 0 and {r["path"] for r in files_of(spark, table).collect()} == now
    assert sorted(map(tuple, read_current(spark, table).select("id", "c0", "c1").collect()), key=str) == want
    spark.range(-5, 0).coalesce(1).write.mode("append").parquet(table)
    assert read_current(spark, table).count() == len(want) + 5
