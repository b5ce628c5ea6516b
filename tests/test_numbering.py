from __future__ import annotations

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from swinglake.operators.numbering import with_row_index, with_row_number
from swinglake.sources.delimited import parse_lines, text_lines
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

SCHEMA = StructType([StructField("n", IntegerType()), StructField("t", StringType())])


def test_rows_are_numbered_per_event(spark):
    rows = [(10, "event1", "a"), (20, "event1", "b"), (30, "event2", "c")]
    df = spark.createDataFrame(rows, "row_index long, input_event string, col1 string")
    got = with_row_number(df, "input_event", "row_index").collect()
    assert sorted(tuple(r) for r in got) == [r + (n,) for r, n in zip(rows, (1, 2, 1))]


def test_a_hot_event_is_numbered_in_slices(spark):
    rnd = random.Random(7)
    rows = [("hot" if rnd.random() < .4 else f"e{rnd.randrange(50)}", rnd.randrange(10**9), i)
            for i in range(20_000)]
    rows += [(None, i % 50, i) for i in range(3_000)]  # a hot NULL key with many ties
    rows += [("hot", None, -1)]
    df = spark.createDataFrame(rows, "k string, t long, i long").repartition(16)
    plain = df.withColumn("row_number", F.row_number().over(Window.partitionBy("k").orderBy("t", "i")))
    sliced = with_row_number(df, "k", ["t", "i"])
    assert sliced.exceptAll(plain.withColumn("row_number", F.col("row_number").cast("long"))).count() == 0
    assert sliced.count() == len(rows)


def test_file_order_over_splits_and_files(spark, tmp_path):
    """Files cut into many splits, two files of one event, blank lines, no last newline."""
    counts = {"e1/a.csv": 3000, "e1/b.csv": 700, "e2/a.csv": 1, "e3/a.csv": 0, "e4/a.csv": 1500}
    for name, n in counts.items():
        f = tmp_path / name
        f.parent.mkdir(exist_ok=True)
        f.write_text("n,t\n" + "\n".join(f"{i},{name}{'' if i % 5 else chr(10)}" for i in range(n)))
    old = {k: spark.conf.get(k) for k in
           ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
        spark.conf.set("spark.sql.files.openCostInBytes", "10")
        lines = text_lines(spark, f"{tmp_path}/*/*.csv")
        assert lines.select("_file_block").distinct().count() > 5
        got = parse_lines(lines, SCHEMA, index="row_index").collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(got) == sum(counts.values())
    for r in got:
        name = r["t"]
        before = 3000 if name == "e1/b.csv" else 0
        assert r["row_number"] == r["n"] + 1 + before
        start = {"e1/a.csv": 0, "e1/b.csv": 3000, "e2/a.csv": 3700, "e4/a.csv": 3701}[name]
        assert r["row_index"] == start + r["n"]
        assert r["_rescued_data"] is None


def test_dense_row_index(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 37 % 5003).alias("k"), F.lit(1).alias("same"))
    by_key = with_row_index(df, "k")
    assert by_key.columns[0] == "row_index"
    keys = [r["k"] for r in by_key.orderBy("row_index").collect()]
    assert keys == sorted(keys)
    ties = with_row_index(df, "same").agg(
        F.min("row_index"), F.max("row_index"), F.count_distinct("row_index")).first()
    assert tuple(ties) == (0, 4999, 5000)
    as_read = with_row_index(spark.range(0, 1000, 1, 5))
    assert as_read.where("id <> row_index").count() == 0
