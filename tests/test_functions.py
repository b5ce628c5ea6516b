from __future__ import annotations

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from swinglake import functions as fn
from swinglake.operators.shaping import rename_at


def whole_ms(x: float | None) -> int:
    if x is None:
        return 0
    i = math.trunc(x)
    return i + 1 if i % 10 == 9 else i


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.floats(-1e6, 1e6)), min_size=50, max_size=200))
def test_frame_times_round_like_the_rule(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(fn.round_frame_ms("x")).collect()]
    assert got == [whole_ms(v) for v in values]


def test_frame_times_at_the_edges(spark):
    values = [None, 0.0, 9.0, 9.999999, 19.5, -1.0, -9.0, -0.5, 79.999992, 83.33]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(fn.round_frame_ms("x")).collect()]
    assert got == [0, 0, 10, 10, 20, 0, -9, 0, 80, 83]
    text = spark.createDataFrame([("9",), ("x",), (None,)], "x string")
    assert [r[0] for r in text.select(fn.round_func("x")).collect()] == [10, 0, 0]


def test_packed_lists(spark):
    df = spark.createDataFrame([("{T;F;;T}", "{0.5;x;}", "{4;7;x;10}"), ("", None, "{}")],
                               "s string, d string, k string")
    first, second = df.select(
        fn.tracking_states(fn.split_list(fn.strip_braces("s"))).alias("s"),
        fn.parse_doubles("d").alias("d"),
        fn.rebase_ms(fn.split_list(fn.strip_braces("k"))).alias("k")).collect()
    assert first["s"] == [1, 0, 0, 1]
    assert first["d"] == [0.5, None, None]
    assert first["k"] == [0.0, 3 * 3.333333, None, 6 * 3.333333]
    assert second["s"] == [0] and second["d"] is None and second["k"] == [None]


def test_zip_pads_and_explode_counts(spark):
    df = spark.createDataFrame([("e", ["a", "b", "c"], [1, 2])], "e string, n array<string>, i array<int>")
    rows = fn.explode_pos(df, fn.zip_arrays("n", "i"), "e").select(
        "e", "position", "item.n", "item.i").collect()
    assert [tuple(r) for r in rows] == [("e", 0, "a", 1), ("e", 1, "b", 2), ("e", 2, "c", None)]


def test_build_map_widens(spark):
    row = spark.range(1).select(fn.build_map({"a": F.lit(1), "b": F.lit(0.5)}).alias("m")).first()
    assert row["m"] == {"a": 1.0, "b": 0.5}


FOLDERS = {
    "2023_04_26_19_10_28_Comets_17_Al_Cole_Home": ("Comets", "17", "Al Cole", "Home"),
    "2023_04_26_19_10_28_River_Otters_7_Jo_Home": ("River Otters", "7", "Jo", "Home"),
    "2023_04_26_19_10_28_North_Bay_Gulls_99_Ann_Mary_Doe_Away":
        ("North Bay Gulls", "99", "Ann Mary Doe", "Away"),
}


@pytest.mark.parametrize("layout,middle", [("game/type", "game1/batting"), ("type/game", "batting/game1")])
@pytest.mark.parametrize("root", ["/lake", "s3://bucket/deep/er/landing/all_games", "file:/x"])
def test_path_metadata(spark, layout, middle, root):
    paths = [(f"{root}/{middle}/{f}/motion.csv", f) for f in FOLDERS]
    df = spark.createDataFrame(paths, "path string, folder string")
    for r in df.select("folder", "path", fn.event_metadata("path", layout).alias("m")).collect():
        m = r["m"]
        assert (m["team"], m["jersey_num"], m["player_name"], m["location"]) == FOLDERS[r["folder"]]
        assert (m["game"], m["event_type"]) == ("game1", "batting")
        assert (m["date"], m["date_time"]) == ("2023-04-26", "2023-04-26-19-10-28")
        assert m["input_event"] == r["path"].rsplit("/", 1)[0]


def test_unknown_path_entity(spark):
    with pytest.raises(ValueError):
        fn.extract_metadata("path", "weather")
    df = spark.createDataFrame([("/l/game2/pitching/e/f.csv",)], "path string")
    assert df.select(fn.extract_metadata(F.col("path"))).first()[0] == "game2"


def test_payload_columns(spark):
    df = spark.createDataFrame([(bytearray("é".encode()), "<p><a>1</a></p>", '{"k": 2}')],
                               "b binary, x string, j string")
    row = df.select(
        fn.decode_utf8("b").alias("b"), fn.from_xml("x", "a int").alias("x"),
        fn.parse_json("j", "k int").alias("j"), fn.now_text().alias("now")).first()
    assert (row["b"], row["x"]["a"], row["j"]["k"], len(row["now"])) == ("é", 1, 2, 19)


def test_columns_by_position(spark):
    df = spark.createDataFrame([(1, "A", "B")], "i int, x string, y string")
    assert rename_at(df, {1: "first", 2: "second"}).columns == ["i", "first", "second"]
    assert fn.lower_all(df).first() == ("1", "a", "b")
