from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from swinglake.operators.tables import read_merged
from swinglake.plans.ingest import Lake, ingest_csv, ingest_report, ingest_xml
from swinglake.sources import files as src
from swinglake.sources.delimited import (
    inferred_schema, pinned_schema, promote_rescued, read_csv_stream, read_report, rescue_cast, rescue_csv, schema_versions,
    widen_schema,
)
from swinglake.sources.xml import read_xml, read_xml_stream
from swinglake.streaming.sinks import drain_to_batch, write_stream


def put(root, name: str, text: str) -> None:
    path = root / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


@pytest.fixture()
def schema(spark):
    return StructType.fromDDL("a int, b double, c string")


def by_c(df):
    return {r["c"]: r for r in df.collect()}


def test_rescue_keeps_every_row(spark, tmp_path, schema):
    put(tmp_path, "e1/m.csv", 'a,b,c\n1,2.5,good\n2\n3,1,extra,9,8\nx,2,bad\n5,6,"quo,ted"\n 7,1,space\n')
    put(tmp_path, "e2/m.csv", "C,more,A\nswapped,9,1\nboth,,zz\n")
    put(tmp_path, "e3/m.csv", "a,b,c,c\n1,2,twice,again\n")
    rows = rescue_csv(spark, f"{tmp_path}/*/m.csv", schema)
    got = by_c(rows)
    assert rows.count() == 9

    def values(c):
        r = got[c]
        return r["a"], r["b"], r["_rescued_data"] and json.loads(r["_rescued_data"]), r["row_number"]

    assert values("good") == (1, 2.5, None, 1)
    assert values(None) == (2, None, None, 2)
    assert values("extra") == (3, 1.0, {"_extra_0": "9", "_extra_1": "8"}, 3)
    assert values("bad") == (None, 2.0, {"a": "x"}, 4)
    assert values("quo,ted") == (5, 6.0, None, 5)
    assert values("space") == (None, 1.0, {"a": "7"}, 6)
    assert values("swapped") == (1, None, {"more": "9"}, 1)
    assert values("both") == (None, None, {"a": "zz"}, 2)
    assert values("twice") == (1, 2.0, {"c_3": "again"}, 1)
    assert got["good"]["input_event"].endswith("/e1")


def test_rescue_with_a_regex_delimiter(spark, tmp_path, schema):
    put(tmp_path, "e1/m.csv", "a|b|c\n1|x|one\n2|0.5|two|more\n")
    got = by_c(rescue_csv(spark, f"{tmp_path}/*/m.csv", schema, "|"))
    assert got["one"]["_rescued_data"] == '{"b":"x"}'
    assert got["two"]["_rescued_data"] == '{"_extra_0":"more"}'


def test_report_skips_title_and_trims(spark, tmp_path):
    put(tmp_path, "e1/e1.report.txt", "Title\tof report\nname\tvalue \n a \t 1\n\nb\t\n")
    put(tmp_path, "e2/e2.report.txt", "\nname\tvalue\tthird\nc\t1\t7\n")
    rows = read_report(spark, f"{tmp_path}/*/*report.txt").collect()
    assert sorted((r["name"], r["value"], r["third"]) for r in rows) == [
        ("a", "1", None), ("b", None, None), ("c", "1", "7")]
    pinned = StructType.fromDDL("name string, value string")
    rescued = {r["name"]: r["_rescued_data"]
               for r in read_report(spark, f"{tmp_path}/*/*report.txt", pinned).collect()}
    assert rescued == {"a": None, "b": None, "c": '{"third":"7"}'}


def test_xml_rescues_values_and_elements(spark, tmp_path):
    put(tmp_path, "e1/p.xml", "<r><p><ID>1</ID><W>z</W><N>9</N></p><p><ID>2</ID><W>80</W></p></r>")
    schema = StructType.fromDDL("ID long, W long, T string")
    got = {r["ID"]: r for r in read_xml(spark, f"{tmp_path}/*/p.xml", "p", schema).collect()}
    assert got[2]["W"] == 80 and got[2]["_rescued_data"] is None
    assert got[1]["W"] is None
    assert json.loads(got[1]["_rescued_data"]) == {"W": "z", "N": "9"}
    assert read_xml(spark, f"{tmp_path}/*/p.xml", "p").count() == 2


XML_ODD = """<r><p><Bats>L</Bats><ID>1</ID><n><a>01</a><a> x</a></n><W>7</W></p>
<p k="v"><ID>2</ID><Z>007</Z><Y>08</Y><Y>b</Y><Y/><Y><q>1</q></Y><E/><w>8</w></p>
<p><ID>3</ID><W>z</p><p><ID>4</ID><W>9</W><T>&lt;&amp;</T></p><p><ID>5</ID><X><![CDATA[a<b]]></X></p><p/></r>"""
XML_FOUND = {1: (7, None, {"Bats": "L", "n": "<a>01</a><a> x</a>"}), 4: (9, "<&", None),
             2: (8, None, {"Z": "007", "Y": "8", "Y_1": "b", "Y_2": "", "Y_3": '{"q":1}', "E": "", "_k": "v"}),
             5: (None, None, {"X": "a<b"})}


@pytest.mark.parametrize("streamed", [False, True])
def test_xml_rescues_elements_by_name(spark, tmp_path, streamed):
    put(tmp_path, "e1/p.xml", XML_ODD)
    schema = StructType.fromDDL("ID long, W long, T string")
    if streamed:
        rows = drain_to_batch(read_xml_stream(spark, f"{tmp_path}/*/p.xml", "p", schema),
                              f"{tmp_path}/table", f"{tmp_path}/checkpoint")
    else:
        rows = read_xml(spark, f"{tmp_path}/*/p.xml", "p", schema)
    got = rows.collect()
    whole = {r["ID"]: (r["W"], r["T"], r["_rescued_data"] and json.loads(r["_rescued_data"]))
             for r in got if "_corrupt_record" not in (r["_rescued_data"] or "") and r["ID"]}
    assert whole == XML_FOUND
    torn = [json.loads(r["_rescued_data"])["_corrupt_record"] for r in got if "_corrupt" in (r["_rescued_data"] or "")]
    assert torn == ["<p><ID>3</ID><W>z</p>"]


def test_rescued_values_are_promoted(spark):
    rows = [(1, None, '{"Note":"7","z":"q"}'), (2, None, '{"NOTE":"x"}'), (3, 5, '{"note":"6"}'), (4, None, None),
            (5, None, '{"note":"8"}'), (6, None, '{}'), (7, None, 'no json'), (8, None, '{"note":"9","NOTE":"10"}')]
    df = spark.createDataFrame(rows, "a int, note long, _rescued_data string")
    added = StructType.fromDDL("note long, z string")
    got = promote_rescued(df, added)
    assert got.columns == ["a", "note", "z", "_rescued_data"]
    assert sorted(map(tuple, got.collect())) == [
        (1, 7, "q", None), (2, None, None, '{"NOTE":"x"}'), (3, 5, None, '{"note":"6"}'), (4, None, None, None),
        (5, 8, None, None), (6, None, None, "{}"), (7, None, None, "no json"), (8, 9, None, '{"NOTE":"10"}')]
    assert promote_rescued(df.limit(0), added).count() == 0


def test_schemas_are_widened_in_versions(spark, tmp_path):
    at, first = f"{tmp_path}/schema", StructType.fromDDL("a int, b string")
    with pytest.raises(ValueError, match="no schema"):
        widen_schema(spark, at, first)
    assert pinned_schema(spark, "none", at, infer=lambda: first) == first
    wider = widen_schema(spark, at, StructType.fromDDL("B string, c long"))
    assert wider.names == ["a", "b", "c"] and widen_schema(spark, at, wider) == wider
    assert schema_versions(spark, at) == [first, wider] and pinned_schema(spark, "none", at) == wider
    with pytest.raises(ValueError, match="another type: C"):
        widen_schema(spark, at, StructType.fromDDL("C int"))


def test_rescue_cast_names_unknown_columns(spark):
    df = spark.createDataFrame([("1", "x", "keep")], "a string, z string, k string")
    row = rescue_cast(df, StructType.fromDDL("a int, b int"), keep=["k"]).first()
    assert tuple(row) == (1, None, '{"z":"x"}', "keep")


def test_schema_is_pinned_once(spark, tmp_path):
    put(tmp_path, "in/m.csv", "a,b\n1,x\n")
    first = pinned_schema(spark, f"{tmp_path}/in", f"{tmp_path}/schema")
    put(tmp_path, "in/n.csv", "a,b\n1.5,x\n")
    assert pinned_schema(spark, f"{tmp_path}/in", f"{tmp_path}/schema") == first
    assert first["a"].dataType.simpleString() == "int"


def test_pinned_schema_serves_the_native_stream(spark, tmp_path):
    put(tmp_path, "in/m.csv", "a b\n1 x\n")
    schema = pinned_schema(spark, f"{tmp_path}/in", f"{tmp_path}/schema", delimiter=" ")
    stream = read_csv_stream(spark, f"{tmp_path}/in", " ", schema)
    write_stream(stream, f"{tmp_path}/table", f"{tmp_path}/checkpoint")
    assert spark.read.parquet(f"{tmp_path}/table").collect() == [(1, "x")]
    with pytest.raises(ValueError, match="sep"):
        pinned_schema(spark, f"{tmp_path}/in", f"{tmp_path}/other", sep=" ")


def test_schema_of_different_headers_goes_by_name(spark, tmp_path):
    put(tmp_path, "in/m.csv", "a,b,d,t\n1,x,2020-01-02,true\n")
    put(tmp_path, "in/n.csv", "b,A,d,n\ny,2.5,2020-01-02 10:00:00,\n")
    put(tmp_path, "in/o.csv", "a,b,e,\n99999999999,,12:30\n")
    schema = pinned_schema(spark, f"{tmp_path}/in", f"{tmp_path}/schema")
    assert {f.name.lower(): f.dataType.simpleString() for f in schema} == {
        "a": "double", "b": "string", "d": "timestamp", "t": "boolean", "n": "string", "e": "string"}
    got = rescue_csv(spark, f"{tmp_path}/in", schema).collect()
    assert sorted((r["a"], r["b"]) for r in got if r["b"]) == [(1.0, "x"), (2.5, "y")]


EVENT = "2023_04_26_19_10_{:02d}_River_Otters_17_Al_Cole_Home"


def test_landing_tree_to_bronze(spark, tmp_path):
    """New files are picked up once, whichever run they arrive before."""
    lake = Lake(f"{tmp_path}/lake", f"{tmp_path}/landing", suffix="_test")
    place = f"landing/all_games_test/game1/batting/{EVENT}"
    put(tmp_path, f"{place.format(1)}/motion.csv", "Timestamp Hips_R11\n0 1.5\n3.3 2.5\n")
    put(tmp_path, f"{place.format(2)}/motion.csv", "Timestamp Hips_R11\n0 x\n")
    put(tmp_path, f"{place.format(1)}/other.csv", "not this one\n")
    put(tmp_path, f"{place.format(1)}/params.xml", "<S><P><ID>7</ID></P></S>")
    put(tmp_path, f"{place.format(1)}/x.report.txt", "title\nname\tvalue\na\t1\n")
    schema = StructType.fromDDL("Timestamp double, Hips_R11 double")

    rows = ingest_csv(spark, lake, "motion", "batting", " ", schema, stamp=True, max_files=1)
    assert rows.columns == ["row_index", "Timestamp", "Hips_R11", "_rescued_data", "input_file",
                            "input_event", "row_number", "ingestion_timestamp"]
    assert sorted((r["row_number"], r["Hips_R11"]) for r in rows.where("_rescued_data is null").collect()) \
        == [(1, 1.5), (2, 2.5)]
    assert rows.where("_rescued_data is not null").first()["_rescued_data"] == '{"Hips_R11":"x"}'
    assert ingest_csv(spark, lake, "motion", "batting", " ", schema).count() == 3
    put(tmp_path, f"{place.format(3)}/motion.csv", "Timestamp Hips_R11\n0 9\n")
    assert ingest_csv(spark, lake, "motion", "batting", " ", schema).count() == 4

    params = ingest_xml(spark, lake, "params", "batting", "P", "S")
    assert [r["ID"] for r in params.collect()] == [7]
    report = ingest_report(spark, lake, "report", "batting")
    assert [(r["name"], r["value"]) for r in report.collect()] == [("a", "1")]
    assert report.first()["input_event"].endswith(EVENT.format(1))
    assert (tmp_path / "lake/bronze/batting_motion_test").exists()


def test_numbers_stay_when_files_come_late(spark, tmp_path):
    lake = Lake(f"{tmp_path}/lake", f"{tmp_path}/landing")
    place = f"landing/all_games/game1/batting/{EVENT}"
    schema = StructType.fromDDL("t int")

    def run():
        rows = ingest_csv(spark, lake, "m", "batting", " ", schema, files=f"{tmp_path}/landing/all_games/*/batting/*/*.csv")
        return {r["t"]: (r["row_number"], r["row_index"]) for r in rows.collect()}

    assert run() == {}
    put(tmp_path, f"{place.format(2)}/b.csv", "t\n1\n2\n3\n")
    first = run()
    assert first == {1: (1, 0), 2: (2, 1), 3: (3, 2)}
    put(tmp_path, f"{place.format(2)}/a.csv", "t\n4\n5\n")       # sorts before the file that is there
    put(tmp_path, f"{place.format(1)}/z.csv", "t\n6\n")          # and so does this event
    second = run()
    assert second == {**first, 6: (1, 3), 4: (4, 4), 5: (5, 5)}
    written = sorted(p.name for p in (tmp_path / "lake/_ledgers/bronze/batting_m").iterdir())
    assert run() == second
    assert sorted(p.name for p in (tmp_path / "lake/_ledgers/bronze/batting_m").iterdir()) == written
    put(tmp_path, f"{place.format(2)}/aa.csv", "t\n7\n")
    assert run() == {**second, 7: (6, 6)}


def test_plain_readers(spark, tmp_path):
    put(tmp_path, "d/x.csv", "a b\n1 2\n")
    put(tmp_path, "d/y.txt", "one\ntwo\n")
    assert src.read_delimited(spark, f"{tmp_path}/d/x.csv").first() == ("1", "2")
    assert [r[0] for r in src.read_text(spark, f"{tmp_path}/d/y.txt").collect()] == ["one", "two"]
    listed = src.list_files(spark, f"{tmp_path}/d").collect()
    assert sorted((r["path"].rsplit("/", 1)[1], r["length"]) for r in listed) == [("x.csv", 8), ("y.txt", 8)]
    spark.range(3).write.parquet(f"{tmp_path}/t")
    assert src.read_table(spark, f"{tmp_path}/t").count() == 3
    assert read_merged(spark, f"{tmp_path}/t").count() == 3


@pytest.mark.parametrize("event_type", ["batting", "event_type=batting"])
def test_all_files_below_a_folder(spark, tmp_path, schema, event_type):
    """Read as by a pattern for the folders, in batch and as streams, without a path for each of them on the driver."""
    for i in range(40):
        put(tmp_path, f"c/g{i % 2}/{event_type}/event=e{i}/m.csv", f"a,b,c\n{i},1,x\n" if i % 3 else f"c,a\nx,{i}\n")
        put(tmp_path, f"r/g{i % 2}/{event_type}/event=e{i}/r.txt", f"title\nname\tvalue\na\t{i}\n")
        put(tmp_path, f"x/g{i % 2}/{event_type}/event=e{i}/p.xml", f"<S><P><a>{i}</a></P></S>")
        put(tmp_path, f"c/g{i % 2}/other/event=e{i}/m.csv", "not this one\n")
    number = StructType.fromDDL("a int")

    def glob(kind, end):
        return f"{tmp_path}/{kind}/*/{event_type}/{end}"

    def ingested(end, run, **kept):
        lake = Lake(f"{tmp_path}/{run}", str(tmp_path))
        return (ingest_csv(spark, lake, "m", "batting", ",", schema, files=glob("c", end), **kept),
                ingest_report(spark, lake, "r", "batting", files=glob("r", end), **kept),
                ingest_xml(spark, lake, "p", "batting", "P", "S", number, files=glob("x", end), **kept))

    made = [(rescue_csv(spark, glob("c", end), schema), read_report(spark, glob("r", end)),
             read_xml(spark, glob("x", end), "P", number), *ingested(end, run, max_files=15))
            for end, run in (("*", "lake1"), ("**", "lake2"))]
    for by_pattern, below in zip(*made):
        assert below.columns == by_pattern.columns and below.count() == 40
        assert below.exceptAll(by_pattern).count() == 0
    again = ingested("**", "lake2")
    assert [r.count() for r in again] == [40, 40, 40]
    assert inferred_schema(spark, glob("r", "**"), "\t") == inferred_schema(spark, glob("r", "*"), "\t")
    # a batch of few small files is one task for each core at most, and one file in bronze for each
    files = {f for f in again[0].inputFiles()}
    assert len(files) <= 3 * spark.sparkContext.defaultParallelism < 40


def test_headers_come_with_the_count_of_lines(spark, tmp_path, schema, monkeypatch):
    """Lines are counted once and headers are not looked up, wherever they are; a file may begin with blank lines."""
    from swinglake.operators import numbering
    tables, keep = [], numbering.staged

    def seen(df, name):
        tables.append(name)
        return keep(df, name)

    monkeypatch.setattr(numbering, "staged", seen)
    put(tmp_path, "e1/m.csv", "\n" * 300 + "c,a\n" + "one,1\n" * 50)
    put(tmp_path, "e2/m.csv", "a,b,c\n2,3,two\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "100b")
        got = rescue_csv(spark, f"{tmp_path}/*/m.csv", schema).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert tables == ["counted", "splits"]
    assert sorted((r["a"], r["c"], r["row_number"]) for r in got) == sorted([(1, "one", i + 1) for i in range(50)] + [(2, "two", 1)])


def test_landing_files_are_written_and_listed_by_several_tasks(spark, tmp_path):
    from swinglake.catalog import fixtures as fx
    from swinglake.catalog.landing import _glob
    from swinglake.operators.numbering import with_file_position

    spark.range(400).selectExpr("id AS event_id", "id % 40 AS user_id", "'tap' AS event_type", "id / 4 AS value").write.parquet(
        f"{tmp_path}/events.parquet")
    fx.append_csv(spark, str(tmp_path), str(tmp_path), F.col("row_number") <= 3)
    roots = [fx.write_csv(spark, str(tmp_path)), fx.write_reports(spark, str(tmp_path)), fx.write_xml(spark, str(tmp_path)), str(tmp_path)]
    for root in roots:
        files = with_file_position(spark.read.text(_glob(root))).select("input_file").distinct()
        found = files.select(F.regexp_extract("input_file", "event=[^/]*_Player_([0-9]+)_", 1).alias("user"),
                             F.regexp_extract("input_file", "/part-([0-9]+)-", 1).alias("task"))
        assert found.select("user").distinct().count() == 40
        assert found.select("task").distinct().count() > 2
