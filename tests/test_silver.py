from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from swinglake.joints import (
    JOINTS, KEY_FRAME_NAMES, MASTER_JOINTS, MEASURES, TRACKER_SLOTS, key_frames_schema, map_keys,
    master_schema, motion_schema, pose_column, tracker_slots,
)
from swinglake.operators.joins import align_frames, enrich, possible_matches
from swinglake.operators.shaping import clean, pack_maps, pose_columns, spread_tracker
from swinglake.plans import silver
from swinglake.sources.files import stream_table
from swinglake.streaming import drain_to_batch, read_batches, union_batches, within, write_stream
from swinglake.streaming.bounded import drain_paired, matches, paired, unmatched, waiting

EVENTS = [f"lake/e{i}" for i in range(4)]


def _motion_rows(spark):
    """40 frames per event; element k of joint j is j + k / 100 + frame."""
    frames = spark.createDataFrame([(e, r) for e in EVENTS for r in range(1, 41)],
                                   "input_event string, row_number long")
    poses = [f"CAST({j} + {k} / 100D + row_number AS {f.dataType.simpleString()}) AS {f.name}"
             for f in motion_schema().fields[1:]
             for j, k in [(JOINTS.index(f.name.split("_")[0]), MEASURES.index(f.name.split("_")[1]))]]
    return frames.selectExpr(
        "row_number - 1 AS row_index", "(row_number - 1) * 3.333333D AS Timestamp", *poses,
        "CASE WHEN row_number = 40 THEN '{}' END AS _rescued_data",
        "'f' AS input_file", "input_event", "row_number")


@pytest.fixture(scope="module")
def bronze(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("bronze")
    _motion_rows(spark).repartition(3).write.parquet(f"{root}/motion")
    states = "{" + ";".join("T" if i % 2 else "F" for i in range(25)) + "}"
    doubles = "{" + ";".join(f"0.{i:02d}" for i in range(25)) + "}"
    frames = [(r, states, doubles, doubles if r > 2 else "{1;x}", None, "f", e, r)
              for e in EVENTS for r in range(1, 42)]
    spark.createDataFrame(
        frames, "row_index long, s string, c string, b string, _rescued_data string, "
                "input_file string, input_event string, row_number long").write.parquet(f"{root}/frames")
    indices = "{" + ";".join(str(5 + 2 * i) if i != 3 else "?" for i in range(17)) + "}"
    lists = [("{T;F}", indices, "{" + ";".join("0.5" for _ in range(17)) + "}",
              "{}" if e == EVENTS[3] else None, "f", e) for e in EVENTS]
    spark.createDataFrame(
        lists, "AreKeyFramesDetected string, KeyFrameIndices string, KeyFrameDetectionScores string, "
               "_rescued_data string, input_file string, input_event string").write.parquet(f"{root}/kf")
    params = [(1, 10, "P0", 190, None, "f", EVENTS[0]), (2, 10, "P0", 190, None, "f", EVENTS[0]),
              (1, 11, "P1", 180, None, "f", EVENTS[1]), (1, 12, "P2", 180, "{}", "f", EVENTS[2])]
    spark.createDataFrame(
        params, "GamePK long, ID long, PlayID string, Weight long, _rescued_data string, "
                "input_file string, input_event string").write.parquet(f"{root}/params")
    return root


def same(a, b):
    assert a.columns == b.columns
    assert a.count() == b.count()
    a, b = (d.select([F.to_json(c).alias(c) if t.startswith("map") else F.col(c)
                      for c, t in d.dtypes]) for d in (a, b))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_schemas():
    assert len(key_frames_schema()) == 475
    assert len(master_schema()) == 35
    assert sum(len(map_keys(j)) for j in MASTER_JOINTS) == 20 * 19 + 9 * 16
    assert {j.lower() for j in MASTER_JOINTS} == {j.lower() for j in JOINTS}


def test_slot_table(spark):
    table = tracker_slots(spark)
    assert table.count() == 25 and table.where("is_duplicate").count() == 5
    assert table.where("slot = 7").first()["motion_sequence"] == "leftwrist"


def test_312_pose_columns(spark, bronze):
    columns = pose_columns(spark.read.parquet(f"{bronze}/motion"))
    assert len(columns) == 312
    assert "Hips_R11" in columns and "JointHead_tz" in columns
    assert not any(c.startswith(("Center", "Top", "Knob")) or "_M" in c for c in columns)


def test_key_frames(spark, bronze):
    read = spark.read.parquet
    table = silver.key_frames(read(f"{bronze}/motion"), read(f"{bronze}/kf"), read(f"{bronze}/params"))
    assert table.schema.fieldNames() == key_frames_schema().fieldNames()
    assert [f.dataType for f in table.schema] == [f.dataType for f in key_frames_schema()]
    rows = table.where(F.col("input_event") == EVENTS[1]).collect()
    by_name = {r["KeyFrameNames"]: r for r in rows}
    assert set(by_name) == set(KEY_FRAME_NAMES)
    # index 5 + 2*8 is 16 frames after the first: 53.3 ms, the 17th motion row
    ball = by_name["BallContact"]
    assert ball["KeyFrameIndicesAdjusted"] == ball["TimestampRounded"] == 53
    assert ball["Hips_R11"] == 17.0 and (ball["ID"], ball["PlayID"]) == (11, "P1")
    # an index that is no number falls on the first row
    assert by_name["LeadingToeStrike"]["Timestamp"] == 0.0
    # lists shorter than the names are padded
    assert by_name["StartBackLegWeightShift"]["AreKeyFramesDetected"] == "T"
    assert ball["AreKeyFramesDetected"] is None
    counts = {r["input_event"]: r["count"] for r in table.groupBy("input_event").count().collect()}
    # two parameter rows double the first event, none or a rescued one leave NULLs,
    # a rescued key-frame row drops the event
    assert counts == {EVENTS[0]: 34, EVENTS[1]: 17, EVENTS[2]: 17}
    assert table.where(F.col("input_event") == EVENTS[2]).first()["GamePK"] is None
    without = silver.key_frames(read(f"{bronze}/motion"), read(f"{bronze}/kf"),
                                read(f"{bronze}/params"), drop_undetected=True)
    assert without.where(F.col("KeyFrameNames") == "LeadingToeStrike").count() == 0
    assert without.count() == 64


def test_key_frames_on_streams(spark, bronze, tmp_path):
    read = spark.read.parquet
    batch = silver.key_frames(read(f"{bronze}/motion"), read(f"{bronze}/kf"), read(f"{bronze}/params"))
    stream = silver.key_frames(
        stream_table(spark, f"{bronze}/motion", max_files=1), stream_table(spark, f"{bronze}/kf"),
        read(f"{bronze}/params"))
    assert stream.isStreaming
    same(silver.publish(spark, stream, f"{tmp_path}/t", f"{tmp_path}/c"), batch)


def test_master(spark, bronze, tmp_path):
    read = spark.read.parquet
    feeds = read(f"{bronze}/motion"), read(f"{bronze}/frames"), read(f"{bronze}/params")
    table = silver.master(*feeds)
    assert table.schema.fieldNames() == master_schema().fieldNames()
    assert table.count() == 39 * (2 + 1 + 1 + 1)
    row = table.where((F.col("input_event") == EVENTS[1]) & (F.col("Timestamp") > 9)
                      & (F.col("Timestamp") < 11)).first()
    wrist, slot = row["leftwrist_zip"], TRACKER_SLOTS.index("leftwrist")
    assert set(wrist) == set(map_keys("leftwrist"))
    joint = JOINTS.index("LeftWrist")
    assert wrist["ty"] == joint + 7 / 100 + 4
    assert (wrist["TrackingStates"], wrist["ConfidenceValues"]) == (slot % 2, slot / 100)
    assert set(row["Knob_zip"]) == set(map_keys("Knob"))
    short = table.where((F.col("input_event") == EVENTS[1]) & (F.col("Timestamp") == 0)).first()
    assert short["hips_zip"]["BoneFittingErrors"] == 1.0
    assert short["spine_zip"]["BoneFittingErrors"] is None  # 'x'
    assert short["neck_zip"]["BoneFittingErrors"] is None   # past the end

    streams = (stream_table(spark, f"{bronze}/motion", max_files=2),
               stream_table(spark, f"{bronze}/frames"))
    same(silver.master_batch(*streams, feeds[2], f"{tmp_path}/b", f"{tmp_path}/s"), table)
    joints = ("hips", "Knob")
    few = silver.master(*streams, feeds[2], joints)
    same(silver.publish(spark, few, f"{tmp_path}/t", f"{tmp_path}/c"), silver.master(*feeds, joints))


def rows_through_exchanges(df, column: str) -> list[int]:
    """Rows written by the exchanges that carry ``column``, once ``df`` has run."""
    plan = df._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    found, todo = [], [plan.executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "Exchange" and column in node.outputPartitioning().toString() + node.child().output().mkString(","):
            found.append(node.metrics().get("shuffleRecordsWritten").get().value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
        if "QueryStage" in name:
            todo.append(node.plan())
    return found


def test_only_matched_wide_rows_are_shuffled(spark):
    from swinglake.catalog import fixtures as fx
    b = fx.bronze(spark, "/root/testdata/sf0.01")
    read = spark.read.parquet
    hints = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    try:
        for h in hints:
            spark.conf.set(h, -1)
        table = silver.key_frames(read(b.motion), read(b.key_frames), read(b.params))
        moved = rows_through_exchanges(table, "Hips_R11")
    finally:
        for h in hints:
            spark.conf.unset(h)
    matched = table.select("input_event", "TimestampRounded").distinct().count()
    assert len(moved) == 1 and matched <= moved[0] <= 1.01 * matched < read(b.motion).count() / 2


@pytest.mark.parametrize("bits", [64, 1 << 12, 1 << 26])
def test_no_match_is_filtered_out(spark, bits):
    """Whatever the size of the filter; a small one only lets more pass."""
    wide = spark.range(5000).select((F.col("id") % 700).cast("int").alias("a"), F.col("id").cast("string").alias("b"))
    narrow = spark.range(0, 5000, 50).select((F.col("id") % 700).alias("k"), F.col("id").cast("string").alias("l"))
    passed = possible_matches(wide, ("a", "b"), narrow, ("k", "l"), bits)
    want = wide.join(narrow, (F.col("a") == F.col("k")) & (F.col("b") == F.col("l")), "left_semi")
    assert want.count() == 100 and want.exceptAll(passed).count() == 0
    assert passed.columns == ["a", "b"] and (bits < 1 << 26 or passed.count() == 100)


def test_late_parameters_are_filled_in(spark, bronze, tmp_path):
    read, feeds = spark.read.parquet, {n: f"{bronze}/{n}" for n in ("motion", "frames", "params")}
    table, staging, some = f"{tmp_path}/t", f"{tmp_path}/s", ("hips",)
    events = sorted(r[0] for r in read(feeds["params"]).select("input_event").distinct().collect())

    def run(params):
        return silver.master_batch(stream_table(spark, feeds["motion"]), stream_table(spark, feeds["frames"]),
                                   params, table, staging, some)

    def files():
        return {str(p): p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("part-*")}

    def compared(rows):
        return rows.withColumn("hips_zip", F.to_json("hips_zip"))

    known = read(feeds["params"]).where(F.col("input_event") == events[0])
    same(compared(run(known)), compared(silver.master(read(feeds["motion"]), read(feeds["frames"]), known, some)))
    before = files()
    assert any("late=1" in f for f in before)
    same(compared(run(read(feeds["params"]))),
         compared(silver.master(*[read(feeds[n]) for n in ("motion", "frames", "params")], some)))
    after = files()
    assert {f: t for f, t in before.items() if "late=0" in f}.items() <= after.items()      # what was complete is untouched
    run(read(feeds["params"]))
    assert files() == after and silver.fill_late_parameters(spark, read(feeds["params"]), table, staging) == 0


def test_maps_from_spread_columns(spark, bronze):
    """Spreading to 75 columns and packing gives what the pipeline packs from arrays."""
    read = spark.read.parquet
    frames = silver.tracker_frames(read(f"{bronze}/frames"))
    flat = align_frames(spread_tracker(frames), clean(read(f"{bronze}/motion")))
    want = silver.pack_maps(align_frames(frames, clean(read(f"{bronze}/motion"))), spread=False)
    got = pack_maps(flat)
    assert not any("TrackingStates" in c or c.startswith("hips_R") for c in got.columns)
    same(got.select(want.columns), want)


def test_salted_enrichment_is_the_plain_one(spark, bronze):
    read = spark.read.parquet
    rows = clean(read(f"{bronze}/motion")).select("input_event", "row_number")
    params = silver.clean_parameters(read(f"{bronze}/params"))
    same(enrich(rows, params, salts=5), enrich(rows, params))


def test_batches_and_drain(spark, bronze, tmp_path):
    stream = stream_table(spark, f"{bronze}/motion", max_files=1).select("input_event", "row_number")
    drained = drain_to_batch(stream, f"{tmp_path}/s", f"{tmp_path}/c")
    rows = spark.read.parquet(f"{bronze}/motion").select("input_event", "row_number")
    same(drained, rows)
    assert union_batches([rows, rows]).count() == 2 * rows.count()


def test_bounded_stream_join(spark, tmp_path):
    times = "i long, at timestamp"
    left = [(i, f"2024-01-01 00:0{i}:00") for i in range(5)]
    for name, shift in (("l", 0), ("r", 1)):
        spark.createDataFrame(left, "i long, t string").select(
            "i", (F.to_timestamp("t") + F.expr(f"make_interval(0,0,0,0,0,i * {shift})")).alias("at")
        ).write.parquet(f"{tmp_path}/{name}")
    a = spark.readStream.schema(times).parquet(f"{tmp_path}/l")
    b = spark.readStream.schema(times).parquet(f"{tmp_path}/r").withColumnRenamed("i", "k")
    a, b, close = within(a, b, "at", "2 minutes")
    joined = a.join(b, (a["i"] == b["k"]) & close).select("i")
    write_stream(joined, f"{tmp_path}/t", f"{tmp_path}/c")
    assert sorted(r[0] for r in spark.read.schema("i long").parquet(f"{tmp_path}/t").collect()) == [0, 1, 2]


def _land(spark, at, rows):
    spark.createDataFrame(rows, "k long, t string, v string").select(
        "k", F.to_timestamp("t").alias("at"), "v").coalesce(1).write.mode("append").parquet(at)


def test_rows_without_partner_leave_the_state(spark, tmp_path):
    """A null key, a null time, repeated rows, and state that ends when the watermark has passed."""
    kinds, got = "k long, at timestamp, v string", []
    hours = [
        ([(1, "2024-01-01 00:00:00", "a"), (1, "2024-01-01 00:00:00", "a"), (2, "2024-01-01 00:00:00", "b"),
          (None, "2024-01-01 00:00:00", "c"), (5, None, "d")],
         [(1, "2024-01-01 00:02:00", "A"), (2, "2024-01-01 00:09:00", "B"), (5, "2024-01-01 00:00:00", "D")]),
        ([(3, "2024-01-01 01:00:00", "e"), (4, "2024-01-01 01:00:00", "f")], [(3, "2024-01-01 01:01:00", "E")])]
    for left, right in hours:
        _land(spark, f"{tmp_path}/l", left)
        _land(spark, f"{tmp_path}/r", right)
        sides = [spark.readStream.schema(kinds).parquet(f"{tmp_path}/{n}") for n in "lr"]
        got += drain_paired(paired(*sides, ["k"], "at", "3 minutes"), f"{tmp_path}/t", f"{tmp_path}/c")
    pairs = matches(spark, f"{tmp_path}/t").select("left.v", F.col("right.v").alias("w")).collect()
    assert sorted(map(tuple, pairs)) == [("a", "A"), ("a", "A"), ("e", "E")]
    alone = {s: sorted(r["v"] for r in unmatched(spark, f"{tmp_path}/t", s).collect()) for s in ("left", "right")}
    assert alone == {"left": ["b", "c", "d"], "right": ["B", "D"]}
    assert [r["v"] for r in waiting(spark, f"{tmp_path}/c", "left").collect()] == ["f"]
    assert waiting(spark, f"{tmp_path}/c", "right").count() == 0
    assert [s.rows_in_state for s in got] == [7, 7, 10, 3]
    assert not any(s.late for s in got)

    _land(spark, f"{tmp_path}/l", [(1, "2024-01-01 00:00:00", "late")])
    with pytest.raises(RuntimeError, match="behind the watermark"):
        sides = [spark.readStream.schema(kinds).parquet(f"{tmp_path}/{n}") for n in "lr"]
        drain_paired(paired(*sides, ["k"], "at", "3 minutes"), f"{tmp_path}/t", f"{tmp_path}/c")


def test_read_batches_hides_the_batch(spark, tmp_path):
    spark.range(2).write.parquet(f"{tmp_path}/t/batch_id=0")
    spark.range(2).withColumn("x", F.lit(1)).write.parquet(f"{tmp_path}/t/batch_id=1")
    table = read_batches(spark, f"{tmp_path}/t")
    assert sorted(table.columns) == ["id", "x"] and table.count() == 4


def test_pose_column_names():
    assert pose_column("Hips", "R11") == "Hips_R11"


@pytest.fixture(scope="module")
def few_events(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("events"))
    spark.range(600).selectExpr("id AS event_id", "id % 12 AS user_id", "'tap' AS event_type", "id / 4 AS value").write.parquet(
        f"{at}/events.parquet")
    return at


def test_motion_rows_become_wide_on_reading(spark, few_events):
    from swinglake.catalog import fixtures as fx
    b = fx.build_bronze(spark, few_events)
    assert "Hips_R11" not in b.kept("motion").columns and "motion" not in vars(b)
    rows, written = b.rows("motion"), spark.read.parquet(b.motion)
    assert rows.columns == written.columns and rows.count() == 600
    assert rows.exceptAll(written).count() == 0


def test_key_frames_of_one_name(spark, few_events):
    from swinglake.catalog import fixtures as fx
    b = fx.build_bronze(spark, few_events)
    feeds = [b.rows(feed) for feed in ("motion", "key_frames", "params")]
    every, one = silver.key_frames(*feeds), silver.key_frames(*feeds, only="BallContact")
    wanted = every.where("KeyFrameNames = 'BallContact'")
    assert one.count() == wanted.count() > 0 and one.exceptAll(wanted).count() == 0


def test_streams_joined_by_place_keep_no_wide_rows(spark, few_events, tmp_path):
    from swinglake.catalog import fixtures as fx
    b = fx.build_bronze(spark, few_events)
    whole = silver.master(b.rows("motion"), b.rows("frames"), b.rows("params"))
    wanted = whole.select("input_event", "Timestamp", "ID", F.map_values("hips_zip").alias("hips"))
    early = {"motion": F.col("row_number") % 2 == 0, "frames": F.col("row_number") % 3 == 0}
    for first in (True, False):                  # rows of either side come after their partners
        for name, share in early.items():
            b.kept(name).where(share if first else ~share).write.mode("append").parquet(f"{tmp_path}/landed/{name}")
        streams, tables = zip(*[fx.placed_feed(spark, name, f"{tmp_path}/landed/{name}") for name in early])
        runs = silver.master_batch(*streams, b.rows("params"), f"{tmp_path}/runs", f"{tmp_path}/at", tables=tables)
        stream = silver.publish_master(*streams, b.rows("params"), tables, f"{tmp_path}/table", f"{tmp_path}/checkpoint")
    for made in (runs, stream):
        made = made.select(wanted.columns[0], "Timestamp", "ID", F.map_values("hips_zip").alias("hips"))
        assert made.count() == wanted.count() > 0 and made.exceptAll(wanted).count() == 0
    staged_motion = spark.read.parquet(f"{tmp_path}/at/motion")
    assert set(staged_motion.columns) == {"input_event", "row_number", *silver.PLACE, "batch_id"}
    state = spark.read.format("statestore").option("storeName", "left-keyWithIndexToValue").load(f"{tmp_path}/checkpoint")
    assert len(state.schema["value"].dataType) <= 6

    motion, rows = b.placed("motion")
    frames = silver.publish_key_frames(motion, b.stream("key_frames"), b.rows("params"), rows, f"{tmp_path}/kf", f"{tmp_path}/kfc")
    batch = silver.key_frames(b.rows("motion"), b.rows("key_frames"), b.rows("params"))
    assert frames.columns == batch.columns
    assert frames.count() == batch.count() > 0 and frames.exceptAll(batch).count() == 0


def test_master_is_appended_in_pieces(spark, few_events, tmp_path, monkeypatch):
    """Pieces hold each pair once, whatever the type of the row numbers, rows that come twice and numbers that are null."""
    from swinglake.catalog import fixtures as fx
    from swinglake.operators.tables import ensure_layers, ensure_table
    b, make, met = fx.build_bronze(spark, few_events), silver.master, []
    motion, frames, params = (b.rows(feed) for feed in ("motion", "frames", "params"))
    frames = frames.withColumn("row_number", F.col("row_number").cast("int")).unionByName(frames.where("row_number % 7 = 0"))
    motion = motion.withColumn("row_number", F.expr("IF(row_number % 5 = 0, NULL, row_number)"))
    name = f"{ensure_layers(spark, f't{tmp_path.name[-1]}m_', str(tmp_path))[2]}.master"
    ensure_table(spark, name, master_schema())

    def seen(motion, *feeds):
        met.append(motion.count())
        return make(motion, *feeds)

    monkeypatch.setattr(silver, "master", seen)
    silver.append_master(motion, frames, params, name)
    assert len(met) == 4 and sum(met) == 600 and max(met) < 300
    shown = ("input_event", "Timestamp", "ID", F.map_values("hips_zip").alias("hips"))
    got, wanted = spark.table(name).select(*shown), make(motion, frames, params).select(*shown)
    assert got.count() == wanted.count() > 400 and got.exceptAll(wanted).count() == 0
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def _hips(rows):
    return rows.select("input_event", "Timestamp", "ID", F.map_values("hips_zip").alias("hips"))


@pytest.mark.parametrize("by_place", [True, False])
def test_runs_join_and_fill_in_pieces(spark, few_events, tmp_path, monkeypatch, by_place):
    """A run that fails between two pieces is made up for, and what is filled in later leaves no copy behind."""
    from swinglake.catalog import fixtures as fx
    b, copies, calls = fx.build_bronze(spark, few_events), [], []
    folder, late = silver.scratch_dir, silver._by_lateness

    def noted(session, name):
        copies.append(folder(session, name))
        return copies[-1]

    def failing(rows):
        calls.append(rows.count())
        if len(calls) == 3:
            raise RuntimeError("lost")
        return late(rows)

    monkeypatch.setattr(silver, "scratch_dir", noted)
    monkeypatch.setattr(silver, "_by_lateness", failing)

    def run(params):
        streams, tables = zip(*[b.placed(name) for name in ("motion", "frames")])
        return silver.master_batch(*streams, params, f"{tmp_path}/table", f"{tmp_path}/at", tables=tables if by_place else None)

    few = b.rows("params").where("ID % 4 = 0")
    with pytest.raises(RuntimeError, match="lost"):
        run(few)
    whole = [_hips(silver.master(b.rows("motion"), b.rows("frames"), params)) for params in (few, b.rows("params"))]
    got = _hips(run(few))
    assert got.count() == whole[0].count() == sum(calls) - calls[2] and got.exceptAll(whole[0]).count() == 0
    assert len(calls) == 3 + 2 and max(calls) < sum(calls) / 2 and not copies
    got = _hips(run(b.rows("params")))
    assert got.count() == whole[1].count() and got.exceptAll(whole[1]).count() == 0 and len(calls) == 5
    assert copies and all(spark.read.parquet(at).count() == 0 for at in copies)


def test_streamed_master_is_written_in_pieces(spark, few_events, tmp_path, monkeypatch):
    from swinglake.catalog import fixtures as fx
    b, sizes, make = fx.build_bronze(spark, few_events), [], silver._met_master

    def seen(*args):
        rows = make(*args)
        sizes.append(rows.count())
        return rows

    monkeypatch.setattr(silver, "_met_master", seen)
    streams, tables = zip(*[b.placed(name) for name in ("motion", "frames")])
    got = _hips(silver.publish_master(*streams, b.rows("params"), tables, f"{tmp_path}/table", f"{tmp_path}/checkpoint"))
    whole = _hips(silver.master(b.rows("motion"), b.rows("frames"), b.rows("params")))
    assert got.count() == whole.count() == sum(sizes) > max(sizes) * 2 and got.exceptAll(whole).count() == 0


def test_layers_hold_no_copy_of_the_wide_motion_rows(spark, few_events):
    from swinglake.catalog import ENTRIES, fixtures as fx
    found = {(r["layer"], r["table"]): (r["n_rows"], r["n_events"])
             for r in ENTRIES["layer_tables"].query(spark, few_events).collect()}
    name = "batting_motion_sequence_batting"
    assert found["bronze", name] == (600, 12) and found["silver", f"{name}_master"][1] == 12 and len(found) == 6
    assert "motion" not in vars(fx.bronze(spark, few_events))
    database = max((d.name for d in spark.catalog.listDatabases("lake_*_bronze")))
    view = spark.table(f"{database}.{name}")
    rows = fx.bronze(spark, few_events).rows("motion")
    assert view.columns == rows.columns and view.dtypes == rows.dtypes
