"""Silver pipelines, in batch and as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swinglake.catalog import fixtures as fx
from swinglake.catalog.registry import query
from swinglake.joints import (
    JOINTS, KEY_FRAME_NAMES, MASTER_JOINTS, MEASURES, TRACKER_SLOTS, UNTRACKED_JOINTS,
    map_column, map_keys, pose_column,
)
from swinglake.operators.joins import align_frames, enrich, match_key_frames
from swinglake.operators.profile import stage_counts
from swinglake.operators.shaping import clean, pose_columns, slot_columns, spread_tracker
from swinglake.plans import silver
from swinglake.session import scratch_dir, staged
from swinglake.sources.files import read_table, stream_table
from swinglake.streaming.bounded import LEFT, OUTCOME, RIGHT, drain_paired, paired, waiting
from swinglake.streaming.sinks import read_batches


def _batch(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path)


def _ms_sql(x: str) -> str:
    whole = f"trunc({x})::INT"
    return (f"(CASE WHEN {x} IS NULL THEN 0 ELSE {whole} + "
            f"CASE WHEN ((({whole}) % 10) + 10) % 10 = 9 THEN 1 ELSE 0 END END)")


# --- key frames ------------------------------------------------------------

_NAMES_SQL = "[" + ", ".join(f"'{n}'" for n in KEY_FRAME_NAMES) + "]"

KEYED = f"""{fx.MOTION}, {fx.KEY_FRAMES}, {fx.PARAMS},
timed AS (
  SELECT *, {_ms_sql('"Timestamp"')} AS "TimestampRounded" FROM motion),
keyed AS (
  SELECT user_id, input_event, _rescued_data, i AS position, {_NAMES_SQL}[i + 1] AS name,
         CASE WHEN (user_id + i) % 4 <> 0 THEN 'T' ELSE 'F' END AS detected,
         '0.' || i AS score,
         CASE WHEN i <> 5 THEN (3 * i)::DOUBLE * 3.333333::DOUBLE END AS ms
  FROM kf, (SELECT unnest(range(17))::INT AS i))"""

_POSES_SQL = ",\n  ".join(
    f'{fx.pose_sql(j, m)} AS "{pose_column(j, m)}"' for j in JOINTS for m in MEASURES)

KEY_FRAMES_SQL = f"""WITH {KEYED}
SELECT p."GamePK", p."ID", p."PlayID", p."Weight", k.name AS "KeyFrameNames",
  k.detected AS "AreKeyFramesDetected", {_ms_sql('k.ms')} AS "KeyFrameIndicesAdjusted",
  k.score AS "KeyFrameDetectionScores", m."Timestamp",
  {_POSES_SQL},
  m.input_event, m."TimestampRounded"
FROM keyed k
JOIN timed m ON k.input_event = m.input_event AND {_ms_sql('k.ms')} = m."TimestampRounded"
LEFT JOIN params p ON p.input_event = m.input_event AND p._rescued_data IS NULL
WHERE k._rescued_data IS NULL AND m._rescued_data IS NULL"""


@query("key_frames", KEY_FRAMES_SQL)
def key_frames(spark: SparkSession, sf_dir: str, only: str | None = None) -> DataFrame:
    b = fx.bronze(spark, sf_dir)
    return silver.key_frames(
        b.rows("motion"), b.rows("key_frames"), b.rows("params"), only=only)


@query("key_frames_stream", KEY_FRAMES_SQL)
def key_frames_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = fx.bronze(spark, sf_dir)
    at, (motion, rows) = scratch_dir(spark, "key-frames-stream"), b.placed("motion")
    return silver.publish_key_frames(
        motion, b.stream("key_frames"), b.rows("params"), rows, f"{at}/table", f"{at}/checkpoint")


@query("detected_key_frames", f"""WITH {KEYED}
SELECT k.name AS key_frame, k.input_event, m.row_number, k.position
FROM keyed k
JOIN timed m ON k.input_event = m.input_event AND {_ms_sql('k.ms')} = m."TimestampRounded"
WHERE k._rescued_data IS NULL AND m._rescued_data IS NULL AND k.ms IS NOT NULL""")
def detected_key_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = fx.bronze(spark, sf_dir)
    lists = silver.key_frame_arrays(clean(b.rows("key_frames")), "input_event")
    frames = silver.explode_key_frames(
        lists, "input_event", drop_undetected=True, position="position")
    rows = clean(b.rows("motion")).select(
        "input_event", "row_number",
        silver.round_frame_ms("Timestamp").alias("TimestampRounded"))
    return match_key_frames(frames, rows).select(
        F.col("KeyFrameNames").alias("key_frame"), "input_event", "row_number", "position")


@query("rebase_scale", f"""WITH {KEYED}
SELECT input_event, position, ms FROM keyed""")
def rebase_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = fx.bronze(spark, sf_dir).rows("key_frames")
    arrays = silver.key_frame_arrays(lists, "input_event")
    return arrays.select(
        "input_event", F.posexplode("KeyFrameIndicesAdjusted").alias("position", "ms"))


@query("zip_explode", f"""WITH {KEYED}
SELECT input_event, position, name AS "KeyFrameNames", detected AS "AreKeyFramesDetected",
  {_ms_sql('ms')} AS "KeyFrameIndicesAdjusted", score AS "KeyFrameDetectionScores"
FROM keyed""")
def zip_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = fx.bronze(spark, sf_dir).rows("key_frames")
    arrays = silver.key_frame_arrays(lists, "input_event")
    return silver.explode_key_frames(arrays, "input_event", position="position")


# --- master ----------------------------------------------------------------
# A map column does not compare across engines, so each map is summed up as
# sum(position of entry * value in whole thousandths), next to the number of maps
# that hold exactly the keys they should, in their order.

def _digest(joint: str) -> str:
    terms = (f"transform(map_values({map_column(joint)}), (v, i) -> "
             f"(i + 1) * coalesce(floor(v * 1000 + 0.5D), 0))")
    return f"aggregate({terms}, 0L, (a, x) -> a + x) AS {joint.lower()}"


def _digest_sql(joint: str) -> str:
    own = next(j for j in JOINTS if j.lower() == joint.lower())
    values = [fx.pose_sql(own, m) for m in MEASURES]
    if joint not in UNTRACKED_JOINTS:
        slot = TRACKER_SLOTS.index(joint)
        values += [fx.state_sql(slot), fx.confidence_sql(slot), fx.error_sql(slot)]
    terms = [f"{i + 1} * floor({v} * 1000 + 0.5::DOUBLE)::BIGINT" for i, v in enumerate(values)]
    return f"({' + '.join(terms)}) AS \"{joint.lower()}\""


def _digested(master: DataFrame) -> DataFrame:
    def keyed(joint: str) -> str:
        keys = ", ".join(f"'{k}'" for k in map_keys(joint))
        return f"CAST(map_keys({map_column(joint)}) = array({keys}) AS INT)"

    return master.selectExpr(
        *silver.PARAMETERS, "Timestamp", "input_event",
        f"{' + '.join(keyed(j) for j in MASTER_JOINTS)} AS n_maps",
        *[_digest(j) for j in MASTER_JOINTS])


_DIGESTS_SQL = ",\n  ".join(_digest_sql(j) for j in MASTER_JOINTS)

ALIGNED = f"""{fx.MOTION}, {fx.FRAMES}, {fx.PARAMS}"""
_ALIGN_SQL = """FROM frames f
JOIN motion m ON f.input_event = m.input_event AND f.row_number = m.row_number
LEFT JOIN params p ON p.input_event = m.input_event AND p._rescued_data IS NULL
WHERE f._rescued_data IS NULL AND m._rescued_data IS NULL"""

MASTER_SQL = f"""WITH {ALIGNED}
SELECT p."GamePK", p."ID", p."PlayID", p."Weight", m."Timestamp", m.input_event,
  {len(MASTER_JOINTS)} AS n_maps,
  {_DIGESTS_SQL}
{_ALIGN_SQL}"""


@query("master_maps", MASTER_SQL)
def master_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = fx.bronze(spark, sf_dir)
    return _digested(silver.master(
        b.rows("motion"), b.rows("frames"), b.rows("params")))


@query("master_maps_stream", MASTER_SQL)
def master_maps_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = fx.bronze(spark, sf_dir)
    at, (streams, tables) = scratch_dir(spark, "master-stream"), zip(b.placed("motion"), b.placed("frames"))
    return _digested(silver.publish_master(*streams, b.rows("params"), tables, f"{at}/table", f"{at}/checkpoint"))


@query("master_batch", MASTER_SQL)
def master_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = fx.bronze(spark, sf_dir)
    at, (streams, tables) = scratch_dir(spark, "master-batch"), zip(b.placed("motion"), b.placed("frames"))
    return _digested(silver.master_batch(*streams, b.rows("params"), f"{at}/table", at, tables=tables))


@query("master_batch_rerun", MASTER_SQL)
def master_batch_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four runs: with half of the motion rows and a third of the tracker rows, with nothing
    new, with the rest, and with nothing again."""
    b, at = fx.bronze(spark, sf_dir), scratch_dir(spark, "master-rerun")
    share = F.pmod(F.xxhash64("input_event", "row_number"), F.lit(6))
    early = {"motion": share < 3, "frames": share % 3 == 0}

    def land(name: str, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(f"{at}/landed/{name}")

    def run() -> DataFrame:
        streams, tables = zip(*[fx.placed_feed(spark, name, f"{at}/landed/{name}") for name in ("motion", "frames")])
        return silver.master_batch(*streams, b.rows("params"), f"{at}/table", at, tables=tables)

    for name, first in early.items():
        land(name, b.kept(name).where(first))
    run()
    run()
    for name, first in early.items():
        land(name, b.kept(name).where(~first))
    run()
    return _digested(run())


@query("late_parameters", MASTER_SQL)
def late_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs with half of the swings' parameters each time, then the rest lands: a run
    with no new rows fills it in, and one more finds nothing to do."""
    b, at = fx.bronze(spark, sf_dir), scratch_dir(spark, "late-parameters")
    share = F.pmod(F.xxhash64("input_event"), F.lit(4))
    rows, params = F.pmod(F.xxhash64("input_event", "row_number"), F.lit(2)) == 0, b.rows("params")

    def land(name: str, some: DataFrame) -> None:
        some.write.mode("append").parquet(f"{at}/landed/{name}")

    def run() -> DataFrame:
        streams, tables = zip(*[fx.placed_feed(spark, name, f"{at}/landed/{name}") for name in ("motion", "frames")])
        return silver.master_batch(*streams, _batch(spark, f"{at}/landed/params"), f"{at}/table", at, tables=tables)

    for first, arrived in ((rows, share == 0), (~rows, share == 1), (None, share > 1)):
        if first is not None:
            land("motion", b.kept("motion").where(first))
            land("frames", b.kept("frames").where(first))
        land("params", params.where(arrived))
        run()
    return _digested(run())


@query("align_rows", f"""WITH {ALIGNED}
SELECT m.input_event, m.row_number, m."Timestamp", f.event_id AS frame_index,
       m.event_id AS motion_index
FROM frames f
JOIN motion m ON f.input_event = m.input_event AND f.row_number = m.row_number
WHERE f._rescued_data IS NULL AND m._rescued_data IS NULL""")
def align_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = fx.bronze(spark, sf_dir)
    frames = clean(b.rows("frames")).select(
        "input_event", "row_number", F.col("row_index").alias("frame_index"))
    rows = clean(b.rows("motion")).select(
        "input_event", "row_number", "Timestamp", F.col("row_index").alias("motion_index"))
    return align_frames(frames, rows)


ENRICH_SQL = f"""WITH {fx.MOTION}, {fx.PARAMS}
SELECT m.input_event, m.row_number, p."GamePK", p."ID", p."PlayID", p."Weight"
FROM motion m LEFT JOIN params p ON p.input_event = m.input_event AND p._rescued_data IS NULL"""


@query("enrich_left", ENRICH_SQL)
def enrich_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = fx.bronze(spark, sf_dir)
    rows = b.rows("motion").select("input_event", "row_number")
    return enrich(rows, silver.clean_parameters(b.rows("params")))


@query("enrich_salted", ENRICH_SQL)
def enrich_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = fx.bronze(spark, sf_dir)
    rows = b.rows("motion").select("input_event", "row_number")
    return enrich(rows, silver.clean_parameters(b.rows("params")), silver.STREAM_SALTS)


# --- pieces ----------------------------------------------------------------

@query("clean_records", f"""WITH {fx.MOTION}
SELECT input_event, row_number, "Timestamp" FROM motion WHERE _rescued_data IS NULL""")
def clean_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.bronze(spark, sf_dir).rows("motion")
    return clean(rows).select("input_event", "row_number", "Timestamp")


@query("strip_split_parse", f"""WITH {fx.EV}, {fx.FRAMES},
slots AS (SELECT unnest(range(25))::INT AS i)
SELECT input_event, row_number, i AS slot,
       ((event_id * 7 + i * 13) % 100) / 100.0::DOUBLE AS confidence,
       (event_id + i) % 50 + 0.5::DOUBLE AS error
FROM frames, slots""")
def strip_split_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.bronze(spark, sf_dir).rows("frames")
    pairs = silver.zip_arrays(
        silver.parse_doubles("Trust").alias("confidence"),
        silver.parse_doubles("Misfit").alias("error"))
    return rows.select(
        "input_event", "row_number", F.posexplode(pairs).alias("slot", "pair")
    ).select("input_event", "row_number", "slot",
             "pair.confidence", "pair.error")


_SPREAD_SQL = ", ".join(
    f'{make(i)} AS "{name}"'
    for measure, make in (("TrackingStates", fx.state_sql),
                          ("ConfidenceValues", fx.confidence_sql),
                          ("BoneFittingErrors", fx.error_sql))
    for i, name in enumerate(slot_columns(measure)))


@query("tracking_states", f"""WITH {fx.EV}, {fx.FRAMES}
SELECT input_event, row_number, {_SPREAD_SQL}
FROM frames f WHERE _rescued_data IS NULL""")
def tracking_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrays = silver.tracker_frames(fx.bronze(spark, sf_dir).rows("frames"))
    return spread_tracker(arrays).drop("TrackingStates", "ConfidenceValues", "BoneFittingErrors")


_BODY = [(j, m) for j in JOINTS if j not in ("Center", "Top", "Knob")
         for m in MEASURES if not m.startswith("M")]
_SUMS_SQL = ", ".join(
    f"sum(floor({fx.pose_sql(j, m)} * 1000 + 0.5::DOUBLE)::BIGINT)::BIGINT AS \"{pose_column(j, m)}\""
    for j, m in _BODY)


@query("pose_columns", f"""WITH {fx.MOTION}
SELECT {_SUMS_SQL}, count(*) AS n_rows FROM motion m""")
def pose_column_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.bronze(spark, sf_dir).rows("motion")
    sums = [F.expr(f"sum(floor({c} * 1000 + 0.5D)) AS {c}") for c in pose_columns(rows)]
    return rows.agg(*sums, F.count("*").alias("n_rows"))


@query("stage_counts", f"""WITH {ALIGNED},
f AS (SELECT * FROM frames WHERE _rescued_data IS NULL),
j AS (SELECT m.input_event FROM f JOIN motion m
      ON f.input_event = m.input_event AND f.row_number = m.row_number
      WHERE m._rescued_data IS NULL),
e AS (SELECT j.input_event FROM j LEFT JOIN params p
      ON p.input_event = j.input_event AND p._rescued_data IS NULL)
SELECT 'frames' AS stage, count(*) AS n_rows FROM f
UNION ALL SELECT 'joined', count(*) FROM j
UNION ALL SELECT 'enriched', count(*) FROM e
UNION ALL SELECT 'packed', count(*) FROM e""")
def stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = fx.bronze(spark, sf_dir)
    motion, params = b.rows("motion"), b.rows("params")
    frames = silver.tracker_frames(b.rows("frames"))
    joined = align_frames(frames, silver.posed_motion(motion))
    enriched = enrich(joined, silver.clean_parameters(params))
    return stage_counts({
        "frames": frames, "joined": joined, "enriched": enriched,
        "packed": silver.packed(enriched)})


@query("bounded_join", f"""WITH {fx.MOTION}, {fx.FRAMES},
m AS (SELECT input_event, row_number, event_id % 240 AS minute FROM motion WHERE _rescued_data IS NULL),
f AS (SELECT input_event, row_number, event_id % 240 + event_id % 7 AS minute FROM frames WHERE _rescued_data IS NULL)
SELECT coalesce(m.input_event, f.input_event) AS input_event, coalesce(m.row_number, f.row_number) AS row_number,
  m.minute AS motion_minute, f.minute AS tracker_minute,
  CASE WHEN f.minute IS NULL THEN 'left' WHEN m.minute IS NULL THEN 'right' ELSE 'matched' END AS outcome
FROM m FULL JOIN f ON m.input_event = f.input_event AND m.row_number = f.row_number
  AND f.minute - m.minute BETWEEN -3 AND 3""")
def bounded_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Motion and tracker rows that arrive over four hours, an hour a run, joined if at most three
    minutes apart: pairs, rows without a partner, and those that still wait in the state."""
    at, start = scratch_dir(spark, "bounded-join"), F.lit("2024-01-01").cast("timestamp")
    b, event = fx.bronze(spark, sf_dir), F.col("row_index")
    ids, lag = F.pmod(event, F.lit(240)), {"motion": F.lit(0), "frames": F.pmod(event, F.lit(7))}
    arriving = {name: staged(clean(rows).select(
        "input_event", "row_number", (ids + lag[name]).alias("minute"),
        (start + F.make_dt_interval(mins=ids + lag[name])).alias("arrived")), "arriving")
        for name, rows in (("motion", b.rows("motion")), ("frames", b.rows("frames")))}
    for hour in range(4):
        for name, rows in arriving.items():
            due = F.least(F.floor(F.col("minute") / 60), F.lit(3)) == hour
            rows.where(due).write.mode("append").parquet(f"{at}/landed/{name}")
        sides = [stream_table(spark, f"{at}/landed/{name}") for name in arriving]
        drain_paired(paired(*sides, ("input_event", "row_number"), "arrived", "3 minutes"),
                     f"{at}/table", f"{at}/checkpoint")
    both = [F.coalesce(f"{LEFT}.{c}", f"{RIGHT}.{c}").alias(c) for c in ("input_event", "row_number")]
    minutes = [F.col(f"{LEFT}.minute").alias("motion_minute"), F.col(f"{RIGHT}.minute").alias("tracker_minute")]
    told = read_batches(spark, f"{at}/table").select(*both, *minutes, OUTCOME)
    for side, own, other in ((LEFT, "motion_minute", "tracker_minute"), (RIGHT, "tracker_minute", "motion_minute")):
        left = waiting(spark, f"{at}/checkpoint", side).withColumnsRenamed({"minute": own})
        told = told.unionByName(left.select("input_event", "row_number", own, F.lit(None).cast("long").alias(other),
                                            F.lit(side).alias(OUTCOME)))
    return told
