"""Bronze -> silver.  Every function takes batch tables and streams alike."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from swinglake.functions import (
    parse_doubles, rebase_ms, round_frame_ms, split_list, strip_braces, to_double,
    tracking_states, zip_arrays,
)
from swinglake.functions.sqltext import ident
from swinglake.joints import (
    JOINTS, KEY_FRAME_NAMES, MASTER_JOINTS, MEASURES, TRACKER_MEASURES, key_frames_schema,
    map_column, master_schema, pose_column,
)
from swinglake.operators.joins import align_frames, enrich, match_key_frames, possible_matches
from swinglake.operators.shaping import clean, pack_maps, rename_at
from swinglake.operators.tables import read_merged
from swinglake.session import scratch_dir, staged, tidy_shuffles
from swinglake.streaming.sinks import BATCH, read_batches, write_stream, write_stream_batches

PARAMETERS = ("GamePK", "ID", "PlayID", "Weight")
STREAM_SALTS = 8


def clean_parameters(params: DataFrame) -> DataFrame:
    return clean(params).select(*PARAMETERS, "input_event")


# --- key frames ------------------------------------------------------------

def key_frame_arrays(key_frames: DataFrame, *keep: str) -> DataFrame:
    """Packed key-frame lists -> arrays, indices as milliseconds."""
    def items(name: str) -> Column:
        return split_list(strip_braces(name)).alias(name)

    lists = key_frames.select(
        *keep, items("AreKeyFramesDetected"), items("KeyFrameIndices"),
        items("KeyFrameDetectionScores"))
    return lists.select(
        *keep,
        F.array(*[F.lit(n) for n in KEY_FRAME_NAMES]).alias("KeyFrameNames"),
        "AreKeyFramesDetected",
        rebase_ms("KeyFrameIndices").alias("KeyFrameIndicesAdjusted"),
        "KeyFrameDetectionScores")


def explode_key_frames(arrays: DataFrame, *keep: str, drop_undetected: bool = False,
                       position: str | None = None) -> DataFrame:
    """One row per key frame.

    An index that is not a number counts as time 0, so it lands on the first
    frame; ``drop_undetected`` leaves such key frames out instead.
    """
    packed = zip_arrays("KeyFrameNames", "AreKeyFramesDetected", "KeyFrameIndicesAdjusted",
                        "KeyFrameDetectionScores")
    rows = arrays.select(*keep, F.posexplode(packed).alias("_position", "_frame"))
    if drop_undetected:
        rows = rows.where(F.col("_frame.KeyFrameIndicesAdjusted").isNotNull())
    place = [F.col("_position").alias(position)] if position else []
    return rows.select(
        *place, "_frame.KeyFrameNames", "_frame.AreKeyFramesDetected",
        round_frame_ms("_frame.KeyFrameIndicesAdjusted").alias("KeyFrameIndicesAdjusted"),
        "_frame.KeyFrameDetectionScores", *keep)


def timed_motion(motion: DataFrame, *keep: str) -> DataFrame:
    """Clean motion rows with the join time, limited to the silver columns and ``keep``."""
    joints = [pose_column(j, m) for j in JOINTS for m in MEASURES]
    present = {c.lower() for c in motion.columns}
    return clean(motion).select(
        to_double("Timestamp").alias("Timestamp"),
        *[c for c in joints if c.lower() in present], "input_event",
        round_frame_ms("Timestamp").alias("TimestampRounded"), *keep)


def key_frames(motion: DataFrame, key_frame_lists: DataFrame, params: DataFrame,
               drop_undetected: bool = False, only: str | None = None) -> DataFrame:
    """The wide key-frame table; with ``only``, its rows of that key frame.

    Parameters are joined to the one key-frame row of a swing, before it becomes
    17 rows and before the wide motion rows come in; being a left join on the
    event the result is the same, and the wide rows are shuffled once.  Of batch
    tables only motion rows at the time of a key frame are shuffled: the narrow key
    frames are made first and filter the scan of the wide rows.
    """
    frames = _frame_rows(key_frame_lists, params, drop_undetected)
    if only is not None:
        frames = frames.where(F.col("KeyFrameNames") == only)
    poses = timed_motion(motion)
    if not (frames.isStreaming or poses.isStreaming):
        frames = staged(frames, "key-frames")
        poses = possible_matches(poses, ("input_event", "TimestampRounded"),
                                 frames, ("input_event", "KeyFrameIndicesAdjusted"))
    return _as_key_frames(match_key_frames(frames, poses))


def _frame_rows(key_frame_lists: DataFrame, params: DataFrame, drop_undetected: bool = False) -> DataFrame:
    lists = enrich(clean(key_frame_lists), clean_parameters(params))
    keep = ("input_event", *PARAMETERS)
    return explode_key_frames(key_frame_arrays(lists, *keep), *keep, drop_undetected=drop_undetected)


def _as_key_frames(joined: DataFrame) -> DataFrame:
    names = {c.lower() for c in joined.columns}
    return joined.selectExpr(*[
        f"CAST({ident(f.name)} AS {f.dataType.simpleString()}) AS {ident(f.name)}"
        for f in key_frames_schema().fields if f.name.lower() in names])


# --- master ----------------------------------------------------------------

def tracker_frames(frames: DataFrame, *keep: str) -> DataFrame:
    """Clean tracker rows with their three packed lists as arrays.  The lists are
    columns 1 to 3 by position; their names differ between exports."""
    frames = rename_at(clean(frames), dict(zip((1, 2, 3), TRACKER_MEASURES)))
    return frames.select(
        "input_event", "row_number",
        tracking_states(split_list(strip_braces("TrackingStates"))).alias("TrackingStates"),
        parse_doubles("ConfidenceValues").alias("ConfidenceValues"),
        parse_doubles("BoneFittingErrors").alias("BoneFittingErrors"), *keep)


def posed_motion(motion: DataFrame, joints: tuple[str, ...] = MASTER_JOINTS, *keep: str) -> DataFrame:
    """Clean motion rows: place in the swing, time and pose columns."""
    return clean(motion).selectExpr(
        "input_event", "row_number", "try_cast(Timestamp AS DOUBLE) AS Timestamp",
        *[ident(pose_column(j, m)) for j in joints for m in MEASURES], *keep)


def aligned(motion: DataFrame, frames: DataFrame, params: DataFrame,
            joints: tuple[str, ...] = MASTER_JOINTS) -> DataFrame:
    """Tracker rows, game parameters and motion rows side by side.  Parameters go to
    the narrow tracker rows first, so the wide rows are shuffled once."""
    rows = tracker_frames(frames)
    rows = enrich(rows, clean_parameters(params), STREAM_SALTS if rows.isStreaming else 1)
    return align_frames(rows, posed_motion(motion, joints))


def packed(joined: DataFrame, joints: tuple[str, ...] = MASTER_JOINTS) -> DataFrame:
    """Maps are made last: made earlier, every row would shuffle its map keys, and
    the tracker's three arrays stand for 75 columns until here."""
    return pack_maps(joined, joints, spread=False).select(
        *PARAMETERS, "Timestamp", "input_event", *[map_column(j) for j in joints])


def master(motion: DataFrame, frames: DataFrame, params: DataFrame,
           joints: tuple[str, ...] = MASTER_JOINTS) -> DataFrame:
    """The master table: one map per joint with its pose and tracking quality."""
    return packed(aligned(motion, frames, params, joints), joints)


def append_master(motion: DataFrame, frames: DataFrame, params: DataFrame, table: str, pieces: int = 4) -> None:
    """Append :func:`master` of batch tables to a table of the catalog, in ``pieces`` by hash of the place in the swing.

    One piece is joined and written after the other and its shuffle files are dropped, so the disk
    holds the shuffled wide rows of one piece, at the price of reading the feeds once for each.
    A run that fails may leave some pieces written.
    """
    def of(feed: DataFrame, piece: int) -> DataFrame:
        place = F.xxhash64("input_event", F.col("row_number").cast("long"))
        return feed.where(F.pmod(place, F.lit(pieces)) == piece)

    with tidy_shuffles(motion.sparkSession):
        for piece in range(pieces):
            master(of(motion, piece), of(frames, piece), params).write.mode("append").insertInto(table)


# --- joins by place ----------------------------------------------------------
# The rows of a Parquet table stay where they are; what is joined, and kept in a stream's state, are keys
# and places.  Whole rows are read from the same table when they are met, and shuffled once.

PLACE = ("_file", "_row")
TRACKER_PLACE = ("_tracker_file", "_tracker_row")
SWING = "_swing"          # hash of the swing; the rest of its division by PIECES is the piece that its rows are joined in
PIECES = 4


def _in_piece(swing: Column, piece: int) -> Column:
    return F.pmod(swing, F.lit(PIECES)) == piece


def _of(feed: DataFrame, piece: int) -> DataFrame:
    return feed.where(_in_piece(F.xxhash64("input_event"), piece))


def placed(table: DataFrame) -> DataFrame:
    """Rows of a Parquet table, batch or stream, with their file and their place in it."""
    return table.select("*", F.col("_metadata.file_path").alias(PLACE[0]), F.col("_metadata.row_index").alias(PLACE[1]))


def publish_key_frames(motion: DataFrame, key_frame_lists: DataFrame, params: DataFrame, rows: DataFrame,
                       table: str, checkpoint: str) -> DataFrame:
    """:func:`key_frames` of two streams as a table.  ``rows`` is the table that the stream ``motion``
    reads, as a batch; both are :func:`placed`."""
    keys = clean(motion).select("input_event", round_frame_ms("Timestamp").alias("TimestampRounded"), *PLACE)
    met = match_key_frames(_frame_rows(key_frame_lists, params), keys).drop("input_event", "TimestampRounded")

    def whole(batch: DataFrame, batch_id: int) -> DataFrame:
        found = staged(batch, "met")
        poses = possible_matches(timed_motion(rows, *PLACE), PLACE, found, PLACE)
        return _as_key_frames(found.join(poses, list(PLACE)))

    write_stream_batches(met, whole, table, checkpoint)
    return read_batches(motion.sparkSession, table, key_frames_schema())


def _keys(feed: DataFrame) -> DataFrame:
    return clean(feed).select("input_event", "row_number", *PLACE)


def _met(motion: DataFrame, frames: DataFrame) -> DataFrame:
    """Places of motion rows and of the tracker rows that belong to them, and their swings."""
    return align_frames(frames.withColumnsRenamed(dict(zip(PLACE, TRACKER_PLACE))), motion).select(
        *PLACE, *TRACKER_PLACE, F.xxhash64("input_event").alias(SWING))


def _met_master(met: DataFrame, motion: DataFrame, frames: DataFrame, params: DataFrame, piece: int,
                joints: tuple[str, ...] = MASTER_JOINTS) -> DataFrame:
    """:func:`master` of the rows of a piece at the places of ``met``."""
    met, motion, frames = met.where(_in_piece(F.col(SWING), piece)).drop(SWING), _of(motion, piece), _of(frames, piece)
    tracker = frames.withColumnsRenamed(dict(zip(PLACE, TRACKER_PLACE)))
    tracker = enrich(tracker_frames(tracker, *TRACKER_PLACE), clean_parameters(params)).drop("input_event", "row_number")
    return packed(met.join(tracker, list(TRACKER_PLACE)).join(posed_motion(motion, joints, *PLACE), list(PLACE)), joints)


def publish_master(motion: DataFrame, frames: DataFrame, params: DataFrame, tables: tuple[DataFrame, DataFrame],
                   table: str, checkpoint: str) -> DataFrame:
    """:func:`master` of two streams as a table.  ``tables`` are what ``motion`` and ``frames`` read,
    as batches; all four are :func:`placed`.

    Wide rows are shuffled for one piece of the swings after the other, so the disk holds those of one piece.
    """
    def whole(batch: DataFrame, batch_id: int) -> Iterator[DataFrame]:
        met = staged(batch, "met")
        with tidy_shuffles(met.sparkSession):
            for piece in range(PIECES):
                yield _met_master(met, *tables, params, piece)

    write_stream_batches(_met(_keys(motion), _keys(frames)), whole, table, checkpoint)
    return read_batches(motion.sparkSession, table, master_schema())


# --- master in runs ----------------------------------------------------------

UPTO = ("motion_upto", "frames_upto")     # the batches of both feeds that a run reaches to
PART = (*UPTO, "piece")                   # what is written at once: a piece of the swings in a run
LATE = "late"                             # 1: the run found no parameters for the row


def _runs(*more: tuple[str, str]) -> StructType:
    schema = StructType()
    for name, kind in (*more, *((u, "integer") for u in PART)):
        schema = schema.add(name, kind)
    return schema


def master_batch(motion: DataFrame, frames: DataFrame, params: DataFrame, table: str,
                 staging: str, joints: tuple[str, ...] = MASTER_JOINTS,
                 tables: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Drain both streams into tables, join what is new as batches, append to ``table``.

    A run joins its new motion rows with all tracker rows and the older motion rows
    with its new tracker rows, so each pair is written once, whichever side came later;
    older motion rows are read by the keys of the new tracker rows.
    Swings are joined in ``PIECES`` by their hash, one after the other, so the disk holds the shuffled wide
    rows of one piece, at the price of reading the feeds once for each.  A piece goes to a folder named after
    the batches that the run reaches to, which tell how far the piece has come: a run that failed is
    made up for by the next one, piece by piece, and a run with nothing new writes nothing.
    Rows without parameters are kept apart and noted; see :func:`fill_late_parameters`,
    which every run ends with.
    With ``tables``, which are what the streams read, as batches, and like these :func:`placed`, keys and
    places are drained instead of rows, and rows are read from there when both sides of a pair have come.
    """
    spark = motion.sparkSession
    if tables is not None:
        motion, frames = _keys(motion), _keys(frames)
    sides, upto = [], []
    for stream, name in ((motion, "motion"), (frames, "frames")):
        at = f"{staging}/{name}"
        write_stream_batches(stream, lambda batch, batch_id: batch, at, f"{at}_checkpoint")
        rows = read_batches(spark, at, StructType([*stream.schema.fields]), keep=BATCH)
        sides.append(rows)
        upto.append(rows.agg(F.coalesce(F.max(BATCH), F.lit(-1)).cast("int")).first()[0])
    # a piece that joined nothing has no rows in the table, and its note only
    done = read_batches(spark, table, _runs()).select(*PART).unionByName(read_batches(spark, f"{staging}/reached", _runs()))
    reached = {r["piece"]: tuple(r[u] for u in UPTO) for r in done.groupBy("piece").agg(
        *[F.max(u).cast("int").alias(u) for u in UPTO]).collect()}
    behind: dict[tuple[int, int], list[int]] = {}
    for piece in range(PIECES):
        if (before := reached.get(piece, (-1, -1))) != tuple(upto):
            behind.setdefault(before, []).append(piece)
    with tidy_shuffles(spark):
        for before, pieces in behind.items():
            _join_new(spark, sides, before, upto, pieces, params, table, staging, joints, tables)
    fill_late_parameters(spark, params, table, staging)
    return read_merged(spark, table).drop(*PART, LATE)


def _join_new(spark: SparkSession, sides: list[DataFrame], before: tuple[int, int], upto: list[int], pieces: list[int],
              params: DataFrame, table: str, staging: str, joints: tuple[str, ...],
              tables: tuple[DataFrame, DataFrame] | None) -> None:
    """Join and write what came to ``pieces`` after the batches ``before``."""
    new_motion, old_motion = (sides[0].where(c).drop(BATCH) for c in (
        F.col(BATCH) > before[0], F.col(BATCH) <= before[0]))
    frames, new_frames = sides[1].drop(BATCH), sides[1].where(F.col(BATCH) > before[1]).drop(BATCH)
    if tables is not None:
        met = _met(new_motion, frames)
        if before[0] >= 0:
            met = met.unionByName(_met(old_motion, new_frames))
        met = staged(met, "met")
    events = new_motion.select("input_event").union(new_frames.select("input_event")).distinct()
    without = staged(events.join(clean_parameters(params).select("input_event"), "input_event", "left_anti"), "without")
    for piece in pieces:
        # noted before the rows are written: parameters that land in between are filled in needlessly, none is missed
        run = f"motion_upto={upto[0]}/frames_upto={upto[1]}/piece={piece}"
        _of(without, piece).write.mode("overwrite").parquet(f"{staging}/without_parameters/{run}")
        if tables is not None:
            rows = _met_master(met, *tables, params, piece, joints)
        else:
            rows = master(_of(new_motion, piece), _of(frames, piece), params, joints)
            if before[0] >= 0:
                place, late_frames = ("input_event", "row_number"), _of(new_frames, piece)
                rows = rows.unionByName(master(possible_matches(
                    _of(old_motion, piece), place, clean(late_frames).select(*place), place), late_frames, params, joints))
        rows = _by_lateness(rows)
        rows.write.mode("overwrite").partitionBy(LATE).parquet(f"{table}/{run}")
        # a file without rows, so that there is a table after a run that joined nothing
        spark.createDataFrame([], rows.drop(LATE).schema).write.mode("append").parquet(f"{table}/{run}/{LATE}=0")
        spark.createDataFrame([(*upto, piece)], _runs()).coalesce(1).write.mode("append").parquet(f"{staging}/reached")


def _by_lateness(rows: DataFrame) -> DataFrame:
    return rows.withColumn(LATE, F.coalesce(*[F.col(p).cast("string") for p in PARAMETERS]).isNull().cast("int"))


def fill_late_parameters(spark: SparkSession, params: DataFrame, table: str, staging: str) -> int:
    """Give rows of the master table the parameters that landed after them; returns for how many swings.

    Swings that a run wrote without parameters are noted by it.  Those whose parameters are there by
    now are looked up, and in the runs concerned only the rows that were late are read, filled and
    put in place of the old ones, a piece of a run at a time: what the disk holds twice are the late rows of
    one piece, and its staged copy is emptied once they are in place.  Then the swings are noted as
    filled, so a call with nothing new reads two narrow tables and writes nothing, and one that failed is repeated.
    """
    noted = read_batches(spark, f"{staging}/without_parameters", _runs(("input_event", "string")))
    filled = read_batches(spark, f"{staging}/filled_parameters", _runs(("input_event", "string")))
    arrived = clean_parameters(params)
    due = staged(noted.join(filled, ["input_event", *PART], "left_anti").join(
        arrived.select("input_event"), "input_event", "left_semi"), "due-parameters")
    swings = due.select("input_event").distinct().count()
    empty = F.coalesce(*[F.col(p).cast("string") for p in PARAMETERS]).isNull()
    with tidy_shuffles(spark):
        for part in due.select(*PART).distinct().orderBy(*PART).collect() if swings else []:      # a row per run and piece
            here = reduce(and_, (F.col(c) == part[c] for c in PART))
            late = read_merged(spark, table).where((F.col(LATE) == 1) & here)
            found = enrich(late.where(empty).drop(*PARAMETERS), staged(_of(arrived, part["piece"]), "arrived"))
            at = scratch_dir(spark, "filled-rows")
            found.select(*late.columns).unionByName(late.where(~empty)).write.parquet(at)
            rows = spark.read.parquet(at)
            (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                 .partitionBy(*PART, LATE).parquet(table))
            spark.createDataFrame([], rows.schema).write.mode("overwrite").parquet(at)
            due.where(here).write.mode("append").parquet(f"{staging}/filled_parameters")
    return swings


# --- published streams -----------------------------------------------------

def publish(spark: SparkSession, stream: DataFrame, table: str, checkpoint: str) -> DataFrame:
    """Append a silver stream to its table and read the table back."""
    write_stream(stream, table, checkpoint)
    return spark.read.schema(stream.schema).parquet(table) if "/" in table else spark.read.table(table)
