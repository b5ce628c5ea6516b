"""Vocabulary of the motion-capture feeds and the table schemas built from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
# Names, their order and the constants below are part of the data format.

JOINTS = (
    "Hips", "JointSpine", "Spine", "Neck", "JointHead", "Head",
    "JointLeftUpperArm", "LeftUpperArm", "LeftForearm", "LeftWrist", "LeftHand",
    "JointRightUpperArm", "RightUpperArm", "RightForearm", "RightWrist", "RightHand",
    "JointLeftThigh", "LeftThigh", "LeftShin", "LeftAnkle", "LeftFoot",
    "JointRightThigh", "RightThigh", "RightShin", "RightAnkle", "RightFoot",
    "Knob", "Top", "Center",
)

# a 4x4 pose matrix, row by row
MEASURES = (
    "R11", "R12", "R13", "tx",
    "R21", "R22", "R23", "ty",
    "R31", "R32", "R33", "tz",
    "M41", "M42", "M43", "M44",
)

# position in the tracker's packed arrays -> joint
TRACKER_SLOTS = (
    "hips", "spine", "neck", "head", "head_dup",
    "leftupperarm", "leftforearm", "leftwrist", "lefthand", "lefthand_dup",
    "rightupperarm", "rightforearm", "rightwrist", "righthand", "righthand_dup",
    "leftthigh", "leftshin", "leftankle", "leftfoot", "leftfoot_dup",
    "rightthigh", "rightshin", "rightankle", "rightfoot", "rightfoot_dup",
)

UNTRACKED_JOINTS = (
    "JointSpine", "JointHead", "JointLeftUpperArm", "JointRightUpperArm",
    "JointLeftThigh", "JointRightThigh", "Knob", "Top", "Center",
)

TRACKER_MEASURES = ("TrackingStates", "ConfidenceValues", "BoneFittingErrors")

KEY_FRAME_NAMES = (
    "StartBackLegWeightShift", "MaximumBackLegWeightShift", "MaximumLeadingLegLift",
    "LeadingToeStrike", "LeadingHeelStrike", "BatElevation45Degrees",
    "BatAzimuth0Degrees", "BatAzimuth45Degrees", "BallContact",
    "BatAzimuth135Degrees", "BatAzimuth180Degrees", "BatAzimuth225Degrees",
    "BatAzimuth270Degrees", "BatAzimuth315Degrees", "BatAzimuth360Degrees",
    "LeadingForearmAzimuth315Degrees", "EventEnd",
)

FRAME_PERIOD_MS = 3.333333
CLUSTER_KEYS = ("ID", "GamePK", "PlayID")
NON_BODY_JOINTS = ("Center", "Top", "Knob")
POSE_MARKERS = ("_R1", "_R2", "_R3", "_t")
# ---------------------------------------------------------------------------

RESCUED = "_rescued_data"
TRACKED_JOINTS = tuple(j for j in TRACKER_SLOTS if not j.endswith("_dup"))
MASTER_JOINTS = TRACKED_JOINTS + UNTRACKED_JOINTS
PARAMETER_FIELDS = (
    T.StructField("GamePK", T.LongType()),
    T.StructField("ID", T.LongType()),
    T.StructField("PlayID", T.StringType()),
    T.StructField("Weight", T.LongType()),
)


def pose_column(joint: str, measure: str) -> str:
    return f"{joint}_{measure}"


def pose_fields() -> list[T.StructField]:
    """The 464 joint columns: the bottom matrix row, and the rotation of the
    scene centre, are whole numbers; everything else is a double."""
    fields = []
    for joint in JOINTS:
        for measure in MEASURES:
            whole = measure[0] == "M" or (joint == "Center" and measure[0] == "R")
            kind = T.IntegerType() if whole else T.DoubleType()
            fields.append(T.StructField(pose_column(joint, measure), kind))
    return fields


def motion_schema() -> T.StructType:
    """Columns of a motion file, as landed."""
    return T.StructType([T.StructField("Timestamp", T.DoubleType()), *pose_fields()])


def key_frames_schema() -> T.StructType:
    """The wide silver key-frame table (475 columns)."""
    return T.StructType([
        *PARAMETER_FIELDS,
        T.StructField("KeyFrameNames", T.StringType()),
        T.StructField("AreKeyFramesDetected", T.StringType()),
        T.StructField("KeyFrameIndicesAdjusted", T.IntegerType()),
        T.StructField("KeyFrameDetectionScores", T.StringType()),
        *motion_schema().fields,
        T.StructField("input_event", T.StringType()),
        T.StructField("TimestampRounded", T.IntegerType()),
    ])


def map_column(joint: str) -> str:
    return f"{joint}_zip"


def map_keys(joint: str) -> list[str]:
    """Keys of one joint's map: 16 pose elements, and for joints the tracker
    reports also its three quality measures."""
    keys = [m.lower() for m in MEASURES]
    return keys if joint in UNTRACKED_JOINTS else keys + list(TRACKER_MEASURES)


def master_schema() -> T.StructType:
    """The silver master table (6 scalars and 29 maps)."""
    maps = T.MapType(T.StringType(), T.DoubleType())
    return T.StructType([
        *PARAMETER_FIELDS,
        T.StructField("Timestamp", T.DoubleType()),
        T.StructField("input_event", T.StringType()),
        *[T.StructField(map_column(j), maps) for j in MASTER_JOINTS],
    ])


def tracker_slots(spark: SparkSession) -> DataFrame:
    """The slot -> joint lookup as a table (25 rows)."""
    rows = [(slot, joint, joint.endswith("_dup")) for slot, joint in enumerate(TRACKER_SLOTS)]
    schema = "slot int, motion_sequence string, is_duplicate boolean"
    return spark.createDataFrame(rows, schema)
