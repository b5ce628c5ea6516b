"""Filters, projections and the two wide reshapes of the silver layer."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swinglake.functions.frames import ColumnOrName, _col
from swinglake.functions.sqltext import ident, text
from swinglake.joints import (
    MASTER_JOINTS, NON_BODY_JOINTS, POSE_MARKERS, RESCUED, TRACKER_MEASURES,
    TRACKER_SLOTS, map_column, map_keys,
)


def clean(df: DataFrame) -> DataFrame:
    """Rows whose values all fitted the schema, without the rescue column."""
    return df.where(F.col(RESCUED).isNull()).drop(RESCUED)


def rename_at(df: DataFrame, names: dict[int, str]) -> DataFrame:
    """Rename columns by position."""
    return df.withColumnsRenamed({df.columns[i]: new for i, new in names.items()})


def pose_columns(df: DataFrame) -> list[str]:
    """Rotation and translation columns of the body joints (312 of a full table)."""
    return [
        c for c in df.columns
        if any(m in c for m in POSE_MARKERS) and not any(j in c for j in NON_BODY_JOINTS)
    ]


def spread_array(df: DataFrame, items: ColumnOrName, names: Sequence[str]) -> DataFrame:
    """Array items as named columns; items past the end of the array are NULL."""
    return df.select(
        "*", *[F.get(_col(items), F.lit(i)).alias(n) for i, n in enumerate(names)])


def slot_columns(measure: str) -> list[str]:
    """Names of the 25 columns one tracker array spreads to."""
    return [f"{slot}_{measure}" for slot in TRACKER_SLOTS]


def spread_tracker(df: DataFrame) -> DataFrame:
    """The three tracker arrays as 75 columns ``{joint}_{measure}``."""
    for measure in TRACKER_MEASURES:
        df = spread_array(df, measure, slot_columns(measure))
    return df


def pack_maps(df: DataFrame, joints: Iterable[str] = MASTER_JOINTS,
              spread: bool = True) -> DataFrame:
    """Joint columns -> one ``{joint}_zip`` map per joint, other columns kept.

    Tracking quality comes from the columns of :func:`spread_tracker`, or with
    ``spread`` off straight from the three arrays.
    """
    maps, used = [], []
    for joint in joints:
        entries = []
        for key in map_keys(joint):
            source = ident(f"{joint}_{key}")
            if key in TRACKER_MEASURES and not spread:
                source = f"get({key}, {TRACKER_SLOTS.index(joint)})"
            else:
                used.append(f"{joint}_{key}")
            entries.append(f"{text(key)}, try_cast({source} AS DOUBLE)")
        maps.append(f"map({', '.join(entries)}) AS {ident(map_column(joint))}")
    arrays = [c for m in TRACKER_MEASURES for c in (m, *slot_columns(m))]
    return df.selectExpr("*", *maps).drop(*used, *arrays)
