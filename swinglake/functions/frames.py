"""Packed-list strings, frame times and key-frame arrays."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swinglake.joints import FRAME_PERIOD_MS

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_braces(c: ColumnOrName) -> Column:
    """``{a;b}`` -> ``a;b``."""
    return F.regexp_replace(_col(c), "[{}]", "")


def split_list(c: ColumnOrName) -> Column:
    """``a;b`` -> ``[a, b]``; an empty string gives one empty item."""
    return F.split(_col(c), ";")


def to_double(c: ColumnOrName) -> Column:
    """Cast that turns unparsable text into NULL instead of failing the job."""
    return _col(c).try_cast("double")


def parse_doubles(c: ColumnOrName) -> Column:
    """``{0.1;0.2}`` -> ``array<double>``; unparsable items become NULL."""
    return F.transform(split_list(strip_braces(c)), lambda x: x.try_cast("double"))


def tracking_states(items: ColumnOrName) -> Column:
    """1 where the tracker says ``T``, 0 for anything else, NULL and '' included."""
    return F.transform(
        _col(items), lambda x: F.when(x == F.lit("T"), F.lit(1)).otherwise(F.lit(0))
    )


def first_item(items: ColumnOrName) -> Column:
    return F.get(_col(items), F.lit(0))


def rebase_ms(items: ColumnOrName, period: float = FRAME_PERIOD_MS) -> Column:
    """Frame indices -> milliseconds after the first index of the list."""
    items = _col(items)
    origin = first_item(items).try_cast("double")
    return F.transform(items, lambda x: (x.try_cast("double") - origin) * F.lit(period))


def zip_arrays(*arrays: ColumnOrName) -> Column:
    """Element-wise structs, padded with NULL to the longest input."""
    return F.arrays_zip(*[_col(a) for a in arrays])


def explode_pos(df: DataFrame, items: ColumnOrName, *keep: str,
                position: str = "position", value: str = "item") -> DataFrame:
    """One row per array item with its 0-based position, next to ``keep``."""
    return df.select(*keep, F.posexplode(_col(items)).alias(position, value))


def round_frame_ms(c: ColumnOrName) -> Column:
    """Whole milliseconds used as a join key: NULL counts as 0, the fraction is
    dropped, and a value ending in 9 moves up by one (frames at 9.99 and 10 ms
    are the same frame)."""
    ms = to_double(c)
    whole = ms.try_cast("int")
    bump = F.when(F.pmod(whole, F.lit(10)) == 9, 1).otherwise(0)
    return F.when(ms.isNull(), F.lit(0)).otherwise(whole + bump)


def build_map(pairs: Mapping[str, ColumnOrName]) -> Column:
    """Literal keys with one value column each."""
    flat: list[Column] = []
    for key, value in pairs.items():
        flat += [F.lit(key), _col(value)]
    return F.create_map(*flat)


def lower_all(df: DataFrame) -> DataFrame:
    return df.select([F.lower(F.col(c)).alias(c) for c in df.columns])
