"""Metadata carried by landing paths.

A swing's files sit in one folder named
``<date>_<time>_<Team words>_<jersey>_<Player words>_<Home|Away>``.  Segments are
counted from the end of the path, so the storage prefix may have any depth, and a
``name=value`` folder as written by ``partitionBy`` counts as its value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from swinglake.functions.frames import ColumnOrName, _col

# fixed values: folder name pattern and the places of game and feed in the path,
# counted from the end (-1 is the file, -2 the event folder)
EVENT_PATTERN = r"^(\d{4}_\d{2}_\d{2})_(\d{2}_\d{2}_\d{2})_(.+?)_(\d+)_(.+)_([^_]+)$"
LAYOUTS = {
    "game/type": {"event_type": -3, "game": -4},
    "type/game": {"event_type": -4, "game": -3},
}
DEFAULT_LAYOUT = "game/type"


def path_part(c: ColumnOrName, start: int, length: int = 1) -> Column:
    """``length`` path segments from ``start`` (1-based, negative from the end)."""
    return F.array_join(F.slice(F.split(_col(c), "/"), start, length), "/")


def _segment(c: ColumnOrName, index: int) -> Column:
    segment = F.get(F.reverse(F.split(_col(c), "/")), F.lit(-index - 1))
    return F.regexp_replace(segment, "^[A-Za-z_]+=", "")


def input_event(c: ColumnOrName) -> Column:
    """The folder of the file: the key all feeds of one swing share."""
    return F.regexp_replace(_col(c), "/[^/]+$", "")


def event_folder(c: ColumnOrName) -> Column:
    return _segment(c, -2)


def _event_group(c: ColumnOrName, group: int) -> Column:
    return F.regexp_extract(event_folder(c), EVENT_PATTERN, group)


def path_game(c: ColumnOrName, layout: str = DEFAULT_LAYOUT) -> Column:
    return _segment(c, LAYOUTS[layout]["game"])


def path_event_type(c: ColumnOrName, layout: str = DEFAULT_LAYOUT) -> Column:
    return _segment(c, LAYOUTS[layout]["event_type"])


def path_date(c: ColumnOrName) -> Column:
    return F.translate(_event_group(c, 1), "_", "-")


def path_date_time(c: ColumnOrName) -> Column:
    return F.translate(F.concat_ws("-", _event_group(c, 1), _event_group(c, 2)), "_", "-")


def path_team(c: ColumnOrName) -> Column:
    return F.translate(_event_group(c, 3), "_", " ")


def path_jersey(c: ColumnOrName) -> Column:
    return _event_group(c, 4)


def path_player(c: ColumnOrName) -> Column:
    return F.translate(_event_group(c, 5), "_", " ")


def path_location(c: ColumnOrName) -> Column:
    return _event_group(c, 6)


def event_metadata(c: ColumnOrName, layout: str = DEFAULT_LAYOUT) -> Column:
    """Everything the path says, as one struct."""
    return F.struct(
        path_game(c, layout).alias("game"),
        path_event_type(c, layout).alias("event_type"),
        path_date(c).alias("date"),
        path_date_time(c).alias("date_time"),
        path_team(c).alias("team"),
        path_jersey(c).alias("jersey_num"),
        path_player(c).alias("player_name"),
        path_location(c).alias("location"),
        input_event(c).alias("input_event"),
    )


def extract_metadata(c: ColumnOrName, entity: str = "game",
                     layout: str = DEFAULT_LAYOUT) -> Column:
    """One path entity by name; an unknown name is an error."""
    by_name = {
        "game": lambda: path_game(c, layout),
        "event_type": lambda: path_event_type(c, layout),
        "date": lambda: path_date(c),
        "date_time": lambda: path_date_time(c),
        "team": lambda: path_team(c),
        "jersey_num": lambda: path_jersey(c),
        "player_name": lambda: path_player(c),
        "location": lambda: path_location(c),
        "input_event": lambda: input_event(c),
    }
    if entity not in by_name:
        raise ValueError(f"unknown path entity {entity!r}; one of {', '.join(by_name)}")
    return by_name[entity]()
