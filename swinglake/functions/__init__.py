"""Column -> Column building blocks; nothing here leaves the JVM."""

from swinglake.functions.frames import (
    first_item, parse_doubles, rebase_ms, round_frame_ms, split_list, strip_braces,
    to_double, tracking_states, zip_arrays, build_map, lower_all, explode_pos,
)
from swinglake.functions.payloads import decode_utf8, from_xml, now_text, parse_json, parse_xml
from swinglake.functions.paths import (
    event_folder, event_metadata, extract_metadata, input_event, path_date, path_date_time,
    path_event_type, path_game, path_jersey, path_location, path_part, path_player, path_team,
)

# the names these had as UDFs
round_func = round_frame_ms
toStrUDF = decode_utf8

__all__ = [
    "build_map", "decode_utf8", "event_folder", "event_metadata", "explode_pos",
    "extract_metadata", "first_item", "from_xml", "input_event", "lower_all", "now_text",
    "parse_doubles", "parse_json", "parse_xml", "path_date", "path_date_time",
    "path_event_type", "path_game", "path_jersey", "path_location", "path_part",
    "path_player", "path_team", "rebase_ms", "round_frame_ms", "split_list",
    "round_func", "strip_braces", "toStrUDF", "to_double", "tracking_states", "zip_arrays",
]
