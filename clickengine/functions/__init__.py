from clickengine.functions.expressions import (
    as_col, event_text, java_hash, java_split, millis_to_ts, seconds_ts, split_words,
    ts_to_micros, ts_to_millis, micros_to_ntz, weighted_avg, field_map, int_div, timestamp_text,
)
from clickengine.functions.sql import register_functions

__all__ = [
    "as_col", "event_text", "java_hash", "java_split", "millis_to_ts", "seconds_ts",
    "split_words", "ts_to_micros", "ts_to_millis", "micros_to_ntz", "weighted_avg",
    "field_map", "int_div", "timestamp_text", "register_functions",
]
