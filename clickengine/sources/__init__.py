from clickengine.sources.readers import (
    from_rows, parse_click_lines, read_click_csv, read_kafka_lines, read_lines,
    register_view, with_event_time, kafka_reader_options,
)
from clickengine.sources.tables import load_table, TABLES

__all__ = [
    "from_rows", "parse_click_lines", "read_click_csv", "read_kafka_lines", "read_lines",
    "register_view", "with_event_time", "kafka_reader_options", "load_table", "TABLES",
]
