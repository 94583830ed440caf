from clickengine.sinks.upsert_table import UpsertTable
from clickengine.sinks.writers import (
    as_documents, kafka_frame, to_batches, to_console, to_csv, to_documents, to_jdbc, to_kafka,
    to_text_files, upsert_latest, write_stream,
)

__all__ = ["UpsertTable", "as_documents", "kafka_frame", "to_batches", "to_console", "to_csv", "to_documents",
           "to_jdbc", "to_kafka", "to_text_files", "upsert_latest", "write_stream"]
