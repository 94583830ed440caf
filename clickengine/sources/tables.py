"""Loading of the parquet tables the registered queries run on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a lazy parquet scan: filters and column pruning of the
    query reach the reader (``PushedFilters`` / ``ReadSchema``).  The queries
    convert timestamps to epoch values, which is only exact with the session
    time zone pinned to UTC; it is set here because a caller may bring its
    own session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")

