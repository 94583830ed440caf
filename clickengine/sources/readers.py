"""Sources (SC1-SC8).  Every reader takes an explicit schema: no inference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickengine.functions.expressions import millis_to_ts, seconds_ts
from clickengine.schemas import CLICK_TABLE


def read_lines(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Text lines as a ``value`` column, batch or stream (SC1)."""
    return (spark.readStream if streaming else spark.read).text(path)


def from_rows(spark: SparkSession, rows, schema) -> DataFrame:
    """In-memory rows with a fixed schema (SC2).  For fixtures and small
    side tables only: the rows travel from the driver."""
    return spark.createDataFrame(rows, schema)


def read_click_csv(spark: SparkSession, path: str, streaming: bool = False,
                   schema: T.StructType = CLICK_TABLE) -> DataFrame:
    """CSV click table by DDL schema (SC3); spaces after the commas are
    trimmed (S16)."""
    reader = spark.readStream if streaming else spark.read
    return (reader.schema(schema)
                  .option("ignoreLeadingWhiteSpace", "true")
                  .option("ignoreTrailingWhiteSpace", "true")
                  .option("mode", "FAILFAST")
                  .csv(path))


def parse_click_lines(df: DataFrame, col: str = "value", on_error: str = "fail") -> DataFrame:
    """Parse ``user, url, timestamp`` lines into clicks (SC4): split on ',',
    trim the three fields, third to bigint.

    on_error="fail": ANSI cast, a bad number fails the job (like
    ``Long.valueOf``); "reject": keep every line, with ``parse_error`` set
    (and the click fields null) for lines that do not parse."""
    parts = F.split(F.col(col), ",")
    at = F.element_at if on_error == "fail" else F.try_element_at
    user, url, ts_txt = (F.trim(at(parts, F.lit(i))) for i in (1, 2, 3))
    if on_error == "fail":
        return df.select(user.alias("user"), url.alias("url"), ts_txt.cast("bigint").alias("timestamp"))
    ts = ts_txt.try_cast("bigint")
    bad = (F.size(parts) < 3) | ts.isNull()
    return df.select(F.when(~bad, user).alias("user"), F.when(~bad, url).alias("url"),
                     F.when(~bad, ts).alias("timestamp"),
                     F.when(bad, F.col(col)).alias("parse_error"))


def kafka_reader_options(servers: str, topic: str, starting: str = "latest",
                         group_id: str | None = None) -> dict:
    """Options of the Kafka line source (SC5)."""
    opts = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    if group_id:
        opts["kafka.group.id"] = group_id
    return opts


def read_kafka_lines(spark: SparkSession, servers: str, topic: str, starting: str = "latest",
                     group_id: str | None = None) -> DataFrame:
    """Kafka topic as a stream of string lines (SC5).  Needs the
    spark-sql-kafka connector on the classpath."""
    r = spark.readStream.format("kafka")
    for k, v in kafka_reader_options(servers, topic, starting, group_id).items():
        r = r.option(k, v)
    return r.load().select(F.col("value").cast("string").alias("value"))


def register_view(df: DataFrame, name: str, rename: dict | None = None, event_time: str | None = None,
                  time_name: str = "et", delay: str | None = None) -> DataFrame:
    """Stream/table to a named view with optional column renames (SC6, SC7);
    ``spark.table(name)`` / SQL read it back.  ``event_time`` names a column of
    epoch milliseconds from which the view gets a row-time column ``time_name``,
    on a stream with a watermark of ``delay``."""
    if event_time:
        df = with_event_time(df, event_time, time_name, delay)
    for old, new in (rename or {}).items():
        df = df.withColumnRenamed(old, new)
    df.createOrReplaceTempView(name)
    return df


def with_event_time(df: DataFrame, ms_col: str, name: str = "et", delay: str | None = None,
                    truncate_to_seconds: bool = False) -> DataFrame:
    """Event-time column from epoch ms, optionally with a watermark (SC8).
    ``truncate_to_seconds`` is the SQL form ``TO_TIMESTAMP(FROM_UNIXTIME(ts/1000))``."""
    et: Column = seconds_ts(F.col(ms_col)) if truncate_to_seconds else millis_to_ts(F.col(ms_col))
    out = df.withColumn(name, et)
    return out.withWatermark(name, delay) if delay else out
