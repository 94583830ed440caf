"""Sinks (SK1-SK10).  Batch writers take a DataFrame; streaming writers take
a streaming DataFrame and a checkpoint location and use ``foreachBatch``
where the target needs idempotent per-batch writes (the batch id makes a
replayed micro-batch overwrite its own output instead of duplicating it)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickengine.functions.expressions import as_col
from clickengine.session import materialize


def table_exists(spark, path: str) -> bool:
    """True if a written folder is there.  Any other trouble with it (listing,
    credentials, damaged files) is an error."""
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def to_console(df: DataFrame, label: str, checkpoint: str | None = None, n: int | None = None):
    """Labelled print (SK1, SK9): a ``label`` column in front of the rows; all
    rows, fetched one partition at a time, or the first ``n``."""
    out = df.select(F.lit(label).alias("label"), *df.columns)
    if df.isStreaming:
        w = out.writeStream.format("console").option("truncate", "false")
        if checkpoint:
            w = w.option("checkpointLocation", checkpoint)
        return w.start()
    if n is not None:
        out.show(n, truncate=False)
    else:
        for row in out.toLocalIterator():
            print(*row)
    return None


def to_text_files(df: DataFrame, path: str, value: Column, max_records: int | None = None,
                  checkpoint: str | None = None, trigger: str | None = None, max_bytes: int | None = None):
    """Rolling UTF-8 text files (SK2): one line per row.  Files roll by rows
    (``max_records``), by size (``max_bytes``), and on a stream by time: every trigger
    closes its files, and an idle stream leaves none open.

    By size, a file is closed by the line that makes it ``max_bytes`` or more, line ends included.
    Every task counts the bytes of its own lines as they come, without a shuffle, and numbers its
    files; they lie in folders by that number (``roll=0``, ``roll=1``, ...)."""
    out = df.select(as_col(value).cast("string").alias("value"))
    rolls = []
    if max_bytes:
        out, rolls = out.mapInArrow(_roll(max_bytes), "value string, roll bigint"), ["roll"]
    if df.isStreaming:
        w = out.writeStream.format("text").option("path", path).option("checkpointLocation", checkpoint)
        w = w.partitionBy(*rolls) if rolls else w
        if max_records:
            w = w.option("maxRecordsPerFile", max_records)
        if trigger:
            w = w.trigger(processingTime=trigger)
        return w.start()
    w = out.write.mode("append")
    w = w.partitionBy(*rolls) if rolls else w
    if max_records:
        w = w.option("maxRecordsPerFile", max_records)
    w.text(path)
    return None


def _roll(max_bytes: int):
    """Numbers the file of each line of a task: a file ends with the line that fills it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, size = 0, 0
        for batch in batches:
            lines = pc.fill_null(batch.column(0), "")
            ends = np.cumsum(np.asarray(pc.binary_length(lines), dtype=np.int64) + 1)
            rolls = np.empty(len(ends), np.int64)
            at, before = 0, 0       # first line of the file in this batch, bytes of the batch before it
            while at < len(ends):
                last = int(np.searchsorted(ends, before + max_bytes - size))
                rolls[at:last + 1] = number
                if last >= len(ends):
                    size += int(ends[-1]) - before
                    break
                number, size, at, before = number + 1, 0, last + 1, int(ends[last])
            yield pa.RecordBatch.from_arrays([lines, pa.array(rolls)], names=["value", "roll"])
    return run


def kafka_frame(df: DataFrame, value: Column, key: Column | None = None) -> DataFrame:
    """The (key, value) string frame a Kafka sink writes (SK3)."""
    cols = [as_col(value).cast("string").alias("value")]
    if key is not None:
        cols.insert(0, as_col(key).cast("string").alias("key"))
    return df.select(*cols)


def to_kafka(df: DataFrame, servers: str, topic: str, value: Column, checkpoint: str,
             key: Column | None = None) -> StreamingQuery:
    """Kafka topic sink (SK3); needs the spark-sql-kafka connector."""
    return (kafka_frame(df, value, key).writeStream.format("kafka")
            .option("kafka.bootstrap.servers", servers).option("topic", topic)
            .option("checkpointLocation", checkpoint).start())


def to_jdbc(df: DataFrame, url: str, table: str, driver: str | None = None,
            checkpoint: str | None = None, properties: dict | None = None):
    """JDBC insert (SK4).  Streams write each micro-batch with
    ``foreachBatch``; rows carry their batch id in the column ``batch_id`` (the
    target table needs it), and a batch that is replayed first deletes what
    an earlier try has left of it, so no row is inserted twice."""
    props = dict(properties or {})
    if driver:
        props["driver"] = driver

    def write(batch: DataFrame, batch_id: int | None = None):
        if batch_id is not None:
            _delete_batch(batch.sparkSession, url, table, batch_id, props)
            batch = batch.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        batch.write.jdbc(url, table, mode="append", properties=props)

    if df.isStreaming:
        return df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).start()
    write(df)
    return None


def _delete_batch(spark, url: str, table: str, batch_id: int, props: dict) -> None:
    """Remove the rows of a batch, if the table is there."""
    jvm = spark.sparkContext._jvm
    if props.get("driver"):
        jvm.java.lang.Class.forName(props["driver"], True, jvm.java.lang.Thread.currentThread().getContextClassLoader())
    own = jvm.java.util.Properties()
    for k, v in props.items():
        own.setProperty(k, str(v))
    connection = jvm.java.sql.DriverManager.getConnection(url, own)
    try:
        found = connection.getMetaData().getTables(None, None, table.split(".")[-1].upper(), None).next() or \
            connection.getMetaData().getTables(None, None, table.split(".")[-1], None).next()
        if found:
            quote = connection.getMetaData().getIdentifierQuoteString().strip()   # the writer quotes column names
            statement = connection.prepareStatement(f"DELETE FROM {table} WHERE {quote}batch_id{quote} = ?")
            statement.setLong(1, batch_id)
            statement.executeUpdate()
    finally:
        connection.close()


def upsert_latest(df: DataFrame, key: str, value: str, order: str, path: str,
                  checkpoint: str | None = None, buckets: int = 64):
    """Keyed last-write-wins table (SK5, re-aimed hash write): the value of a
    key's row with the largest ``order`` over all batches, so a late batch never
    replaces a newer value.  The table is hash-partitioned by key into
    ``buckets`` folders (choose them so that one folder is a comfortable file);
    a batch reads, merges and rewrites only the folders of its keys (partition
    pruning, dynamic partition overwrite)."""
    spark = df.sparkSession

    def merge(batch: DataFrame, batch_id: int = 0):
        bucket = F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")
        rows = batch.select(key, value, order).withColumn("_bucket", bucket)
        merged = _latest(rows, key, value, order)
        if table_exists(spark, path):
            old = spark.read.parquet(path)
            touched = rows.select("_bucket").distinct()     # at most ``buckets`` rows
            same = old.join(F.broadcast(touched), "_bucket", "left_semi")
            # materialized: the folders are read before they are overwritten
            merged = materialize(_latest(rows.unionByName(same), key, value, order))
        (merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
               .partitionBy("_bucket").parquet(path))

    if df.isStreaming:
        return df.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).start()
    merge(df)
    return None


def _latest(rows: DataFrame, key: str, value: str, order: str) -> DataFrame:
    last = F.max_by(F.struct(value, order), F.struct(F.col(order).isNotNull(), order))
    return (rows.groupBy("_bucket", key).agg(last.alias("_v"))
                .select(key, F.col(f"_v.{value}").alias(value), F.col(f"_v.{order}").alias(order), "_bucket"))


def as_documents(df: DataFrame, key: str, value: str, index: str, keep: list[str] | None = None) -> DataFrame:
    """Rows as one-field JSON documents ``{key: value}`` for an index (SK6)."""
    doc = F.to_json(F.create_map(F.col(key).cast("string"), F.col(value).cast("string")))
    return df.select(*(keep or []), F.lit(index).alias("index_name"), doc.alias("doc"))


def to_documents(df: DataFrame, key: str, value: str, index: str, path: str,
                 checkpoint: str | None = None):
    """Write JSON documents partitioned by index name (SK6)."""
    docs = as_documents(df, key, value, index)
    if df.isStreaming:
        return (docs.writeStream.format("text").partitionBy("index_name").option("path", path)
                .option("checkpointLocation", checkpoint).start())
    docs.write.mode("append").partitionBy("index_name").text(path)
    return None


def to_batches(df: DataFrame, size: int, writer, checkpoint: str, remainder_path: str,
               key: list[str] | None = None, bucket_rows: int = 1 << 20) -> StreamingQuery:
    """Buffered sink (SK7, ST14): rows are flushed to ``writer(batch_df,
    batch_id)`` in groups of ``size`` (per ``key`` if given, else over the
    whole stream in ``_order``); the unflushed remainder is kept in a parquet
    folder per batch id, so a restart from the checkpoint resumes with it
    (the operator list state).  Rows need an ``_order`` column.  Numbering
    uses the skew-safe ordered scan: even the single global buffer is split
    into arrival buckets instead of one task."""
    from clickengine.operators.ordered import arrival_bucket, ordered_scan
    spark = df.sparkSession
    keys = key or ["_buffer"]

    def flush(batch: DataFrame, batch_id: int):
        before = f"{remainder_path}/batch={batch_id - 1}"
        rows = batch
        if batch_id > 0:   # every earlier batch has left a remainder, if only an empty one
            rows = spark.read.schema(batch.schema).parquet(before).unionByName(batch)
        if not key:
            rows = rows.withColumn("_buffer", F.lit(0))
        numbered = ordered_scan(rows, keys, ["_order"], arrival_bucket("_order", bucket_rows), rn="_pos",
                                hot_rows=bucket_rows)
        per_key = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_total"))
        if key:
            numbered = numbered.join(per_key, on=keys)
        else:   # one buffer: its size is one number, not a join on its only key
            numbered = numbered.withColumn("_total", per_key.select("_total").scalar())
        full = F.floor(F.col("_total") / size) * size
        done = numbered.where(F.col("_pos") <= full).drop("_pos", "_total")
        rest = numbered.where(F.col("_pos") > full).drop("_pos", "_total")
        if not key:
            done, rest = done.drop("_buffer"), rest.drop("_buffer")
        writer(done, batch_id)
        rest.write.mode("overwrite").parquet(f"{remainder_path}/batch={batch_id}")

    return df.writeStream.foreachBatch(flush).option("checkpointLocation", checkpoint).start()


def to_csv(df: DataFrame, path: str, header: bool = False):
    """CSV table insert (SK8)."""
    df.write.mode("append").option("header", str(header).lower()).csv(path)


def write_stream(df: DataFrame, mode: str, fmt: str = "memory", name: str | None = None,
                 checkpoint: str | None = None, **options) -> StreamingQuery:
    """Table to append stream (``append``) or changelog stream (``update``)
    (SK10)."""
    w = df.writeStream.outputMode(mode).format(fmt)
    if name:
        w = w.queryName(name)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    for k, v in options.items():
        w = w.option(k, v)
    return w.start()
