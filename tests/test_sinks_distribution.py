"""Sinks (SK1-SK10) round trips and distribution wrappers (DP1-DP7)."""

import os

import pytest
from pyspark.sql import functions as F

from clickengine.functions import event_text
from clickengine.operators import distribution as DP
from clickengine.sinks import (as_documents, kafka_frame, to_console, to_csv, to_documents, to_jdbc, to_text_files,
                               upsert_latest, write_stream)
from clickengine.sources import read_lines
from tests.conftest import rows
from tests.fixtures import EVENTS_A, events


def test_text_files_round_trip(spark, tmp_path):
    e = events(spark)
    out = str(tmp_path / "out")
    to_text_files(e, out, event_text(F.col("user"), F.col("url"), F.col("timestamp")), max_records=3)
    back = read_lines(spark, out)
    assert back.count() == 8
    assert len([f for f in os.listdir(out) if f.endswith(".txt")]) >= 3   # rolled by size
    assert "Event{user='Bob', url='./cart', timestamp=1970-01-01 00:00:02.0}" in [r.value for r in back.collect()]


def test_csv_round_trip(spark, tmp_path):
    e = events(spark).select("user", "url", "timestamp")
    out = str(tmp_path / "csv")
    to_csv(e, out)
    back = spark.read.schema("user string, url string, timestamp long").csv(out)
    assert rows(back) == rows(e)


def test_jdbc_embedded_derby(spark, tmp_path):
    url = f"jdbc:derby:memory:clicks{os.getpid()};create=true"
    e = events(spark).select("user", "url")
    to_jdbc(e, url, "clicks", driver="org.apache.derby.jdbc.EmbeddedDriver")
    back = spark.read.jdbc(url, "clicks", properties={"driver": "org.apache.derby.jdbc.EmbeddedDriver"})
    assert back.count() == 8


def test_upsert_latest(spark, tmp_path):
    path = str(tmp_path / "latest")
    e = events(spark, EVENTS_A)
    upsert_latest(e.where("seq <= 4"), "user", "url", "seq", path)
    upsert_latest(e.where("seq > 4"), "user", "url", "seq", path)
    got = rows(spark.read.parquet(path).select("user", "url"))
    assert got == [("Alice", "./prod?id=200"), ("Bob", "./prod?id=3"), ("Mary", "./home")]
    # a later batch touching one key rewrites only that key's bucket folder
    before = {d: os.path.getmtime(os.path.join(path, d)) for d in os.listdir(path) if d.startswith("_bucket=")}
    upsert_latest(e.where("seq = 1").withColumn("seq", F.lit(99)).withColumn("url", F.lit("./new")),
                  "user", "url", "seq", path)
    after = {d: os.path.getmtime(os.path.join(path, d)) for d in os.listdir(path) if d.startswith("_bucket=")}
    assert sum(1 for d in before if after.get(d) != before[d]) == 1
    assert rows(spark.read.parquet(path).where("user = 'Mary'").select("url")) == [("./new",)]
    assert spark.read.parquet(path).count() == 3


def test_documents(spark, tmp_path):
    e = events(spark)
    docs = as_documents(e, "user", "url", "clicks")
    assert docs.first().doc == '{"Mary":"./home"}'
    out = str(tmp_path / "idx")
    to_documents(e, "user", "url", "clicks", out)
    assert spark.read.text(f"{out}/index_name=clicks").count() == 8


def test_kafka_frame(spark):
    f = kafka_frame(events(spark), F.col("url"), F.col("user"))
    assert f.columns == ["key", "value"] and f.count() == 8


def test_distribution(spark):
    df = spark.range(1, 9).withColumnRenamed("id", "v")
    parts = DP.by_partition_id(df, F.col("v"), 2).rdd.glom().collect()
    assert sorted(x.v for x in parts[0]) == [2, 4, 6, 8] and sorted(x.v for x in parts[1]) == [1, 3, 5, 7]
    assert DP.shuffle(df, 4).rdd.getNumPartitions() == 4
    assert DP.rebalance(df, 3).rdd.getNumPartitions() == 3
    assert DP.gather(df).rdd.getNumPartitions() == 1
    assert DP.rescale(DP.rebalance(df, 4), 2).rdd.getNumPartitions() == 2
    assert DP.by_key(df, "v", 5).rdd.getNumPartitions() == 5
    assert DP.spread(DP.gather(df), 4).rdd.getNumPartitions() == 4
    assert DP.spread(DP.rebalance(df, 6)).rdd.getNumPartitions() == 6
    assert DP.broadcast_all(df).count() == 8


def test_console_and_kafka_options(spark, capsys):
    from clickengine.sinks import to_console
    from clickengine.sources import kafka_reader_options
    to_console(events(spark), "clicks", n=3)
    assert "clicks" in capsys.readouterr().out
    opts = kafka_reader_options("host:9092", "clicks", "latest", "g1")
    assert opts == {"kafka.bootstrap.servers": "host:9092", "subscribe": "clicks",
                    "startingOffsets": "latest", "kafka.group.id": "g1"}


def test_upsert_keeps_the_newer_row(spark, tmp_path):
    """A late batch, a replayed batch and a null order never replace a newer value."""
    path = str(tmp_path / "latest")
    for batch in ([("a", "new", 5), ("b", "x", 1)], [("a", "old", 3), ("c", "y", None)], [("a", "new", 5), ("c", "z", 2)]):
        upsert_latest(spark.createDataFrame(batch, "k string, v string, o long"), "k", "v", "o", path)
    assert rows(spark.read.parquet(path).select("k", "v", "o")) == [("a", "new", 5), ("b", "x", 1), ("c", "z", 2)]


def test_upsert_reports_an_unreadable_table(spark, tmp_path):
    path = tmp_path / "latest"
    path.mkdir()
    (path / "part-0.parquet").write_text("no parquet file")
    with pytest.raises(Exception):
        upsert_latest(spark.createDataFrame([("a", "v", 1)], "k string, v string, o long"), "k", "v", "o", str(path))
    assert (path / "part-0.parquet").exists()


def test_streaming_jdbc_does_not_insert_twice(spark, tmp_path):
    driver = "org.apache.derby.jdbc.EmbeddedDriver"
    url = f"jdbc:derby:memory:stream{os.getpid()};create=true"
    src = str(tmp_path / "src")
    events(spark).select("user", "url").write.parquet(src)
    stream = lambda: spark.readStream.schema("user string, url string").parquet(src)
    for checkpoint in ("a", "b"):   # the second run replays batch 0 after a lost checkpoint
        to_jdbc(stream(), url, "seen", driver=driver, checkpoint=str(tmp_path / checkpoint)).processAllAvailable()
    for q in spark.streams.active:
        q.stop()
    assert spark.read.jdbc(url, "seen", properties={"driver": driver}).count() == 8


def test_streaming_upsert_documents_and_changelog(spark, tmp_path):
    src = str(tmp_path / "src")
    e = events(spark, EVENTS_A)
    e.write.parquet(src)
    stream = lambda: spark.readStream.schema(e.schema).parquet(src)
    queries = [upsert_latest(stream(), "user", "url", "seq", str(tmp_path / "up"), checkpoint=str(tmp_path / "c1")),
               to_documents(stream(), "user", "url", "clicks", str(tmp_path / "docs"), checkpoint=str(tmp_path / "c2")),
               write_stream(stream().groupBy("user").count(), "update", name="changes", checkpoint=str(tmp_path / "c3"))]
    for q in queries:
        q.processAllAvailable()
        q.stop()
    assert rows(spark.read.parquet(str(tmp_path / "up")).select("user", "url")) == [
        ("Alice", "./prod?id=200"), ("Bob", "./prod?id=3"), ("Mary", "./home")]
    assert spark.read.text(str(tmp_path / "docs")).count() == e.count()
    assert rows(spark.table("changes")) == rows(e.groupBy("user").count())


def test_console_prints_every_row(spark, capsys):
    to_console(spark.range(45), "label")
    assert len(capsys.readouterr().out.splitlines()) == 45


@pytest.mark.parametrize("lines", [[9] * 100, [20_000] * 30, [9, 30_000, 0, 70_000, 500, None, 1] * 9])
def test_text_files_roll_by_size(spark, tmp_path, lines):
    """A file ends with the line that fills it, whatever the length of the lines."""
    out, limit = str(tmp_path / "out"), 64_000 if max(x or 0 for x in lines) > 9 else 250
    df = spark.createDataFrame([(n,) for n in lines], "n int").coalesce(1).withColumn("v", F.expr("repeat('é', n div 2) || repeat('x', n % 2)"))
    to_text_files(df, out, F.col("v"), max_bytes=limit)
    files = {}
    for folder in os.listdir(out):
        if folder.startswith("roll="):
            [name] = [f for f in os.listdir(os.path.join(out, folder)) if f.endswith(".txt")]
            files[int(folder[5:])] = os.path.join(out, folder, name)
    sizes = [os.path.getsize(files[i]) for i in range(len(files))]
    assert all(limit <= n < limit + max(x or 0 for x in lines) + 1 for n in sizes[:-1])
    assert sum(sizes) == sum((n or 0) + 1 for n in lines)
    want, size = [0], 0     # the same rule, line by line
    for n in lines:
        if size >= limit:
            want.append(0)
            size = 0
        size += (n or 0) + 1
        want[-1] = size
    assert sizes == want


def test_text_files_roll_by_size_on_a_stream(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(3000).selectExpr("repeat('y', 99) v").coalesce(1).write.parquet(src)
    q = to_text_files(spark.readStream.schema("v string").parquet(src), out, F.col("v"), max_bytes=100_000, checkpoint=str(tmp_path / "ck"))
    q.processAllAvailable()
    q.stop()
    sizes = sorted(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(out) for f in fs if f.endswith(".txt"))
    assert sizes == [100_000] * 3
