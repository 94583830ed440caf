"""Batch = stream: each streaming form, fed the sf0.001 events in arrival
slices (every slice is a restart from the checkpoint), gives the batch
operator's result.  A far-future sentinel row flushes windows and timers
where the reference's bounded source would (SURVEY S4)."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from clickengine.operators import aggregates as AG
from clickengine.operators import joins as JN
from clickengine.operators import patterns as CE
from clickengine.operators import timers as TM
from clickengine.operators import windows as WN
from clickengine.operators.ordered import arrival_bucket, time_bucket
from clickengine.streaming import forms as SF
from clickengine.streaming import processors as P
from clickengine.streaming.replay import StreamReplay, is_sentinel, sentinel_row, slice_by
from tests.conftest import SF_SMALL, rows

H = 3_600_000


@pytest.fixture(scope="module")
def ev(spark):
    return (spark.read.parquet(f"{SF_SMALL}/events.parquet")
                 .withColumn("ts", F.col("ts").cast("timestamp"))
                 .withColumn("user_id", F.col("user_id").cast("string")))


def _workdir():
    return tempfile.mkdtemp(prefix="ce-stream-", dir="/tmp")


def replay(spark, ev, build, mode="append", slices=3, sentinel_key=None, order="event_id"):
    r = StreamReplay(spark, ev.schema, _workdir())
    out = build(r.source())
    parts = slice_by(ev, order, slices)
    if sentinel_key:
        parts.append(sentinel_row(ev, sentinel_key, "ts"))
    for part in parts:
        r.push(part)
        r.run(out, mode)
    res = r.results()
    res = res.drop("batch_id")
    if sentinel_key and sentinel_key in res.columns:
        res = res.where(~is_sentinel(sentinel_key))
    return res


def _wm(df, delay="0 seconds"):
    return df.withWatermark("ts", delay)


def test_window_count_stream(spark, ev):
    got = replay(spark, ev, lambda s: SF.url_view_count(_wm(s), "event_type", "ts", "6 hours"),
                 sentinel_key="event_type")
    assert rows(got) == rows(AG.url_view_count(ev, "event_type", "ts", "6 hours"))


def test_uv_count_chained_stream(spark, ev):
    got = replay(spark, ev, lambda s: SF.uv_count(_wm(s), "user_id", "ts", "6 hours"), sentinel_key="user_id")
    exp = AG.uv_count(ev.where(~is_sentinel("user_id")), "user_id", "ts", "6 hours")
    # the sentinel's own window is the only extra one
    got = got.where(F.col("window_start") < F.lit("2100-01-01").cast("timestamp"))
    assert rows(got) == rows(exp)


def test_session_stream(spark, ev):
    got = replay(spark, ev, lambda s: SF.session_count(_wm(s), "user_id", "ts", "1 hour"), sentinel_key="user_id")
    exp = WN.session_windows(ev, ["user_id"], "ts", ["ts", "event_id"], "1 hour", time_bucket("ts"))
    assert rows(got) == rows(exp)


def _sides(df, etype, p):
    return df.where(F.col("event_type") == etype).select(
        "user_id", F.col("event_id").alias(f"{p}_id"), F.col("ts").alias(f"{p}_ts"))


def test_interval_join_stream(spark, ev):
    def build(s):
        left = _sides(s, "purchase", "l").withWatermark("l_ts", "0 seconds")
        right = _sides(s, "click", "r").withWatermark("r_ts", "0 seconds")
        return SF.interval_join(left, right, "user_id", "l_ts", "r_ts", "-5 hours", "10 hours")
    got = replay(spark, ev, build)
    exp = JN.interval_join(_sides(ev, "purchase", "l"), _sides(ev, "click", "r"), "user_id", "l_ts", "r_ts",
                           "-5 hours", "10 hours")
    assert rows(got, "user_id", "l_id", "r_id") == rows(exp, "user_id", "l_id", "r_id")


def test_window_join_stream(spark, ev):
    def build(s):
        left = _sides(s, "view", "l").withWatermark("l_ts", "0 seconds")
        right = _sides(s, "click", "r").withWatermark("r_ts", "0 seconds")
        return SF.window_join(left, right, "user_id", "l_ts", "r_ts", "1 day")
    got = replay(spark, ev, build)
    exp = JN.window_join(_sides(ev, "view", "l"), _sides(ev, "click", "r"), "user_id", "l_ts", "r_ts", "1 day")
    assert rows(got, "user_id", "l_id", "r_id") == rows(exp, "user_id", "l_id", "r_id")


def test_event_timer_processor(spark, ev):
    got = replay(spark, ev, lambda s: P.run(_wm(s), "user_id", P.EventTimers("user_id", "ts", 6 * H),
                                            P.EventTimers.OUTPUT))
    fired = got.where("kind = 'fired'").select(F.col("key").alias("user_id"), "at_ms")
    exp = TM.event_timers(ev, "user_id", "ts", "6 hours").select("user_id", F.unix_millis("timer_ts").alias("at_ms"))
    assert rows(fired) == rows(exp)
    assert got.where("kind = 'arrival'").count() == ev.count()


def test_periodic_count_processor(spark, ev):
    got = replay(spark, ev, lambda s: P.run(_wm(s), "user_id", P.PeriodicCount("ts", 6 * H), P.PeriodicCount.OUTPUT))
    exp = TM.periodic_count(ev, "user_id", "ts", "6 hours").select(
        "user_id", F.unix_millis("tick_ts").alias("tick_ms"), "cnt")
    assert rows(got) == rows(exp)


def test_avg_every_n_processor(spark, ev):
    got = replay(spark, ev, lambda s: P.run(s, "user_id", P.AvgEveryN("event_id", "ts", 5), P.AvgEveryN.OUTPUT,
                                            time_mode="None"))
    exp = WN.avg_every_n(ev, ["user_id"], ["event_id"], "ts", 5, arrival_bucket("event_id"))
    exp = exp.select("user_id", "batch_no", (F.unix_micros("avg_ts") / 1000).cast("long").alias("avg_ms"))
    # the batch form averages micro-seconds; compare at millisecond precision
    assert rows(got, "key", "batch_no") == rows(exp, "user_id", "batch_no")
    diff = got.join(exp, (got.key == exp.user_id) & (got.batch_no == exp.batch_no)) \
              .where(F.abs(got.avg_ms - exp.avg_ms) > 1).count()
    assert diff == 0


def test_fail_state_machine_processor(spark, ev):
    got = replay(spark, ev, lambda s: P.run(s, "user_id", P.FailStateMachine("event_id", "event_type", "error"),
                                            P.FailStateMachine.OUTPUT, time_mode="None"))
    exp = CE.fail_state_machine(ev, ["user_id"], ["event_id"], "event_type", "error", arrival_bucket("event_id"))
    assert rows(got) == rows(exp)


def test_followed_within_processor(spark, ev):
    build = lambda s: P.run(_wm(s), "user_id", P.FollowedWithin("event_id", "ts", "event_type", "signup", "purchase",
                                                                 24 * H), P.FollowedWithin.OUTPUT)
    got = replay(spark, ev, build, sentinel_key="user_id")
    exp = CE.followed_within(ev, ["user_id"], ["ts", "event_id"], "ts", F.col("event_type") == "signup",
                             F.col("event_type") == "purchase", "24 hours", time_bucket("ts"))
    assert rows(got, "key", "seq", "status") == rows(exp, "user_id", "event_id", "status")


def _shuffled(df, spark):
    """The rows in three slices, out of order: every third row, by hash."""
    return [df.where(F.pmod(F.xxhash64("event_id"), F.lit(3)) == i) for i in range(3)]


def _event_time(spark, ev, processor):
    """A processor over out-of-order slices; the watermark only moves at the end."""
    r = StreamReplay(spark, ev.schema, _workdir())
    out = P.run(r.source().withWatermark("ts", "400 days"), "user_id", processor, processor.OUTPUT)
    for part in _shuffled(ev, spark):
        r.push(part)
        r.run(out)
    r.push(sentinel_row(ev, "user_id", "ts"))
    r.run(out)
    r.run(out)
    return r.results()


def test_strict_sequence_out_of_order(spark, ev):
    e = ev.where("pmod(xxhash64(user_id), 3) = 0").select("user_id", "event_id", "ts", "event_type")
    got = _event_time(spark, e, P.StrictSequence("event_id", "ts", "event_type", ["error"] * 3))
    exp = CE.strict_sequence(e, ["user_id"], ["ts", "event_id"], [F.col("event_type") == "error"] * 3, time_bucket("ts"),
                             "ts", ["a", "b", "c"])
    ms = lambda c: F.unix_millis(F.col(c).cast("timestamp"))
    assert exp.count() > 0
    assert rows(got.select("key", "times_ms")) == rows(exp.select(F.col("user_id").cast("string").alias("key"),
                                                                F.array(ms("a"), ms("b"), ms("c")).alias("times_ms")))


def test_consecutive_two_types_out_of_order(spark, ev):
    e = ev.where("pmod(xxhash64(user_id), 3) = 0").select("user_id", "event_id", "ts", "event_type")
    got = _event_time(spark, e, P.StrictSequence("event_id", "ts", "event_type", ["view", "click"]))
    exp = CE.strict_sequence(e, ["user_id"], ["ts", "event_id"], [F.col("event_type") == "view", F.col("event_type") == "click"],
                             time_bucket("ts"), "ts", ["a", "b"])
    assert got.count() == exp.count() > 0


@pytest.mark.parametrize("first,then", [("signup", "purchase"), ("view", "view")])
def test_followed_within_out_of_order(spark, ev, first, then):
    """Also with overlapping conditions: no row follows itself."""
    e = ev.where("pmod(xxhash64(user_id), 3) = 0").select("user_id", "event_id", "ts", "event_type")
    got = _event_time(spark, e, P.FollowedWithin("event_id", "ts", "event_type", first, then, 24 * H))
    exp = CE.followed_within(e, ["user_id"], ["ts", "event_id"], "ts", F.col("event_type") == first,
                             F.col("event_type") == then, "24 hours", time_bucket("ts"))
    got = got.select(F.col("key"), "seq", "then_ms", "status")
    exp = exp.select(F.col("user_id").cast("string").alias("key"), F.col("event_id").alias("seq"),
                     F.unix_millis(F.col("then_ts").cast("timestamp")).alias("then_ms"), "status")
    assert sorted(map(str, got.collect())) == sorted(map(str, exp.collect()))


def test_keyed_state_processor(spark, ev):
    got = replay(spark, ev, lambda s: P.run(s, "user_id", P.KeyedStateSummary("event_id", "event_type", "ts"),
                                            P.KeyedStateSummary.OUTPUT, time_mode="ProcessingTime"))
    last = got.groupBy("key").agg(F.max_by(F.struct(*got.columns), "cnt").alias("s")).select("s.*")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    exp = ev.groupBy("user_id").agg(
        F.count("*").alias("cnt"), F.min_by("event_type", "event_id").alias("first_url"),
        F.expr("sum(unix_micros(cast(ts as timestamp)) div 1000) div count(*)").alias("avg_ms"),
        F.max_by((us / 1000).cast("long"), "event_id").alias("last_ms"), F.countDistinct("event_type").alias("n_urls"),
        F.transform(F.array_sort(F.collect_list(F.struct("event_id", "event_type"))), lambda x: x["event_type"]).alias("urls"))
    cols = ["cnt", "first_url", "avg_ms", "last_ms", "n_urls", "urls"]
    assert rows(last.select("key", *cols)) == rows(exp.select(F.col("user_id").cast("string").alias("key"), *cols))


def test_row_without_order_value_is_an_error(spark, ev):
    bad = ev.limit(5).withColumn("event_id", F.when(F.col("event_id") % 2 == 0, F.col("event_id")))
    with pytest.raises(Exception, match="has no event_id"):
        replay(spark, bad.union(ev.limit(0)), lambda s: P.run(s, "user_id", P.FailStateMachine("event_id", "event_type", "error"),
                                                              P.FailStateMachine.OUTPUT, time_mode="None"), slices=1, order="ts")


def test_replay_reports_failure_and_timeout(spark, ev):
    r = StreamReplay(spark, ev.schema, _workdir())
    r.push(ev)
    with pytest.raises(Exception, match="boom"):
        r.run(r.source().withColumn("x", F.raise_error(F.lit("boom"))))
    r = StreamReplay(spark, ev.schema, _workdir())
    r.push(ev)
    with pytest.raises(TimeoutError):
        r.run(r.source(), timeout=0)


def test_slices_hold_every_row(spark, ev):
    from clickengine.streaming.replay import slice_by
    some = ev.withColumn("event_id", F.when(F.col("event_id") % 3 > 0, F.col("event_id")))
    assert sum(p.count() for p in slice_by(some, "event_id", 4)) == ev.count()
    assert sum(p.count() for p in slice_by(some.where("event_id is null"), "event_id", 4)) == some.where("event_id is null").count()


def test_previous_action_then_patterns(spark, ev):
    """The rules are joined inside the streaming query."""
    mid = ev.agg(F.max("event_id")).first()[0] // 2
    pats = spark.createDataFrame([("view", "click", -1), ("click", "purchase", mid)],
                                 "action1 string, action2 string, seq long")
    got = replay(spark, ev, lambda s: SF.match_transitions(s, pats, "user_id", "event_type", "event_id"))
    exp = JN.match_transitions(ev.select("user_id", "event_id", "event_type"), pats, "user_id", "event_type",
                               "event_id", arrival_bucket("event_id"))
    assert rows(got, "key", "seq") == rows(exp, "user_id", "event_id")


def test_reconcile_stream(spark):
    app = spark.createDataFrame([("order-1", 1000), ("order-2", 2000), ("order-3", 3500), ("~", 99_000_000)],
                                "order_id string, ms long").withColumn("app_et", F.timestamp_millis("ms"))
    third = spark.createDataFrame([("order-1", 3000), ("order-3", 4000), ("order-9", 9000), ("~~", 99_000_000)],
                                  "tp_id string, ms long").withColumn("tp_et", F.timestamp_millis("ms"))
    d = _workdir()
    ra, rt = StreamReplay(spark, app.schema, d + "/a"), StreamReplay(spark, third.schema, d + "/t")
    ra.push(app)
    rt.push(third)
    a = ra.source().withWatermark("app_et", "0 seconds").drop("ms")
    t = rt.source().withWatermark("tp_et", "0 seconds").drop("ms")
    out = SF.reconcile(a, t.withColumnRenamed("tp_id", "order_id"), "order_id", "app_et", "tp_et", "5 seconds")
    ra.run(out)
    ra.run(out)  # a second (no-data) run lets the watermark flush unmatched rows
    got = ra.results().where("order_id NOT LIKE '~%'")
    assert rows(got, "order_id", "status") == [
        ("order-1", "matched"), ("order-2", "app_only"), ("order-3", "matched"), ("order-9", "third_only")]


def test_buffered_sink_restart(spark, ev):
    """Flush every 10 rows; the unflushed remainder survives restarts."""
    from clickengine.sinks import to_batches
    d = _workdir()
    r = StreamReplay(spark, ev.schema, d)
    flushed = os.path.join(d, "flushed")

    def writer(df, batch_id):
        df.write.mode("overwrite").parquet(f"{flushed}/batch_id={batch_id}")

    src = r.source().withColumn("_order", F.col("event_id"))
    for part in slice_by(ev, "event_id", 3):
        r.push(part)
        q = to_batches(src, 10, writer, r.ckpt, os.path.join(d, "remainder"))
        q.awaitTermination(5)
        q.processAllAvailable()
        q.stop()
    got = spark.read.parquet(flushed)
    n = ev.count()
    assert got.count() == (n // 10) * 10
    assert got.select("event_id").distinct().count() == got.count()


def test_union_watermark_is_minimum(spark):
    """SO1: union of two streams with 2 s and 5 s delays; the combined
    watermark is the minimum, so a 10 s window closes only when both allow."""
    from clickengine.operators.transforms import union_streams
    schema = "user string, ms long"
    d = _workdir()
    r1, r2 = StreamReplay(spark, spark.createDataFrame([], schema).schema, d + "/1"), \
        StreamReplay(spark, spark.createDataFrame([], schema).schema, d + "/2")
    s1 = r1.source().withColumn("et", F.timestamp_millis("ms")).withWatermark("et", "2 seconds")
    s2 = r2.source().withColumn("et", F.timestamp_millis("ms")).withWatermark("et", "5 seconds")
    out = SF.url_view_count(union_streams(s1, s2), "user", "et", "10 seconds")
    r1.push(spark.createDataFrame([("a", 1000), ("a", 13000)], schema))
    r2.push(spark.createDataFrame([("b", 2000), ("b", 13000)], schema))
    r1.run(out)
    r1.run(out)
    # min watermark = 13 s - 5 s = 8 s < 10 s: the [0, 10 s) window is still open
    assert r1.results() is None or r1.results().count() == 0
    r1.push(spark.createDataFrame([("a", 16000)], schema))
    r2.push(spark.createDataFrame([("b", 16000)], schema))
    r1.run(out)
    r1.run(out)
    # min watermark = 16 s - 5 s = 11 s: the first window is emitted
    assert rows(r1.results(), "user", "cnt") == [("a", 1), ("b", 1)]


def test_processing_time_timers_smoke(spark, ev):
    """ST5: processing-time timers fire by the wall clock; the query is
    bounded by the replay driver's idle stop."""
    import time
    r = StreamReplay(spark, ev.schema, _workdir())
    out = P.run(r.source(), "event_type", P.ProcessingTimeTimers(1), P.ProcessingTimeTimers.OUTPUT,
                time_mode="ProcessingTime")
    r.push(ev.where("event_id < 100"))
    r.run(out, timeout=60)
    time.sleep(0.1)
    r.run(out, timeout=60)
    got = r.results()
    assert got.where("kind = 'arrival'").count() == 100
    assert got.where("kind = 'fired'").count() >= 1


def test_value_state_ttl_expires(spark, ev):
    """ST12: with a 1 ms TTL the count state expires between batches."""
    build = lambda s: P.run(s, "user_id", P.KeyedStateSummary("event_id", "event_type", "ts", ttl_ms=1),
                            P.KeyedStateSummary.OUTPUT, time_mode="ProcessingTime")
    got = replay(spark, ev, build, slices=3)
    final = got.groupBy("key").agg(F.max("cnt").alias("cnt"))
    exp = ev.groupBy("user_id").count()
    # counts restart in every batch instead of accumulating
    assert final.agg(F.sum("cnt")).first()[0] < exp.agg(F.sum("count")).first()[0]


def test_builtin_late_drop_matches_split_late(spark):
    """S3: Spark drops too-late rows silently before the stateful operator.
    The replay driver runs a no-data batch after every slice, which moves the
    watermark before the next slice arrives, so here the built-in drop equals
    the contract rule ``split_late(lag_slices=1)`` (without those batches it
    lags one more slice: ``lag_slices=2``)."""
    schema = "slice long, k string, ms long"
    data = [(0, "x", 1000), (1, "x", 30000), (2, "x", 2000), (3, "x", 3000), (4, "x", 60000)]
    df = spark.createDataFrame(data, schema).withColumn("et", F.timestamp_millis("ms"))
    r = StreamReplay(spark, spark.createDataFrame([], schema).schema, _workdir())
    out = SF.url_view_count(r.source().withColumn("et", F.timestamp_millis("ms")).withWatermark("et", "0 seconds"),
                            "k", "et", "10 seconds")
    for i in range(5):
        r.push(df.where(F.col("slice") == i).drop("et"))
        r.run(out, "update")
    counted = r.results().where("window_start = TIMESTAMP '1970-01-01 00:00:00'").agg(F.max("cnt")).first()[0]
    split = TM.split_late(df, "slice", "et", "10 seconds", "0 seconds", "0 seconds", lag_slices=1)
    kept = split.where("ms < 10000 AND NOT is_late").count()
    assert counted == kept == 1
    assert split.where("is_late").count() == 2      # the side output


def test_window_top_n_stream(spark, ev):
    """TK1 on a stream: closed windows in append mode, ranked per batch."""
    from clickengine.operators import topn as TK
    d = _workdir()
    r = StreamReplay(spark, ev.schema, d)
    counts, rank = SF.window_top_n_batches(_wm(r.source()), "event_type", "ts", 2, "6 hours", offset="3 hours")
    out = os.path.join(d, "top")

    def writer(df, batch_id):
        df.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    for part in slice_by(ev, "event_id", 3) + [sentinel_row(ev, "event_type", "ts")]:
        r.push(part)
        q = (counts.writeStream.outputMode("append").foreachBatch(SF.top_n_sink(rank, writer))
             .option("checkpointLocation", r.ckpt).trigger(availableNow=True).start())
        q.awaitTermination(120)
        q.stop()
    got = spark.read.parquet(out).drop("batch_id").where(~is_sentinel("event_type"))
    exp = TK.window_top_n(ev, "event_type", "ts", 2, "6 hours", offset="3 hours")
    assert rows(got) == rows(exp)


def test_rolling_count_update_stream(spark, ev):
    """AG2 on a stream: update mode re-emits the touched keys' counts; the
    last update per key is the batch count, every update a rolling value."""
    got = replay(spark, ev, lambda s: SF.rolling_count(s, "event_type"), mode="update")
    final = got.groupBy("event_type").agg(F.max("cnt").alias("cnt"))
    assert rows(final) == rows(AG.count_by(ev, ["event_type"]))
    roll = AG.rolling_count(ev.select("event_type", "event_id"), ["event_type"], ["event_id"],
                            arrival_bucket("event_id"))
    assert got.join(roll, ["event_type", "cnt"], "left_anti").count() == 0


def test_late_refinement_update_mode(spark):
    """ST3: delay 2 s + allowed lateness 60 s; a late row inside the lateness
    refines its window (update mode re-emits it), a later one is dropped."""
    schema = "k string, ms long"
    r = StreamReplay(spark, spark.createDataFrame([], schema).schema, _workdir())
    src = r.source().withColumn("et", F.timestamp_millis("ms"))
    out = SF.late_refinement(src, "k", "et", "10 seconds", "2 seconds", "60 seconds")
    for part in [[("x", 1000), ("x", 30000)], [("x", 2000)], [("x", 200000)], [("x", 3000)]]:
        r.push(spark.createDataFrame(part, schema))
        r.run(out, "update")
    first = r.results().where("window_start = TIMESTAMP '1970-01-01 00:00:00'")
    assert sorted(x.cnt for x in first.collect()) == [1, 2]     # emitted, then refined once


def test_streaming_word_count_and_csv(spark, tmp_path):
    """SC1 + PF3 + AG2 on a stream: text lines -> tokens -> rolling counts
    (update mode); SC3: the click CSV read as a stream with its schema."""
    from clickengine.operators.transforms import tokenize
    from clickengine.sources import read_click_csv, read_lines
    from tests.fixtures import CLICK_TXT, WORDS
    src = tmp_path / "lines"
    src.mkdir()
    (src / "a.txt").write_text("\n".join(WORDS) + "\n")
    counts = tokenize(read_lines(spark, str(src), streaming=True), "value").groupBy("word").count()
    q = counts.writeStream.outputMode("update").format("memory").queryName("wc_stream") \
              .option("checkpointLocation", str(tmp_path / "ck")).start()
    q.processAllAvailable()
    q.stop()
    got = dict((r.word, r["count"]) for r in spark.sql("SELECT word, max(count) AS count FROM wc_stream GROUP BY word").collect())
    assert got == {"hello": 3, "world": 1, "bigdata": 1, "flink": 1, "hi": 1, "spark": 1}

    csv = tmp_path / "csv"
    csv.mkdir()
    (csv / "click.txt").write_text("\n".join(f"{u}, {url}, {ts}" for _, u, url, ts in CLICK_TXT) + "\n")
    s = read_click_csv(spark, str(csv), streaming=True)
    q = s.writeStream.format("memory").queryName("csv_stream").option("checkpointLocation", str(tmp_path / "ck2")).start()
    q.processAllAvailable()
    q.stop()
    assert spark.sql("SELECT count(*) FROM csv_stream WHERE user_name = 'Tom'").first()[0] == 5


def test_pv_uv_ratio_stream(spark, ev):
    got = replay(spark, ev, lambda s: SF.pv_uv_ratio(_wm(s), "user_id", "ts", "6 hours", "1 hour"),
                 sentinel_key="user_id")
    got = got.where(F.col("window_start") < F.lit("2100-01-01").cast("timestamp"))
    assert rows(got) == rows(AG.pv_uv_ratio(ev, "user_id", "ts", "6 hours", "1 hour"))


def test_text_file_sink_stream(spark, ev, tmp_path):
    """SK2 on a stream: rows as UTF-8 lines, files rolled by row count."""
    from clickengine.functions import event_text
    from clickengine.sinks import to_text_files
    r = StreamReplay(spark, ev.schema, _workdir())
    r.push(ev.where("event_id < 50"))
    s = r.source().withColumn("ms", F.unix_millis("ts"))
    out = str(tmp_path / "text")
    q = to_text_files(s, out, event_text(F.col("user_id"), F.col("event_type"), F.col("ms")), max_records=10,
                      checkpoint=str(tmp_path / "ck"))
    q.processAllAvailable()
    q.stop()
    back = spark.read.text(out)
    assert back.count() == 50
    assert all(v.startswith("Event{user='") for v in (x.value for x in back.collect()))
    assert len([f for f in os.listdir(out) if f.endswith(".txt")]) >= 5
