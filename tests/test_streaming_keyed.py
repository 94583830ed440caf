"""Batch = stream for the operators of ``streaming.keyed``: OVER frames, cumulating and count windows,
co-groups, changelogs, live rules and history joins, under shuffled arrival where order is event time."""

import time

import pytest
from pyspark.sql import functions as F

from clickengine.operators import aggregates as AG
from clickengine.operators import joins as JN
from clickengine.operators import windows as WN
from clickengine.operators.ordered import arrival_bucket, time_bucket
from clickengine.plans import catalog
from clickengine.streaming import forms as SF
from clickengine.streaming import keyed
from clickengine.streaming import processors as P
from clickengine.streaming.replay import StreamReplay, is_sentinel, sentinel_row, slice_by
from tests.conftest import SF_SMALL, rows
from tests.test_streaming import _shuffled, _sides, _workdir, ev, replay  # noqa: F401


def out_of_order(spark, df, build, key="user_id"):
    """``build`` over slices in which arrival has nothing to do with time; the watermark moves at the end."""
    r = StreamReplay(spark, df.schema, _workdir())
    out = build(r.source().withWatermark("ts", "400 days"))
    for part in _shuffled(df, spark):
        r.push(part)
        r.run(out)
    r.push(sentinel_row(df, key, "ts"))
    for _ in range(3):
        r.run(out)
    return r.results().drop("batch_id")


@pytest.fixture(scope="module")
def some(ev):  # noqa: F811
    return ev.where("pmod(xxhash64(user_id), 3) = 0")


def _valued(df):
    """A value with nulls, negative and beyond 2^53."""
    return df.select("user_id", "event_id", "ts", F.expr(
        "case when event_id % 3 = 0 then null when event_id % 2 = 0 then -event_id else 9007199254740993 + event_id end").alias("v"))


@pytest.mark.parametrize("width", ["1 hour", "30 days"])
def test_over_rows_out_of_order(spark, some, width):
    e = _valued(some)
    got = out_of_order(spark, e, lambda s: SF.over_rows_avg(s, "user_id", "ts", "event_id", "v", 3, width=width))
    exp = WN.over_rows_avg(e, ["user_id"], ["ts", "event_id"], "v", 3, time_bucket("ts"))
    assert exp.where("avg_value is null").count() > 0
    assert rows(got) == rows(exp.select("user_id", "event_id", "avg_value"))


def test_over_rows_in_slices(spark, some):
    """With the rows coming in order, frames reach back into earlier batches."""
    e = _valued(some)
    got = replay(spark, e, lambda s: SF.over_rows_avg(s.withWatermark("ts", "1 hour"), "user_id", "ts", "event_id", "v", 2),
                 sentinel_key="user_id", order="ts")
    exp = WN.over_rows_avg(e, ["user_id"], ["ts", "event_id"], "v", 2, time_bucket("ts"))
    assert rows(got) == rows(exp.select("user_id", "event_id", "avg_value"))


def test_over_rows_is_the_registered_query(spark, some):
    """The frame of ``over_rows_avg`` in the catalog: milliseconds, three rows before."""
    e = some.withColumn("ms", F.unix_millis("ts"))
    got = out_of_order(spark, e, lambda s: SF.over_rows_avg(s, "user_id", "ts", "event_id", "ms", 3, name="avg_ms"))
    exp = catalog.queries()["over_rows_avg"](spark, SF_SMALL)
    # the whole table's rows, by the event they belong to
    exp = exp.join(e.select(F.col("event_id").alias("_e")), F.col("event_id") == F.col("_e"), "left_semi")
    assert rows(got.select("event_id", "avg_ms")) == rows(exp.select("event_id", "avg_ms"))


@pytest.mark.parametrize("shuffled", [False, True])
def test_cumulating_windows(spark, some, shuffled):
    def build(s):
        return SF.cumulate_counts(s if shuffled else s.withWatermark("ts", "0 seconds"), "user_id", "ts", "6 hours", "1 day")
    if shuffled:
        got = out_of_order(spark, some, build)
    else:
        got = replay(spark, some, build, slices=4, sentinel_key="user_id", order="ts")
    got = got.where(~is_sentinel("user_id"))
    exp = WN.cumulate_counts(some, ["user_id"], "ts", "6 hours", "1 day").select("user_id", "window_start", "window_end", "cnt")
    assert rows(got) == rows(exp)
    assert got.groupBy("user_id", "window_end").count().where("count > 1").count() == 0     # one row a window


@pytest.mark.parametrize("size,slide", [(10, 2), (4, None), (3, 2), (2, 5)])
def test_count_windows(spark, some, size, slide):
    e = _valued(some).withColumn("v", F.col("v") % 1000)
    got = replay(spark, e, lambda s: SF.count_window(s, "user_id", "event_id", size, slide, "v"))
    exp = WN.count_window(e, ["user_id"], ["event_id"], size, slide, arrival_bucket("event_id"), "v")
    assert exp.count() > 0
    assert rows(got) == rows(exp.select(*got.columns))


def test_cogroup_with_one_sided_windows(spark, some):
    def build(s):
        left = _sides(s, "view", "l").withWatermark("l_ts", "0 seconds")
        right = _sides(s, "click", "r").withWatermark("r_ts", "0 seconds")
        return SF.window_cogroup(left, right, "user_id", "l_ts", "r_ts", "1 day",
                                 {"n_left": "count(1)", "first_left": "min(l_id)"}, {"n_right": "count(1)", "last_right": "max(r_id)"})
    d = _workdir()
    r = StreamReplay(spark, some.schema, d)
    out = build(r.source())
    end = [sentinel_row(some, "user_id", "ts").withColumn("event_type", F.lit(t)) for t in ("view", "click")]
    for part in slice_by(some, "event_id", 3) + [end[0].unionByName(end[1])]:
        r.push(part)
        r.run(out)
    got = r.results().drop("batch_id").where(~is_sentinel("user_id"))
    exp = JN.window_cogroup(_sides(some, "view", "l"), _sides(some, "click", "r"), "user_id", "l_ts", "r_ts", "1 day",
                            [F.count(F.lit(1)).alias("n_left"), F.min("l_id").alias("first_left")],
                            [F.count(F.lit(1)).alias("n_right"), F.max("r_id").alias("last_right")])
    assert exp.where("n_left is null").count() and exp.where("n_right is null").count()
    assert rows(got) == rows(exp.select(*got.columns))


def test_changelog_stream_rebuilds_the_counts(spark, ev):  # noqa: F811
    got = replay(spark, ev, lambda s: SF.changelog_count(s, "user_id", "event_id"))
    exp = AG.changelog_count(ev, ["user_id"], ["event_id"], arrival_bucket("event_id"))
    assert rows(got) == rows(exp.select(*got.columns))
    assert rows(AG.apply_changelog(got, ["user_id"])) == rows(AG.count_by(ev, ["user_id"]))
    cancelled = spark.createDataFrame([("a", 1, "+I", 1), ("a", 2, "-U", 1)], "k string, s long, op string, cnt long")
    assert AG.apply_changelog(cancelled, ["k"]).collect() == []


def test_rules_that_arrive_while_the_query_runs(spark, ev):  # noqa: F811
    """A rule sent in the middle takes effect from there on; null users are one user."""
    e = ev.select(F.when(F.col("user_id") != "3", F.col("user_id")).alias("user_id"), "event_id", "event_type")
    last = e.agg(F.max("event_id")).first()[0]
    rules = spark.createDataFrame([("view", "click", -1), ("click", "purchase", last // 3 + 5), ("view", "view", last // 3 + 5 + last // 2)],
                                  "action1 string, action2 string, seq long")
    d = _workdir()
    re, rr = StreamReplay(spark, e.schema, d + "/e"), StreamReplay(spark, rules.schema, d + "/r")
    out = SF.match_live_rules(re.source(), rr.source(), "user_id", "event_type", "event_id", buckets=4)
    step = last // 3 + 1
    counts = []
    for i in range(3):
        for replay_, df, c in ((re, e, "event_id"), (rr, rules, "seq")):
            replay_.push(df.where((F.col(c) < (i + 1) * step) & (F.col(c) >= (i * step if i else -1))))
        re.run(out)
        counts.append(re.results().where("action1 = 'click'").count())
    exp = JN.match_transitions(e, rules, "user_id", "event_type", "event_id", arrival_bucket("event_id"))
    assert counts[0] == 0 < counts[1]
    cols = ["event_id", "user_id", "action1", "action2"]
    assert rows(exp.where("user_id is null"))
    assert rows(re.results(), *cols) == rows(exp, *cols)


@pytest.mark.parametrize("ttl", [None, "1 hour"])
def test_history_join_stream(spark, some, ttl):
    got = replay(spark, some, lambda s: SF.history_join(_sides(s, "signup", "l"), _sides(s, "purchase", "r"), "user_id", ttl))
    exp = JN.history_join(_sides(some, "signup", "l"), _sides(some, "purchase", "r"), "user_id")
    assert exp.count() > 0
    assert rows(got) == rows(exp.select(*got.columns))


def test_history_join_forgets_after_its_ttl(spark):
    schema = "k string, l long, r long"
    r = StreamReplay(spark, spark.createDataFrame([], schema).schema, _workdir())
    s = r.source()
    out = SF.history_join(s.where("l is not null").select("k", "l"), s.where("r is not null").select("k", "r"), "k", "1 milliseconds")
    for part in ([("a", 1, None), ("a", None, 2), (None, 5, 6)], [("a", None, 3)]):
        r.push(spark.createDataFrame(part, schema))
        r.run(out)
        time.sleep(0.05)
    assert rows(r.results().drop("batch_id")) == [("a", 1, 2)]


class _Memory:
    """Value state in memory."""

    def __init__(self):
        self.row = None

    def getValueState(self, name, schema):
        return self

    def exists(self):
        return self.row is not None

    def get(self):
        return self.row

    def update(self, row):
        self.row = row

    def clear(self):
        self.row = None


def test_expiring_value_refreshes_and_is_read_once():
    v = keyed.ExpiringValue(_Memory(), "v", "n long", 100)
    assert v.get(0) == (None, False)
    v.update((7,), 0)
    assert v.get(99) == ((7,), False)
    assert v.get(198) == ((7,), False)      # the read at 99 has refreshed it
    assert v.get(298) == ((7,), True)       # expired: once more, then gone
    assert v.get(299) == (None, False)


@pytest.mark.parametrize("ttl", [1, 3_600_000])
def test_expiring_count_on_a_stream(spark, ev, ttl):  # noqa: F811
    e = ev.where("event_id < 300")
    got = replay(spark, e, lambda s: P.run(s, "user_id", keyed.ExpiringCount(ttl), keyed.ExpiringCount.OUTPUT,
                                           time_mode="ProcessingTime"), slices=2)
    last = {r.user_id: r["count"] for r in e.groupBy("user_id").count().collect()}
    seen = got.where("not expired").groupBy("key").agg(F.max("cnt").alias("top"), F.sum("cnt").alias("all")).collect()
    old = {r.key: r.cnt for r in got.where("expired").collect()}
    if ttl == 1:    # every batch counts for itself, and tells what it found expired
        assert old and {r.key: r["all"] for r in seen} == last
    else:
        assert not old and {r.key: r.top for r in seen} == last
