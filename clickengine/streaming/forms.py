"""Structured Streaming forms of the windowed, join and late-data operators.

They share the column logic of the batch operators; the differences are a
watermark on every event-time input and the output mode.  Inputs need a
``timestamp`` (not ``timestamp_ntz``) event-time column: ``event_time``
casts one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickengine.operators.windows import _us, window_col
from clickengine.streaming import keyed, processors


def event_time(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """Cast the event-time column to ``timestamp`` and set the watermark
    (bounded out-of-orderness ``delay``; '0 seconds' for in-order input)."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def url_view_count(df: DataFrame, key: str, ts: str, size: str, slide: str | None = None,
                   offset: str | None = None) -> DataFrame:
    """Windowed count per key (AG14, WN1-WN3); append mode emits each window
    once the watermark passes its end, update mode on every change."""
    return (df.groupBy(F.col(key), window_col(ts, size, slide, offset).alias("_w"))
              .agg(F.count(F.lit(1)).alias("cnt"))
              .select(key, "cnt", F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end")))


def uv_count(df: DataFrame, user: str, ts: str, size: str) -> DataFrame:
    """Exact distinct users per window on a stream (AG10): distinct counts
    are not allowed on streams, so two chained aggregations - (window, user)
    then window via ``window_time`` - both in append mode."""
    per_user = df.groupBy(window_col(ts, size).alias("w"), F.col(user)).agg(F.count(F.lit(1)).alias("_n"))
    return (per_user.groupBy(F.window(F.window_time("w"), size).alias("_w"))
                    .agg(F.count(F.lit(1)).alias("uv"))
                    .select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "uv"))


def session_count(df: DataFrame, key: str, ts: str, gap: str) -> DataFrame:
    """Session windows per key (WN4)."""
    return (df.groupBy(F.col(key), F.session_window(ts, gap).alias("_s"))
              .agg(F.count(F.lit(1)).alias("cnt"))
              .select(key, F.col("_s.start").alias("window_start"), F.col("_s.end").alias("window_end"), "cnt"))


def window_join(left: DataFrame, right: DataFrame, key: str, l_ts: str, r_ts: str, size: str) -> DataFrame:
    """Stream-stream tumbling-window join (JN1): equi-join on key and the
    window column; both sides watermarked, state dropped per window."""
    # The window becomes the event-time column; the raw times are kept as
    # plain values (a stream may carry only one event-time column).
    lw = left.withColumn("_w", window_col(l_ts, size)).withColumn(l_ts, F.timestamp_micros(F.unix_micros(l_ts)))
    rw = right.withColumn("_w", window_col(r_ts, size)).withColumn(r_ts, F.timestamp_micros(F.unix_micros(r_ts)))
    j = lw.join(rw, on=[key, "_w"], how="inner")
    return j.withColumn("window_start", F.col("_w.start")).withColumn("window_end", F.col("_w.end")).drop("_w")


def interval_join(left: DataFrame, right: DataFrame, key: str, l_ts: str, r_ts: str,
                  lower: str, upper: str, how: str = "inner") -> DataFrame:
    """Stream-stream interval join (JN3): the range condition lets Spark drop
    state once the watermark passes the interval."""
    lo, hi = _us(lower), _us(upper)
    cond = [left[key] == right[key],
            right[r_ts] >= left[l_ts] + F.expr(f"INTERVAL {lo} MICROSECONDS"),
            right[r_ts] <= left[l_ts] + F.expr(f"INTERVAL {hi} MICROSECONDS")]
    j = left.join(right, on=cond, how=how)
    return j.drop(right[key])


def reconcile(app: DataFrame, third: DataFrame, key: str, app_ts: str, third_ts: str, wait: str) -> DataFrame:
    """Stream-stream reconciliation (JN5): full outer join on the id with the
    match window [app, app + wait]; unmatched rows come out with nulls once
    the watermark passes the window.  Column names must not clash."""
    w = _us(wait)
    a = app.withColumnRenamed(key, "_app_key")
    cond = [a["_app_key"] == third[key], third[third_ts] >= a[app_ts],
            third[third_ts] <= a[app_ts] + F.expr(f"INTERVAL {w} MICROSECONDS")]
    j = a.join(third, on=cond, how="full_outer")
    status = (F.when(F.col("_app_key").isNotNull() & third[key].isNotNull(), "matched")
               .when(F.col("_app_key").isNotNull(), "app_only").otherwise("third_only"))
    return j.select(F.coalesce(F.col("_app_key"), third[key]).alias(key), status.alias("status"),
                    a[app_ts].alias("app_ts"), third[third_ts].alias("third_ts"))


def late_refinement(df: DataFrame, key: str, ts: str, size: str, delay: str, lateness: str) -> DataFrame:
    """Late data with allowed lateness (ST3): the watermark keeps windows
    open for delay + lateness and ``update`` mode re-emits a window when a
    late row refines it.  Too-late rows are dropped by Spark; route them to
    a side output with ``operators.timers.split_late`` ahead of this."""
    wm = f"{_us(delay) + _us(lateness)} microseconds"
    d = df.withWatermark(ts, wm)
    return url_view_count(d, key, ts, size)


def rolling_count(df: DataFrame, key: str) -> DataFrame:
    """Rolling keyed count (AG2, AG3): in ``update`` mode every micro-batch
    emits the new count of each key it touched (the changelog's +U side)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("cnt"))


def window_top_n_batches(df: DataFrame, key: str, ts: str, n: int, size: str, slide: str | None = None,
                         offset: str | None = None):
    """Streaming top-N per window (TK1, TK2).  Row-number windows are not
    allowed on streams, so closed windows come out of the windowed count in
    ``append`` mode (each window exactly once) and are ranked per
    micro-batch.  Returns (counts stream, rank function for foreachBatch)."""
    from clickengine.operators.topn import rank_within
    counts = url_view_count(df, key, ts, size, slide, offset)

    def rank(batch: DataFrame) -> DataFrame:
        return rank_within(batch, ["window_start", "window_end"], [F.col("cnt").desc(), F.col(key)], n)

    return counts, rank


def top_n_sink(rank, writer):
    """``foreachBatch`` function applying ``rank`` to a batch and passing the
    result to ``writer(df, batch_id)``."""
    def apply(batch: DataFrame, batch_id: int):
        writer(rank(batch), batch_id)
    return apply


def pv_uv_ratio(df: DataFrame, user: str, ts: str, size: str, slide: str | None = None) -> DataFrame:
    """Page views, distinct users and their ratio per window on a stream
    (AG9): (window, user) counts first, then per window the sum of the counts
    (pv) and the number of users (uv) - two chained append-mode aggregations."""
    per_user = df.groupBy(window_col(ts, size, slide).alias("w"), F.col(user)).agg(F.count(F.lit(1)).alias("_n"))
    # the window column keeps its event-time metadata, so the second
    # aggregation can group by it directly (and is closed by the watermark)
    agg = (per_user.groupBy(F.col("w"))
                   .agg(F.sum("_n").alias("pv"), F.count(F.lit(1)).alias("uv")))
    return agg.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      "pv", "uv", (F.col("pv") / F.col("uv")).alias("ratio"))


def match_transitions(events: DataFrame, patterns: DataFrame, key: str, action: str, seq: str) -> DataFrame:
    """Rule matching on a stream (JN6) with a rule table that is at rest; ``match_live_rules`` takes
    rules that arrive while the query runs.  Each row with the key's previous action,
    joined inside the streaming query with the rule table (action1, action2, seq:
    the rule holds for rows after ``seq`` up to the next rule's).  The rule table is
    a static side; Spark broadcasts it if it is small."""
    from pyspark.sql import Window
    since = patterns.select("action1", "action2", F.col("seq").alias("_from"),
                            F.lead("seq").over(Window.orderBy("seq")).alias("_to"))
    rows = processors.run(events, key, processors.PreviousAction(seq, action), processors.PreviousAction.OUTPUT,
                          time_mode="None")
    return rows.join(since, (rows.prev_action == since.action1) & (rows.action == since.action2)
                     & (rows.seq > since["_from"]) & (since["_to"].isNull() | (rows.seq <= since["_to"]))) \
               .select("key", "seq", "prev_action", "action")


def match_live_rules(events: DataFrame, rules: DataFrame, key: str, action: str, seq: str, buckets: int = 64) -> DataFrame:
    """Live rules (JN6, ST13): both sides are streams.  Every bucket of keys gets every rule (as many copies of the
    small side as buckets), and a rule counts from its sequence number on, also for rows of the same
    micro-batch.  ``rules``: (action1, action2, seq).  A rule that arrives after rows with a larger number
    only counts for rows still to come."""
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    rows = events.select(bucket.alias("bucket"), F.lit("row").alias("kind"), F.col(key).cast("string").alias("name"),
                         F.col(seq).cast("bigint").alias("seq"), F.col(action).alias("action1"), F.lit(None).cast("string").alias("action2"))
    every = F.explode(F.sequence(F.lit(0), F.lit(buckets - 1)))
    both = rows.unionByName(rules.select(every.alias("bucket"), F.lit("rule").alias("kind"), F.lit(None).cast("string").alias("name"),
                                         F.col("seq").cast("bigint").alias("seq"), "action1", "action2"))
    out = processors.run(both, "bucket", keyed.LiveRules(), keyed.LiveRules.OUTPUT, time_mode="None")
    return out.select(F.col("name").cast(events.schema[key].dataType).alias(key), F.col("seq").alias(seq), "action1", "action2")


def over_rows_avg(df: DataFrame, key: str, ts: str, seq: str, value: str, preceding: int, name: str = "avg_value",
                  width: str = "1 hour") -> DataFrame:
    """Event-time OVER frame on a watermarked stream (WN13): (key, seq, average of the value over the row and the
    ``preceding`` rows before it in event time).  Rows wait for the watermark in time buckets of ``width``."""
    d = df.select(key, ts, F.col(seq).cast("bigint").alias(seq), F.col(value).cast("bigint").cast("string").alias(value))
    p = keyed.OverRowsAvg(ts, seq, value, preceding, _us(width) // 1000)
    return processors.run(d, key, p, p.OUTPUT).select(F.col("key").cast(df.schema[key].dataType).alias(key), F.col("seq").alias(seq),
                                                      F.col("avg").alias(name))


def cumulate_counts(df: DataFrame, key: str, ts: str, step: str, max_size: str, name: str = "cnt") -> DataFrame:
    """Cumulating windows on a watermarked stream (WN12).  Spark counts the rows per key and pane of one step
    (with partial aggregates, so a hot key is no hot task); the closed panes, few and small, feed the windows."""
    step_us, max_us = _us(step), _us(max_size)
    if step_us % 1000 or max_us % step_us:
        raise ValueError("the step must be whole milliseconds, the size a multiple of the step")
    panes = (df.groupBy(F.col(key), F.window(ts, step).alias("_w")).agg(F.count(F.lit(1)).alias("n"))
             .select(key, F.window_time("_w").alias("_et"), F.unix_micros("_w.start").alias("pane_us"), "n"))
    p = keyed.CumulateCounts(step_us // 1000, max_us // 1000)
    out = processors.run(panes, key, p, p.OUTPUT)
    return out.select(F.col("key").cast(df.schema[key].dataType).alias(key), F.timestamp_millis("base_ms").alias("window_start"),
                      F.timestamp_millis("end_ms").alias("window_end"), F.col("cnt").alias(name))


def count_window(df: DataFrame, key: str, seq: str, size: int, slide: int | None, value: str) -> DataFrame:
    """Count windows on a stream (WN5), in arrival order: the columns of ``windows.count_window``."""
    d = df.select(key, F.col(seq).cast("bigint").alias(seq), F.col(value).cast("bigint").cast("string").alias(value))
    p = keyed.CountWindow(seq, value, size, slide)
    return processors.run(d, key, p, p.OUTPUT, time_mode="None").select(
        F.col("key").cast(df.schema[key].dataType).alias(key), "end_rn", "n_rows", F.col("first_seq").alias(f"first_{seq}"),
        F.col("total").alias(f"sum_{value}"), F.col("top").alias(f"max_{value}"))


def changelog_count(df: DataFrame, key: str, seq: str) -> DataFrame:
    """Changelog of a running group count on a stream (AG13, SK10), in arrival order: (key, seq, op, cnt, pos).
    ``aggregates.apply_changelog`` rebuilds the counts."""
    p = keyed.ChangelogCount(seq)
    d = df.select(key, F.col(seq).cast("bigint").alias(seq))
    return processors.run(d, key, p, p.OUTPUT, time_mode="None").select(
        F.col("key").cast(df.schema[key].dataType).alias(key), F.col("seq").alias(seq), "op", "cnt", "pos")


def window_cogroup(left: DataFrame, right: DataFrame, key: str, l_ts: str, r_ts: str, size: str, left_aggs: dict[str, str],
                   right_aggs: dict[str, str]) -> DataFrame:
    """Window co-group of two watermarked streams (JN2): one row per key and window with rows on either side.
    Both sides go, tagged, into one windowed aggregation, so a window with rows on one side only comes out like
    any other.  ``*_aggs``: name -> SQL aggregate over that side's columns, which must not clash; a side without
    rows has nulls."""
    def tagged(df, ts, side):
        return df.select(F.col(key), F.col(ts).alias("_ts"), F.lit(side).alias("_side"),
                         *[F.struct(*[c for c in df.columns if c != key]).alias(f"_{side}")])

    l, r = tagged(left, l_ts, "l"), tagged(right, r_ts, "r")
    both = (l.withColumn("_r", F.lit(None).cast(r.schema["_r"].dataType))
            .unionByName(r.withColumn("_l", F.lit(None).cast(l.schema["_l"].dataType))))
    both = both.select(key, "_ts", "_side", *[F.col(f"_{s}.{c}").alias(c) for s, df in (("l", left), ("r", right))
                                             for c in df.columns if c != key])

    def one_sided(aggs, side):
        mine = f"FILTER (WHERE _side = '{side}')"
        return [F.expr(f"CASE WHEN count(1) {mine} > 0 THEN {agg} {mine} END").alias(name) for name, agg in aggs.items()]

    out = both.groupBy(F.col(key), F.window("_ts", size).alias("_w")).agg(*one_sided(left_aggs, "l"), *one_sided(right_aggs, "r"))
    return out.select(key, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *left_aggs, *right_aggs)


def history_join(left: DataFrame, right: DataFrame, key: str, ttl: str | None = None) -> DataFrame:
    """Full-history inner join of two streams (JN4).  Without ``ttl`` it is Spark's own stream join, which keeps both
    sides for good; with one a row meets the rows of the other side that arrived at most ``ttl`` (wall clock)
    before it or come within ``ttl`` after it.  Columns other than ``key`` must not clash; null keys match nothing."""
    if ttl is None:
        return left.join(right, on=key, how="inner")
    exact = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}

    def tagged(df, side):
        return df.where(F.col(key).isNotNull()).select(key, F.lit(side).alias("side"),
                                                       F.to_json(F.struct(*df.columns), exact).alias("row"))

    p = keyed.HistoryJoin(_us(ttl) // 1000)
    pairs = processors.run(tagged(left, "l").unionByName(tagged(right, "r")), key, p, p.OUTPUT, time_mode="ProcessingTime")
    pairs = pairs.select(F.from_json("l", left.schema, exact).alias("l"), F.from_json("r", right.schema, exact).alias("r"))
    return pairs.select(F.col(f"l.{key}").alias(key), *[F.col(f"l.{c}").alias(c) for c in left.columns if c != key],
                        *[F.col(f"r.{c}").alias(c) for c in right.columns if c != key])
