"""Joins (JN1-JN7).

Equi-keys always come first so Spark can hash-partition both sides; time
conditions become either a window column in the key (window joins) or a
time-bucket key plus a residual range filter (interval join), which splits
a hot key over many tasks.  Small-side broadcasts are behind a row-count
check.  The pair-producing joins emit exactly the reference's pairs; the
``*_counts`` forms aggregate each side first and never build the pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickengine.functions.expressions import ts_to_micros
from clickengine.operators.ordered import ordered_scan
from clickengine.operators.windows import _us, with_window

BROADCAST_MAX_ROWS = 1_000_000


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                       known_rows: int | None = None) -> DataFrame:
    """Broadcast hint only for a side with a proven size bound.

    ``known_rows``: a bound that holds by construction (e.g. a rule table
    built from literal rows) - no job is run.  Otherwise the frame is counted
    up to ``max_rows + 1`` rows; use that only for inputs that are cheap to
    evaluate.  Sides whose size is only known after computing them (e.g. an
    aggregate) are better left to AQE, which converts a join to a broadcast
    join at run time from the measured size of the shuffle stage."""
    if known_rows is not None:
        small = known_rows <= max_rows
    else:
        small = df.limit(max_rows + 1).count() <= max_rows
    return F.broadcast(df) if small else df


def window_join(left: DataFrame, right: DataFrame, key: str, l_ts: str, r_ts: str, size: str) -> DataFrame:
    """Tumbling-window inner join (JN1): every (left, right) pair with the
    same key in the same window.  Column names other than ``key`` must not
    clash (rename first)."""
    lw = with_window(left, l_ts, size)
    rw = with_window(right, r_ts, size)
    return lw.join(rw, on=[key, "window_start", "window_end"], how="inner")


def window_join_counts(left: DataFrame, right: DataFrame, key: str, l_ts: str, r_ts: str,
                       size: str) -> DataFrame:
    """Pair counts of the window join per (key, window), from per-side counts:
    the pairs themselves are never built."""
    lc = with_window(left, l_ts, size).groupBy(key, "window_start", "window_end").agg(F.count(F.lit(1)).alias("n_left"))
    rc = with_window(right, r_ts, size).groupBy(key, "window_start", "window_end").agg(F.count(F.lit(1)).alias("n_right"))
    return (lc.join(rc, on=[key, "window_start", "window_end"], how="inner")
              .withColumn("n_pairs", F.col("n_left") * F.col("n_right")))


def window_cogroup(left: DataFrame, right: DataFrame, key: str, l_ts: str, r_ts: str, size: str,
                   left_aggs: list[Column], right_aggs: list[Column]) -> DataFrame:
    """Window co-group (JN2): one row per key and window present on either
    side, each side reduced by its aggregate list (e.g. ``count``, ``min``;
    ``sort_array(collect_list(...))`` gives the reference's lists where a
    group is known to be small).  A side with no rows has null aggregates."""
    keys = [key, "window_start", "window_end"]
    la = with_window(left, l_ts, size).groupBy(*keys).agg(*left_aggs)
    ra = with_window(right, r_ts, size).groupBy(*keys).agg(*right_aggs)
    return la.join(ra, on=keys, how="full_outer")


def interval_join(left: DataFrame, right: DataFrame, key: str, l_ts: str, r_ts: str,
                  lower: str, upper: str, bucket: str | None = None) -> DataFrame:
    """Interval join (JN3): pairs with the same key and
    ``left.ts + lower <= right.ts <= left.ts + upper`` (both ends inclusive;
    ``lower`` may be negative, e.g. '-5 seconds').

    Right rows are keyed by a time bucket; each left row is repeated for the
    (at most two, with the default width) buckets its interval touches.
    The join is then an equi-join on (key, bucket) plus a range filter, so
    one hot key is spread over its time buckets."""
    lo, hi = _us(lower), _us(upper)
    width = _us(bucket) if bucket else max(hi - lo, 1)
    l_us, r_us = ts_to_micros(l_ts), ts_to_micros(r_ts)
    lb = left.withColumn("_ij_us", l_us).withColumn(
        "_ij_b", F.explode(F.sequence(F.floor((F.col("_ij_us") + lo) / width).cast("bigint"),
                                      F.floor((F.col("_ij_us") + hi) / width).cast("bigint"))))
    rb = right.withColumn("_ij_rus", r_us).withColumn("_ij_b", F.floor(F.col("_ij_rus") / width).cast("bigint"))
    cond = [lb[key] == rb[key], lb["_ij_b"] == rb["_ij_b"],
            rb["_ij_rus"] >= lb["_ij_us"] + lo, rb["_ij_rus"] <= lb["_ij_us"] + hi]
    out = lb.join(rb, on=cond, how="inner")
    return out.select(lb[key], *[lb[c] for c in left.columns if c != key],
                      *[rb[c] for c in right.columns if c != key])


def history_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Full-history inner join (JN4): every pair with the same key, no time
    bound (the reference's list-state join emits matched pairs only)."""
    return left.join(right, on=key, how="inner")


def history_join_counts(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Pair counts of the history join per key from per-side counts."""
    lc = left.groupBy(key).agg(F.count(F.lit(1)).alias("n_left"))
    rc = right.groupBy(key).agg(F.count(F.lit(1)).alias("n_right"))
    return lc.join(rc, on=key, how="inner").withColumn("n_pairs", F.col("n_left") * F.col("n_right"))


def reconcile(app: DataFrame, third: DataFrame, key: str, app_ts: str, third_ts: str,
              wait: str) -> DataFrame:
    """Two-source reconciliation (JN5): an app record and a third-party
    record with the same id match iff ``app.ts <= third.ts <= app.ts + wait``.
    Output one ``matched`` row per match; otherwise one ``app_only`` row per
    app record and one ``third_only`` row per third-party record.
    Ids are unique per side."""
    w = _us(wait)
    a = app.select(F.col(key), F.col(app_ts).alias("app_ts"))
    t = third.select(F.col(key), F.col(third_ts).alias("third_ts"))
    j = a.join(t, on=key, how="full_outer")
    gap = ts_to_micros("third_ts") - ts_to_micros("app_ts")
    matched = F.col("app_ts").isNotNull() & F.col("third_ts").isNotNull() & (gap >= 0) & (gap <= w)
    none_ts = F.lit(None).cast(j.schema["app_ts"].dataType)
    none_tp = F.lit(None).cast(j.schema["third_ts"].dataType)
    rows = F.when(matched, F.array(F.struct(F.lit("matched").alias("status"), F.col("app_ts"), F.col("third_ts")))) \
            .otherwise(F.filter(F.array(
                F.when(F.col("app_ts").isNotNull(),
                       F.struct(F.lit("app_only").alias("status"), F.col("app_ts"), none_tp.alias("third_ts"))),
                F.when(F.col("third_ts").isNotNull(),
                       F.struct(F.lit("third_only").alias("status"), none_ts.alias("app_ts"), F.col("third_ts")))),
                lambda x: x.isNotNull()))
    return j.select(key, F.explode(rows).alias("_r")).select(key, "_r.status", "_r.app_ts", "_r.third_ts")


def match_transitions(actions: DataFrame, patterns: DataFrame, user: str, action: str, seq: str,
                      bucket: Column, patterns_rows: int | None = None) -> DataFrame:
    """Broadcast rule match (JN6, ST13): a user's previous and current
    action equal the pattern in force when the action arrives, the pattern
    in force being the latest one with a smaller ``seq`` (only the newest
    broadcast pattern is kept).  Patterns: (action1, action2, seq).

    Previous action: skew-safe ordered scan.  A pattern with seq s is in
    force for actions with seq in (s, next pattern's seq]; patterns join by
    (action1, action2) plus that range."""
    a = ordered_scan(actions, [user], [seq], bucket, recent=(1, [action]), rn=None, recent_name="_prev")
    a = a.withColumn("prev_action", F.when(F.size("_prev") == 2, F.element_at("_prev", 1)[action])).drop("_prev")
    # One task over the rule table: broadcast state, a handful of rows.
    p = patterns.select(F.col("action1"), F.col("action2"), F.col("seq").alias("_p_from"),
                        F.lead("seq").over(Window.orderBy("seq")).alias("_p_to"))
    p = broadcast_if_small(p, known_rows=patterns_rows)
    cond = [a["prev_action"] == p["action1"], a[action] == p["action2"],
            a[seq] > p["_p_from"], p["_p_to"].isNull() | (a[seq] <= p["_p_to"])]
    return a.join(p, on=cond, how="inner").select(
        a[user], a[seq], a["prev_action"].alias("action1"), a[action].alias("action2"))


def lateral_split(df: DataFrame, col: str, sep: str, keep: list[str]) -> DataFrame:
    """Lateral table-function join (JN7, UD2): one (word, length) row per
    token of ``col`` split on ``sep`` (trailing empty tokens dropped); rows
    with no tokens vanish (inner lateral join)."""
    from clickengine.functions.expressions import java_split
    parts = F.transform(java_split(F.col(col), sep), lambda w: F.struct(w.alias("word"), F.length(w).alias("length")))
    return df.select(*keep, F.explode(parts).alias("_t")).select(*keep, "_t.word", "_t.length")
