"""Batch closed forms of the timer / watermark programs (ST3, ST4, ST6, S3).

A bounded input ends with the watermark at +infinity in the reference
engine; these forms report what the timers and late-data split produce for
the rows seen, with the watermark equal to the largest event time so far.
The global maximum is a scalar subquery (``DataFrame.scalar``: a partial
max per task, one value broadcast into the filter); per-key and per-slice
tables are joined back by key, and AQE turns those joins into broadcast
joins at run time when their measured size is small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickengine.functions.expressions import int_div, ts_to_micros
from clickengine.operators.joins import broadcast_if_small
from clickengine.operators.windows import _us, from_micros

#: Ticks of a key that are generated as one array.
TICK_BLOCK = 4096


def event_timers(df: DataFrame, key: str, ts: str, delay: str) -> DataFrame:
    """Event-time timers (ST4): every row registers a timer at ``ts + delay``
    for its key; one timer per (key, time).  A timer fires once the
    watermark (largest event time seen) is strictly past it."""
    like = df.schema[ts].dataType
    d_us = _us(delay)
    wm = df.select(F.max(ts_to_micros(ts))).scalar()
    timers = df.select(F.col(key), (ts_to_micros(ts) + d_us).alias("_t")).distinct()
    return timers.where(F.col("_t") < wm).select(key, from_micros(F.col("_t"), like).alias("timer_ts"))


def periodic_count(df: DataFrame, key: str, ts: str, every: str) -> DataFrame:
    """Periodic running count (ST6): from a key's first event at t0, a timer
    every ``every`` reports the key's count of rows with time <= the tick;
    ticks are emitted while they are before the last event time seen.

    Closed form: tick index of a row k = max(1, ceil((t - t0) / every));
    counts per (key, k) (partial aggregation), ticks per key generated from
    the key's (t0, global max) and a running sum over the *tick* rows."""
    like = df.schema[ts].dataType
    p = _us(every)
    us = ts_to_micros(ts)
    wm = df.select(F.max(us)).scalar()
    first = df.groupBy(key).agg(F.min(us).alias("_t0"))
    # One row per key, known only after the aggregate: AQE broadcasts it at
    # run time when its measured size is small, else keeps a shuffle join on
    # the key and splits a skewed key's partition (skew-join handling).
    rows = df.select(F.col(key), us.alias("_us")).join(first, on=key)
    k = F.greatest(F.lit(1), F.ceil((F.col("_us") - F.col("_t0")) / F.lit(p)).cast("bigint"))
    per_tick = rows.groupBy(key, k.alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    n_ticks = int_div(wm - F.col("_t0") - 1, p)
    # In two steps, so that no array holds all ticks of a long span: blocks first, then their ticks.
    blocks = F.sequence(F.lit(0).cast("bigint"), int_div(n_ticks - 1, TICK_BLOCK))
    ticks = (first.where(n_ticks >= 1).select(key, "_t0", n_ticks.alias("_n_ticks"), F.explode(blocks).alias("_tb"))
                  .select(key, "_t0", F.explode(F.sequence(F.col("_tb") * TICK_BLOCK + 1,
                                                           F.least((F.col("_tb") + 1) * TICK_BLOCK, F.col("_n_ticks")))).alias("_k")))
    # the running sum runs over tick rows (time span / period per key), not
    # over the key's events
    w = Window.partitionBy(key).orderBy("_k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (ticks.join(per_tick, on=[key, "_k"], how="left")
                 .withColumn("cnt", F.sum(F.coalesce(F.col("_n"), F.lit(0))).over(w))
                 .select(key, from_micros(F.col("_t0") + F.col("_k") * p, like).alias("tick_ts"), "cnt"))


def split_late(df: DataFrame, slice_col: str, ts: str, size: str, delay: str, lateness: str,
               lag_slices: int = 1, watermark: str | None = None, max_slices: int = 1_000_000) -> DataFrame:
    """Late-data split (ST3, S3).  Rows arrive in slices (micro-batches); the
    watermark at slice i is max(ts over slices <= i - lag_slices) - delay.
    A row is too late for its tumbling window of ``size`` iff
    window end + allowed lateness <= that watermark.  Adds ``window_start``,
    ``window_end`` and ``is_late``.  ``lag_slices=2`` predicts what Spark's
    built-in streaming drop does (its late filter lags one more batch).
    ``watermark`` names a column for the watermark each row was judged by (ST16).

    The slice table has a row per micro-batch.  It goes to every task if it has
    at most ``max_slices`` rows, which is checked; beyond, the events are joined
    with it on the slice."""
    like = df.schema[ts].dataType
    size_us, delay_us, late_us = _us(size), _us(delay), _us(lateness)
    us = ts_to_micros(ts)
    per_slice = df.groupBy(slice_col).agg(F.max(us).alias("_smax"))
    # One task over the per-slice table: one row per micro-batch, not per event.
    w = Window.orderBy(slice_col).rowsBetween(Window.unboundedPreceding, -lag_slices)
    wm = per_slice.select(slice_col, (F.max("_smax").over(w) - delay_us).alias("_wm"))
    start = us - F.pmod(us, F.lit(size_us))
    d = df.withColumn("_ws", start).join(broadcast_if_small(wm, max_slices), on=slice_col, how="left")
    late = F.coalesce(F.col("_ws") + size_us + late_us <= F.col("_wm"), F.lit(False))
    return (d.withColumn("window_start", from_micros(F.col("_ws"), like))
             .withColumn("window_end", from_micros(F.col("_ws") + size_us, like))
             .withColumn("is_late", late)
             .withColumns({watermark: from_micros(F.col("_wm"), like)} if watermark else {}).drop("_ws", "_wm"))
