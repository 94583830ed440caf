"""Windows (WN1-WN13).

Time windows use Spark's ``window``/``session_window`` expressions or plain
micro-second arithmetic, so they stay inside whole-stage codegen and group
with partial aggregation.  Row-count windows and OVER frames go through
``ordered_scan`` so a hot key is split across tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickengine.functions.expressions import int_div, ts_to_micros
from clickengine.operators.ordered import Running, ordered_scan
from clickengine.session import materialize


def _us(d: str) -> int:
    """'6 hours' / '10 seconds' / '500 milliseconds' -> micro-seconds."""
    n, unit = d.split()
    unit = unit.rstrip("s")
    mult = {"microsecond": 1, "millisecond": 1000, "second": 10**6, "minute": 60 * 10**6,
            "hour": 3600 * 10**6, "day": 86400 * 10**6}[unit]
    return int(float(n) * mult)


def from_micros(us: Column, like_type: T.DataType) -> Column:
    """Micro-seconds -> timestamp of the same kind (NTZ or LTZ) as ``like_type``."""
    ts = F.timestamp_micros(us)
    return ts.cast("timestamp_ntz") if isinstance(like_type, T.TimestampNTZType) else ts


def window_col(ts: str, size: str, slide: str | None = None, offset: str | None = None) -> Column:
    """Tumbling (slide None), sliding, or offset tumbling event-time window."""
    if offset:
        return F.window(ts, size, slide or size, offset)
    if slide:
        return F.window(ts, size, slide)
    return F.window(ts, size)


def with_window(df: DataFrame, ts: str, size: str, slide: str | None = None,
                offset: str | None = None) -> DataFrame:
    """Add ``window_start``/``window_end``; a sliding window repeats the row
    once per window containing it (WN1-WN3, WN8)."""
    return (df.withColumn("_w", window_col(ts, size, slide, offset))
              .withColumn("window_start", F.col("_w.start"))
              .withColumn("window_end", F.col("_w.end")).drop("_w"))


def tumble(df, ts, size, offset=None):
    return with_window(df, ts, size, None, offset)


def hop(df, ts, size, slide):
    return with_window(df, ts, size, slide)


def cumulate(df: DataFrame, ts: str, step: str, max_size: str) -> DataFrame:
    """Cumulating windows (WN12): windows [base, base+step), [base, base+2
    step) ... [base, base+max) with ``base`` the start of the ``max`` tumbling
    window; a row belongs to every window whose end is past it."""
    step_us, max_us = _us(step), _us(max_size)
    like = df.schema[ts].dataType
    us = ts_to_micros(ts)
    base = us - F.pmod(us, F.lit(max_us))
    first_end = base + (int_div(us - base, step_us) + 1) * step_us
    ends = F.sequence(first_end, base + max_us, F.lit(step_us))
    return (df.withColumn("_cum_base", base)
              .withColumn("_cum_end", F.explode(ends))
              .withColumn("window_start", from_micros(F.col("_cum_base"), like))
              .withColumn("window_end", from_micros(F.col("_cum_end"), like))
              .drop("_cum_base", "_cum_end"))


def cumulate_counts(df: DataFrame, keys: list[str], ts: str, step: str, max_size: str, name: str = "cnt") -> DataFrame:
    """Rows per key and cumulating window (WN12): first counted per pane of one
    step, then the small pane counts are spread over their windows."""
    us = ts_to_micros(ts)
    pane = from_micros(us - F.pmod(us, F.lit(_us(step))), df.schema[ts].dataType)
    panes = (df.where(F.col(ts).isNotNull()).groupBy(*keys, pane.alias("_pane")).agg(F.count(F.lit(1)).alias("_n")))
    return (cumulate(panes, "_pane", step, max_size).groupBy(*keys, "window_start", "window_end")
            .agg(F.sum("_n").alias(name)))


def fixed_tumble(df: DataFrame, ts: str, size: str) -> DataFrame:
    """Hand-made tumbling window (WN7): ``start = floor(t / size) * size``
    in plain arithmetic, ``end = start + size``."""
    size_us = _us(size)
    like = df.schema[ts].dataType
    us = ts_to_micros(ts)
    start = us - F.pmod(us, F.lit(size_us))
    return (df.withColumn("window_start", from_micros(start, like))
              .withColumn("window_end", from_micros(start + size_us, like)))


def session_ids(df: DataFrame, key: list[str], ts: str, order: list[str], gap: str,
                bucket: Column) -> DataFrame:
    """Assign each row its session start (WN4): a session ends when the next
    row of the key is more than ``gap`` later (windows [t, t + gap) that touch
    are merged, as in the reference library and Spark's session_window).  Two skew-safe ordered scans:
    lag -> session-start flag -> running max of the start times."""
    gap_us = _us(gap)
    d = df.withColumn("_sess_us", ts_to_micros(ts))
    d = ordered_scan(d, key, order, bucket, recent=(1, ["_sess_us"]), rn=None, recent_name="_sess_r")
    prev = F.when(F.size("_sess_r") == 2, F.element_at("_sess_r", 1)["_sess_us"])
    d = d.withColumn("_sess_new", prev.isNull() | (F.col("_sess_us") - prev > gap_us)).drop("_sess_r")
    # The second scan reads the first one's output twice (rows + bucket
    # summary): materialise it once instead of recomputing its shuffle.
    d = materialize(d)
    d = ordered_scan(d, key, order, bucket, rn=None,
                     running={"_sess_start": Running("max", F.when(F.col("_sess_new"), F.col("_sess_us")))})
    return d.drop("_sess_new")


# Gap-wide time buckets of a key that make a span.
SESSION_SPAN = 1 << 16


def session_windows(df: DataFrame, key: list[str], ts: str, order: list[str], gap: str,
                    bucket: Column | None = None, span: int = SESSION_SPAN) -> DataFrame:
    """Session windows with a count per session (WN4): (key, window_start,
    window_end, cnt), ``window_end`` = last row time + gap.

    Rows in one gap-wide time bucket are less than a gap apart, rows two buckets apart are more.  So a
    session breaks where the bucket before is empty or its last row is more than a gap away,
    and sessions follow from per-(key, bucket) first / last / count - a partial aggregate, no row-level
    shuffle.  A key's buckets are dealt over tasks by spans of ``span`` buckets; the last bucket of a
    span also goes to the next one, which needs its last row.  Only sessions that touch the
    edge of a span, at most two a span, are put together by key.  (``order`` and ``bucket`` are
    accepted for symmetry with ``session_ids``.)"""
    like = df.schema[ts].dataType
    gap_us = _us(gap)
    us = ts_to_micros(ts)
    b = (df.where(F.col(ts).isNotNull())
           .groupBy(*key, F.floor(us / F.lit(gap_us)).cast("bigint").alias("_sb"))
           .agg(F.min(us).alias("_first"), F.max(us).alias("_last"), F.count(F.lit(1)).alias("_n")))
    place = F.pmod(F.col("_sb"), F.lit(span))
    own = ((F.col("_sb") - place) / span).cast("bigint")
    b = b.withColumn("_edge", place == span - 1).withColumn("_span", F.explode(F.when(F.col("_edge"), F.array(own, own + 1)).otherwise(F.array(own))))
    b = b.withColumn("_copy", F.col("_span") != own)
    local = Window.partitionBy(*key, "_span").orderBy("_sb")
    before = F.lag("_last").over(local)
    b = b.withColumn("_start", F.when(~F.col("_copy") & (before.isNull() | (F.col("_first") - before > gap_us)), F.col("_first")))
    b = b.withColumn("_sid", F.max("_start").over(local.rowsBetween(Window.unboundedPreceding, Window.currentRow))).where(~F.col("_copy"))
    # without a start in its span a session goes on from the span before
    parts = b.groupBy(*key, "_span", "_sid").agg(F.max("_last").alias("_end"), F.sum("_n").alias("cnt"), F.max("_edge").alias("_open"))
    whole = F.col("_sid").isNotNull() & ~F.col("_open")
    chain = Window.partitionBy(*key).orderBy("_span", F.col("_sid").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edges = (parts.where(~whole).withColumn("_sid", F.max("_sid").over(chain))
                  .groupBy(*key, "_sid").agg(F.max("_end").alias("_end"), F.sum("cnt").alias("cnt")))
    return (parts.where(whole).select(*key, "_sid", "_end", "cnt").unionByName(edges)
                 .select(*key, from_micros(F.col("_sid"), like).alias("window_start"),
                         from_micros(F.col("_end") + gap_us, like).alias("window_end"), "cnt"))


def builtin_session_windows(df: DataFrame, key: list[str], ts: str, gap: str) -> DataFrame:
    """Same result with Spark's ``session_window`` (one task per key in
    batch; used by the streaming form and as a cross-check)."""
    return (df.groupBy(*key, F.session_window(ts, gap).alias("_s"))
              .agg(F.count(F.lit(1)).alias("cnt"))
              .select(*key, F.col("_s.start").alias("window_start"),
                      F.col("_s.end").alias("window_end"), "cnt"))


def count_window(df: DataFrame, key: list[str], order: list[str], size: int,
                 slide: int | None, bucket: Column, value: str) -> DataFrame:
    """Count windows (WN5): per key, a tumbling window fires every ``size``
    rows; a sliding one every ``slide`` rows over the last ``size`` rows.
    Output per firing: key, end row number, rows in window, first order value
    of the window, sum and max of ``value``."""
    every = slide or size
    first = order[0]
    d = ordered_scan(df, key, order, bucket, recent=(size - 1, [first, value]), rn="end_rn",
                     recent_name="_cw")
    d = d.where(F.pmod(F.col("end_rn"), F.lit(every)) == 0)
    if not slide:
        d = d.where(F.size("_cw") == size)
    # Nulls don't count, as in SQL; a window of nulls has a null sum.
    vals = F.filter(F.transform("_cw", lambda x: x[value]), lambda x: x.isNotNull())
    total = F.aggregate(vals, F.lit(0).cast(df.schema[value].dataType), lambda a, x: a + x)
    return d.select(*key, "end_rn",
                    F.size("_cw").cast("bigint").alias("n_rows"),
                    F.element_at("_cw", 1)[first].alias(f"first_{first}"),
                    F.when(F.size(vals) > 0, total).alias(f"sum_{value}"),
                    F.array_max(vals).alias(f"max_{value}"))


def avg_every_n(df: DataFrame, key: list[str], order: list[str], ts: str, n: int,
                bucket: Column) -> DataFrame:
    """Tumbling count window by state (WN6): every ``n`` rows of a key emit
    the average timestamp (integer micro-seconds), then start again; the
    incomplete tail emits nothing."""
    like = df.schema[ts].dataType
    d = ordered_scan(df, key, order, bucket, rn="_rn")
    d = d.withColumn("batch_no", int_div(F.col("_rn") - 1, n))
    g = (d.groupBy(*key, "batch_no")
          .agg(F.count(F.lit(1)).alias("_n"),
               F.sum(ts_to_micros(ts).cast("decimal(38,0)")).alias("_s"))
          .where(F.col("_n") == n))
    return g.select(*key, "batch_no", from_micros(int_div(F.col("_s"), n), like).alias("avg_ts"))


def over_rows_avg(df: DataFrame, key: list[str], order: list[str], value: str,
                  preceding: int, bucket: Column, name: str = "avg_value") -> DataFrame:
    """``AVG(value) OVER (PARTITION BY key ORDER BY order ROWS BETWEEN p
    PRECEDING AND CURRENT ROW)`` on a bigint, kept bigint (truncating), as
    the reference SQL engine does (WN13).  Nulls don't count; a frame of nulls
    has a null average."""
    d = ordered_scan(df, key, order, bucket, recent=(preceding, [value]), rn=None, recent_name="_orw")
    vals = F.filter(F.transform("_orw", lambda x: x[value].cast("decimal(38,0)")), lambda x: x.isNotNull())
    total = F.aggregate(vals, F.lit(0).cast("decimal(38,0)"), lambda a, x: a + x)
    return d.withColumn(name, F.when(F.size(vals) > 0, int_div(total, F.size(vals)))).drop("_orw")
