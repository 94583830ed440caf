"""Aggregations (AG1-AG15, ST10/ST11 closed forms, SK5/SK7 batch forms).

Grouped aggregates use built-in functions only, so Spark runs them as a
partial (map-side) aggregate, a hash exchange of the partial rows, and a
final aggregate: a hot key costs one partial row per task, not its rows.
Nothing collects the rows of a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickengine.functions.expressions import int_div, ts_to_micros
from clickengine.operators.ordered import ordered_scan
from clickengine.operators.transforms import tokenize
from clickengine.operators.windows import _us, from_micros, window_col


def count_by(df: DataFrame, keys: list[str], name: str = "cnt", col: str | None = None) -> DataFrame:
    """Group count (AG1, AG3 final, AG7).  ``col`` counts non-null values."""
    c = F.count(F.col(col)) if col else F.count(F.lit(1))
    return df.groupBy(*keys).agg(c.alias(name))


def word_count(df: DataFrame, col: str, sep: str = " ", partitions: int | None = None) -> DataFrame:
    """Batch word count (PF3 + AG1): tokenise on one separator, count by a
    partial aggregate per task, then one exchange of (word, partial count).
    ``partitions`` spreads a text that arrives in too few (``spread``)."""
    from clickengine.operators.distribution import spread
    return count_by(tokenize(spread(df.select(col), partitions), col, sep), ["word"])


def rolling_count(df: DataFrame, key: list[str], order: list[str], bucket: Column,
                  name: str = "cnt") -> DataFrame:
    """Rolling keyed count (AG2, AG3): one updated count per input row."""
    return ordered_scan(df, key, order, bucket, rn=name)


def most_active(df: DataFrame, key: str, order: str) -> DataFrame:
    """Global reduce for the most active key (AG4), two-phase: count and last
    arrival per key (partial aggregation), then one ``max_by`` over the per-key
    rows.  A later key reaching the same maximum wins, as in the sequential
    reduce that keeps the old value only when strictly larger."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("cnt"), F.max(order).alias("_last"))
    best = F.max_by(F.struct(F.col(key), F.col("cnt")), F.struct(F.col("cnt"), F.col("_last")))
    return per_key.agg(best.alias("_b")).select(F.col(f"_b.{key}").alias(key), F.col("_b.cnt").alias("cnt"))


def max_field(df: DataFrame, key: str, field: str, order: str, keep: list[str]) -> DataFrame:
    """Keyed ``max(field)`` (AG5): the maximum of ``field``; the other fields
    stay those of the key's first row."""
    return df.groupBy(key).agg(
        *[F.min_by(c, order).alias(c) for c in keep],
        F.max(field).alias(field))


def max_row(df: DataFrame, key: str, field: str, order: str, cols: list[str]) -> DataFrame:
    """Keyed ``maxBy(field)`` (AG6): the whole row with the largest ``field``;
    on ties the earliest row."""
    best = F.max_by(F.struct(*[F.col(c) for c in cols]), F.struct(F.col(field), -F.col(order)))
    return df.groupBy(key).agg(best.alias("_r")).select(key, *[F.col(f"_r.{c}").alias(c) for c in cols])


def avg_long(df: DataFrame, keys: list, value: Column, name: str) -> DataFrame:
    """Average of a bigint with integer division, via (sum, count) (AG8)."""
    return (df.groupBy(*keys)
              .agg(F.sum(value.cast("decimal(38,0)")).alias("_s"), F.count(value).alias("_n"))
              .withColumn(name, int_div(F.col("_s"), F.col("_n"))).drop("_s", "_n"))


def window_avg_ts(df: DataFrame, key: str, ts: str, size: str) -> DataFrame:
    """Per key and tumbling window, the average event time (AG8)."""
    like = df.schema[ts].dataType
    d = df.withColumn("_w", window_col(ts, size))
    out = avg_long(d, [key, "_w"], ts_to_micros(ts), "_avg_us")
    return out.select(key, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"),
                      from_micros(F.col("_avg_us"), like).alias("avg_ts"))


def url_view_count(df: DataFrame, key: str, ts: str, size: str, slide: str | None = None,
                   offset: str | None = None) -> DataFrame:
    """Views per key and window with the window bounds (AG14, WN1-WN3).  A
    sliding window first counts per pane of one slide, then spreads the small
    pane counts over their windows."""
    if slide and not offset and _panes_fit(size, slide):
        panes = (df.where(F.col(ts).isNotNull()).groupBy(F.col(key), _pane(df, ts, slide).alias("_p"))
                   .agg(F.count(F.lit(1)).alias("_n")))
        return (panes.groupBy(F.col(key), window_col("_p", size, slide).alias("_w")).agg(F.sum("_n").alias("cnt"))
                     .select(key, "cnt", F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end")))
    return (df.groupBy(F.col(key), window_col(ts, size, slide, offset).alias("_w"))
              .agg(F.count(F.lit(1)).alias("cnt"))
              .select(key, "cnt", F.col("_w.start").alias("window_start"),
                      F.col("_w.end").alias("window_end")))


def _panes_fit(size: str, slide: str) -> bool:
    """True if windows start and end on multiples of the slide."""
    return _us(size) % _us(slide) == 0


def _pane(df: DataFrame, ts: str, slide: str) -> Column:
    """Start of the row's pane, of one slide."""
    us = ts_to_micros(ts)
    return from_micros(us - F.pmod(us, F.lit(_us(slide))), df.schema[ts].dataType)


def uv_count(df: DataFrame, user: str, ts: str, size: str, slide: str | None = None) -> DataFrame:
    """Exact distinct users per window (AG10, AG11).  Spark plans the
    distinct as (window, user) partial aggregation, then a count per window."""
    return (df.groupBy(window_col(ts, size, slide).alias("_w"))
              .agg(F.count_distinct(user).alias("uv"))
              .select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "uv"))


def pv_uv_ratio(df: DataFrame, user: str, ts: str, size: str, slide: str | None = None) -> DataFrame:
    """Page views, distinct users and their ratio per window (AG9): counted per (window, user) once,
    with partial aggregates ahead of the one large shuffle, then per window."""
    per_user = df.groupBy(window_col(ts, size, slide).alias("_w"), F.col(user)).agg(F.count(F.lit(1)).alias("_n"))
    return (per_user.groupBy("_w").agg(F.sum("_n").alias("pv"), F.count(user).alias("uv"))
              .select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"),
                      "pv", "uv", (F.col("pv") / F.col("uv")).alias("ratio")))


def tumble_reduce(df: DataFrame, key: str, ts: str, size: str) -> DataFrame:
    """Window reduce of (key, 1) pairs (AG12, PF11)."""
    ones = df.select(F.col(key), F.col(ts), F.lit(1).cast("bigint").alias("one"))
    return (ones.groupBy(key, window_col(ts, size).alias("_w"))
                .agg(F.sum("one").alias("cnt"))
                .select(key, F.col("_w.start").alias("window_start"),
                        F.col("_w.end").alias("window_end"), "cnt"))


def url_counts_ranked(df: DataFrame, key: str, ts: str, size: str, slide: str | None = None) -> DataFrame:
    """Per window, every key's count with its position in descending count
    order (ties by key) - the sorted url->count map of AG15 as rows.  The
    ranking spreads one window's keys over several tasks (``rank_all``)."""
    from clickengine.operators.topn import rank_all
    counts = url_view_count(df, key, ts, size, slide).withColumn("_neg_cnt", -F.col("cnt"))
    return rank_all(counts, ["window_start", "window_end"], ["_neg_cnt", key]).drop("_neg_cnt")


def url_counts_map(df: DataFrame, key: str, ts: str, size: str, slide: str | None = None) -> DataFrame:
    """AG15 literally: one row per window with a key->count map whose entries
    are ordered by descending count.  The map holds every distinct key of the
    window, so use it where that number is bounded; ``url_counts_ranked``
    is the row form."""
    counts = url_view_count(df, key, ts, size, slide)
    entries = F.sort_array(F.collect_list(F.struct((-F.col("cnt")).alias("neg"), F.col(key).alias("k"),
                                                   F.col("cnt").alias("v"))))
    return (counts.groupBy("window_start", "window_end")
                  .agg(entries.alias("_e"))
                  .select("window_start", "window_end",
                          F.map_from_entries(F.transform("_e", lambda e: F.struct(e["k"], e["v"]))).alias("counts")))


def changelog_count(df: DataFrame, key: list[str], order: list[str], bucket: Column) -> DataFrame:
    """Changelog of a running group count (AG13): the first row of a key is
    an insert ``+I``; every later row retracts the old count ``-U`` and adds
    the new one ``+U``.  ``pos`` orders the two rows of one input row."""
    d = ordered_scan(df, key, order, bucket, rn="_n")
    changes = F.when(F.col("_n") == 1, F.array(F.struct(F.lit("+I").alias("op"), F.col("_n").alias("cnt"),
                                                       F.lit(0).alias("pos")))) \
               .otherwise(F.array(F.struct(F.lit("-U").alias("op"), (F.col("_n") - 1).alias("cnt"), F.lit(0).alias("pos")),
                                  F.struct(F.lit("+U").alias("op"), F.col("_n").alias("cnt"), F.lit(1).alias("pos"))))
    return (d.select(*key, *order, F.explode(changes).alias("_c"))
             .select(*key, *order, "_c.op", "_c.cnt", F.col("_c.pos").cast("bigint").alias("pos")))


def apply_changelog(changes: DataFrame, key: list[str], name: str = "cnt") -> DataFrame:
    """The group counts that a changelog amounts to, whatever the order of its rows: what was put less what
    was taken back.  Groups whose rows cancel out vanish."""
    put = F.col("op").isin("+I", "+U")
    return (changes.groupBy(*key).agg(F.sum(F.when(put, F.col("cnt")).otherwise(-F.col("cnt"))).alias(name),
                                      F.sum(F.when(put, 1).otherwise(-1)).alias("_left"))
            .where(F.col("_left") > 0).drop("_left"))


def keyed_summary(df: DataFrame, key: str, order: str, url: str, ts: str) -> DataFrame:
    """Per-key state summary (ST10, ST11 closed form): reducing state keeps
    the first url and the latest time; aggregating state the count and the
    average time."""
    like = df.schema[ts].dataType
    us = ts_to_micros(ts)
    return (df.groupBy(key)
              .agg(F.min_by(url, order).alias("first_url"), F.max_by(ts, order).alias("last_ts"),
                   F.count(F.lit(1)).alias("cnt"), F.sum(us.cast("decimal(38,0)")).alias("_s"))
              .select(key, "first_url", "last_ts", "cnt",
                      from_micros(int_div(F.col("_s"), F.col("cnt")), like).alias("avg_ts")))


def latest_by_key(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """Keyed last-write-wins (SK5 batch form)."""
    return df.groupBy(key).agg(F.max_by(value, order).alias(value))


def buffered_batches(df: DataFrame, key: list[str], order: str, size: int, bucket: Column) -> DataFrame:
    """Buffered sink flushes (SK7 batch form): consecutive groups of ``size``
    rows per key in arrival order; only complete groups are flushed."""
    d = ordered_scan(df, key, [order], bucket, rn="_rn").withColumn("batch_no", int_div(F.col("_rn") - 1, size))
    return (d.groupBy(*key, "batch_no")
             .agg(F.count(F.lit(1)).alias("n_rows"), F.min(order).alias(f"first_{order}"),
                  F.max(order).alias(f"last_{order}"))
             .where(F.col("n_rows") == size))
