"""Per-key ordered scans that stay parallel when one key is hot.

Many click analyses need, for each row, something about the rows before it
*of the same key* in arrival or event-time order: a running count, a running
max, or the previous few rows (lag).  A plain ``Window.partitionBy(key)``
sends every row of a key to one task; if a key holds a third of the data that
task holds a third of the data.

In ``ordered_scan`` keys of up to ``HOT_KEY_ROWS`` rows are one window
partition each.  The *hot* keys (found by one partial count; at
most ``HOT_KEYS`` of them, the largest ones, so their list may be broadcast)
are split into order buckets, monotone with the order, in three distributed
steps:

1. local pass: ``Window.partitionBy(key, bucket)`` - row number, running
   aggregates and the last ``k`` rows inside the bucket;
2. bucket summary: one row per (key, bucket) with its count, aggregates and
   its last ``k`` rows, computed from the hot rows by partial aggregation
   (the last row as a partial ``max_by``, k > 1 rows as a partial top-k);
   a window over the *summary* gives the carry-in of every bucket: rows,
   aggregates and the ``k`` rows before it;
3. join the carry-in back on (key, bucket).

Buckets of a hot key are quantiles of its own first order column, so they
follow the key's own row rate; a caller's bucket expression serves where that
column isn't a number or a time.  Quantiles come from a sample of the key's rows
picked by a hash, in whole numbers: wherever the plan computes them, they are the same.

Building a scan starts no job: the list of hot keys is a part of the plan.  Without
hot keys, the usual case, it is empty at run time, and adaptive execution drops
the joins with it and steps 2 and 3.  ``hot_keys`` takes a list that the caller
knows.  The result equals a single window per key
(tests check it with tiny buckets).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickengine.functions.expressions import as_col, int_div, ts_to_micros

# Default bucket widths for the registered queries.  Arrival buckets bound the
# rows of one (key, bucket) partition by the width; time buckets by the event
# rate times the width.  Wide enough that cold keys add few summary rows.
ARRIVAL_BUCKET_ROWS = 1 << 20
TIME_BUCKET_SECONDS = 86_400
# Keys with more rows than this are split into order buckets.
HOT_KEY_ROWS = 1 << 20
# At most so many keys are split, the largest ones: the bound of the broadcast.
HOT_KEYS = 10_000
# Buckets of a hot key, by quantiles of its order column.
QUANTILES = 256
# Rows of a hot key that the quantiles are taken from, about.
QUANTILE_ROWS = 1 << 14

_COMBINE = {
    "sum": lambda a, b: a + b,
    "max": lambda a, b: F.greatest(a, b),
    "min": lambda a, b: F.least(a, b),
}
_AGG = {"sum": F.sum, "max": F.max, "min": F.min}


def arrival_bucket(seq, width: int = ARRIVAL_BUCKET_ROWS) -> Column:
    """Bucket of an arrival sequence number (monotone in arrival order)."""
    return int_div(as_col(seq), width)


def time_bucket(ts, seconds: int = TIME_BUCKET_SECONDS) -> Column:
    """Bucket of a timestamp column (monotone in event-time order)."""
    return F.floor(ts_to_micros(ts) / F.lit(seconds * 1_000_000)).cast("bigint")


@dataclass(frozen=True)
class Running:
    """A running aggregate from the key's first row up to the current row,
    or up to the row before it (``exclusive``)."""
    kind: str   # "sum" | "max" | "min"
    expr: Column
    exclusive: bool = False


def ordered_scan(df: DataFrame, key: list[str], order: list[str], bucket: Column,
                 running: dict[str, Running] | None = None,
                 recent: tuple[int, list[str]] | None = None,
                 rn: str | None = "rn", descending: bool = False,
                 recent_name: str = "recent", hot_rows: int | None = HOT_KEY_ROWS,
                 quantiles: bool = True, hot_keys: DataFrame | None = None) -> DataFrame:
    """Add per-key ordered columns to ``df``.

    key:        key column names (the scan restarts per key)
    order:      column names giving a total order within a key
    bucket:     expression monotone (non-decreasing) along ``order``
    running:    name -> Running(kind, expr): running aggregate
    recent:     (k, cols): array ``recent_name`` of the last k+1 rows
                (structs of ``cols``, oldest first, current row last)
    rn:         name of the 1-based row number within the key (None: skip)
    descending: scan from the last row backwards (suffix aggregates)
    hot_rows:   only keys with more rows than this are split into buckets.
                0 / None: every key is, by ``bucket``
    quantiles:  split hot keys by quantiles of ``order[0]`` where it is a
                number or a time, else (or if False) by ``bucket``
    hot_keys:   the keys to split, if the caller knows them (columns of ``key``, at most
                ``HOT_KEYS`` rows); an empty frame splits none
    """
    running = running or {}
    # Null keys are a group like any other: partition and join keys are the
    # non-nullable pair (coalesce(key, default), key is null).
    kinds = {f.name: f.dataType for f in df.schema.fields}
    pkeys, extra = [], {}
    for i, c in enumerate(key):
        extra |= {f"_oscan_k{i}": F.coalesce(F.col(c), default_value(kinds[c])), f"_oscan_n{i}": F.col(c).isNull()}
        pkeys += [f"_oscan_k{i}", f"_oscan_n{i}"]
    # Each row's value for the aggregates, under fixed names.
    extra |= {f"_oscan_v_{n}": s.expr for n, s in running.items()}
    extra[_B] = F.coalesce(bucket.cast("bigint"), F.lit(_NULL_BUCKET).cast("bigint"))
    d = df.withColumns(extra)
    scan = _Scan(pkeys, order, running, recent, rn, descending, recent_name)
    if hot_rows:
        counts = d.groupBy(*pkeys).agg(F.count(F.lit(1)).alias("_oscan_rows"))
        if hot_keys is not None:
            known = F.broadcast(hot_keys.select(*[c.alias(n) for n, c in extra.items() if n in pkeys]).distinct())
            hot = counts.join(known, pkeys, "left_semi")
        else:
            hot = counts.where(F.col("_oscan_rows") > hot_rows).orderBy(F.desc("_oscan_rows"), *pkeys).limit(HOT_KEYS)
        split = F.col(_B)
        value = _number(kinds[order[0]], order[0]) if quantiles else None
        if value is not None:
            # exact quantiles of a sample by hash: no order of merging can change them
            every = F.ceil(F.col("_oscan_rows") / F.lit(QUANTILE_ROWS))
            place = f"transform(sequence(1, {QUANTILES - 1}), i -> element_at(_oscan_s, cast(size(_oscan_s) * i div {QUANTILES} as int) + 1))"
            hot = (d.join(F.broadcast(hot), pkeys).where(F.pmod(F.xxhash64(*order), every) == 0)
                   .groupBy(*pkeys, "_oscan_rows").agg(F.sort_array(F.collect_list(value)).alias("_oscan_s"))
                   .select(*pkeys, "_oscan_rows", F.expr(f"if(size(_oscan_s) > 0, {place}, null)").alias("_oscan_q")))
            split = F.when(value.isNull() | F.col("_oscan_q").isNull(), F.col(_B)).otherwise(
                F.size(F.filter("_oscan_q", lambda b: b < value)).cast("bigint"))
        # a row per hot key, at most HOT_KEYS; rows of other keys stay in one bucket
        d = d.join(F.broadcast(hot), pkeys, "left").withColumn(_B, F.when(F.col("_oscan_rows").isNotNull(), split).otherwise(0))
    return scan.split(d, hot=bool(hot_rows)).select(*df.columns, *scan.added())


_B = "_oscan_bkt"


def _number(kind: T.DataType, name: str) -> Column | None:
    """A column as a long in the same order, if it is a time or a whole number."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return ts_to_micros(name)
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.col(name).cast("bigint")
    return None


@dataclass(frozen=True)
class _Scan:
    """What an ordered scan computes, as a plain window or split by buckets."""
    pkeys: list[str]
    order: list[str]
    running: dict[str, Running]
    recent: tuple[int, list[str]] | None
    rn: str | None
    descending: bool
    recent_name: str

    def _local(self, d: DataFrame, by: list[str], prefix: str = "") -> DataFrame:
        """Row number, running aggregates and last rows within ``by``."""
        w = Window.partitionBy(*by).orderBy(*[F.col(c).desc() if self.descending else F.col(c).asc() for c in self.order])
        out = {}
        if self.rn:
            out[prefix + self.rn] = F.row_number().over(w).cast("bigint")
        for n, s in self.running.items():
            frame = w.rowsBetween(Window.unboundedPreceding, -1 if s.exclusive else Window.currentRow)
            out[prefix + n] = _AGG[s.kind](F.col(f"_oscan_v_{n}")).over(frame)
        if self.recent:
            k, cols = self.recent
            row = F.struct(*[F.col(c) for c in cols])
            if k <= 8:
                rows = F.array(*[F.lag(row, i).over(w) for i in range(k, 0, -1)], row)
                rows = F.filter(rows, lambda x: x.isNotNull())
            else:
                rows = F.collect_list(row).over(w.rowsBetween(-k, 0))
            out[prefix + self.recent_name] = rows
        return d.withColumns(out)

    def added(self) -> list[str]:
        """The columns that the scan adds."""
        return [*([self.rn] if self.rn else []), *self.running, *([self.recent_name] if self.recent else [])]

    def split(self, rows: DataFrame, hot: bool) -> DataFrame:
        """The scan of rows with their buckets; with ``hot`` only marked keys have more than one."""
        k, cols = self.recent if self.recent else (0, [])
        pkeys, lp = self.pkeys, "_oscan_l_"
        local = self._local(rows, [*pkeys, _B], lp)
        d = rows.where(F.col("_oscan_rows").isNotNull()) if hot else rows

        # Bucket summary, one row per (key, bucket): counts and totals by
        # partial (map-side) aggregation; the last k rows by `row_number() <=
        # k`, which Catalyst plans as a partial WindowGroupLimit.
        aggs = [F.count(F.lit(1)).alias("_oscan_bcnt")]
        aggs += [_AGG[s.kind](F.col(f"_oscan_v_{n}")).alias(f"_oscan_b_{n}") for n, s in self.running.items()]
        last = F.struct(*[F.col(c) for c in self.order], F.struct(*[F.col(c) for c in cols]).alias("r")) if k else None
        if k == 1:
            pick = F.min_by if self.descending else F.max_by
            aggs.append(F.array(pick(last, F.struct(*[F.col(c) for c in self.order]))).alias("_oscan_btail"))
        summary = d.groupBy(*pkeys, _B).agg(*aggs)
        if k > 1:
            rev = [F.col(c).asc() if self.descending else F.col(c).desc() for c in self.order]
            tails = (d.withColumn("_oscan_rk", F.row_number().over(Window.partitionBy(*pkeys, _B).orderBy(*rev)))
                      .where(F.col("_oscan_rk") <= k)
                      .groupBy(*pkeys, _B)
                      .agg(F.sort_array(F.collect_list(last), asc=not self.descending).alias("_oscan_btail")))
            summary = summary.join(tails, on=[*pkeys, _B], how="inner")

        w_b = Window.partitionBy(*pkeys).orderBy(F.col(_B).desc() if self.descending else F.col(_B).asc())
        before = w_b.rowsBetween(Window.unboundedPreceding, -1)
        carry = [*pkeys, _B, F.sum("_oscan_bcnt").over(before).alias("_oscan_ccnt")]
        for n, s in self.running.items():
            carry.append(_AGG[s.kind](F.col(f"_oscan_b_{n}")).over(before).alias(f"_oscan_c_{n}"))
        if k:
            tails = F.flatten(F.collect_list("_oscan_btail").over(w_b.rowsBetween(-k, -1)))
            carry.append(F.transform(tails, lambda x: x["r"]).alias("_oscan_halo"))
        # A key's first bucket has nothing to carry in.
        carried = summary.select(*carry).where(F.col("_oscan_ccnt").isNotNull())

        out = {}
        if self.rn:
            out[self.rn] = F.col(lp + self.rn) + F.coalesce(F.col("_oscan_ccnt"), F.lit(0))
        for n, s in self.running.items():
            lv, cv = F.col(lp + n), F.col(f"_oscan_c_{n}")
            out[n] = F.when(cv.isNull(), lv).when(lv.isNull(), cv).otherwise(_COMBINE[s.kind](cv, lv))
        if k:
            mine = F.col(lp + self.recent_name)
            both = F.coalesce(F.concat(F.when(F.size(mine) <= k, F.col("_oscan_halo")), mine), mine)
            out[self.recent_name] = F.slice(both, F.greatest(F.size(both) - (k + 1), F.lit(0)) + 1, k + 1)
        elif self.recent:
            out[self.recent_name] = F.col(lp + self.recent_name)
        return local.join(carried, on=[*pkeys, _B], how="left").withColumns(out)


_NULL_BUCKET = -(1 << 63)


def default_value(dt: T.DataType) -> Column:
    """A non-null stand-in value of the key's type (paired with a null flag)."""
    if isinstance(dt, T.StringType):
        return F.lit("")
    if isinstance(dt, T.BinaryType):
        return F.lit(bytearray()).cast(dt)
    return F.lit(0).cast(dt) if not isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType)) \
        else F.lit(0).cast("timestamp").cast(dt)


def lag_of(recent: str, field: str, n: int) -> Column:
    """Value of ``field`` ``n`` rows before the current one (null if none),
    from an array built by ``ordered_scan(recent=...)``."""
    arr = F.col(recent)
    idx = F.size(arr) - 1 - n
    return F.when(idx >= 0, F.element_at(arr, idx + 1)[field])
