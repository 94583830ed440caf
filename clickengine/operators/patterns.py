"""Event-pattern detection (CE1-CE5) as ordered-scan compositions.

The pattern automaton of the reference library is not rebuilt.  Each
pattern the reference uses reduces to per-key context that ``ordered_scan``
computes in parallel even for a hot key:

- strict ``next`` chains / ``times(n).consecutive()``: the last n rows of the
  key (a ``recent`` array) all satisfy the step condition;
- relaxed ``followedBy`` with ``within``: a suffix minimum (descending scan)
  gives the first later ``then`` row.

Matches overlap (no skip strategy): four failures in a row give two matches
of three.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickengine.functions.expressions import ts_to_micros
from clickengine.operators.ordered import Running, ordered_scan
from clickengine.operators.windows import _us


def consecutive_n(df: DataFrame, key: list[str], order: list[str], cond: Column, n: int,
                  bucket: Column, ts: str) -> DataFrame:
    """Rows where the key's last ``n`` rows (in ``order``) all satisfy
    ``cond``: one match per such row.  Output: key, ``times`` (the n times,
    oldest first), ``first_ts``, ``last_ts``."""
    d = df.withColumn("_cn_ok", F.coalesce(cond, F.lit(False)))
    d = ordered_scan(d, key, order, bucket, recent=(n - 1, ["_cn_ok", ts]), rn=None, recent_name="_cn_r")
    all_ok = F.aggregate(F.col("_cn_r"), F.lit(True), lambda a, x: a & x["_cn_ok"])
    m = d.where((F.size("_cn_r") == n) & all_ok)
    times = F.transform("_cn_r", lambda x: x[ts])
    return m.select(*key, times.alias("times"), F.element_at(times, 1).alias("first_ts"),
                    F.element_at(times, -1).alias("last_ts"))


def strict_sequence(df: DataFrame, key: list[str], order: list[str], conds: list[Column],
                    bucket: Column, ts: str, names: list[str]) -> DataFrame:
    """A ``begin.where(c1).next(c2).next(c3)...`` pattern (CE1): the key's
    last len(conds) rows satisfy the conditions in order.  Output: key and
    one time column per step (``names``)."""
    n = len(conds)
    d = df
    for i, c in enumerate(conds):
        d = d.withColumn(f"_ss_{i}", F.coalesce(c, F.lit(False)))
    flags = [f"_ss_{i}" for i in range(n)]
    d = ordered_scan(d, key, order, bucket, recent=(n - 1, [*flags, ts]), rn=None, recent_name="_ss_r")
    ok = F.size("_ss_r") == n
    for i in range(n):
        ok = ok & F.element_at("_ss_r", i + 1)[flags[i]]
    return d.where(ok).select(*key, *[F.element_at("_ss_r", i + 1)[ts].alias(names[i]) for i in range(n)])


def fail_state_machine(df: DataFrame, key: list[str], order: list[str], event_type: str,
                       fail: str, bucket: Column, n: int = 3) -> DataFrame:
    """The explicit state machine of CE3 in arrival order: every failure
    moves one state forward, any other event type resets to the start; an
    alert fires on each failure that completes ``n`` in a row (the machine
    stays in its last state, so longer runs alert again).  Equivalently: an
    alert on every row whose last ``n`` rows are all failures.
    Output: key and order columns of the alerting rows."""
    d = df.withColumn("_fs_fail", F.coalesce(F.col(event_type) == fail, F.lit(False)))
    d = ordered_scan(d, key, order, bucket, recent=(n - 1, ["_fs_fail"]), rn=None, recent_name="_fs_r")
    all_fail = F.aggregate(F.col("_fs_r"), F.lit(True), lambda a, x: a & x["_fs_fail"])
    return d.where((F.size("_fs_r") == n) & all_fail).select(*key, *order)


def followed_within(df: DataFrame, key: list[str], order: list[str], ts: str, first: Column,
                    then: Column, within: str, bucket: Column) -> DataFrame:
    """``begin(first).followedBy(then).within(w)`` with timeout output (CE4,
    CE5): for each ``first`` row the first ``then`` row of the key after it
    (relaxed contiguity; a row never follows itself); ``matched`` if it comes strictly less than ``w``
    later, else ``timeout`` (bounded input: every pending match is flushed).
    Output: key, order columns, ``first_ts``, ``then_ts`` (null on timeout),
    ``status``."""
    w = _us(within)
    d = df.withColumn("_fw_first", F.coalesce(first, F.lit(False))) \
          .withColumn("_fw_then_us", F.when(then, ts_to_micros(ts)))
    d = d.withColumn("_fw_then_ts", F.when(then, F.col(ts)))
    d = ordered_scan(d, key, order, bucket, rn=None, descending=True,
                     running={"_fw_next_us": Running("min", F.col("_fw_then_us"), exclusive=True)})
    d = d.where(F.col("_fw_first"))
    gap = F.col("_fw_next_us") - ts_to_micros(ts)
    ok = F.col("_fw_next_us").isNotNull() & (gap < w)
    # then_ts is recovered from micros so it keeps the input time type.
    from clickengine.operators.windows import from_micros
    like = df.schema[ts].dataType
    return d.select(*key, *order, F.col(ts).alias("first_ts"),
                    F.when(ok, from_micros(F.col("_fw_next_us"), like)).alias("then_ts"),
                    F.when(ok, F.lit("matched")).otherwise(F.lit("timeout")).alias("status"))


def match_sequence(df: DataFrame, key: list[str], order: list[str], steps: list[Column], bucket: Column,
                   ts: str, contiguity: str = "strict", times: int = 1, within: str | None = None,
                   names: list[str] | None = None) -> DataFrame:
    """One entry for the patterns the reference uses:

    - ``contiguity="strict"``, several steps: ``begin.next.next...`` (CE1)
    - ``contiguity="strict"``, one step, ``times=n``: ``times(n).consecutive()`` (CE2)
    - ``contiguity="relaxed"``, two steps, ``within``: ``followedBy`` with a
      time bound and timeout output (CE4)

    Optional steps, negation, other loops and skip strategies are not used by
    the reference and not offered."""
    if contiguity == "strict" and len(steps) == 1:
        return consecutive_n(df, key, order, steps[0], times, bucket, ts)
    if contiguity == "strict":
        seq = [c for c in steps for _ in range(times)]
        return strict_sequence(df, key, order, seq, bucket, ts,
                               names or [f"step{i + 1}_ts" for i in range(len(seq))])
    if contiguity == "relaxed" and len(steps) == 2 and within:
        return followed_within(df, key, order, ts, steps[0], steps[1], within, bucket)
    raise ValueError("unsupported pattern: strict steps, strict times(n), or relaxed two steps with within")
