"""Sorting, ranking and top-N (TK1-TK5, UD4).

Per-window top-N is ``row_number() <= n`` over windows; Catalyst turns it
into a ``WindowGroupLimit`` that keeps only n rows per group *before* the
exchange, so the shuffle carries at most n rows per group and task.  The
global top-N is ``orderBy().limit()`` (``TakeOrderedAndProject``: a top-n
per task, then a merge of n rows per task).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickengine.operators.aggregates import url_view_count
from clickengine.operators.ordered import HOT_KEY_ROWS, ordered_scan
from clickengine.session import materialize


def top_n(df: DataFrame, order: list[Column], n: int, name: str = "row_num") -> DataFrame:
    """Global top-N with its position (TK3)."""
    top = df.orderBy(*order).limit(n)   # TakeOrderedAndProject: n rows per task, merged
    # numbering the n survivors needs one task, over n rows
    return top.withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("bigint"))


def rank_within(df: DataFrame, group: list[str], order: list[Column], n: int,
                name: str = "rank") -> DataFrame:
    """First ``n`` rows per group by ``order`` (ties broken by the caller's
    trailing order columns)."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= n) \
             .withColumn(name, F.col(name).cast("bigint"))


def window_top_n(df: DataFrame, key: str, ts: str, n: int, size: str, slide: str | None = None,
                 offset: str | None = None) -> DataFrame:
    """Top-N keys by count per window (TK1 keyed, TK2 all-window): count per
    (key, window), then the first n per window by count desc, key asc.
    ``n`` is honoured; a window with fewer keys returns them all."""
    counts = url_view_count(df, key, ts, size, slide, offset)
    return rank_within(counts, ["window_start", "window_end"], [F.col("cnt").desc(), F.col(key)], n)


def top_values(df: DataFrame, group: list[str], value: str, n: int) -> DataFrame:
    """Table aggregate Top-n of a value per group (TK5, UD4): rows
    (value, rank) for the n largest values, duplicates kept."""
    w = Window.partitionBy(*group).orderBy(F.col(value).desc())
    return (df.withColumn("rank", F.row_number().over(w))
              .where(F.col("rank") <= n)
              .select(*group, F.col(value).alias("value"), F.col("rank").cast("bigint").alias("rank")))


def rank_all(df: DataFrame, group: list[str], order: list[str], name: str = "rank",
             partitions: int | None = None, hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """Position of every row within its group by ascending ``order`` (a
    total order), without putting a whole group into one task: the rows are
    range-partitioned on (group, order), so one large group spans several
    range partitions; the range partition id is then monotone along the
    order and serves as the bucket of a skew-safe ordered scan.

    Range bounds are sampled anew by every execution, so the ranged rows and
    their partition ids are materialized once, before the scan reads them
    more than once."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialize(df.repartitionByRange(n, *group, *order).withColumn("_rank_pid", F.spark_partition_id()))
    return ordered_scan(ranged, group, order, F.col("_rank_pid"), rn=name, hot_rows=hot_rows,
                        quantiles=False).drop("_rank_pid")
