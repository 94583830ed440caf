"""Data distribution (DP1-DP7).  Thin wrappers over Spark's partitioning
operators; each one is a full shuffle except ``rescale`` down and ``gather``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def shuffle(df: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """Random redistribution (DP1)."""
    return df.repartition(n, F.rand(seed))


def rebalance(df: DataFrame, n: int) -> DataFrame:
    """Round-robin redistribution (DP2)."""
    return df.repartition(n)


def rescale(df: DataFrame, n: int, up: bool = False) -> DataFrame:
    """Local redistribution (DP3): merge partitions without a shuffle, or with
    ``up`` spread them round-robin over more.  The caller says which, as counting
    the partitions of a plan with shuffles would run them."""
    return df.repartition(n) if up else df.coalesce(n)


def broadcast_all(df: DataFrame) -> DataFrame:
    """Replicate to every task (DP4): only as the small side of a join."""
    return F.broadcast(df)


def gather(df: DataFrame) -> DataFrame:
    """Everything in one partition (DP5).  Small results only."""
    return df.coalesce(1)


def by_partition_id(df: DataFrame, expr: Column, n: int) -> DataFrame:
    """Custom partitioner (DP6): the row goes to partition ``expr``
    (``pmod`` keeps it in range for negative values)."""
    return df.repartitionById(n, F.pmod(expr, F.lit(n)).cast("int"))


def by_key(df: DataFrame, key, n: int | None = None) -> DataFrame:
    """Hash partitioning by key (DP7)."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.repartition(n, *keys) if n else df.repartition(*keys)


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Round-robin the rows over ``partitions`` tasks ahead of CPU-heavy row
    expansion, for inputs that come in fewer, such as one large unsplittable
    file.  Without a number the rows stay where the reader's split size has put them."""
    return df.repartition(partitions) if partitions else df
