"""Projections, filters, row expansion and routing (PF1-PF11) and set
operations (SO1, SO2).  All are narrow transformations: no shuffle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickengine.functions.expressions import as_col, java_split


def project(df: DataFrame, cols) -> DataFrame:
    """map: keep / compute the given columns (PF1, PF11)."""
    return df.select(*[as_col(c) for c in cols])


def filter_eq(df: DataFrame, col: str, value) -> DataFrame:
    """filter by equality with a literal (PF2); pushed into the parquet scan."""
    return df.where(F.col(col) == F.lit(value))


def where_select(df: DataFrame, cond: Column, cols) -> DataFrame:
    """Table-API ``where(...).select(...)`` (PF8)."""
    return df.where(cond).select(*[as_col(c) for c in cols])


def tokenize(df: DataFrame, col: str, sep: str = " ", name: str = "word",
             keep: list[str] | None = None) -> DataFrame:
    """flatMap a line into tokens split on one separator (PF3)."""
    return df.select(*(keep or []), F.explode(java_split(F.col(col), sep)).alias(name))


def fields_as_rows(df: DataFrame, cols, name: str = "field",
                   keep: list[str] | None = None) -> DataFrame:
    """One row per field, each rendered as a string (PF4)."""
    arr = F.array(*[as_col(c).cast("string") for c in cols])
    return df.select(*(keep or []), F.explode(arr).alias(name))


def expand_by_rule(df: DataFrame, rules: list[tuple[Column, list]], name: str = "out",
                   always: list | None = None, keep: list[str] | None = None) -> DataFrame:
    """Conditional flatMap (PF5, PF6): the first rule whose condition holds
    emits its expressions (an if / else-if chain; no rule, no rows), then the
    ``always`` expressions are emitted for every row."""
    chosen = F.array().cast("array<string>")
    for cond, exprs in reversed(rules):
        chosen = F.when(cond, F.array(*[as_col(e).cast("string") for e in exprs])).otherwise(chosen)
    if always:
        chosen = F.concat(chosen, F.array(*[as_col(e).cast("string") for e in always]))
    return df.select(*(keep or []), F.explode(chosen).alias(name))


def route(df: DataFrame, routes: list[tuple[str, Column]], default: str = "other",
          name: str = "route") -> DataFrame:
    """Side-output split (PF10): tag each row with the first matching route.
    One scan; the caller filters per tag or writes all tags in one
    ``foreachBatch``."""
    tag = F.lit(default)
    for label, cond in reversed(routes):
        tag = F.when(cond, F.lit(label)).otherwise(tag)
    return df.withColumn(name, tag)


def split_routes(df: DataFrame, routes: list[tuple[str, Column]], default: str = "other",
                 name: str = "route") -> dict[str, DataFrame]:
    """The routed frame as one DataFrame per output tag."""
    tagged = route(df, routes, default, name)
    labels = [r[0] for r in routes] + [default]
    return {label: tagged.where(F.col(name) == label).drop(name) for label in labels}


def union_streams(*dfs: DataFrame) -> DataFrame:
    """Bag union of same-schema inputs (SO1).  On streams the combined
    watermark is the minimum (``spark.sql.streaming.multipleWatermarkPolicy``)."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def connect_map(left: DataFrame, right: DataFrame, left_expr: Column, right_expr: Column,
                name: str = "value") -> DataFrame:
    """Connect two differently typed inputs by mapping each to one output
    type, then union (SO2)."""
    return left.select(left_expr.alias(name)).unionByName(right.select(right_expr.alias(name)))
