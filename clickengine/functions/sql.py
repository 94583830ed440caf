"""SQL registration of the user-defined functions (UD1-UD3, UD5).

The functions are SQL-bodied (``CREATE TEMPORARY FUNCTION ... RETURN``), so
they inline into the plan as ordinary Catalyst expressions: whole-stage
codegen stays intact and no Python worker is involved.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

_FUNCTIONS = [
    # UD1: 32-bit String.hashCode, folded in [0, 2^32) then made signed.
    """CREATE OR REPLACE TEMPORARY FUNCTION my_hash(s STRING) RETURNS INT RETURN
       CAST(pmod(aggregate(
                CASE WHEN s = '' THEN CAST(array() AS ARRAY<BIGINT>)
                     ELSE transform(split(s, ''), c -> CAST(ascii(c) AS BIGINT)) END,
                CAST(0 AS BIGINT), (a, x) -> pmod(a * 31 + x, 4294967296))
            + 2147483648, 4294967296) - 2147483648 AS INT)""",
    # UD2: split a url on '?' into (word, length) rows; trailing empty parts dropped.
    """CREATE OR REPLACE TEMPORARY FUNCTION my_split(s STRING)
       RETURNS TABLE (word STRING, length INT) RETURN
       SELECT w, length(w) FROM (SELECT explode(
           CASE WHEN s = '' THEN array('')
                WHEN regexp_replace(s, '[?]+\\\\z', '') = '' THEN CAST(array() AS ARRAY<STRING>)
                ELSE split(regexp_replace(s, '[?]+\\\\z', ''), '[?]') END) AS w)""",
]


def register_functions(spark: SparkSession) -> None:
    """Register the SQL functions on ``spark`` (idempotent)."""
    for stmt in _FUNCTIONS:
        spark.sql(stmt)
