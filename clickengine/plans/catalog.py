"""Named queries over the driver tables, each with an equivalent SQL oracle.

Every query reads whole tables (no id subsets, prefixes or row caps) and
returns a DataFrame whose column names equal the oracle's.  Mapping of the
click model onto ``events`` (see SURVEY 7.3): user -> ``user_id``, url ->
``event_type``, arrival order -> ``event_id``, event time -> ``ts``.  The
reference's second-scale windows are scaled to the table's minutes-apart
events: 10 s -> 6 h, 5 s -> 3 h, 2 s -> 1 h; per-user windows use 2 days.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickengine.functions import (event_text, int_div, java_hash, java_split, register_functions,
                                   seconds_ts, ts_to_micros, ts_to_millis)
from clickengine.operators import aggregates as AG
from clickengine.operators import joins as JN
from clickengine.operators import patterns as CE
from clickengine.operators import timers as TM
from clickengine.operators import topn as TK
from clickengine.operators import transforms as PF
from clickengine.operators import windows as WN
from clickengine.operators.ordered import arrival_bucket, time_bucket
from clickengine.sources import load_table, parse_click_lines, register_view

QueryFn = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, QueryFn] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql.strip()
        return fn
    return deco


def queries() -> dict[str, QueryFn]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _ev(spark: SparkSession, d: str) -> DataFrame:
    return load_table(spark, d, "events")


def _ms(ts="ts"):
    return ts_to_millis(ts)


# SQL fragments (DuckDB) -------------------------------------------------------
def _tb(size: str, col: str = "ts", origin: str = "1970-01-01") -> str:
    return f"time_bucket(INTERVAL '{size}', {col}, TIMESTAMP '{origin}')"


EPOCH = "TIMESTAMP '1970-01-01'"
H = 3_600_000_000  # one hour in micro-seconds

# ============================================================ AG14 / WN1 (flagship)

@query("url_view_count", f"""
SELECT event_type, count(*) AS cnt, ws AS window_start, ws + INTERVAL '6 hours' AS window_end
FROM (SELECT event_type, {_tb('6 hours')} AS ws FROM events) GROUP BY event_type, ws""")
def q_url_view_count(spark, d):
    return AG.url_view_count(_ev(spark, d), "event_type", "ts", "6 hours")


@query("tumble_offset", f"""
SELECT event_type, count(*) AS cnt, ws AS window_start, ws + INTERVAL '6 hours' AS window_end
FROM (SELECT event_type, {_tb('6 hours', 'ts', '1970-01-01 03:00:00')} AS ws FROM events)
GROUP BY event_type, ws""")
def q_tumble_offset(spark, d):
    return AG.url_view_count(_ev(spark, d), "event_type", "ts", "6 hours", offset="3 hours")


def _sliding_sql(size_h: int, slide_h: int, cols: str) -> str:
    n = size_h // slide_h
    return (f"SELECT {cols}, {_tb(f'{slide_h} hours')} - to_hours((k * {slide_h})::BIGINT) AS ws "
            f"FROM events, range(0, {n}) t(k)")


@query("pv_uv_ratio", f"""
SELECT ws AS window_start, ws + INTERVAL '6 hours' AS window_end, count(*) AS pv,
       count(DISTINCT user_id) AS uv, count(*) / count(DISTINCT user_id) AS ratio
FROM ({_sliding_sql(6, 1, 'user_id')}) GROUP BY ws""")
def q_pv_uv_ratio(spark, d):
    return AG.pv_uv_ratio(_ev(spark, d), "user_id", "ts", "6 hours", "1 hour")


@query("uv_count", f"""
SELECT ws AS window_start, ws + INTERVAL '6 hours' AS window_end, count(DISTINCT user_id) AS uv
FROM (SELECT user_id, {_tb('6 hours')} AS ws FROM events) GROUP BY ws""")
def q_uv_count(spark, d):
    return AG.uv_count(_ev(spark, d), "user_id", "ts", "6 hours")


@query("tumble_reduce", f"""
SELECT user_id, ws AS window_start, ws + INTERVAL '2 days' AS window_end, sum(1)::BIGINT AS cnt
FROM (SELECT user_id, {_tb('2 days')} AS ws FROM events) GROUP BY user_id, ws""")
def q_tumble_reduce(spark, d):
    return AG.tumble_reduce(_ev(spark, d), "user_id", "ts", "2 days")


@query("window_avg_ts", f"""
SELECT user_id, ws AS window_start, ws + INTERVAL '2 days' AS window_end,
       make_timestamp((sum(epoch_us(ts)) // count(*))::BIGINT) AS avg_ts
FROM (SELECT user_id, ts, {_tb('2 days')} AS ws FROM events) GROUP BY user_id, ws""")
def q_window_avg_ts(spark, d):
    return AG.window_avg_ts(_ev(spark, d), "user_id", "ts", "2 days")


@query("window_url_counts", f"""
SELECT window_start, window_end, event_type, cnt,
       row_number() OVER (PARTITION BY window_start ORDER BY cnt DESC, event_type) AS rank
FROM (SELECT ws AS window_start, ws + INTERVAL '6 hours' AS window_end, event_type, count(*) AS cnt
      FROM ({_sliding_sql(6, 3, 'event_type')}) GROUP BY ws, event_type)""")
def q_window_url_counts(spark, d):
    return AG.url_counts_ranked(_ev(spark, d), "event_type", "ts", "6 hours", "3 hours")


# ============================================================ AG1-AG7, AG13, ST10/11, SK5-SK7

_JAVA_SPLIT_SQL = """CASE WHEN text = '' THEN ['']
            WHEN regexp_replace(text, ' +\\z', '') = '' THEN []::VARCHAR[]
            ELSE string_split(regexp_replace(text, ' +\\z', ''), ' ') END"""


@query("word_count", f"""
SELECT word, count(*) AS cnt FROM (SELECT unnest({_JAVA_SPLIT_SQL}) AS word FROM documents)
GROUP BY word""")
def q_word_count(spark, d):
    docs, cores = load_table(spark, d, "documents"), spark.sparkContext.defaultParallelism
    # a table of fewer files than cores (one row group each, here) is spread ahead of the tokenising
    return AG.word_count(docs, "text", partitions=cores if len(docs.inputFiles()) < cores else None)


@query("rolling_count", """
SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS cnt
FROM events""")
def q_rolling_count(spark, d):
    e = _ev(spark, d).select("event_id", "event_type")
    return AG.rolling_count(e, ["event_type"], ["event_id"], arrival_bucket("event_id"))


@query("reduce_count", "SELECT user_id, count(*) AS cnt FROM events GROUP BY user_id")
def q_reduce_count(spark, d):
    return AG.count_by(_ev(spark, d), ["user_id"])


@query("most_active_user", """
SELECT user_id, cnt FROM (SELECT user_id, count(*) AS cnt, max(event_id) AS last FROM events GROUP BY user_id)
ORDER BY cnt DESC, last DESC LIMIT 1""")
def q_most_active_user(spark, d):
    return AG.most_active(_ev(spark, d), "user_id", "event_id")


@query("max_field", """
SELECT user_id, arg_min(event_type, event_id) AS event_type, max(ts) AS ts FROM events GROUP BY user_id""")
def q_max_field(spark, d):
    return AG.max_field(_ev(spark, d), "user_id", "ts", "event_id", ["event_type"])


@query("max_by_row", """
SELECT user_id, event_id, event_type, ts FROM (
  SELECT user_id, event_id, event_type, ts,
         row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS r FROM events) WHERE r = 1""")
def q_max_by_row(spark, d):
    return AG.max_row(_ev(spark, d), "user_id", "ts", "event_id", ["event_id", "event_type", "ts"])


@query("group_count", """
SELECT user_id AS user_name, count(event_type) AS cnt FROM events GROUP BY user_id""")
def q_group_count(spark, d):
    _clicks_view(spark, d)
    return spark.sql("SELECT user_name, COUNT(url) AS cnt FROM clicks GROUP BY user_name")


def _clicks_view(spark, d):
    """The click table of the SQL programs: (user_name, url, ts ms, et)."""
    e = _ev(spark, d).select(F.col("user_id").alias("user_name"), F.col("event_type").alias("url"),
                             _ms().alias("ts"), "event_id")
    e = e.withColumn("et", seconds_ts(F.col("ts")).cast("timestamp_ntz"))
    e.createOrReplaceTempView("clicks")
    return e


@query("changelog_count", """
WITH r AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events)
SELECT user_id, event_id, '+I' AS op, n AS cnt, 0::BIGINT AS pos FROM r WHERE n = 1
UNION ALL SELECT user_id, event_id, '-U', n - 1, 0::BIGINT FROM r WHERE n > 1
UNION ALL SELECT user_id, event_id, '+U', n, 1::BIGINT FROM r WHERE n > 1""")
def q_changelog_count(spark, d):
    e = _ev(spark, d).select("user_id", "event_id")
    return AG.changelog_count(e, ["user_id"], ["event_id"], arrival_bucket("event_id"))


@query("keyed_state_summary", """
SELECT user_id, arg_min(event_type, event_id) AS first_url, arg_max(ts, event_id) AS last_ts,
       count(*) AS cnt, make_timestamp((sum(epoch_us(ts)) // count(*))::BIGINT) AS avg_ts
FROM events GROUP BY user_id""")
def q_keyed_state_summary(spark, d):
    return AG.keyed_summary(_ev(spark, d), "user_id", "event_id", "event_type", "ts")


@query("latest_by_key", "SELECT user_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id")
def q_latest_by_key(spark, d):
    return AG.latest_by_key(_ev(spark, d), "user_id", "event_type", "event_id")


@query("json_documents", """
SELECT event_id, 'clicks' AS index_name, '{"' || user_id || '":"' || event_type || '"}' AS doc FROM events""")
def q_json_documents(spark, d):
    from clickengine.sinks.writers import as_documents
    return as_documents(_ev(spark, d), "user_id", "event_type", "clicks", keep=["event_id"])


@query("buffered_batches", """
SELECT user_id, batch_no, count(*) AS n_rows, min(event_id) AS first_event_id, max(event_id) AS last_event_id
FROM (SELECT user_id, event_id, (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 10 AS batch_no
      FROM events) GROUP BY user_id, batch_no HAVING count(*) = 10""")
def q_buffered_batches(spark, d):
    e = _ev(spark, d).select("user_id", "event_id")
    return AG.buffered_batches(e, ["user_id"], "event_id", 10, arrival_bucket("event_id"))


# ============================================================ WN4-WN7, WN9-WN13

@query("session_count", f"""
WITH a AS (SELECT user_id, ts, event_id,
             CASE WHEN lag(ts) OVER w IS NULL OR epoch_us(ts) - epoch_us(lag(ts) OVER w) > {H} THEN 1 ELSE 0 END AS s
           FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
b AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid FROM a)
SELECT user_id, min(ts) AS window_start, max(ts) + INTERVAL '1 hour' AS window_end, count(*) AS cnt
FROM b GROUP BY user_id, sid""")
def q_session_count(spark, d):
    e = _ev(spark, d).select("user_id", "ts", "event_id")
    return WN.session_windows(e, ["user_id"], "ts", ["ts", "event_id"], "1 hour", time_bucket("ts"))


@query("count_window", """
WITH a AS (SELECT user_id, event_id, CAST(round(value * 100) AS BIGINT) AS cents,
             row_number() OVER w AS end_rn, count(*) OVER w10 AS n_rows, first_value(event_id) OVER w10 AS first_event_id,
             sum(CAST(round(value * 100) AS BIGINT)) OVER w10 AS sum_cents, max(CAST(round(value * 100) AS BIGINT)) OVER w10 AS max_cents
           FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id),
                              w10 AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))
SELECT user_id, end_rn, n_rows, first_event_id, sum_cents::BIGINT AS sum_cents, max_cents FROM a WHERE end_rn % 2 = 0""")
def q_count_window(spark, d):
    e = _ev(spark, d).select("user_id", "event_id", F.round(F.col("value") * 100).cast("bigint").alias("cents"))
    return WN.count_window(e, ["user_id"], ["event_id"], 10, 2, arrival_bucket("event_id"), "cents")


@query("avg_ts_every_n", """
SELECT user_id, batch_no, make_timestamp((sum(epoch_us(ts)) // 5)::BIGINT) AS avg_ts
FROM (SELECT user_id, ts, (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 5 AS batch_no FROM events)
GROUP BY user_id, batch_no HAVING count(*) = 5""")
def q_avg_ts_every_n(spark, d):
    e = _ev(spark, d).select("user_id", "event_id", "ts")
    return WN.avg_every_n(e, ["user_id"], ["event_id"], "ts", 5, arrival_bucket("event_id"))


@query("fake_window", f"""
SELECT event_type, ws AS window_start, ws + INTERVAL '6 hours' AS window_end, count(*) AS cnt
FROM (SELECT event_type, make_timestamp(epoch_us(ts) - epoch_us(ts) % {6 * H}) AS ws FROM events)
GROUP BY event_type, ws""")
def q_fake_window(spark, d):
    e = WN.fixed_tumble(_ev(spark, d), "ts", "6 hours")
    return e.groupBy("event_type", "window_start", "window_end").agg(F.count(F.lit(1)).alias("cnt"))


_ET_SQL = "make_timestamp(((epoch_us(ts) // 1000) // 1000) * 1000000)"


@query("sql_tumble", f"""
SELECT user_id AS user_name, ws + INTERVAL '6 hours' AS window_end, count(event_type) AS cnt
FROM (SELECT user_id, event_type, {_tb('6 hours', _ET_SQL)} AS ws FROM events) GROUP BY user_id, ws""")
def q_sql_tumble(spark, d):
    _clicks_view(spark, d)
    return spark.sql("""
        SELECT user_name, window.end AS window_end, COUNT(url) AS cnt
        FROM clicks GROUP BY user_name, window(et, '6 hours')""")


@query("sql_hop", f"""
SELECT user_id AS user_name, ws AS window_start, ws + INTERVAL '6 hours' AS window_end, count(event_type) AS cnt
FROM (SELECT user_id, event_type, {_tb('3 hours', _ET_SQL)} - to_hours((k * 3)::BIGINT) AS ws
      FROM events, range(0, 2) t(k)) GROUP BY user_id, ws""")
def q_sql_hop(spark, d):
    _clicks_view(spark, d)
    return spark.sql("""
        SELECT user_name, window.start AS window_start, window.end AS window_end, SUM(n) AS cnt
        FROM (SELECT user_name, window.start AS pane, COUNT(url) AS n
              FROM clicks GROUP BY user_name, window(et, '3 hours'))
        GROUP BY user_name, window(pane, '6 hours', '3 hours')""")


@query("sql_cumulate", f"""
SELECT user_id AS user_name, ws AS window_start, ws + to_hours((k * 3)::BIGINT) AS window_end, count(*) AS cnt
FROM (SELECT user_id, et, {_tb('6 hours', 'et')} AS ws FROM (SELECT user_id, {_ET_SQL} AS et FROM events)),
     range(1, 3) t(k)
WHERE et < ws + to_hours((k * 3)::BIGINT) GROUP BY user_id, ws, k""")
def q_sql_cumulate(spark, d):
    c = _clicks_view(spark, d)
    return WN.cumulate_counts(c, ["user_name"], "et", "3 hours", "6 hours")


@query("over_rows_avg", """
SELECT event_id, user_id, (sum((epoch_us(ts) // 1000)) OVER w // count(*) OVER w)::BIGINT AS avg_ms
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)""")
def q_over_rows_avg(spark, d):
    e = _ev(spark, d).select("event_id", "user_id", "ts", _ms().alias("ms"))
    out = WN.over_rows_avg(e, ["user_id"], ["ts", "event_id"], "ms", 3, time_bucket("ts"), name="avg_ms")
    return out.select("event_id", "user_id", "avg_ms")


# ============================================================ TK1-TK5

@query("window_topn_url", f"""
SELECT * FROM (
  SELECT ws AS window_start, ws + INTERVAL '6 hours' AS window_end, event_type, count(*) AS cnt,
         row_number() OVER (PARTITION BY ws ORDER BY count(*) DESC, event_type) AS rank
  FROM (SELECT event_type, {_tb('6 hours', 'ts', '1970-01-01 03:00:00')} AS ws FROM events)
  GROUP BY ws, event_type) WHERE rank <= 2""")
def q_window_topn_url(spark, d):
    return TK.window_top_n(_ev(spark, d), "event_type", "ts", 2, "6 hours", offset="3 hours")


@query("window_topn_sliding", f"""
SELECT * FROM (
  SELECT ws AS window_start, ws + INTERVAL '6 hours' AS window_end, event_type, count(*) AS cnt,
         row_number() OVER (PARTITION BY ws ORDER BY count(*) DESC, event_type) AS rank
  FROM ({_sliding_sql(6, 3, 'event_type')}) GROUP BY ws, event_type) WHERE rank <= 2""")
def q_window_topn_sliding(spark, d):
    return TK.window_top_n(_ev(spark, d), "event_type", "ts", 2, "6 hours", slide="3 hours")


@query("sql_topn", """
SELECT user_id, cnt, row_number() OVER (ORDER BY cnt DESC, user_id) AS row_num
FROM (SELECT user_id, count(*) AS cnt FROM events GROUP BY user_id) ORDER BY cnt DESC, user_id LIMIT 2""")
def q_sql_topn(spark, d):
    counts = AG.count_by(_ev(spark, d), ["user_id"])
    return TK.top_n(counts, [F.col("cnt").desc(), F.col("user_id")], 2)


@query("sql_window_topn", f"""
SELECT * FROM (
  SELECT ws AS window_start, ws + INTERVAL '6 hours' AS window_end, user_id AS user_name, count(event_type) AS cnt,
         row_number() OVER (PARTITION BY ws ORDER BY count(event_type) DESC, user_id) AS row_num
  FROM (SELECT user_id, event_type, {_tb('6 hours', _ET_SQL)} AS ws FROM events) GROUP BY ws, user_id)
WHERE row_num <= 2""")
def q_sql_window_topn(spark, d):
    _clicks_view(spark, d)
    return spark.sql("""
        SELECT window_start, window_end, user_name, cnt, CAST(row_num AS BIGINT) AS row_num FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY window_start, window_end ORDER BY cnt DESC, user_name) AS row_num
          FROM (SELECT window.start AS window_start, window.end AS window_end, user_name, COUNT(url) AS cnt
                FROM clicks GROUP BY user_name, window(et, '6 hours')))
        WHERE row_num <= 2""")


@query("table_agg_top2", f"""
SELECT window_end, value, rank FROM (
  SELECT ws + INTERVAL '6 hours' AS window_end, count(*) AS value,
         row_number() OVER (PARTITION BY ws ORDER BY count(*) DESC) AS rank
  FROM (SELECT user_id, {_tb('6 hours', _ET_SQL)} AS ws FROM events) GROUP BY ws, user_id) WHERE rank <= 2""")
def q_table_agg_top2(spark, d):
    _clicks_view(spark, d)
    counts = spark.sql("""SELECT window.end AS window_end, COUNT(*) AS cnt
                          FROM clicks GROUP BY user_name, window(et, '6 hours')""")
    return TK.top_values(counts, ["window_end"], "cnt", 2)


# ============================================================ JN1-JN7

def _side(spark, d, etype, prefix):
    e = _ev(spark, d).where(F.col("event_type") == etype)
    return e.select("user_id", F.col("event_id").alias(f"{prefix}_event_id"), F.col("ts").alias(f"{prefix}_ts"))


def _day_sides_sql(cols="l.user_id, l.ws"):
    return f"""(SELECT user_id, event_id, {_tb('1 day')} AS ws FROM events WHERE event_type = 'view') l
  JOIN (SELECT user_id, event_id, {_tb('1 day')} AS ws FROM events WHERE event_type = 'click') r
  ON l.user_id = r.user_id AND l.ws = r.ws"""


@query("window_join", f"""
SELECT l.user_id, l.ws AS window_start, l.ws + INTERVAL '1 day' AS window_end,
       count(DISTINCT l.event_id) AS n_left, count(DISTINCT r.event_id) AS n_right, count(*) AS n_pairs
FROM {_day_sides_sql()} GROUP BY l.user_id, l.ws""")
def q_window_join(spark, d):
    return JN.window_join_counts(_side(spark, d, "view", "l"), _side(spark, d, "click", "r"),
                                 "user_id", "l_ts", "r_ts", "1 day")


@query("window_join_pairs", f"""
SELECT l.user_id, l.ws AS window_start, l.ws + INTERVAL '1 day' AS window_end, l.event_id AS l_id, r.event_id AS r_id
FROM {_day_sides_sql()}""")
def q_window_join_pairs(spark, d):
    """The pairs themselves: as many as a day of one user holds."""
    pairs = JN.window_join(_side(spark, d, "view", "l"), _side(spark, d, "click", "r"), "user_id", "l_ts", "r_ts", "1 day")
    return pairs.select("user_id", "window_start", "window_end", F.col("l_event_id").alias("l_id"),
                        F.col("r_event_id").alias("r_id"))


@query("window_cogroup", f"""
WITH l AS (SELECT user_id, {_tb('1 day')} AS ws, count(*) AS n_left, min(ts) AS first_left_ts
           FROM events WHERE event_type = 'view' GROUP BY 1, 2),
     r AS (SELECT user_id, {_tb('1 day')} AS ws, count(*) AS n_right, min(ts) AS first_right_ts
           FROM events WHERE event_type = 'click' GROUP BY 1, 2)
SELECT coalesce(l.user_id, r.user_id) AS user_id, coalesce(l.ws, r.ws) AS window_start,
       coalesce(l.ws, r.ws) + INTERVAL '1 day' AS window_end,
       coalesce(n_left, 0) AS n_left, coalesce(n_right, 0) AS n_right, first_left_ts, first_right_ts
FROM l FULL OUTER JOIN r ON l.user_id = r.user_id AND l.ws = r.ws""")
def q_window_cogroup(spark, d):
    out = JN.window_cogroup(_side(spark, d, "view", "l"), _side(spark, d, "click", "r"), "user_id",
                            "l_ts", "r_ts", "1 day",
                            [F.count(F.lit(1)).alias("n_left"), F.min("l_ts").alias("first_left_ts")],
                            [F.count(F.lit(1)).alias("n_right"), F.min("r_ts").alias("first_right_ts")])
    return out.select("user_id", "window_start", "window_end",
                      F.coalesce("n_left", F.lit(0)).alias("n_left"), F.coalesce("n_right", F.lit(0)).alias("n_right"),
                      "first_left_ts", "first_right_ts")


@query("interval_join", f"""
SELECT l.user_id, l.event_id AS l_event_id, l.ts AS l_ts, r.event_id AS r_event_id, r.ts AS r_ts
FROM events l JOIN events r ON l.user_id = r.user_id
 AND epoch_us(r.ts) BETWEEN epoch_us(l.ts) - {5 * H} AND epoch_us(l.ts) + {10 * H}
WHERE l.event_type = 'purchase' AND r.event_type = 'click'""")
def q_interval_join(spark, d):
    return JN.interval_join(_side(spark, d, "purchase", "l"), _side(spark, d, "click", "r"),
                            "user_id", "l_ts", "r_ts", "-5 hours", "10 hours")


@query("history_join", """
SELECT l.user_id, count(DISTINCT l.event_id) AS n_left, count(DISTINCT r.event_id) AS n_right, count(*) AS n_pairs
FROM events l JOIN events r ON l.user_id = r.user_id
WHERE l.event_type = 'signup' AND r.event_type = 'purchase' GROUP BY l.user_id""")
def q_history_join(spark, d):
    return JN.history_join_counts(_side(spark, d, "signup", "l"), _side(spark, d, "purchase", "r"), "user_id")


@query("bill_check", """
WITH a AS (SELECT o_orderkey AS order_id, o_orderdate AS app_ts FROM orders),
     t AS (SELECT l_orderkey AS order_id, min(l_shipdate) AS third_ts FROM lineitem GROUP BY l_orderkey),
     j AS (SELECT coalesce(a.order_id, t.order_id) AS order_id, app_ts, third_ts,
                  app_ts IS NOT NULL AND third_ts IS NOT NULL AND third_ts >= app_ts
                  AND third_ts <= app_ts + INTERVAL '365 days' AS ok
           FROM a FULL OUTER JOIN t ON a.order_id = t.order_id)
SELECT order_id, 'matched' AS status, app_ts, third_ts FROM j WHERE ok
UNION ALL SELECT order_id, 'app_only', app_ts, NULL FROM j WHERE NOT ok AND app_ts IS NOT NULL
UNION ALL SELECT order_id, 'third_only', NULL, third_ts FROM j WHERE NOT ok AND third_ts IS NOT NULL""")
def q_bill_check(spark, d):
    app = load_table(spark, d, "orders").select(F.col("o_orderkey").alias("order_id"), "o_orderdate")
    third = (load_table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("order_id"))
             .agg(F.min("l_shipdate").alias("l_shipdate")))
    return JN.reconcile(app, third, "order_id", "o_orderdate", "l_shipdate", "365 days")


def _patterns(spark, d):
    """Rule table of the broadcast-state program, built from the events:
    view->click in force from the start, click->purchase from the middle
    arrival id on.  Two rows: a proven-small broadcast side."""
    mid = int_div(_ev(spark, d).select(F.max("event_id")).scalar(), 2)
    rules = spark.range(2).select(
        F.when(F.col("id") == 0, "view").otherwise("click").alias("action1"),
        F.when(F.col("id") == 0, "click").otherwise("purchase").alias("action2"),
        F.when(F.col("id") == 0, F.lit(-1).cast("bigint")).otherwise(mid).alias("seq"))
    return rules


@query("behavior_pattern", """
WITH a AS (SELECT user_id, event_id, event_type,
                  lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS prev FROM events),
     mid AS (SELECT max(event_id) // 2 AS m FROM events)
SELECT user_id, event_id, prev AS action1, event_type AS action2 FROM a, mid
WHERE (event_id > -1 AND event_id <= mid.m AND prev = 'view' AND event_type = 'click')
   OR (event_id > mid.m AND prev = 'click' AND event_type = 'purchase')""")
def q_behavior_pattern(spark, d):
    actions = _ev(spark, d).select("user_id", "event_id", "event_type")
    return JN.match_transitions(actions, _patterns(spark, d), "user_id", "event_type", "event_id",
                                arrival_bucket("event_id"), patterns_rows=2)


@query("udtf_split", """
SELECT page_id, word, length(word)::INTEGER AS length FROM (
  SELECT page_id, unnest(CASE WHEN url = '' THEN ['']
                              WHEN regexp_replace(url, '[?]+\\z', '') = '' THEN []::VARCHAR[]
                              ELSE string_split(regexp_replace(url, '[?]+\\z', ''), '?') END) AS word
  FROM pages)""")
def q_udtf_split(spark, d):
    register_functions(spark)
    load_table(spark, d, "pages").createOrReplaceTempView("pages_v")
    return spark.sql("SELECT page_id, word, length FROM pages_v, LATERAL my_split(url)")


@query("udf_hash", """
SELECT page_id, CAST(((list_reduce(list_transform(string_split(url, ''), lambda c: ascii(c)::BIGINT),
        lambda a, x: (a * 31 + x) % 4294967296, 0::BIGINT) + 2147483648) % 4294967296) - 2147483648 AS INTEGER) AS h
FROM pages""")
def q_udf_hash(spark, d):
    register_functions(spark)
    load_table(spark, d, "pages").createOrReplaceTempView("pages_v")
    return spark.sql("SELECT page_id, my_hash(url) AS h FROM pages_v")


@query("udaf_weighted_avg", """
SELECT l_returnflag, CASE WHEN sum(l_linenumber) <> 0
       THEN (sum(l_partkey * l_linenumber) // sum(l_linenumber))::BIGINT END AS wavg
FROM lineitem GROUP BY l_returnflag""")
def q_udaf_weighted_avg(spark, d):
    from clickengine.functions import weighted_avg
    li = load_table(spark, d, "lineitem")
    return li.groupBy("l_returnflag").agg(weighted_avg("l_partkey", "l_linenumber").alias("wavg"))


# ============================================================ PF, SC, SO, SF

@query("map_project", "SELECT user_id FROM events")
def q_map_project(spark, d):
    return PF.project(_ev(spark, d), ["user_id"])


@query("filter_eq", "SELECT event_id, user_id, event_type FROM events WHERE event_type = 'click'")
def q_filter_eq(spark, d):
    return PF.filter_eq(_ev(spark, d), "event_type", "click").select("event_id", "user_id", "event_type")


@query("flatmap_fields", """
SELECT event_id, unnest([event_type, props, CAST((epoch_us(ts) // 1000) AS VARCHAR)]) AS field FROM events""")
def q_flatmap_fields(spark, d):
    e = _ev(spark, d).withColumn("ms", _ms())
    return PF.fields_as_rows(e, ["event_type", "props", "ms"], keep=["event_id"])


@query("flatmap_conditional", """
SELECT event_id, unnest(CASE WHEN event_type = 'click' THEN [props]
                             WHEN event_type = 'view' THEN [event_type, props, CAST((epoch_us(ts) // 1000) AS VARCHAR)]
                             ELSE []::VARCHAR[] END) AS out FROM events""")
def q_flatmap_conditional(spark, d):
    e = _ev(spark, d).withColumn("ms", _ms())
    return PF.expand_by_rule(e, [(F.col("event_type") == "click", ["props"]),
                                 (F.col("event_type") == "view", ["event_type", "props", "ms"])],
                             keep=["event_id"])


_FRAC_SQL = "coalesce(nullif(rtrim(lpad(CAST((epoch_us(ts) // 1000) % 1000 AS VARCHAR), 3, '0'), '0'), ''), '0')"
_EVENT_TEXT_SQL = (f"'Event{{user=''' || event_type || ''', url=''' || props || ''', timestamp=' || "
                   f"strftime(make_timestamp((epoch_us(ts) // 1000) * 1000), '%Y-%m-%d %H:%M:%S') || '.' || {_FRAC_SQL} || '}}'")


@query("process_expand", f"""
SELECT event_id, unnest(CASE WHEN event_type = 'click' THEN [event_type || 'clicks' || props, {_EVENT_TEXT_SQL}]
                             WHEN event_type = 'view' THEN [event_type, event_type, {_EVENT_TEXT_SQL}]
                             ELSE [{_EVENT_TEXT_SQL}] END) AS out FROM events""")
def q_process_expand(spark, d):
    e = _ev(spark, d).withColumn("ms", _ms())
    return PF.expand_by_rule(
        e, [(F.col("event_type") == "click", [F.concat("event_type", F.lit("clicks"), "props")]),
            (F.col("event_type") == "view", ["event_type", "event_type"])],
        always=[event_text(F.col("event_type"), F.col("props"), F.col("ms"))], keep=["event_id"])


@query("map_length", "SELECT page_id, length(url)::INTEGER AS url_length FROM pages")
def q_map_length(spark, d):
    return PF.project(load_table(spark, d, "pages"), ["page_id", F.length("url").alias("url_length")])


@query("table_where_select", "SELECT user_id AS user_name, event_type AS url FROM events WHERE event_type = 'purchase'")
def q_table_where_select(spark, d):
    c = _ev(spark, d).select(F.col("user_id").alias("user_name"), F.col("event_type").alias("url"))
    return PF.where_select(c, F.col("url") == "purchase", ["user_name", "url"])


@query("view_select", "SELECT event_type AS url, user_id AS user_name FROM events")
def q_view_select(spark, d):
    register_view(_ev(spark, d), "event_view", rename={"user_id": "user_name", "event_type": "url"})
    spark.table("event_view").where(F.lit(True)).createOrReplaceTempView("event_view_copy")
    return spark.sql("SELECT url, user_name FROM event_view_copy")


@query("split_route", """
SELECT event_id, CASE WHEN event_type = 'click' THEN 'click' WHEN event_type = 'view' THEN 'view'
                      ELSE 'other' END AS route FROM events""")
def q_split_route(spark, d):
    e = _ev(spark, d).select("event_id", "event_type")
    return PF.route(e, [("click", F.col("event_type") == "click"), ("view", F.col("event_type") == "view")]) \
             .select("event_id", "route")


@query("parse_lines", """
SELECT CAST(user_id AS VARCHAR) AS "user", event_type AS url, (epoch_us(ts) // 1000) AS "timestamp" FROM events""")
def q_parse_lines(spark, d):
    lines = _ev(spark, d).select(F.concat_ws(", ", F.col("user_id").cast("string"), "event_type",
                                             _ms().cast("string")).alias("value"))
    return parse_click_lines(lines)


@query("event_time_seconds", f"SELECT event_id, {_ET_SQL} AS et FROM events")
def q_event_time_seconds(spark, d):
    from clickengine.sources import with_event_time
    e = _ev(spark, d).select("event_id", _ms().alias("ms"))
    return with_event_time(e, "ms", truncate_to_seconds=True).select("event_id", F.col("et").cast("timestamp_ntz").alias("et"))


@query("union_streams", """
SELECT user_id, event_type, ts FROM events WHERE event_type = 'click'
UNION ALL SELECT user_id, event_type, ts FROM events WHERE event_type IS DISTINCT FROM 'click'""")
def q_union_streams(spark, d):
    e = _ev(spark, d).select("user_id", "event_type", "ts")
    return PF.union_streams(e.where(F.col("event_type") == "click"), e.where(~F.col("event_type").eqNullSafe("click")))


@query("connect_map", """
SELECT 'Long: ' || o_orderkey AS value FROM orders UNION ALL SELECT 'Integer:' || l_linenumber FROM lineitem""")
def q_connect_map(spark, d):
    o = load_table(spark, d, "orders")
    li = load_table(spark, d, "lineitem")
    return PF.connect_map(o, li, F.concat(F.lit("Long: "), F.col("o_orderkey").cast("string")),
                          F.concat(F.lit("Integer:"), F.col("l_linenumber").cast("string")))


@query("scalar_functions", f"""
SELECT event_id,
       len(string_split(props, ' ')) AS n_tokens,
       trim('  ' || event_type || ' ') AS trimmed,
       CAST(CAST(event_id AS VARCHAR) AS BIGINT) AS id_roundtrip,
       event_type = 'click' AS is_click,
       event_type || 'clicks' || props AS joined,
       length(props) AS props_length,
       CAST(((list_reduce(list_transform(string_split(event_type, ''), lambda c: ascii(c)::BIGINT),
            lambda a, x: (a * 31 + x) % 4294967296, 0::BIGINT) + 2147483648) % 4294967296) - 2147483648 AS INTEGER) AS type_hash,
       {_EVENT_TEXT_SQL} AS event_text,
       {_ET_SQL} AS et,
       (epoch_us(ts) // 1000) // 1000 AS secs,
       event_id % 2 AS parity,
       value / 2 AS half_value,
       '{{"' || user_id || '":"' || event_type || '"}}' AS doc,
       {_ET_SQL} - INTERVAL 5 SECOND AS before_et
FROM events""")
def q_scalar_functions(spark, d):
    e = _ev(spark, d).withColumn("ms", _ms())
    return e.select(
        "event_id",
        F.size(java_split(F.col("props"), " ")).cast("bigint").alias("n_tokens"),
        F.trim(F.concat(F.lit("  "), "event_type", F.lit(" "))).alias("trimmed"),
        F.col("event_id").cast("string").cast("bigint").alias("id_roundtrip"),
        (F.col("event_type") == "click").alias("is_click"),
        F.concat("event_type", F.lit("clicks"), "props").alias("joined"),
        F.length("props").cast("bigint").alias("props_length"),
        java_hash(F.col("event_type")).alias("type_hash"),
        event_text(F.col("event_type"), F.col("props"), F.col("ms")).alias("event_text"),
        seconds_ts(F.col("ms")).cast("timestamp_ntz").alias("et"),
        int_div(F.col("ms"), 1000).alias("secs"),
        F.pmod(F.col("event_id"), F.lit(2)).alias("parity"),
        (F.col("value") / 2).alias("half_value"),
        F.to_json(F.create_map(F.col("user_id").cast("string"), F.col("event_type"))).alias("doc"),
        (seconds_ts(F.col("ms")).cast("timestamp_ntz") - F.expr("INTERVAL 5 SECONDS")).alias("before_et"))


# ============================================================ ST3, ST4, ST6

@query("event_timers", """
SELECT DISTINCT user_id, ts + INTERVAL '6 hours' AS timer_ts FROM events
WHERE ts + INTERVAL '6 hours' < (SELECT max(ts) FROM events)""")
def q_event_timers(spark, d):
    return TM.event_timers(_ev(spark, d).select("user_id", "ts"), "user_id", "ts", "6 hours")


@query("periodic_pv", f"""
WITH f AS (SELECT user_id, min(epoch_us(ts)) AS t0 FROM events GROUP BY user_id),
     g AS (SELECT max(epoch_us(ts)) AS wm FROM events),
     ticks AS (SELECT user_id, t0, unnest(generate_series(1, (wm - t0 - 1) // {6 * H})) AS k FROM f, g)
SELECT t.user_id, make_timestamp(t.t0 + t.k * {6 * H}) AS tick_ts, count(e.event_id) AS cnt
FROM ticks t JOIN events e ON e.user_id = t.user_id AND epoch_us(e.ts) <= t.t0 + t.k * {6 * H}
GROUP BY t.user_id, t.t0, t.k""")
def q_periodic_pv(spark, d):
    return TM.periodic_count(_ev(spark, d).select("user_id", "ts"), "user_id", "ts", "6 hours")


def _late_input(spark, d):
    e = _ev(spark, d).select("event_id", "ts")
    day = int_div(ts_to_micros("ts"), 86_400_000_000)
    # arrival slice: 4-day ranges of event time; rows with an odd event_id
    # (pmod(event_id * 7919, 2)) arrive one slice later.  Every row is kept.
    return e.withColumn("slice", int_div(day, 4) + F.pmod(F.col("event_id") * 7919, F.lit(2)))


@query("late_split", f"""
WITH e AS (SELECT event_id, ts, (epoch_us(ts) // 86400000000) // 4 + (event_id * 7919) % 2 AS slice FROM events),
     s AS (SELECT slice, max(epoch_us(ts)) AS smax FROM e GROUP BY slice),
     w AS (SELECT slice, max(smax) OVER (ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {H} AS wm FROM s)
SELECT e.event_id, e.ts, e.slice, {_tb('6 hours', 'e.ts')} AS window_start,
       {_tb('6 hours', 'e.ts')} + INTERVAL '6 hours' AS window_end,
       coalesce(epoch_us({_tb('6 hours', 'e.ts')}) + {6 * H} + {36 * H} <= w.wm, false) AS is_late
FROM e JOIN w ON e.slice = w.slice""")
def q_late_split(spark, d):
    return TM.split_late(_late_input(spark, d), "slice", "ts", "6 hours", "1 hour", "36 hours")


# ============================================================ CE1-CE5

def _fail():
    return F.col("event_type") == "error"


@query("login_fail_3", """
SELECT user_id, t1 AS first_ts, t2 AS second_ts, ts AS third_ts FROM (
  SELECT user_id, ts, event_type, lag(ts, 2) OVER w AS t1, lag(ts, 1) OVER w AS t2,
         lag(event_type, 2) OVER w AS e1, lag(event_type, 1) OVER w AS e2
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
WHERE event_type = 'error' AND e1 = 'error' AND e2 = 'error'""")
def q_login_fail_3(spark, d):
    e = _ev(spark, d).select("user_id", "ts", "event_id", "event_type")
    return CE.strict_sequence(e, ["user_id"], ["ts", "event_id"], [_fail(), _fail(), _fail()], time_bucket("ts"), "ts",
                              ["first_ts", "second_ts", "third_ts"])


@query("consecutive_n", """
SELECT user_id, t1 AS first_ts, ts AS last_ts FROM (
  SELECT user_id, ts, event_type, lag(ts, 2) OVER w AS t1,
         sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS nf,
         count(*) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS n
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
WHERE nf = 3 AND n = 3""")
def q_consecutive_n(spark, d):
    e = _ev(spark, d).select("user_id", "ts", "event_id", "event_type")
    return CE.consecutive_n(e, ["user_id"], ["ts", "event_id"], _fail(), 3, time_bucket("ts"), "ts") \
             .select("user_id", "first_ts", "last_ts")


@query("fail_state_machine", """
WITH a AS (SELECT user_id, event_id, event_type = 'error' AS f,
                  sum(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END)
                    OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS grp FROM events),
     b AS (SELECT *, sum(CASE WHEN f THEN 1 ELSE 0 END)
                    OVER (PARTITION BY user_id, grp ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS run FROM a)
SELECT user_id, event_id FROM b WHERE f AND run >= 3""")
def q_fail_state_machine(spark, d):
    e = _ev(spark, d).select("user_id", "event_id", "event_type")
    return CE.fail_state_machine(e, ["user_id"], ["event_id"], "event_type", "error", arrival_bucket("event_id"))


@query("order_timeout", """
WITH a AS (SELECT user_id, event_id, ts, event_type,
                  min(CASE WHEN event_type = 'purchase' THEN ts END) OVER (PARTITION BY user_id ORDER BY ts, event_id
                      ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt FROM events)
SELECT user_id, ts, event_id, ts AS first_ts,
       CASE WHEN nxt IS NOT NULL AND epoch_us(nxt) - epoch_us(ts) < 86400000000 THEN nxt END AS then_ts,
       CASE WHEN nxt IS NOT NULL AND epoch_us(nxt) - epoch_us(ts) < 86400000000 THEN 'matched' ELSE 'timeout' END AS status
FROM a WHERE event_type = 'signup'""")
def q_order_timeout(spark, d):
    e = _ev(spark, d).select("user_id", "event_id", "ts", "event_type")
    return CE.followed_within(e, ["user_id"], ["ts", "event_id"], "ts", F.col("event_type") == "signup",
                              F.col("event_type") == "purchase", "24 hours", time_bucket("ts"))


FLAGSHIP = "url_view_count"
