"""AG, WN, TK, UD fixtures on click.txt (F2) and the 8 click events (F3)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from clickengine.functions import weighted_avg
from clickengine.operators import aggregates as AG
from clickengine.operators import topn as TK
from clickengine.operators import windows as WN
from tests.conftest import rows
from tests.fixtures import EVENTS_A, EVENTS_B, clicks, events


def _sec(ts):
    return int(ts.replace(tzinfo=dt.timezone.utc).timestamp()) if ts.tzinfo is None else int(ts.timestamp())


def test_group_count_and_sql_topn(spark):
    c = clicks(spark)
    assert dict(rows(AG.count_by(c, ["user_name"], col="url"))) == {"Tom": 5, "Bob": 3, "Jack": 2, "Lisa": 1}
    top = TK.top_n(AG.count_by(c, ["user_name"]), [F.col("cnt").desc(), F.col("user_name")], 2)
    assert rows(top) == [("Bob", 3, 2), ("Tom", 5, 1)]


def test_sql_tumble_and_hop(spark):
    c = clicks(spark)
    c.createOrReplaceTempView("clicks_f2")
    t = spark.sql("""SELECT user_name, window.end AS we, COUNT(url) AS cnt FROM clicks_f2
                     GROUP BY user_name, window(et, '10 seconds')""")
    got = sorted((_sec(r.we), r.user_name, r.cnt) for r in t.collect())
    assert got == [(10, "Bob", 2), (10, "Jack", 2), (10, "Lisa", 1), (10, "Tom", 4), (20, "Bob", 1), (20, "Tom", 1)]
    h = spark.sql("""SELECT user_name, COUNT(url) FROM clicks_f2
                     GROUP BY user_name, window(et, '10 seconds', '5 seconds')""")
    assert h.count() == 13


def test_cumulate(spark):
    w = WN.cumulate(clicks(spark), "et", "5 seconds", "10 seconds")
    out = w.groupBy("user_name", "window_end").agg(F.count(F.lit(1)).alias("cnt"))
    got = sorted((_sec(r.window_end), r.user_name, r.cnt) for r in out.collect())
    assert got == [(5, "Bob", 1), (5, "Jack", 1), (5, "Lisa", 1), (5, "Tom", 1),
                   (10, "Bob", 2), (10, "Jack", 2), (10, "Lisa", 1), (10, "Tom", 4),
                   (15, "Bob", 1), (15, "Tom", 1), (20, "Bob", 1), (20, "Tom", 1)]


def test_over_rows_avg_bigint(spark):
    out = WN.over_rows_avg(clicks(spark), ["user_name"], ["et", "seq"], "ts", 3, F.lit(0))
    got = {}
    for r in out.orderBy("seq").collect():
        got.setdefault(r.user_name, []).append(r.avg_value)
    assert got == {"Bob": [3000, 5000, 7000], "Jack": [1000, 3500], "Lisa": [2000],
                   "Tom": [4000, 4500, 5666, 6500, 8500]}


def test_window_topn_and_top2(spark):
    c = clicks(spark)
    counts = (c.groupBy("user_name", F.window("et", "10 seconds").alias("w")).agg(F.count("url").alias("cnt"))
               .select("user_name", "cnt", F.col("w.end").alias("window_end")))
    top = TK.rank_within(counts, ["window_end"], [F.col("cnt").desc(), F.col("user_name")], 2)
    got = sorted((_sec(r.window_end), r.rank, r.user_name, r.cnt) for r in top.collect())
    assert got == [(10, 1, "Tom", 4), (10, 2, "Bob", 2), (20, 1, "Bob", 1), (20, 2, "Tom", 1)]
    t2 = TK.top_values(counts, ["window_end"], "cnt", 2)
    assert sorted((_sec(r.window_end), r.rank, r.value) for r in t2.collect()) == \
        [(10, 1, 4), (10, 2, 2), (20, 1, 1), (20, 2, 1)]
    # n is honoured; fewer rows than n gives them all
    assert TK.window_top_n(c, "url", "et", 5, "10 seconds").count() == 4 + 2


def test_window_top_n_plan_has_group_limit(spark):
    c = clicks(spark)
    plan = TK.window_top_n(c, "url", "et", 2, "10 seconds")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_weighted_avg(spark):
    c = clicks(spark).withColumn("w", F.lit(1))
    got = dict(rows(c.groupBy("user_name").agg(weighted_avg("ts", "w").alias("a"))))
    assert got == {"Jack": 3500, "Lisa": 2000, "Bob": 7000, "Tom": 7600}
    zero = c.withColumn("w", F.lit(0)).groupBy("user_name").agg(weighted_avg("ts", "w").alias("a"))
    assert all(r.a is None for r in zero.collect())


def test_max_field_and_max_row(spark):
    e = events(spark, EVENTS_A)
    mf = AG.max_field(e, "user", "timestamp", "seq", ["url"])
    assert rows(mf, "user", "url", "timestamp") == [
        ("Alice", "./prod?id=100", 3200), ("Bob", "./cart", 4200), ("Mary", "./home", 1000)]
    mr = AG.max_row(e, "user", "timestamp", "seq", ["url", "timestamp"])
    assert rows(mr, "user", "url", "timestamp") == [
        ("Alice", "./prod?id=200", 3200), ("Bob", "./prod?id=3", 4200), ("Mary", "./home", 1000)]
    # tie on the max field -> earliest row
    tie = spark.createDataFrame([(1, "a", "x", 5), (2, "a", "y", 5)], "seq long, user string, url string, timestamp long")
    assert rows(AG.max_row(tie, "user", "timestamp", "seq", ["url"]), "url") == [("x",)]


def test_reduce_most_active_and_rolling(spark):
    e = events(spark, EVENTS_B)
    assert dict(rows(AG.count_by(e, ["user"]))) == {"Mary": 1, "Alice": 2, "Bob": 5}
    assert rows(AG.most_active(e, "user", "seq")) == [("Bob", 5)]
    roll = AG.rolling_count(e, ["user"], ["seq"], F.floor(F.col("seq") / 3))
    assert [(r.user, r.cnt) for r in roll.orderBy("seq").collect()] == [
        ("Mary", 1), ("Bob", 1), ("Alice", 1), ("Bob", 2), ("Alice", 2), ("Bob", 3), ("Bob", 4), ("Bob", 5)]
    # tie: the key reaching the maximum last wins
    tie = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b"), (4, "a")], "seq long, user string")
    assert rows(AG.most_active(tie, "user", "seq")) == [("a", 2)]


def test_latest_and_summary(spark):
    e = events(spark, EVENTS_A)
    assert rows(AG.latest_by_key(e, "user", "url", "seq")) == [
        ("Alice", "./prod?id=200"), ("Bob", "./prod?id=3"), ("Mary", "./home")]
    s = AG.keyed_summary(e, "user", "seq", "url", "et")
    bob = s.where("user = 'Bob'").first()
    assert (bob.first_url, bob.cnt) == ("./cart", 5)
    assert int(bob.last_ts.timestamp() * 1000) == 4200


def test_changelog(spark):
    e = events(spark, EVENTS_B)
    cl = AG.changelog_count(e, ["user"], ["seq"], F.lit(0))
    bob = [(r.op, r.cnt) for r in cl.where("user = 'Bob'").orderBy("seq", "pos").collect()]
    assert bob == [("+I", 1), ("-U", 1), ("+U", 2), ("-U", 2), ("+U", 3), ("-U", 3), ("+U", 4), ("-U", 4), ("+U", 5)]


def test_window_aggregates_properties(spark):
    """Property checks on a seeded click stream: tumbling counts sum to the
    rows; sliding (slide = size/2) counts are twice the rows; uv by the
    incremental and the full-window form agree; last cumulate step equals
    tumbling."""
    import random
    random.seed(7)
    users, urls = ["Mary", "Alice", "Bob", "Carry"], ["./home", "./cart", "./fav", "./prod?id=100", "./prod?id=10"]
    data = [(i, random.choice(users), random.choice(urls), 1000 * i + random.randint(0, 999)) for i in range(500)]
    e = spark.createDataFrame(data, "seq long, user string, url string, timestamp long") \
             .withColumn("et", F.timestamp_millis("timestamp"))
    tumble = AG.url_view_count(e, "url", "et", "10 seconds")
    assert tumble.agg(F.sum("cnt")).first()[0] == 500
    hop = AG.url_view_count(e, "url", "et", "10 seconds", "5 seconds")
    assert hop.agg(F.sum("cnt")).first()[0] == 1000
    uv = AG.uv_count(e, "user", "et", "10 seconds")
    full = e.groupBy(F.window("et", "10 seconds").alias("w")).agg(F.size(F.collect_set("user")).alias("n"))
    assert rows(uv.select("window_start", "uv")) == rows(full.select(F.col("w.start"), F.col("n").cast("bigint")))
    cum = WN.cumulate(e, "et", "5 seconds", "10 seconds")
    last = cum.where(F.col("window_end") == F.col("window_start") + F.expr("INTERVAL 10 SECONDS"))
    assert last.count() == 500
    fake = WN.fixed_tumble(e, "et", "10 seconds").groupBy("url", "window_start").count()
    assert rows(fake, "url", "window_start", "count") == rows(tumble, "url", "window_start", "cnt")


def test_count_windows_and_every_n(spark):
    data = [(i, "u", 1000 * i) for i in range(1, 13)]
    e = spark.createDataFrame(data, "seq long, user string, ts long").withColumn("et", F.timestamp_millis("ts"))
    sl = WN.count_window(e, ["user"], ["seq"], 10, 2, F.floor(F.col("seq") / 4), "ts")
    got = [(r.end_rn, r.n_rows, r.first_seq) for r in sl.orderBy("end_rn").collect()]
    assert got == [(2, 2, 1), (4, 4, 1), (6, 6, 1), (8, 8, 1), (10, 10, 1), (12, 10, 3)]
    tb = WN.count_window(e, ["user"], ["seq"], 5, None, F.floor(F.col("seq") / 4), "ts")
    assert [(r.end_rn, r.sum_ts) for r in tb.orderBy("end_rn").collect()] == [(5, 15000), (10, 40000)]
    avg = WN.avg_every_n(e, ["user"], ["seq"], "et", 5, F.floor(F.col("seq") / 4))
    assert [int(r.avg_ts.timestamp() * 1000) for r in avg.orderBy("batch_no").collect()] == [3000, 8000]


def test_sessions_match_builtin(spark):
    import random
    random.seed(3)
    fine = [(i, random.choice("abc"), random.randint(0, 100000)) for i in range(300)]
    # whole seconds with a 2 s gap: exact-gap differences and ties
    coarse = [(i, random.choice("ab"), 1000 * random.randint(0, 60)) for i in range(200)]
    for data in (fine, coarse):
        e = spark.createDataFrame(data, "seq long, k string, ms long").withColumn("et", F.timestamp_millis("ms"))
        ours = WN.session_windows(e, ["k"], "et", ["et", "seq"], "2 seconds")
        ref = WN.builtin_session_windows(e, ["k"], "et", "2 seconds")
        assert rows(ours) == rows(ref)
        # the per-row session assignment agrees with the aggregated form
        ids = WN.session_ids(e, ["k"], "et", ["et", "seq"], "2 seconds", F.floor(F.col("ms") / 7000))
        per = ids.groupBy("k", "_sess_start").count()
        assert rows(per, "k", "count") == rows(ours, "k", "cnt")


def test_url_counts_map_sorted(spark):
    m = AG.url_counts_map(clicks(spark), "url", "et", "10 seconds").orderBy("window_start")
    # the map keeps entry order in Spark; a Python dict would not, so read keys/values
    first = m.select(F.map_keys("counts").alias("k"), F.map_values("counts").alias("v")).first()
    assert first.k[:2] == ["./home", "./cart"] and first.v[:2] == [4, 3] and sum(first.v) == 9
    ranked = AG.url_counts_ranked(clicks(spark), "url", "et", "10 seconds")
    assert rows(ranked.where("rank = 1"), "url") == [("./cart",), ("./home",)]


def test_nulls_do_not_count_in_frames(spark):
    df = spark.createDataFrame([("u", 1, 10), ("u", 2, None), ("u", 3, 30), ("v", 1, None)], "k string, o long, v long")
    got = WN.over_rows_avg(df, ["k"], ["o"], "v", 2, F.lit(0))
    assert sorted((r.k, r.o, r.avg_value) for r in got.collect()) == [("u", 1, 10), ("u", 2, 10), ("u", 3, 20), ("v", 1, None)]
    got = WN.count_window(df, ["k"], ["o"], 3, 1, F.lit(0), "v")
    assert sorted((r.k, r.end_rn, r.sum_v, r.max_v) for r in got.collect()) == [
        ("u", 1, 10, 10), ("u", 2, 10, 10), ("u", 3, 40, 30), ("v", 1, None, None)]


@pytest.mark.parametrize("span", [1, 2, 3, 1 << 16])
def test_sessions_across_spans(spark, span):
    """A key's buckets dealt over spans: sessions that end in one, reach over several, or break between two;
    gaps of exactly the session gap; null keys."""
    import random
    rng = random.Random(span)
    data = [(rng.choice(["a", None, "b"]), 1000 * rng.choice([rng.randint(0, 40), rng.randint(0, 400), 2 * rng.randint(0, 60)])) for _ in range(250)]
    e = spark.createDataFrame(data, "k string, ms long").withColumn("et", F.timestamp_millis("ms"))
    ours = WN.session_windows(e, ["k"], "et", ["et"], "2 seconds", span=span)
    ref = WN.builtin_session_windows(e, ["k"], "et", "2 seconds")
    assert sorted(map(str, ours.collect())) == sorted(map(str, ref.collect()))


def test_hot_key_sessions_are_spread(spark):
    """One key with all rows: no task of the span windows sees more than a span of its buckets."""
    e = spark.range(40_000).select(F.lit("hot").alias("k"), F.timestamp_seconds(F.col("id") * F.when(F.col("id") % 10 == 0, 3).otherwise(1)).alias("et"))
    ours = WN.session_windows(e, ["k"], "et", ["et"], "1 second", span=1024)
    plan = ours._jdf.queryExecution().optimizedPlan().toString()
    assert "_span" in plan
    ref = WN.builtin_session_windows(e, ["k"], "et", "1 second")
    assert ours.exceptAll(ref).count() == 0 and ours.count() == ref.count()


def test_ticks_of_a_long_span(spark):
    """Two rows 5,000,000 ticks apart: ticks come in blocks, none is lost or doubled."""
    from clickengine.operators import timers as TM
    e = spark.createDataFrame([("a", 0), ("a", 5_000_000_000), ("b", 4_999_999_000)], "k string, ms long").withColumn("et", F.timestamp_millis("ms"))
    got = TM.periodic_count(e, "k", "et", "1 second")
    assert got.groupBy("k").agg(F.count("*"), F.count_distinct("tick_ts"), F.max("cnt")).collect() == [("a", 4_999_999, 4_999_999, 1)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "4096" in plan
