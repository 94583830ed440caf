"""ordered_scan equals a single per-key window, whatever the bucketing."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from clickengine.operators.ordered import Running, arrival_bucket, lag_of, ordered_scan


@pytest.mark.parametrize("width,descending,hot_rows", [(1, False, 0), (5, False, 0), (64, True, 0), (1000, False, 0),
                                                       (5, False, 100), (7, True, 100)])
def test_matches_plain_window_with_hot_key(spark, width, descending, hot_rows):
    random.seed(width)
    # one key holds most of the rows; a null key and null values included
    keys = ["hot"] * 6 + ["a", "b", None]
    data = [(i, random.choice(keys), random.choice([None, 1, 2, 3, 9])) for i in range(600)]
    df = spark.createDataFrame(data, "seq long, k string, v long")
    out = ordered_scan(df, ["k"], ["seq"], arrival_bucket("seq", width),
                       running={"s": Running("sum", F.col("v")), "mx": Running("max", F.col("v")),
                                "mn": Running("min", F.col("v"))},
                       recent=(3, ["seq", "v"]), descending=descending, hot_rows=hot_rows)
    out = out.select("seq", "rn", "s", "mx", "mn", lag_of("recent", "v", 1).alias("l1"),
                     lag_of("recent", "seq", 3).alias("l3"))
    o = F.col("seq").desc() if descending else F.col("seq")
    w = Window.partitionBy("k").orderBy(o)
    ref = df.select("seq", F.row_number().over(w).cast("bigint").alias("rn"), F.sum("v").over(w).alias("s"),
                    F.max("v").over(w).alias("mx"), F.min("v").over(w).alias("mn"),
                    F.lag("v", 1).over(w).alias("l1"), F.lag("seq", 3).over(w).alias("l3"))
    assert sorted(out.collect()) == sorted(ref.collect())


def test_no_full_shuffle_in_summary(spark):
    df = spark.range(1000).select(F.col("id").alias("seq"), (F.col("id") % 3).alias("k"))
    out = ordered_scan(df, ["k"], ["seq"], arrival_bucket("seq", 100), hot_rows=0)
    plan = out._jdf.queryExecution().executedPlan().toString()
    # the per-bucket summary is a partial aggregate before its exchange
    assert "partial_count" in plan


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(data=st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(-5, 5)), min_size=1, max_size=60),
       width=st.integers(1, 20), descending=st.booleans(), hot=st.sampled_from([0, 5, 1000]))
def test_property_running_sum_and_lag(spark, data, width, descending, hot):
    rows_ = [(i, k, v) for i, (k, v) in enumerate(data)]
    df = spark.createDataFrame(rows_, "seq long, k string, v long")
    out = ordered_scan(df, ["k"], ["seq"], arrival_bucket("seq", width), running={"s": Running("sum", F.col("v"))},
                       recent=(1, ["v"]), descending=descending, hot_rows=hot)
    got = {r.seq: (r.rn, r.s, lag_of_value(r.recent)) for r in out.collect()}
    exp = {}
    for key in {k for _, k, _ in rows_}:
        seq = sorted((r for r in rows_ if r[1] == key), key=lambda r: r[0], reverse=descending)
        total, prev = 0, None
        for i, (s, _, v) in enumerate(seq):
            total += v
            exp[s] = (i + 1, total, prev)
            prev = v
    assert got == exp


def lag_of_value(recent):
    return recent[-2]["v"] if len(recent) == 2 else None


def test_rank_all_spans_range_partitions(spark):
    """One big group ranked across several range partitions equals row_number."""
    from clickengine.operators.topn import rank_all
    random.seed(5)
    data = [(random.choice(["big"] * 8 + ["s1", "s2"]), random.randint(0, 50), f"u{i:04d}") for i in range(800)]
    df = spark.createDataFrame(data, "g string, neg long, u string")
    out = rank_all(df, ["g"], ["neg", "u"], partitions=8)
    ranked = out.select("g", "u", "rank")
    ref = df.select("g", "u", F.row_number().over(Window.partitionBy("g").orderBy("neg", "u")).cast("bigint").alias("rank"))
    assert sorted(ranked.collect()) == sorted(ref.collect())
    # the big group really was spread over several range partitions
    parts = df.repartitionByRange(8, "g", "neg", "u").where("g = 'big'").select(F.spark_partition_id()).distinct().count()
    assert parts > 1


def test_rank_all_of_a_large_group_keeps_its_payload(spark):
    """More rows than the range sampler reads and than a hot key holds, with a payload column."""
    from clickengine.operators.topn import rank_all
    n = 60_000
    df = spark.range(n, numPartitions=8).select(
        F.lit("w").alias("g"), F.pmod(F.xxhash64("id"), F.lit(10**9)).alias("v"), "id", F.sha2(F.col("id").cast("string"), 256).alias("pay"))
    got = rank_all(df, ["g"], ["v", "id"], hot_rows=1000, partitions=8)
    w = Window.partitionBy("g").orderBy("v", "id")
    want = df.withColumn("want", F.row_number().over(w)).select("id", "want")
    assert got.join(want, "id").where("rank = want and pay is not null").count() == n


def test_hot_null_key_is_split(spark):
    """Two thirds of the rows on a null key: no window task gets them all, and the numbers hold."""
    df = spark.range(30_000, numPartitions=4).select(
        F.when(F.col("id") % 3 == 0, F.col("id") % 50).alias("k"), F.col("id").alias("o"))
    got = ordered_scan(df, ["k"], ["o"], F.lit(0), hot_rows=1000, recent=(2, ["o"]),
                       running={"s": Running("sum", F.col("o")), "b": Running("max", F.col("o"), exclusive=True)})
    w = Window.partitionBy("k").orderBy("o")
    want = df.select("o", F.row_number().over(w).alias("n"), F.sum("o").over(w).alias("t"), F.lag("o", 2).over(w).alias("l"),
                     F.lag("o", 1).over(w).alias("p"))
    both = got.join(want, "o")
    assert both.count() == 30_000
    first = F.when(F.size("recent") == 3, F.col("recent")[0]["o"])
    assert both.where(~((F.col("rn") == F.col("n")) & (F.col("s") == F.col("t")) & first.eqNullSafe(F.col("l"))
                        & F.col("b").eqNullSafe(F.col("p")))).count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "_oscan_bkt" in plan


def test_building_a_scan_starts_no_job(spark):
    """Both branches are in the plan; without hot keys only the plain window runs."""
    df = spark.range(2000).select((F.col("id") % 7).alias("k"), F.col("id").alias("o"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build", "build")
    got = ordered_scan(df, ["k"], ["o"], F.lit(0), recent=(1, ["o"]))
    assert list(tracker.getJobIdsForGroup("build")) == []
    spark.sparkContext.setJobGroup("run", "run")
    assert got.count() == 2000
    got.collect()
    final = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("Window ") == 1 and "_oscan_bcnt" not in final


def test_quantiles_do_not_depend_on_the_layout(spark):
    """The same buckets from any partitioning, and about equal ones, also far from a uniform order."""
    df = spark.range(200_000).select(F.lit("h").alias("k"), F.expr("cast(pow(id / 20000.0, 6) * 1000 as bigint) * 200000 + id").alias("o"))
    counts = []
    for n in (1, 7):
        got = ordered_scan(df.repartition(n), ["k"], ["o"], F.lit(0), hot_rows=1000)
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert "_oscan_q" in plan
        w = Window.partitionBy("k").orderBy("o")
        assert got.exceptAll(df.withColumn("rn", F.row_number().over(w).cast("bigint"))).count() == 0
        counts.append(sorted(r[0] for r in got.select("rn").collect()))
    assert counts[0] == counts[1] == list(range(1, 200_001))


def test_known_hot_keys(spark):
    df = spark.range(900).select(F.when(F.col("id") % 3 > 0, F.lit("a")).alias("k"), F.col("id").alias("o"))
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("o")).cast("bigint"))
    for keys in ([("a",)], [(None,), ("a",), ("none",)], []):
        got = ordered_scan(df, ["k"], ["o"], arrival_bucket("o", 50), hot_keys=spark.createDataFrame(keys, "k string"))
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
