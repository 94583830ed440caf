"""JN, CE and timer fixtures (FIXTURES.md F6-F13)."""

import pytest
from pyspark.sql import functions as F

from clickengine.operators import joins as JN
from clickengine.operators import patterns as CE
from clickengine.operators import timers as TM
from tests.conftest import rows


def _ms(col):
    return (F.unix_millis(F.col(col))).alias(col)


def _f6(spark):
    left = spark.createDataFrame([("a", 1000), ("b", 1000), ("a", 2000), ("b", 2000), ("b", 5100)], "k string, lts long")
    right = spark.createDataFrame([("a", 3000), ("b", 4000), ("a", 4500), ("b", 5500)], "k string, rts int")
    return (left.withColumn("l_et", F.timestamp_millis("lts")),
            right.withColumn("r_et", F.timestamp_millis(F.col("rts").cast("bigint"))))


def test_window_join_and_counts(spark):
    l, r = _f6(spark)
    pairs = JN.window_join(l, r, "k", "l_et", "r_et", "5 seconds")
    assert rows(pairs, "k", "lts", "rts") == sorted([
        ("a", 1000, 3000), ("a", 1000, 4500), ("a", 2000, 3000), ("a", 2000, 4500),
        ("b", 1000, 4000), ("b", 2000, 4000), ("b", 5100, 5500)])
    counts = JN.window_join_counts(l, r, "k", "l_et", "r_et", "5 seconds")
    assert counts.agg(F.sum("n_pairs")).first()[0] == 7


def test_window_cogroup_lists(spark):
    l, r = _f6(spark)
    out = JN.window_cogroup(l, r, "k", "l_et", "r_et", "5 seconds",
                            [F.sort_array(F.collect_list("lts")).alias("left")],
                            [F.sort_array(F.collect_list("rts")).alias("right")])
    got = sorted((r.k, r.left, r.right) for r in out.collect())
    assert got == [("a", [1000, 2000], [3000, 4500]), ("b", [1000, 2000], [4000]), ("b", [5100], [5500])]
    # one side empty -> null aggregates on that side
    l2 = l.union(l.sparkSession.createDataFrame([("z", 9000)], "k string, lts long")
                 .withColumn("l_et", F.timestamp_millis("lts")))
    out2 = JN.window_cogroup(l2, r, "k", "l_et", "r_et", "5 seconds",
                             [F.count(F.lit(1)).alias("nl")], [F.count(F.lit(1)).alias("nr")])
    z = out2.where("k = 'z'").first()
    assert (z.nl, z.nr) == (1, None)


def test_interval_join(spark):
    orders = spark.createDataFrame([("Mary", 5000), ("Alice", 5000), ("Bob", 20000), ("Alice", 20000), ("Cary", 51000)],
                                   "user string, o_ms long").withColumn("o_et", F.timestamp_millis("o_ms"))
    clicks = spark.createDataFrame([
        ("Mary", "./home", 1000), ("Bob", "./cart", 2000), ("Alice", "./prod?id=100", 3000), ("Bob", "./prod?id=1", 3300),
        ("Alice", "./prod?id=200", 36000), ("Bob", "./home", 30000), ("Bob", "./prod?id=2", 23000),
        ("Bob", "./prod?id=3", 33000)], "user string, url string, c_ms long").withColumn("c_et", F.timestamp_millis("c_ms"))
    for bucket in (None, "1 second", "3 seconds"):
        out = JN.interval_join(orders, clicks, "user", "o_et", "c_et", "-5 seconds", "10 seconds", bucket)
        assert rows(out, "user", "o_ms", "c_ms") == sorted([
            ("Mary", 5000, 1000), ("Alice", 5000, 3000), ("Bob", 20000, 23000), ("Bob", 20000, 30000)])


def test_history_join(spark):
    l = spark.createDataFrame([("a", 1000), ("b", 2000), ("a", 3000)], "k string, lts long")
    r = spark.createDataFrame([("a", 3000), ("b", 4000), ("a", 6000)], "k string, rts long")
    assert rows(JN.history_join(l, r, "k"), "k", "lts", "rts") == [
        ("a", 1000, 3000), ("a", 1000, 6000), ("a", 3000, 3000), ("a", 3000, 6000), ("b", 2000, 4000)]
    assert rows(JN.history_join_counts(l, r, "k"), "k", "n_pairs") == [("a", 4), ("b", 1)]


def test_bill_check(spark):
    app = spark.createDataFrame([("order-1", "app", 1000), ("order-2", "app", 2000), ("order-3", "app", 3500)],
                                "order_id string, channel string, ts long").withColumn("et", F.timestamp_millis("ts"))
    third = spark.createDataFrame([("order-1", "third-party", "success", 3000), ("order-3", "third-party", "success", 4000),
                                   ("order-9", "third-party", "success", 9000), ("order-2", "third-party", "success", 8000)],
                                  "order_id string, channel string, status string, ts long").withColumn("et", F.timestamp_millis("ts"))
    out = JN.reconcile(app, third, "order_id", "et", "et", "5 seconds")
    assert rows(out, "order_id", "status") == [
        ("order-1", "matched"), ("order-2", "app_only"), ("order-2", "third_only"),
        ("order-3", "matched"), ("order-9", "third_only")]


def test_behavior_pattern(spark):
    acts = [("Alice", "login"), ("Alice", "pay"), ("Bob", "login"), ("Bob", "order")]
    # pattern 1 in force for Alice, pattern 2 for Bob
    a = spark.createDataFrame([(u, x, s) for (u, x), s in zip(acts, [2, 3, 5, 6])], "user_id string, action string, seq long")
    p = spark.createDataFrame([("login", "pay", 1), ("login", "order", 4)], "action1 string, action2 string, seq long")
    out = JN.match_transitions(a, p, "user_id", "action", "seq", F.lit(0))
    assert rows(out, "user_id", "action1", "action2") == [("Alice", "login", "pay"), ("Bob", "login", "order")]
    # both patterns before all actions: only the latest is kept
    p2 = spark.createDataFrame([("login", "pay", 0), ("login", "order", 1)], "action1 string, action2 string, seq long")
    out2 = JN.match_transitions(a, p2, "user_id", "action", "seq", F.lit(0))
    assert rows(out2, "user_id", "action1", "action2") == [("Bob", "login", "order")]


def _logins(spark, data):
    df = spark.createDataFrame([(i + 1, *r) for i, r in enumerate(data)],
                               "seq long, user_id string, ip string, event_type string, ts long")
    return df.withColumn("et", F.timestamp_millis("ts"))


OUT_OF_ORDER = [("user_1", "192.168.0.1", "fail", 2000), ("user_1", "192.168.0.2", "fail", 3000),
                ("user_2", "192.168.1.29", "fail", 4000), ("user_1", "171.56.23.10", "fail", 5000),
                ("user_2", "192.168.1.29", "fail", 7000), ("user_2", "192.168.1.29", "fail", 8000),
                ("user_2", "192.168.1.29", "success", 6000)]


def test_login_fail_patterns(spark):
    df = _logins(spark, OUT_OF_ORDER)
    fail = F.col("event_type") == "fail"
    ce1 = CE.strict_sequence(df, ["user_id"], ["et", "seq"], [fail, fail, fail], F.lit(0), "ts",
                             ["first", "second", "third"])
    assert rows(ce1) == [("user_1", 2000, 3000, 5000)]
    ce2 = CE.consecutive_n(df, ["user_id"], ["et", "seq"], fail, 3, F.lit(0), "ts")
    assert rows(ce2, "user_id", "times") == [("user_1", [2000, 3000, 5000])]
    # four failures in a row give two overlapping matches
    four = _logins(spark, [("u", "ip", "fail", t) for t in (1000, 2000, 3000, 4000)])
    assert CE.consecutive_n(four, ["user_id"], ["et", "seq"], F.col("event_type") == "fail", 3, F.lit(0), "ts").count() == 2


def test_state_machine_in_arrival_order(spark):
    in_order = [OUT_OF_ORDER[i] for i in (0, 1, 2, 3, 6, 4, 5)]
    df = _logins(spark, in_order)
    out = CE.fail_state_machine(df, ["user_id"], ["seq"], "event_type", "fail", F.floor(F.col("seq") / 2))
    assert rows(out, "user_id") == [("user_1",)]
    # an unknown type resets the machine
    reset = _logins(spark, [("u", "ip", "fail", 1), ("u", "ip", "fail", 2), ("u", "ip", "other", 3), ("u", "ip", "fail", 4)])
    assert CE.fail_state_machine(reset, ["user_id"], ["seq"], "event_type", "fail", F.lit(0)).count() == 0


def test_order_timeout(spark):
    data = [("user_1", "order_1", "create", 1000), ("user_2", "order_2", "create", 2000),
            ("user_1", "order_1", "modify", 10 * 1000), ("user_1", "order_1", "pay", 60 * 1000),
            ("user_2", "order_3", "create", 10 * 60 * 1000), ("user_2", "order_3", "pay", 20 * 60 * 1000),
            ("user_3", "order_4", "create", 0), ("user_3", "order_4", "pay", 15 * 60 * 1000)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(data)],
                               "seq long, user_id string, order_id string, event_type string, ts long") \
              .withColumn("et", F.timestamp_millis("ts"))
    out = CE.followed_within(df, ["order_id"], ["et", "seq"], "et", F.col("event_type") == "create",
                             F.col("event_type") == "pay", "15 minutes", F.lit(0))
    assert rows(out, "order_id", "status") == [
        ("order_1", "matched"), ("order_2", "timeout"), ("order_3", "matched"), ("order_4", "timeout")]


def test_event_timers(spark):
    df = spark.createDataFrame([("Mary", 1000), ("Alice", 11000), ("Bob", 11001)], "user string, ms long") \
              .withColumn("et", F.timestamp_millis("ms"))
    fired = TM.event_timers(df, "user", "et", "10 seconds")
    assert rows(fired.select("user", _ms("timer_ts"))) == [("Mary", 11000)]
    with_sentinel = df.union(spark.createDataFrame([("~", 60000)], "user string, ms long")
                             .withColumn("et", F.timestamp_millis("ms")))
    fired = TM.event_timers(with_sentinel, "user", "et", "10 seconds").where("user <> '~'")
    assert rows(fired.select("user", _ms("timer_ts"))) == [("Alice", 21000), ("Bob", 21001), ("Mary", 11000)]


def test_periodic_count_matches_simulation(spark):
    import random
    random.seed(11)
    t, data = 0, []
    for i in range(400):
        t += random.randint(0, 3000)
        data.append((random.choice(["Mary", "Bob", "Alice"]), t))
    df = spark.createDataFrame(data, "user string, ms long").withColumn("et", F.timestamp_millis("ms"))
    got = rows(TM.periodic_count(df, "user", "et", "10 seconds").select("user", _ms("tick_ts"), "cnt"))
    # row-by-row simulation: timers fire when the watermark (max ts) passes them
    first, exp = {}, []
    gmax = max(ms for _, ms in data)
    for u, ms in data:
        first.setdefault(u, ms)
    for u, t0 in first.items():
        k = 1
        while t0 + 10000 * k < gmax:
            tick = t0 + 10000 * k
            exp.append((u, tick, sum(1 for uu, m in data if uu == u and m <= tick)))
            k += 1
    assert got == sorted(exp)


def test_split_late(spark):
    # slices 1000 | 30000 | 2000 | 3000, delay 0, 10 s windows
    df = spark.createDataFrame([(0, 1000), (1, 30000), (2, 2000), (3, 3000)], "slice long, ms long") \
              .withColumn("et", F.timestamp_millis("ms"))
    late = dict(rows(TM.split_late(df, "slice", "et", "10 seconds", "0 seconds", "0 seconds").select("ms", "is_late")))
    assert late == {1000: False, 30000: False, 2000: True, 3000: True}
    builtin = dict(rows(TM.split_late(df, "slice", "et", "10 seconds", "0 seconds", "0 seconds", lag_slices=2)
                        .select("ms", "is_late")))
    assert builtin == {1000: False, 30000: False, 2000: False, 3000: True}


def test_match_sequence_entry(spark):
    df = _logins(spark, OUT_OF_ORDER)
    fail = F.col("event_type") == "fail"
    a = CE.match_sequence(df, ["user_id"], ["et", "seq"], [fail, fail, fail], F.lit(0), "ts")
    b = CE.match_sequence(df, ["user_id"], ["et", "seq"], [fail], F.lit(0), "ts", times=3)
    assert a.count() == b.count() == 1
    c = CE.match_sequence(df, ["user_id"], ["et", "seq"], [fail, F.col("event_type") == "success"], F.lit(0), "ts",
                          contiguity="relaxed", within="10 seconds")
    assert rows(c, "user_id", "status")[0][0] == "user_1"


def test_split_late_shows_the_watermark(spark):
    from clickengine.operators import timers as TM
    df = spark.createDataFrame([(0, 0), (0, 50), (1, 10), (2, 120)], "slice long, s long") \
              .select("slice", F.timestamp_seconds("s").alias("ts"))
    for most in (1_000_000, 1):   # broadcast, and joined on the slice
        got = TM.split_late(df, "slice", "ts", "10 seconds", "5 seconds", "0 seconds", watermark="wm", max_slices=most)
        rows_ = sorted((r.slice, r.ts.second + 60 * r.ts.minute, r.wm and r.wm.second, r.is_late) for r in got.collect())
        assert rows_ == [(0, 0, None, False), (0, 50, None, False), (1, 10, 45, True), (2, 120, 45, False)]


def test_followed_within_never_matches_itself(spark):
    df = spark.createDataFrame([("u", 1, 0, "a"), ("u", 2, 10, "a"), ("u", 3, 500, "a")], "k string, o long, s long, t string") \
              .withColumn("ts", F.timestamp_seconds("s"))
    got = CE.followed_within(df, ["k"], ["ts", "o"], "ts", F.col("t") == "a", F.col("t") == "a", "100 seconds", F.lit(0))
    assert sorted((r.o, r.status) for r in got.collect()) == [(1, "matched"), (2, "timeout"), (3, "timeout")]


def test_checkpoint_folder_is_needed_on_a_cluster(spark, monkeypatch):
    from types import SimpleNamespace

    from clickengine.session import checkpoint_dir
    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(fake)
