"""PF, SO, SF, SC fixtures (FIXTURES.md F1-F5)."""

from pyspark.sql import functions as F

from clickengine.functions import event_text, java_hash, java_split, register_functions
from clickengine.operators import transforms as PF
from clickengine.operators import aggregates as AG
from clickengine.sources import parse_click_lines, read_click_csv
from tests.conftest import rows
from tests.fixtures import EVENTS_A, WORDS, events


def test_word_count_batch(spark):
    df = spark.createDataFrame([(w,) for w in WORDS], "line string")
    got = dict(rows(AG.word_count(df, "line")))
    assert got == {"hello": 3, "world": 1, "bigdata": 1, "flink": 1, "hi": 1, "spark": 1}


def test_rolling_word_count(spark):
    df = spark.createDataFrame([(i, w) for i, w in enumerate(WORDS)], "seq long, line string")
    tokens = df.select("seq", F.posexplode(java_split(F.col("line"), " ")).alias("pos", "word"))
    out = AG.rolling_count(tokens, ["word"], ["seq", "pos"], F.col("seq"))
    assert out.count() == 8
    assert sorted(r.cnt for r in out.where("word = 'hello'").collect()) == [1, 2, 3]


def test_java_split_semantics(spark):
    df = spark.createDataFrame([("a  b ",), (" ",), ("",), ("x",)], "s string")
    got = {r.s: r.p for r in df.select("s", java_split(F.col("s"), " ").alias("p")).collect()}
    assert got == {"a  b ": ["a", "", "b"], " ": [], "": [""], "x": ["x"]}


def test_map_filter_flatmap(spark):
    e = events(spark, EVENTS_A[:3])
    assert rows(PF.project(e, ["user"])) == [("Alice",), ("Bob",), ("Mary",)]
    assert rows(PF.filter_eq(e, "user", "Mary").select("user")) == [("Mary",)]
    assert rows(e.select(F.length("url").alias("n"))) == [(6,), (6,), (13,)]
    assert PF.fields_as_rows(e, ["user", "url", "timestamp"]).count() == 9
    cond = PF.expand_by_rule(e, [(F.col("user") == "Mary", ["url"]),
                                 (F.col("user") == "Bob", ["user", "url", "timestamp"])])
    assert rows(cond) == [("./cart",), ("./home",), ("2000",), ("Bob",)]


def test_process_expand(spark):
    e = events(spark, EVENTS_A[:3])
    out = PF.expand_by_rule(
        e, [(F.col("user") == "Mary", [F.concat("user", F.lit("clicks"), "url")]),
            (F.col("user") == "Bob", ["user", "user"])],
        always=[event_text(F.col("user"), F.col("url"), F.col("timestamp"))])
    got = [r[0] for r in rows(out)]
    assert len(got) == 6
    assert "Maryclicks./home" in got and got.count("Bob") == 2
    assert "Event{user='Mary', url='./home', timestamp=1970-01-01 00:00:01.0}" in got


def test_split_route_and_connect(spark):
    e = events(spark)
    parts = PF.split_routes(e, [("mary", F.col("user") == "Mary"), ("bob", F.col("user") == "Bob")])
    assert (parts["mary"].count(), parts["bob"].count(), parts["other"].count()) == (1, 5, 2)
    ints = spark.createDataFrame([(1,), (2,), (3,)], "v int")
    longs = spark.createDataFrame([(4,), (5,), (6,)], "v long")
    out = PF.connect_map(ints, longs, F.concat(F.lit("Integer:"), F.col("v").cast("string")),
                         F.concat(F.lit("Long: "), F.col("v").cast("string")))
    assert rows(out) == [("Integer:1",), ("Integer:2",), ("Integer:3",), ("Long: 4",), ("Long: 5",), ("Long: 6",)]


def test_union_keeps_duplicates(spark):
    a = spark.createDataFrame([("a", 1)], "k string, v long")
    assert PF.union_streams(a, a, a).count() == 3


def test_hash_udf(spark):
    register_functions(spark)
    got = spark.sql("SELECT my_hash('Alice') a, my_hash('Mary') m").first()
    assert (got.a, got.m) == (63350368, 2390779)
    df = spark.createDataFrame([("Alice",), ("Mary",)], "s string")
    assert rows(df.select(java_hash(F.col("s")))) == [(2390779,), (63350368,)]


def test_table_function_split(spark):
    register_functions(spark)
    spark.createDataFrame([("./prod?id=100",), ("./home",), ("??",)], "url string").createOrReplaceTempView("u")
    got = rows(spark.sql("SELECT url, word, length FROM u, LATERAL my_split(url)"), "word", "length")
    assert got == [("./home", 6), ("./prod", 6), ("id=100", 6)]


def test_parse_lines_fail_and_reject(spark, tmp_path):
    lines = spark.createDataFrame([("Mary, ./home, 1000",), ("bad line",), ("Bob, ./cart, x",)], "value string")
    rej = parse_click_lines(lines, on_error="reject")
    assert rej.where("parse_error IS NULL").count() == 1
    assert rows(rej.where("parse_error IS NULL").select("user", "url", "timestamp")) == [("Mary", "./home", 1000)]
    import pytest
    with pytest.raises(Exception):
        parse_click_lines(lines.where("value LIKE 'Bob%'")).collect()


def test_csv_source_trims(spark, tmp_path):
    p = tmp_path / "click.txt"
    p.write_text("Jack, ./home, 1000\nLisa, ./cart, 2000\n")
    df = read_click_csv(spark, str(p))
    assert rows(df) == [("Jack", "./home", 1000), ("Lisa", "./cart", 2000)]


def test_rejected_lines_and_trailing_newlines(spark):
    from clickengine.functions import java_split
    from clickengine.functions.sql import register_functions
    from clickengine.sources import parse_click_lines, register_view
    lines = spark.createDataFrame([("a, ./x, 5",), ("short",), ("a,b",), ("a,b,no",), ("",)], "value string")
    got = {r.parse_error: (r.user, r.url, r.timestamp) for r in parse_click_lines(lines, on_error="reject").collect()}
    assert got == {None: ("a", "./x", 5), "short": (None,) * 3, "a,b": (None,) * 3, "a,b,no": (None,) * 3, "": (None,) * 3}
    register_functions(spark)
    by_sql = [r.word for r in spark.sql("SELECT word FROM my_split('a?b??\\n')").collect()]
    by_column = spark.createDataFrame([("a?b??\n",)], "s string").select(F.explode(java_split("s", "?")).alias("w"))
    assert by_sql == [r.w for r in by_column.collect()] == ["a", "b", "", "\n"]
    view = register_view(spark.createDataFrame([(1500,)], "ms long"), "timed", event_time="ms", time_name="rt")
    assert spark.table("timed").select(F.unix_millis("rt")).first()[0] == 1500 and "rt" in view.columns
