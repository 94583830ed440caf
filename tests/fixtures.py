"""Inline inputs of the reference programs (FIXTURES.md), times in epoch ms."""

from pyspark.sql import functions as F

WORDS = ["hello world", "hello bigdata", "hello flink", "hi spark"]

CLICK_TXT = [  # (seq, user, url, ts)
    (1, "Jack", "./home", 1000), (2, "Lisa", "./cart", 2000), (3, "Bob", "./prod?id=100", 3000),
    (4, "Tom", "./cart", 4000), (5, "Tom", "./home", 5000), (6, "Jack", "./home", 6000),
    (7, "Bob", "./cart", 7000), (8, "Tom", "./home", 8000), (9, "Tom", "./prod?id=10", 9000),
    (10, "Bob", "./cart", 11000), (11, "Tom", "./home", 12000),
]

EVENTS_A = [  # (user, url, ts), arrival order A
    ("Mary", "./home", 1000), ("Bob", "./cart", 2000), ("Alice", "./prod?id=100", 3000),
    ("Bob", "./prod?id=1", 3300), ("Bob", "./home", 3500), ("Alice", "./prod?id=200", 3200),
    ("Bob", "./prod?id=2", 3800), ("Bob", "./prod?id=3", 4200),
]
EVENTS_B = [EVENTS_A[i] for i in (0, 1, 2, 3, 5, 4, 6, 7)]


def clicks(spark, data=CLICK_TXT):
    """click.txt as (seq, user_name, url, ts ms, et timestamp)."""
    df = spark.createDataFrame(data, "seq long, user_name string, url string, ts long")
    return df.withColumn("et", F.timestamp_millis("ts"))


def events(spark, data=EVENTS_A):
    """Event rows with arrival ``seq`` (1-based) and ``et`` timestamp."""
    rows = [(i + 1, u, url, t) for i, (u, url, t) in enumerate(data)]
    df = spark.createDataFrame(rows, "seq long, user string, url string, timestamp long")
    return df.withColumn("et", F.timestamp_millis("timestamp"))
