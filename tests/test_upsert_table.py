"""Upsert table: append-only deltas, folding, replay, snapshots."""

import os
import random

import pytest
from pyspark.sql import functions as F

from clickengine.operators import aggregates as AG
from clickengine.sinks import UpsertTable
from clickengine.streaming.replay import slice_by
from tests.conftest import SF_SMALL, rows

SCHEMA = "k string, v string, o long"


def _table(spark, path, **kw):
    return UpsertTable(spark, str(path), ["k"], "o", SCHEMA, **kw)


def _files(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


@pytest.mark.parametrize("kw", [{}, {"max_deltas": 2}, {"max_deltas": 3, "bucket_rows": 20}])
def test_random_batches(spark, tmp_path, kw):
    """Whatever was folded when, the newest row of each key is read; null keys and orders, late and repeated rows."""
    rng = random.Random(1)
    t, best = _table(spark, tmp_path / "t", **kw), {}
    for i in range(9):
        batch = [(rng.choice([None, *"abcdefghijklmnop"]), f"{i}-{j}", rng.choice([None, rng.randint(0, 10_000) * 100 + j])) for j in range(12)]
        batch = [b for n, b in enumerate(batch) if b[2] is not None or b[0] not in [x[0] for x in batch[:n]]]
        t.write(spark.createDataFrame(batch, SCHEMA), i)
        for k, v, o in batch:
            old = best.get(k)
            if old is None or (o is not None and (old[1] is None or o >= old[1])):
                best[k] = (v, o)
        if i % 4 == 3:
            got = {r.k: (r.v, r.o) for r in t.read().collect()}
            assert {k: x[1] for k, x in got.items()} == {k: x[1] for k, x in best.items()}
            assert all(got[k] == best[k] for k in got if best[k][1] is not None)
    assert t.read().count() == len(best)


def test_small_batches_rewrite_nothing(spark, tmp_path):
    path = tmp_path / "t"
    t = _table(spark, path, bucket_rows=1000, max_deltas=4)
    t.write(spark.range(5000).selectExpr("cast(id as string) k", "'old' v", "0L o"))
    m = t._manifest()
    assert m["base_rows"] == 5000
    base = {f: x for f, x in _files(path).items() if "/base/" in f}
    assert len(base) == 5                       # files grow in number with the table
    for i in range(6):
        t.write(spark.createDataFrame([(str(i), f"n{i}", 1), (f"x{i}", "new", 1)], SCHEMA))
    after = _files(path)
    assert all(after[f] == x for f, x in base.items()) and t._manifest()["base"] == m["base"]
    assert len(t._manifest()["runs"]) == 1
    got = t.read()
    assert got.count() == 5006 and rows(got.where("o = 1 and v != 'new'").select("k", "v")) == [(str(i), f"n{i}") for i in range(6)]
    t.compact()
    assert t._manifest()["runs"] == [] and t._manifest()["base_rows"] == 5006 and t.read().count() == 5006
    assert any(f.startswith("base/") for f in t.garbage()) and t._manifest()["base"] not in t.garbage()


def test_replayed_batches_and_snapshots(spark, tmp_path):
    t = _table(spark, tmp_path / "t", max_deltas=2)
    one = spark.createDataFrame([("a", "x", 1), ("a", "y", 2)], SCHEMA)
    t.write(one, 0)
    t.write(one, 0)
    before = t.read()
    t.write(spark.createDataFrame([("a", "z", 3), ("b", "z", 3)], SCHEMA), 1)   # folds both
    t.write(one, 0)                                                             # folded long ago
    assert rows(t.read()) == [("a", "z", 3), ("b", "z", 3)]
    assert rows(before.select("k")) == [("a",)]
    t.write(spark.createDataFrame([], SCHEMA))
    assert t.read().count() == 2
    assert _table(spark, tmp_path / "none").read().collect() == []


def test_runs_grow_in_size(spark, tmp_path):
    """Deltas are folded with runs of their own size only: their number stays logarithmic."""
    t = _table(spark, tmp_path / "t", bucket_rows=10_000, max_deltas=2)
    for i in range(16):
        t.write(spark.range(i * 10, i * 10 + 10).selectExpr("cast(id as string) k", "'v' v", "id o"), i)
    m = t._manifest()
    assert t.read().count() == 160 and sum(m["run_rows"]) + m["base_rows"] >= 140 and len(m["runs"]) <= 4


def test_stream_is_the_batch_form(spark, tmp_path):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").select(F.col("user_id").cast("string").alias("k"), F.col("event_type").alias("v"),
                                                                 F.col("event_id").alias("o"))
    src = tmp_path / "in"
    t = _table(spark, tmp_path / "t", max_deltas=2)
    stream = None
    for part in slice_by(ev, "o", 4):
        part.write.mode("append").parquet(str(src))
        stream = stream or spark.readStream.schema(ev.schema).parquet(str(src))
        t.sink(stream, str(tmp_path / "ck"), availableNow=True).awaitTermination(120)
    assert rows(t.read().select("k", "v")) == rows(AG.latest_by_key(ev, "k", "v", "o"))
