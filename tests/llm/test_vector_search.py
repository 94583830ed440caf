"""Nearest neighbours against brute force: exact with one part, recall with learned ones."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickengine.llm import vector_search as VS
from clickengine.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, every=50, k=5):
    """{(query id, vector): [(id, cosine), ...]} over the rows that take part."""
    good = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        good[i, tuple(v)] = np.array(v, np.float32).astype(float)
    out = {}
    for (i, v), a in good.items():
        if i % every:
            continue
        near = [(-float((a * b).sum() / np.sqrt((a * a).sum()) / np.sqrt((b * b).sum())), j) for (j, _), b in good.items() if j != i]
        out[i, v] = [(j, -s) for s, j in sorted((round(s, 12), j) for s, j in near)[:k]]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return out


def same(got, want):
    assert {q: [(n + 1, j) for n, (j, _) in enumerate(w)] for q, w in want.items() if w} == {q: [x[:2] for x in g] for q, g in got.items()}
    for q, w in want.items():
        assert np.allclose([s for _, s in w], [x[2] for x in got.get(q, [])], atol=1e-12)


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(6).astype(np.float32).tolist()) for i in range(120)]
    rows += [(200 + i, rows[3][1]) for i in range(60)]                      # copies, two of them queries
    rows += [(i, (np.array(rows[7][1]) * 2).tolist()) for i in (301, 302)]  # equal cosines, ties by id
    rows += [(None, rows[1][1]), (400, None), (450, []), (500, [0.0] * 6), (550, [1.0, None, 1.0, 1.0, 1.0, 1.0]),
             (600, [float("nan")] * 6), (650, [float("inf")] * 6), (700, [1.0, 2.0])]
    rows += [rows[0]] * 5
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = found(VS.search(df.withColumn("class", F.lit(1)).withColumn("part", F.lit("x")), block_rows=40, chunk_rows=2))
    want = {q: w for (q, _), w in brute([r for r in rows if r[1] is None or len(r[1]) == 6]).items()}
    same(got, want)
    assert set(got) == {0, 50, 100, 200, 250}


def test_few_rows_and_none(spark):
    assert VS.search(spark.createDataFrame([], SCHEMA)).collect() == []
    one = spark.createDataFrame([(0, [1.0, 2.0])], SCHEMA)
    assert VS.search(one).collect() == []
    two = spark.createDataFrame([(0, [1.0, 2.0]), (1, [2.0, 1.0]), (50, [-1.0, -2.0])], SCHEMA)
    same(found(VS.search(two)), {q: w for (q, _), w in brute([(0, [1.0, 2.0]), (1, [2.0, 1.0]), (50, [-1.0, -2.0])]).items()})


def test_learned_parts_reach_recall(spark):
    """Clustered vectors, learned from a sample smaller than the table; a third of the rows is one vector."""
    rng = np.random.default_rng(9)
    centres = rng.standard_normal((40, 16)) * 3
    vectors = (centres[rng.integers(0, 40, 6000)] + rng.standard_normal((6000, 16))).astype(np.float32)
    vectors[rng.permutation(6000)[:2000]] = vectors[0]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], SCHEMA).repartition(6)
    got = found(VS.search(df, sample=1500, part_rows=250))
    u = VS.unit(vectors).astype(float)
    hits = 0
    for q in range(0, 6000, 50):
        score = np.round(u @ u[q], 6)
        score[q] = -9
        want = np.lexsort((np.arange(6000), -score))[:5]
        hits += sum(score[j] >= score[want[-1]] for _, j, _ in got[q])
        assert [r for r, _, _ in got[q]] == [1, 2, 3, 4, 5]
    assert hits >= 0.9 * 5 * 120


def test_parts_are_balanced_and_learnable():
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((16, 12)) * 4
    v = VS.unit((centres[np.arange(3200) % 16] + rng.standard_normal((3200, 12))).astype(np.float32))
    label = VS.balanced_parts(VS.neighbour_graph(v, 10), 16)
    assert np.bincount(label).tolist() == [200] * 16
    graph = VS.neighbour_graph(v, 10)
    assert (label[graph] == label[:, None]).mean() > 0.9
    router = VS.train(v, label, 16)
    assert (router.scores(v).argmax(axis=1) == label).mean() > 0.9


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_query_recall(spark, sf):
    d = f"/root/testdata/{sf}"
    got = found(QUERIES["op11_vector_search"](spark, d))
    rows = spark.read.parquet(f"{d}/embeddings.parquet").orderBy("vec_id").collect()
    want = brute([(r.vec_id, list(r.embedding)) for r in rows])
    hits = sum(len({j for j, _ in w} & {j for _, j, _ in got[q]}) for (q, _), w in want.items())
    assert len(got) == len(want) and hits >= 0.9 * sum(map(len, want.values()))
