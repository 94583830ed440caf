"""Approximate nearest neighbours by learned partitions.

1. Fit, on a bounded sample (``SAMPLE`` distinct vectors picked by a hash, on the driver):
   the graph of nearest neighbours is halved again and again, each half with the same number
   of vectors, by the slowest mode of a walk on the graph and then by swaps that lower the
   number of cut edges.  A small classifier (one hidden layer) learns the part of a vector.
2. Index: every vector goes to its most probable part.  Parts are dealt by count: one of more
   than ``BLOCK_ROWS`` vectors is spread over as many blocks as it needs.
3. Search: a query goes to its ``probes`` most probable parts, and is compared with all vectors
   of all their blocks, in double precision on the original vectors.

``probes`` is set by the fit: the fewest parts in which the sample's own nearest neighbours are found
with a share of ``target``.  The tests hold the recall against brute force.  The number of parts
follows the number of vectors (``PART_ROWS`` each) up to ``MAX_PARTS``; beyond that parts get more
blocks, so a task stays as small as before and their number grows.

Equal vectors are one entry of the index with the smallest ids of its members (one more than the
neighbours asked for, as a query is not its own neighbour).  No neighbour is lost: each further copy
would come after these in the order of (cosine, id).  Equal queries are searched once.

Rows without an id, and vectors that are null, zero, of another length than most, or hold null or
non-finite components take no part; a query of that kind has no rows.  Rows equal in id and vector
count once; other rows with the id of the query are not its neighbours.  An empty table gives no rows,
further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickengine.llm.common import materialize

SAMPLE = 16_384       # distinct vectors that the parts are learned from
PART_ROWS = 1_024     # vectors of a part, about
MAX_PARTS = 256
BLOCK_ROWS = 4_096    # vectors of a part that a task compares at once
CHUNK_ROWS = 4_096    # queries it compares them with
GRAPH = 10            # neighbours of a vector in the graph
HIDDEN = 128


# ------------------------------------------------------------------ the learned parts

@dataclass
class Router:
    """A classifier of parts: softmax(relu(v w1 + b1) w2 + b2) of the unit vector v."""
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    probes: int = 1

    @property
    def parts(self) -> int:
        return len(self.b2)

    def scores(self, unit: np.ndarray) -> np.ndarray:
        return np.maximum(unit @ self.w1 + self.b1, 0) @ self.w2 + self.b2


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1, in single precision; scaled first, so that no length over- or underflows."""
    v = vectors.astype(np.float64)
    v /= np.abs(v).max(axis=1, keepdims=True)
    return (v / np.sqrt((v * v).sum(axis=1, keepdims=True))).astype(np.float32)


def neighbour_graph(v: np.ndarray, k: int) -> np.ndarray:
    """The k nearest other vectors of each unit vector, nearest first."""
    out = np.empty((len(v), k), np.int64)
    for i in range(0, len(v), 512):
        near = v[i:i + 512] @ v.T
        near[np.arange(len(near)), np.arange(i, i + len(near))] = -np.inf
        best = np.argpartition(-near, k - 1, axis=1)[:, :k] if k < len(v) - 1 else np.argsort(-near, axis=1)[:, :k]
        order = np.argsort(-np.take_along_axis(near, best, 1), axis=1, kind="stable")
        out[i:i + 512] = np.take_along_axis(best, order, 1)
    return out


def _halve(a: np.ndarray, b: np.ndarray, n: int, rng) -> np.ndarray:
    """Balanced halves of a graph of n vertices with edges a-b: which vertices are in the second one."""
    degree = np.bincount(a, minlength=n) + np.bincount(b, minlength=n) + 1.0

    def around(x):
        return np.bincount(a, x[b], n) + np.bincount(b, x[a], n)

    x = rng.standard_normal(n)
    for _ in range(40):
        x = (around(x) + x) / degree
        x -= (x * degree).sum() / degree.sum()
        size = np.abs(x).max()
        if size == 0:
            x = rng.standard_normal(n)
        else:
            x /= size
    side = np.zeros(n, bool)
    side[np.argsort(x, kind="stable")[n // 2:]] = True
    cut = int((side[a] != side[b]).sum())
    for _ in range(12):
        other = around(side.astype(float))          # neighbours in the second half
        gain = np.where(side, degree - 1 - 2 * other, 2 * other - (degree - 1))
        zero, one = np.flatnonzero(~side), np.flatnonzero(side)
        zero, one = zero[np.argsort(-gain[zero], kind="stable")], one[np.argsort(-gain[one], kind="stable")]
        m = min(len(zero), len(one))
        swaps = int((gain[zero[:m]] + gain[one[:m]] > 0).sum()) // 2
        if not swaps:
            break
        trial = side.copy()
        trial[zero[:swaps]], trial[one[:swaps]] = True, False
        now = int((trial[a] != trial[b]).sum())
        if now >= cut:
            break
        side, cut = trial, now
    return side


def balanced_parts(graph: np.ndarray, parts: int, seed: int = 7) -> np.ndarray:
    """A part of each vertex, ``parts`` a power of two, each with the same number of vertices (or one more)."""
    n, k = graph.shape
    rng = np.random.default_rng(seed)
    label = np.zeros(n, np.int64)
    a, b = np.repeat(np.arange(n), k), graph.ravel()
    level = 1
    while level < parts:
        nxt = label * 2
        place = np.empty(n, np.int64)
        inner = label[a] == label[b]
        ia, ib = a[inner], b[inner]
        edge_part = label[ia]
        order = np.argsort(edge_part, kind="stable")
        bounds = np.searchsorted(edge_part[order], np.arange(level + 1))
        members = np.argsort(label, kind="stable")
        at = np.searchsorted(label[members], np.arange(level + 1))
        for p in range(level):
            own = members[at[p]:at[p + 1]]
            if len(own) < 2:
                continue
            place[own] = np.arange(len(own))
            e = order[bounds[p]:bounds[p + 1]]
            nxt[own] += _halve(place[ia[e]], place[ib[e]], len(own), rng)
        label, level = nxt, level * 2
    return label


def train(v: np.ndarray, label: np.ndarray, parts: int, epochs: int = 12, seed: int = 11) -> Router:
    """The classifier, by Adam on the cross entropy in small batches."""
    rng = np.random.default_rng(seed)
    d = v.shape[1]
    weights = [rng.standard_normal((d, HIDDEN)).astype(np.float32) * np.float32(np.sqrt(2)), np.zeros(HIDDEN, np.float32),
               (rng.standard_normal((HIDDEN, parts)) / np.sqrt(HIDDEN)).astype(np.float32), np.zeros(parts, np.float32)]
    m, s = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    step = 0
    for epoch in range(epochs):
        rate = 0.004 * (1 - epoch / epochs)
        deal = rng.permutation(len(v))
        for i in range(0, len(v), 256):
            rows = deal[i:i + 256]
            x, y = v[rows], label[rows]
            w1, b1, w2, b2 = weights
            h = np.maximum(x @ w1 + b1, 0)
            z = h @ w2 + b2
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(y)), y] -= 1
            p /= len(y)
            back = (p @ w2.T) * (h > 0)
            step += 1
            for j, g in enumerate((x.T @ back, back.sum(0), h.T @ p, p.sum(0))):
                m[j] = 0.9 * m[j] + 0.1 * g
                s[j] = 0.999 * s[j] + 0.001 * g * g
                weights[j] = (weights[j] - rate * (m[j] / (1 - 0.9 ** step))
                              / (np.sqrt(s[j] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return Router(*weights)


def fit_router(vectors: np.ndarray, parts: int, k: int, target: float) -> Router:
    """Parts, classifier and number of probes from sample vectors."""
    v = unit(vectors)
    if parts < 2 or len(v) < 4 * parts:
        d = v.shape[1] if v.ndim == 2 else 1
        return Router(np.zeros((d, 1), np.float32), np.zeros(1, np.float32), np.zeros((1, 1), np.float32), np.zeros(1, np.float32))
    graph = neighbour_graph(v, min(GRAPH, len(v) - 1))
    router = train(v, balanced_parts(graph, parts), parts)
    scores = router.scores(v)
    home = scores.argmax(axis=1)
    # the place of each near neighbour's part in the order of a vector's parts
    near = graph[:, :k]
    mine = np.take_along_axis(scores, home[near], 1)
    place = np.concatenate([(scores[i:i + 1024, None, :] > mine[i:i + 1024, :, None]).sum(axis=2) for i in range(0, len(v), 1024)])
    found = np.cumsum(np.bincount(place.ravel(), minlength=parts)) / place.size
    router.probes = int(np.searchsorted(found, target) + 1)
    return router


# ------------------------------------------------------------------ on Spark

def _matrix(column: pa.Array, dim: int, kind) -> np.ndarray:
    """A matrix from a column of packed vectors."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, dim), kind)
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), dim)


def _sound(batch: pa.RecordBatch, dim: int, kind) -> tuple[np.ndarray, np.ndarray]:
    """(ids, vectors) of the rows of a batch that take part."""
    ids, vectors = batch.column(0), batch.column(1)
    has_id = np.asarray(ids.is_valid())
    sizes = np.asarray(pc.fill_null(pc.list_value_length(vectors), -1))
    rows = np.flatnonzero(has_id & (sizes == dim))
    flat = pc.list_flatten(vectors.take(pa.array(rows)))
    values = np.asarray(pc.fill_null(flat, float("nan"))).astype(kind, copy=False).reshape(len(rows), dim)
    good = np.isfinite(values).all(axis=1) & (values != 0).any(axis=1)
    return np.asarray(ids.take(pa.array(rows[good]))).astype(np.int64), values[good]


def _packed(vectors: np.ndarray) -> tuple[list[bytes], list[bytes]]:
    """Vectors as bytes, and a 256-bit digest of each."""
    raw, size = np.ascontiguousarray(vectors).tobytes(), vectors.shape[1] * vectors.itemsize
    packed = [raw[i:i + size] for i in range(0, len(raw), size)]
    return packed, [hashlib.sha256(p).digest() for p in packed]


def _top(ids: np.ndarray, score: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Positions of the first ``n`` of each row by (score descending, id), rows ascending."""
    order = np.lexsort((ids, -score, row))
    r = row[order]
    first = np.searchsorted(r, r)
    return order[np.arange(len(r)) - first < n]


def _compare(queries: np.ndarray, rows: np.ndarray, ids: list, n: int):
    """(query, id, cosine) of the first ``n`` ids of each query.  A matrix product finds who may be among
    them; their cosines are then summed the same way for every pair, so that equal ones are equal."""
    q, r = queries.astype(np.float64), rows.astype(np.float64)
    q /= np.abs(q).max(axis=1, keepdims=True)
    r /= np.abs(r).max(axis=1, keepdims=True)
    qn, rn = np.sqrt((q * q).sum(axis=1)), np.sqrt((r * r).sum(axis=1))
    size = np.array([len(x) for x in ids])
    flat, start = np.array([x for y in ids for x in y], np.int64), np.concatenate(([0], np.cumsum(size)))
    out = []
    for i in range(0, len(q), 256):
        near = (q[i:i + 256] @ r.T) / (qn[i:i + 256, None] * rn[None, :])
        k = min(n, len(r))
        least = np.partition(near, len(r) - k, axis=1)[:, len(r) - k]
        a, b = np.nonzero(near >= least[:, None] - 1e-9)
        a = a + i
        score = (q[a] * r[b]).sum(axis=1) / (qn[a] * rn[b])
        # every copy of a vector with its own id
        copies = size[b]
        pick = np.repeat(np.arange(len(a)), copies)
        member = flat[start[b][pick] + np.arange(len(pick)) - np.repeat(np.cumsum(copies) - copies, copies)]
        best = _top(member, score[pick], a[pick], n)
        out.append((a[pick][best], member[best], score[pick][best]))
    return tuple(np.concatenate(x) for x in zip(*out))


def search(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", every: int = 50, k: int = 5,
           target: float = 0.95, sample: int = SAMPLE, part_rows: int = PART_ROWS, block_rows: int = BLOCK_ROWS,
           chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """The ``k`` nearest found of each row whose ``key`` is divisible by ``every``: (query_id, rank, vec_id, score)."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(key).cast("bigint").alias("id"), F.col(vector).alias("v"))
    kind = np.float32 if dict(rows.dtypes)["v"] == "array<float>" else np.float64
    if kind is np.float64:
        rows = rows.select("id", F.col("v").cast("array<double>").alias("v"))
    lengths = rows.where(F.size("v") > 0).groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    dim = lengths.n if lengths else 1

    def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per batch: each distinct vector with its smallest ids, and whether it is a query."""
        for batch in batches:
            ids, values = _sound(batch, dim, kind)
            if not len(ids):
                continue
            packed, digest = _packed(values)
            found: dict[bytes, set] = {}
            where = {}
            asked = set()
            for i, d, at in zip(ids.tolist(), digest, range(len(ids))):
                found.setdefault(d, set()).add(i)
                where[d] = at
                if i % every == 0:
                    asked.add(d)
            yield pa.RecordBatch.from_arrays([
                pa.array(list(found), pa.binary()), pa.array([packed[where[d]] for d in found], pa.binary()),
                pa.array([sorted(s)[:k + 1] for s in found.values()], pa.list_(pa.int64())), pa.array([d in asked for d in found])],
                names=["class", "v", "ids", "asked"])

    entries = rows.mapInArrow(classes, "class binary, v binary, ids array<bigint>, asked boolean")
    merged = entries.groupBy("class").agg(
        F.first("v").alias("v"), F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, k + 1).alias("ids"),
        F.max("asked").alias("asked"))
    index = materialize(merged)
    count = index.count()

    # the sample: classes with the smallest digests
    share = F.conv(F.hex(F.substring("class", 1, 6)), 16, 10).cast("bigint")
    bound = min(1.0, sample / max(count, 1)) * 256.0 ** 6
    picked = index.where(share < F.lit(int(bound))).select("class", "v").toArrow().sort_by("class")
    parts = 1
    while parts < MAX_PARTS and parts * part_rows < count:
        parts *= 2
    router = fit_router(_matrix(picked.column("v"), dim, kind), parts, k, target)
    learned = spark.sparkContext.broadcast(router)   # at most 64 * 128 + 128 * 256 weights for 64 components

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = learned.value
        for batch in batches:
            scores = model.scores(unit(_matrix(batch.column("v"), dim, kind)))
            order = np.argsort(-scores, axis=1, kind="stable")[:, :model.probes].astype(np.int32)
            asked = np.asarray(batch.column("asked"))
            probes = [o.tolist() if q else [] for o, q in zip(order, asked)]
            yield pa.RecordBatch.from_arrays([
                batch.column("class"), batch.column("v"), batch.column("ids"), pa.array(order[:, 0]),
                pa.array(probes, pa.list_(pa.int32()))], names=["class", "v", "ids", "part", "probes"])

    routed = materialize(index.mapInArrow(route, "class binary, v binary, ids array<bigint>, part int, probes array<int>"))
    # blocks of each part's vectors, chunks of its queries (at most MAX_PARTS counts)
    stored = routed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    wanted = routed.select(F.explode("probes").alias("part")).groupBy("part").agg(F.count(F.lit(1)).alias("m"))
    deal = stored.join(wanted, "part").select("part", F.ceil(F.col("n") / block_rows).cast("int").alias("blocks"),
                                              F.ceil(F.col("m") / chunk_rows).cast("int").alias("chunks"))
    deal = F.broadcast(deal)
    spread = F.xxhash64("class")
    left = (routed.select("class", "v", "ids", "part").join(deal, "part")
            .withColumn("block", F.pmod(spread, F.col("blocks")).cast("int"))
            .withColumn("chunk", F.explode(F.expr("sequence(0, chunks - 1)")))
            .select(F.col("part").alias("p"), "block", "chunk", F.col("v").alias("w"), "ids"))
    right = (routed.select("class", F.col("v").alias("q"), F.explode("probes").alias("part")).join(deal, "part")
             .withColumn("chunk", F.pmod(spread, F.col("chunks")).cast("int"))
             .withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)")))
             .select(F.col("part").alias("p"), "block", "chunk", "class", "q"))

    def compare(one: pa.Table, two: pa.Table) -> pa.Table:
        schema = pa.schema([("class", pa.binary()), ("found", pa.list_(pa.struct([("far", pa.float64()), ("id", pa.int64())])))])
        if not one.num_rows or not two.num_rows:
            return schema.empty_table()
        a, ids, score = _compare(_matrix(two.column("q"), dim, kind), _matrix(one.column("w"), dim, kind),
                                 one.column("ids").to_pylist(), k + 1)
        cut = np.append(np.flatnonzero(np.append(True, a[1:] != a[:-1])), len(a)).astype(np.int32)
        pairs = pa.StructArray.from_arrays([pa.array(-score), pa.array(ids)], names=["far", "id"])
        return pa.Table.from_arrays([two.column("class").combine_chunks().take(pa.array(a[cut[:-1]])),
                                     pa.ListArray.from_arrays(pa.array(cut), pairs)], schema=schema)

    cell = ["p", "block", "chunk"]
    near = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(compare, "class binary, found array<struct<far: double, id: bigint>>")
    best = near.groupBy("class").agg(F.slice(F.array_sort(F.flatten(F.collect_list("found"))), 1, k + 1).alias("found"))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, values = _sound(batch, dim, kind)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(_packed(values)[1], pa.binary())], names=["query_id", "class"])

    asked = rows.where(F.col("id") % every == 0).mapInArrow(ask, "query_id bigint, class binary").distinct()
    others = F.slice(F.filter("found", lambda x: x["id"] != F.col("query_id")), 1, k)
    return (asked.join(best, "class").select("query_id", F.posexplode(others).alias("rank", "o"))
            .select("query_id", (F.col("rank") + 1).alias("rank"), F.col("o.id").alias("vec_id"), (-F.col("o.far")).alias("score")))
