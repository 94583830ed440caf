"""Quality by co-training: a text classifier and a page classifier teach each other.

The text view is a hashed byte n-gram profile; the page view is what is known about a document
without its wording: language, source, size and layout.  Both start from labelled documents.
In each round both views score every unlabelled document, on Spark, and each labels those it is
surest about for the other view.  At the end each view's scores are calibrated on labelled
documents that no round has seen, and the calibrated views are combined.

What is fitted is bounded: ``LABELLED`` labelled documents, and ``TAKEN`` documents a view, class
and round that a view has labelled.  They are picked from all documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickengine.llm.common import SPACE, blocks, text_buffer

#: Labelled documents used for fitting: the first by a hash of their ids.
LABELLED = 3000
#: Buckets of the text view's n-grams.
FEATURES = 1024
#: Buckets of a category of the page view.
CATEGORIES = 32
ROUNDS = 3
#: A view passes on the surest documents of a class and round: at most this share of all, at
#: most so many, and only above this certainty.
SHARE, TAKEN, SURE = 0.05, 300, 0.95
#: The surest are ranked in so many buckets of documents first.
BUCKETS = 64
#: One of so many labelled documents is kept for calibration.
HELD_OUT = 4
#: Documents with a lower probability of good quality aren't kept.
KEEP = 0.2

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[b for b in range(33, 127) if not chr(b).isalnum()]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True


def _shares(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(table[data])))
    return (total[offsets[1:]] - total[offsets[:-1]]) / np.maximum(np.diff(offsets), 1)


def text_view(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Square roots of the shares of each bucket among a text's byte 4-grams."""
    n = len(offsets) - 1
    out = np.zeros((n, FEATURES), np.float32)
    if len(data) < 4:
        return out
    d = data.astype(np.uint32)
    gram = d[:-3] | d[1:-2] << np.uint32(8) | d[2:-1] << np.uint32(16) | d[3:] << np.uint32(24)
    bucket = (gram * np.uint32(0x9E3779B1) >> np.uint32(22)).astype(np.int64)
    text = np.repeat(np.arange(n), np.diff(offsets))
    same = text[:-3] == text[3:]
    counts = np.bincount(text[:-3][same] * FEATURES + bucket[same], minlength=n * FEATURES).reshape(n, FEATURES)
    return np.sqrt(counts / np.maximum(counts.sum(1, keepdims=True), 1)).astype(np.float32)


def page_view(data: np.ndarray, offsets: np.ndarray, lang: list, source: list) -> np.ndarray:
    """Size, layout, language and source of each document."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    newline = np.zeros(256, bool)
    newline[10] = True
    layout = [np.log1p(size) / 10, *(_shares(data, offsets, t) * k for t, k in (
        (SPACE, 3), (newline, 30), (_SYMBOL, 3), (_UPPER, 3), (_DIGIT, 10)))]
    out = np.zeros((n, len(layout) + 2 * CATEGORIES), np.float32)
    out[:, :len(layout)] = np.stack(layout, 1)
    for k, values in enumerate((lang, source)):
        at = [zlib.crc32((v or "").encode()) % CATEGORIES for v in values]
        out[np.arange(n), len(layout) + k * CATEGORIES + np.array(at, np.int64)] = 1
    return out


@dataclass(frozen=True)
class Linear:
    """A logistic classifier."""
    weights: np.ndarray
    bias: float

    def logit(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights + self.bias


def fit_linear(x: np.ndarray, y: np.ndarray, ridge: float = 1e-4, steps: int = 200) -> Linear:
    """Logistic regression by accelerated gradient steps on standardised features."""
    mean, spread = x.mean(0), x.std(0) + 1e-3
    z = ((x - mean) / spread).astype(np.float64)
    z = np.concatenate((z, np.ones((len(z), 1))), 1)
    top = np.ones(z.shape[1])
    for _ in range(30):  # the largest curvature, by power iteration
        top = z.T @ (z @ (top / np.linalg.norm(top)))
    rate = 3.6 / (np.linalg.norm(top) / len(z) + ridge)
    w, ahead = np.zeros(z.shape[1]), np.zeros(z.shape[1])
    for k in range(steps):
        slope = z.T @ (1 / (1 + np.exp(-np.clip(z @ ahead, -30, 30))) - y) / len(z) + ridge * ahead
        new = ahead - rate * slope
        ahead = new + k / (k + 3) * (new - w)
        w = new
    return Linear(w[:-1] / spread, float(w[-1] - (w[:-1] * mean / spread).sum()))


@dataclass(frozen=True)
class Model:
    """The two views, and their calibrated combination."""
    text: Linear
    page: Linear
    scale: tuple[Linear, Linear]
    both: Linear

    def scores(self, text: np.ndarray, page: np.ndarray) -> list[np.ndarray]:
        """Calibrated probabilities of the text view, the page view and both."""
        logits = np.stack([s.logit(v.logit(x)[:, None]) for s, v, x in
                           zip(self.scale, (self.text, self.page), (text, page))], 1)
        return [1 / (1 + np.exp(-np.clip(v, -30, 30))) for v in (logits[:, 0], logits[:, 1], self.both.logit(logits))]


#: (text rows, page rows) of the documents that view v (0: text, 1: page) is surest to be of class c.
Surest = dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]


def co_train(text: np.ndarray, page: np.ndarray, label: np.ndarray,
             surest: Callable[[tuple[Linear, Linear]], Surest]) -> Model:
    """Fit on labelled rows of both views (label 1 or 0).  ``surest`` is called once a round with the
    text and the page classifier, and doesn't give a document twice."""
    views = (text, page)
    held = np.arange(len(label)) % HELD_OUT == 0
    x, y = [v[~held] for v in views], [label[~held]] * 2
    for _ in range(ROUNDS):
        picked = surest((fit_linear(x[0], y[0]), fit_linear(x[1], y[1])))
        for (view, value), rows in sorted(picked.items(), key=lambda p: p[0]):
            x[1 - view] = np.concatenate((x[1 - view], rows[1 - view]))
            y[1 - view] = np.concatenate((y[1 - view], np.full(len(rows[0]), value)))
    models = [fit_linear(*xy) for xy in zip(x, y)]
    logits = [m.logit(v[held]) for m, v in zip(models, views)]
    scale = tuple(fit_linear(z[:, None], label[held], 1e-3) for z in logits)
    calibrated = np.stack([s.logit(z[:, None]) for s, z in zip(scale, logits)], 1)
    return Model(*models, scale, fit_linear(calibrated, label[held], 1e-3))


def most_taken(documents: int) -> int:
    """How many documents a view passes on a class and round."""
    return max(1, min(TAKEN, int(SHARE * documents)))


def _views(batch: pa.RecordBatch, at: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(i, j, text view, page view) of the rows of a batch; columns from ``at``: text, lang, source."""
    data, offsets = text_buffer(batch.column(at))
    lang, source = batch.column(at + 1).to_pylist(), batch.column(at + 2).to_pylist()
    for i, j in blocks(offsets):
        d, o = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        yield i, j, text_view(d, o), page_view(d, o, lang[i:j], source[i:j])


def _select(docs: DataFrame, key: str, text: str, lang: str, source: str) -> DataFrame:
    return docs.select(F.col(key).alias("k"), *[F.col(c).cast("string").alias(n) for c, n in
                                                ((text, "text"), (lang, "lang"), (source, "source"))])


def _with_views(rows: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and both views (t, p: float32 bytes) of rows with text, lang and source."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, t, p in _views(batch, len(keep)):
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).slice(i, j - i) for c in range(len(keep))],
                     *[pa.array([r.tobytes() for r in v.astype(np.float32)], pa.binary()) for v in (t, p)]],
                    [*keep, "t", "p"])

    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.select(*keep, "text", "lang", "source").mapInArrow(run, f"{kinds}, t binary, p binary")


def _stack(rows: list) -> tuple[np.ndarray, np.ndarray]:
    text, page = (np.stack([np.frombuffer(r[c], np.float32) for r in rows]) for c in "tp")
    return text, page


def _pool(rows: DataFrame, known: DataFrame, most: int) -> Callable[[tuple[Linear, Linear]], Surest]:
    """``surest`` over all unlabelled rows.  A document is its features: rows of the same text,
    language and source (x, a hash of them) are one, and one that was taken isn't given again.

    A round reads the documents twice: to score them, which leaves a few numbers of those that a
    view is sure of, and for the views of the ones that are taken."""
    rows = rows.withColumn("x", F.xxhash64(F.coalesce("text", F.lit("")), F.coalesce("lang", F.lit("")),
                                           F.lit("|"), F.coalesce("source", F.lit(""))))
    bar = float(np.log(SURE / (1 - SURE)))
    gone = np.zeros(0, np.int64)

    def surest(models: tuple[Linear, Linear]) -> Surest:
        nonlocal gone
        seen = gone  # at most ROUNDS * 4 * TAKEN numbers

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i, j, t, p in _views(batch, 2):
                    logit = [m.logit(v).astype(np.float64) for m, v in zip(models, (t, p))]
                    x = np.asarray(batch.column(1).slice(i, j - i))
                    sure = np.flatnonzero((np.maximum(*map(np.abs, logit)) >= bar) & ~np.isin(x, seen))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(i, j - i).take(pa.array(sure)), pa.array(x[sure]),
                         *[pa.array(z[sure]) for z in logit]], ["k", "x", "t", "p"])

        kind = rows.schema["k"].dataType.simpleString()
        scored = rows.select("k", "x", "text", "lang", "source").mapInArrow(run, f"k {kind}, x long, t double, p double")
        # Text hashes pick the same documents wherever they lie; the surest come first.
        free = scored.join(known.select("k"), "k", "left_anti").groupBy("x").agg(F.min("t").alias("t"), F.min("p").alias("p"))
        sides = [F.struct(F.lit(v).alias("v"), F.lit(c).alias("c"), (F.col(n) * (2 * c - 1)).alias("sure"))
                 for v, n in enumerate("tp") for c in (0, 1)]
        sides = free.select("x", F.inline(F.array(*sides))).where(F.col("sure") >= bar)
        order = [F.desc("sure"), "x"]
        first = Window.partitionBy("v", "c", F.pmod("x", F.lit(BUCKETS))).orderBy(*order)
        top = sides.withColumn("n", F.row_number().over(first)).where(F.col("n") <= most).drop("n")
        top = top.withColumn("n", F.row_number().over(Window.partitionBy("v", "c").orderBy(*order))).where(F.col("n") <= most)
        picks = top.select("x", "v", "c", "n").collect()  # 4 * TAKEN rows of numbers
        if not picks:
            return {}
        gone = np.union1d(gone, np.array([r.x for r in picks], np.int64))
        wanted = rows.sparkSession.createDataFrame([(x,) for x in {r.x for r in picks}], "x long")
        found = _with_views(rows.join(F.broadcast(wanted), "x", "left_semi"), ["x"])
        views = {r.x: r for r in found.groupBy("x").agg(F.min(F.struct("t", "p")).alias("s")).select("x", "s.*").collect()}
        by: dict[tuple[int, int], list] = {}
        for r in sorted(picks, key=lambda r: r.n):
            by.setdefault((r.v, r.c), []).append(views[r.x])
        return {side: _stack(v) for side, v in by.items()}

    return surest


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
        source: str = "source", quality: str = "quality") -> Model | None:
    """The co-trained model; None if the labelled documents aren't of both classes.

    Rows of a null id, or a null quality, aren't labelled; an id with several labels has the
    smallest, and a labelled id with several texts stands for one of them.
    """
    rows = _select(docs, key, text, lang, source)
    known = (labels.where(F.col(key).isNotNull() & F.col(quality).isNotNull())
             .groupBy(F.col(key).alias("k")).agg(F.min((F.col(quality) > 0).cast("int")).alias("y")))
    there = known.join(rows.select("k"), "k", "left_semi")
    sample = F.broadcast(there.orderBy(F.xxhash64("k"), "k").limit(LABELLED))
    seen = _with_views(rows.join(sample, "k"), ["k", "y"])
    one = seen.groupBy("k", "y").agg(F.min(F.struct("t", "p")).alias("s")).select("k", "y", "s.*")
    got = sorted(one.collect(), key=lambda r: r.k)  # LABELLED rows
    label = np.array([r.y for r in got], np.int64)
    if len({*label.tolist()}) < 2:
        return None
    return co_train(*_stack(got), label, _pool(rows, known, most_taken(docs.count())))


def score(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text", lang: str = "lang",
          source: str = "source", keep: float = KEEP) -> DataFrame:
    """``key``, text_score, page_score, score (probabilities of good quality) and kept of every row.

    Null or empty texts have no n-grams and size 0, a null language or source is one of its own;
    repeated rows are scored each; without a model the scores are null and all rows are kept.
    """
    rows = _select(docs, key, text, lang, source)
    kind = rows.schema["k"].dataType.simpleString()
    if model is None:
        none = F.lit(None).cast("double")
        return rows.select(F.col("k").alias(key), none.alias("text_score"), none.alias("page_score"),
                           none.alias("score"), F.lit(True).alias("kept"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, t, p in _views(batch, 1):
                out = model.scores(t, p)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), *map(pa.array, out), pa.array(out[2] >= keep)],
                    ["k", "text_score", "page_score", "score", "kept"])

    scored = rows.mapInArrow(run, f"k {kind}, text_score double, page_score double, score double, kept boolean")
    return scored.withColumnRenamed("k", key)
