"""Quality rules: counts with fixed limits, then a hashed n-gram likelihood ratio.

Byte 4-grams of a text are hashed to buckets.  Two multinomials over the buckets, one of
trusted documents and one of the whole corpus, give each bucket a log-likelihood ratio; a
document's score is the mean over its n-grams, so that length doesn't matter.  A document
fails by the fixed limits or by a score below the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickengine.llm.common import SPACE, PrefixHash, blocks, mix, text_buffer, word_bounds

#: Buckets of the hashed n-grams (a power of two): the size of the model.
BUCKETS = 1 << 16
#: Pseudo-count of every bucket.
SMOOTHING = 0.5
#: Documents whose mean log ratio is below fail.
MIN_SCORE = -0.25

MIN_WORDS, MAX_REPEATED_PERCENT, WINDOW = 20, 30, 8

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_N = 4

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Model:
    """Log ratio of each bucket, and the score below which a document fails."""
    ratio: np.ndarray
    min_score: float


def _grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, first): the bucket of every n-gram, and the index of each text's first one."""
    n = np.maximum(np.diff(offsets) - _N + 1, 0)
    if len(data) < _N:
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    d = data.astype(np.uint64)
    value = d[:-3] | d[1:-2] << np.uint64(8) | d[2:-1] << np.uint64(16) | d[3:] << np.uint64(24)
    bucket = (value * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BUCKETS.bit_length() + 1)
    inside = np.ones(len(bucket), bool)  # an n-gram that starts near a text's end would cross it
    for back in range(1, _N):
        at = offsets[1:] - back
        at = at[(at >= 0) & (at < len(bucket))]
        inside[at] = False
    return bucket[inside].astype(np.int64), np.concatenate(([0], np.cumsum(n)))


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values)))
    return total[first[1:]] - total[first[:-1]]


def _repeats(keys: np.ndarray) -> np.ndarray:
    """True where a key occurs twice or more."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    same = np.zeros(len(k) + 1, bool)
    same[1:-1] = k[1:] == k[:-1]
    out = np.zeros(len(k), bool)
    out[order] = same[1:] | same[:-1]
    return out


def _repeated_before(keys: np.ndarray) -> np.ndarray:
    """True where an equal key stands earlier."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    out = np.zeros(len(k), bool)
    out[order[1:]] = k[1:] == k[:-1]
    return out


def count_block(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of each text of a block of bytes."""
    n = len(offsets) - 1
    prefix = PrefixHash(data)
    start, end, first = word_bounds(data, offsets, SPACE)
    n_words = np.diff(first)
    space = SPACE[data]
    chars = _sums(~space & ((data & 0xC0) != 0x80), offsets)
    symbols = _sums(_SYMBOL[data], offsets)

    newline = np.zeros(256, bool)
    newline[10] = True
    l_start, l_end, l_first = word_bounds(data, offsets, newline)
    l_text = np.repeat(np.arange(n), np.diff(l_first))
    filled = np.concatenate(([0], np.cumsum(~space)))
    worded = filled[l_end] > filled[l_start]
    l_key = mix(prefix.of(l_start, l_end) + (l_text * 0x9E3779B1 + (l_end - l_start)).astype(np.uint64))
    dup = np.zeros(len(l_key), bool)
    dup[worded] = _repeated_before(l_key[worded])

    repeated = np.zeros(n, np.int64)
    if len(start) >= WINDOW:
        h = prefix.of(start, end) + (end - start).astype(np.uint64)
        text_of = np.repeat(np.arange(n), n_words)
        m = len(h) - WINDOW + 1
        key = np.zeros(m, np.uint64)
        for k in range(WINDOW):
            key = key * np.uint64(0xD6E8FEB86659FD93) + h[k:k + m]
        whole = np.flatnonzero(text_of[:m] == text_of[WINDOW - 1:])
        key = mix(key[whole] + text_of[whole].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        twice = whole[_repeats(key)]
        step = np.zeros(len(h) + 1, np.int64)
        np.add.at(step, twice, 1)
        np.add.at(step, twice + WINDOW, -1)
        repeated = _sums(np.cumsum(step[:-1]) > 0, first)
    return {"n_words": n_words, "word_chars": chars, "n_symbols": symbols,
            "n_dup_lines": _sums(dup, l_first), "n_repeat_words": repeated}


def _judge(column: pa.Array, model: Model) -> dict[str, np.ndarray]:
    """Counts, score and verdict of each text of an Arrow column."""
    data, offsets = text_buffer(column)
    parts: list[dict] = []
    for i, j in blocks(offsets):
        block, at = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        part = count_block(block, at)
        bucket, first = _grams(block, at)
        total = _sums(model.ratio[bucket], first)
        part["score"] = total / np.maximum(np.diff(first), 1)
        parts.append(part)
    names = [*COUNTS, "score"]
    out = {k: np.concatenate([p[k] for p in parts]) if parts else np.zeros(0) for k in names}
    out["base_failed"] = (out["n_words"] < MIN_WORDS) | (
        100 * out["n_repeat_words"] > MAX_REPEATED_PERCENT * out["n_words"])
    out["kept"] = ~out["base_failed"] & (out["score"] >= model.min_score)
    return out


def trusted_ids(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """The distinct ids (column k) of good, non-toxic labelled documents."""
    good = labels.where((F.col("quality") == 1) & (F.col("toxic") == 0) & F.col(key).isNotNull())
    return good.select(F.col(key).alias("k")).distinct()


def _count(texts: DataFrame) -> np.ndarray:
    """How often each bucket occurs among the n-grams of a column of texts.  Each task adds up
    its own buckets, so at most ``BUCKETS`` rows a task are shuffled, and ``BUCKETS`` rows reach
    the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            data, offsets = text_buffer(batch.column(0))
            for i, j in blocks(offsets):
                bucket, _ = _grams(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                total += np.bincount(bucket, minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    rows = texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(BUCKETS)
    out[rows.bucket] = rows.n
    return out


def fit(docs: DataFrame, trusted: DataFrame, min_score: float = MIN_SCORE, key: str = "doc_id",
        text: str = "text") -> Model:
    """The log ratios: n-grams of all documents against those of the trusted ones.

    ``trusted`` has the ids in column k.  They may be any number: documents are dealt out by id
    and met with them task by task, without a broadcast.  Null ids are never trusted; no trusted n-grams, or no
    documents, give ratios of zero: every score is then 0.
    """
    rows = docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))
    raw = _count(rows.select("t"))
    target = _count(rows.where("k is not null").join(trusted.hint("shuffle_hash"), "k", "left_semi").select("t"))
    if target.sum() == 0:
        return Model(np.zeros(BUCKETS), min_score)
    share = [(c + SMOOTHING) / (c.sum() + SMOOTHING * BUCKETS) for c in (target, raw)]
    return Model(np.log(share[0]) - np.log(share[1]), min_score)


def judge(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, the counts, base_failed, kept and score of every row.

    A null or empty text has no words and fails; repeated rows are judged each; other
    columns aren't read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = _judge(batch.column(1), model)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(got[c].astype(np.int64)) for c in COUNTS],
                 pa.array(got["base_failed"]), pa.array(got["kept"]), pa.array(got["score"].astype(float))],
                [key, *COUNTS, "base_failed", "kept", "score"])

    kind = docs.select(key).schema[0].dataType.simpleString()
    schema = f"`{key}` {kind}, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, kept boolean, score double"
    return docs.select(key, F.col(text).cast("string")).mapInArrow(run, schema)


def keep(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows that pass, with all their columns."""
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_judge(batch.column(at), model)["kept"]))

    return docs.mapInArrow(run, docs.schema)
