"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickengine.session import checkpoint_dir, ship_package
from clickengine.sources.tables import load_table

#: Texts are handled in blocks of about so many bytes, so that the arrays of a
#: block stay small whatever the size of an Arrow batch (one text is never cut).
BLOCK_BYTES = 1 << 20

#: Bytes that end a word: space, tab, LF, VT, FF, CR.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

#: Lower-cases A-Z only.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the driver; the workers can import this package from then on."""
    ship_package(spark)
    return load_table(spark, sf_dir, name)


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage: write the rows as a table in the shared checkpoint folder and read it.
    Later steps read only the columns they need, and a lost executor costs a re-reading."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/table-{uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ranked(df: DataFrame, group: str, bucket: Column, order: list, name: str) -> DataFrame:
    """Number the rows of each ``group`` from 0 without gaps.

    A group may hold any share of the rows, so it is numbered in buckets: a row
    number inside (group, bucket) plus the number of rows in the group's earlier
    buckets.  The bucket counts are a small table that joins on the same keys the
    row numbers are partitioned by, so the rows are shuffled once.  Null groups
    aren't supported.
    """
    rows = df.withColumn("_bucket", bucket)
    counts = rows.groupBy(F.col(group).alias("_g"), F.col("_bucket").alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_g").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_g", "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy(group, "_bucket").orderBy(*order))
    numbered = rows.withColumn("_row", inside)
    joined = numbered.join(offsets, (F.col(group) == F.col("_g")) & (F.col("_bucket") == F.col("_b")))
    return (joined.withColumn(name, F.col("_before") + F.col("_row") - 1)
            .drop("_bucket", "_g", "_b", "_before", "_row"))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column: text i is bytes[offsets[i]:offsets[i + 1]].
    Nulls count as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def blocks(offsets: np.ndarray, size: int = BLOCK_BYTES):
    """Ranges (i, j) of texts with about ``size`` bytes together, at least one text each."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        yield i, j
        i = j


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: spreads every input bit over the whole word."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class PrefixHash:
    """Polynomial prefix hashes modulo 2**64 of a block of bytes: the hash of any
    range is a difference of two prefix sums, scaled to be independent of where the
    range lies.  Bytes first go through a table of 64-bit values made from ``seed``."""

    _powers: dict = {}

    def __init__(self, data: np.ndarray, seed: int = 1):
        base = (0x9E3779B97F4A7C15 * (2 * seed + 1)) % 2**64 | 5
        rng = np.random.default_rng(seed)
        table = rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        up, self.down = self._power(base, len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(table[data] * up[:len(data)], out=self.sums[1:])

    @classmethod
    def _power(cls, base: int, n: int):
        """Powers of the base and of its inverse, kept by the worker process."""
        if base not in cls._powers or len(cls._powers[base][0]) < n:
            size = max(n, BLOCK_BYTES + 1024)
            pair = []
            for b in (base, pow(base, -1, 2**64)):
                p = np.empty(size, np.uint64)
                p[0] = 1
                done = 1
                while done < size:
                    more = min(done, size - done)
                    p[done:done + more] = p[:more] * np.uint64(pow(b, done, 2**64))
                    done += more
                pair.append(p)
            cls._powers[base] = tuple(pair)
        return cls._powers[base]

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])


def word_bounds(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray):
    """(start, end, first): byte ranges of the words of a block of texts, and for each
    text the index of its first word (one more entry than texts).  Words don't cross texts."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~separator[data]
    step = inside[1:] & ~inside[:-1]
    stop = inside[:-1] & ~inside[1:]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    both = inside[cut] & inside[cut + 1]
    step[cut] |= both
    stop[cut] |= both
    start, end = np.flatnonzero(step[:len(data)]), np.flatnonzero(stop)
    return start, end, np.searchsorted(start, offsets)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of the ranges starts[i] .. starts[i] + lengths[i] - 1."""
    total = int(lengths.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    out = np.ones(total, np.int64)
    keep = lengths > 0
    s, n = starts[keep].astype(np.int64), lengths[keep].astype(np.int64)
    at = np.concatenate(([0], np.cumsum(n)[:-1]))
    out[at] = s
    out[at[1:]] -= s[:-1] + n[:-1] - 1
    return np.cumsum(out)


def _slices(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about so many bytes."""
    for batch in batches:
        rows = max(1, batch.num_rows * size // max(batch.nbytes, 1))
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def whole_groups(batches: Iterator[pa.RecordBatch], key: str, rows: int, size: int | None = None) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Batches sorted by ``key`` as tables of about ``rows`` rows, or ``size`` bytes if that is
    less, that hold whole groups, each with the first row of its groups."""
    def starts(k):
        return np.flatnonzero(np.append(True, k[1:] != k[:-1]))

    held: list[pa.RecordBatch] = []
    count, need = 0, rows
    most = size
    for batch in batches if size is None else _slices(batches, size):
        held.append(batch)
        count += batch.num_rows
        if count < need and (size is None or sum(b.nbytes for b in held) < most):
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        k = np.asarray(table.column(key).combine_chunks())
        cut = int(np.searchsorted(k, k[-1]))  # the first row of the last group
        if cut:
            yield table.slice(0, cut).combine_chunks(), starts(k[:cut])
        held = table.slice(cut).to_batches()
        count -= cut
        need = max(rows, 2 * count)
        most = size and max(size, 2 * sum(b.nbytes for b in held))
    if count:
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, starts(np.asarray(table.column(key).combine_chunks()))
