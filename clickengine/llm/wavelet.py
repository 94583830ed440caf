"""Token files as wavelet matrices, one per shard.

A shard is a run of documents in the order of their ids.  Its token ids stand in one succinct
matrix: a plane of bits for each bit of an id, the ids being split by that bit, in stable
order, before the next plane.  With ones counted per block of bits, the compressed file answers
access, rank, select, counts and occurrences without the token list.
"""

from __future__ import annotations

import struct
import zlib  # for checksums
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickengine.llm.tokens import Encoder
from clickengine.session import checkpoint_dir

END = 0
#: Tokens of a shard; a longer document is a shard of its own.
SHARD_TOKENS = 1 << 20
#: Bits to a count of the rank directory.
BLOCK = 512
#: Texts that are encoded together, and pieces of a generation of the encoder's cache.
TEXTS, CACHE = 256, 300_000

_HEAD = struct.Struct("<4sBxxxQQ")
_MAGIC = b"WMX1"


def _packed(data: bytes) -> bytes:
    return struct.pack("<Q", len(body := zstandard.compress(data, 1))) + body


class WaveletMatrix:
    """The planes of a sequence of ids, with rank and select."""

    def __init__(self, n: int, planes: list[np.ndarray], documents: np.ndarray):
        self.n, self.planes = n, planes  # planes: packed bits, most significant first
        self.documents = documents       # tokens of each document
        self.directory, self.zeros = [], []
        for p in planes:
            ones = np.add.reduceat(np.bitwise_count(p).astype(np.int64), np.arange(0, len(p), BLOCK // 8)) if n else []
            self.directory.append(np.concatenate(([0], np.cumsum(ones))).astype(np.int64))
            self.zeros.append(n - int(self.directory[-1][-1]))

    @classmethod
    def build(cls, ids: np.ndarray, documents: np.ndarray) -> WaveletMatrix:
        ids = np.asarray(ids, np.uint32)
        bits = max(int(ids.max(initial=0)).bit_length(), 1)
        ids = ids.astype(np.uint16) if bits <= 16 else ids
        planes = []
        for shift in range(bits - 1, -1, -1):
            one = (ids >> shift & 1).astype(bool)
            planes.append(np.packbits(one))
            ones, zeros = np.flatnonzero(one), np.flatnonzero(~one)
            split = np.empty_like(ids)
            np.take(ids, zeros, out=split[:len(zeros)])
            np.take(ids, ones, out=split[len(zeros):])
            ids = split
        return cls(len(ids), planes, np.asarray(documents, np.int64))

    def to_bytes(self) -> bytes:
        head = _HEAD.pack(_MAGIC, len(self.planes), self.n, len(self.documents))
        return head + _packed(self.documents.astype("<i8").tobytes()) + b"".join(_packed(p.tobytes()) for p in self.planes)

    @classmethod
    def from_bytes(cls, data: bytes) -> WaveletMatrix:
        magic, bits, n, documents = _HEAD.unpack_from(data)
        if magic != _MAGIC:
            raise ValueError("not a wavelet matrix file")
        at, parts = _HEAD.size, []
        for _ in range(bits + 1):
            size, = struct.unpack_from("<Q", data, at)
            parts.append(zstandard.decompress(data[at + 8:at + 8 + size]))
            at += 8 + size
        lengths = np.frombuffer(parts[0], "<i8")
        if len(lengths) != documents:
            raise ValueError("damaged wavelet matrix file")
        return cls(n, [np.frombuffer(p, np.uint8) for p in parts[1:]], lengths)

    def _bit(self, plane: int, at: int) -> int:
        return int(self.planes[plane][at >> 3]) >> (7 - (at & 7)) & 1

    def _ones(self, plane: int, at: int) -> int:
        """Ones before a position."""
        block = at // BLOCK
        p = self.planes[plane]
        first = block * BLOCK // 8
        out = int(self.directory[plane][block]) + int(np.bitwise_count(p[first:at >> 3]).sum())
        return out + (int(p[at >> 3]) >> (8 - (at & 7))).bit_count() if at & 7 else out

    def access(self, at: int) -> int:
        """The id at a position."""
        if not 0 <= at < self.n:
            raise IndexError(at)
        out = 0
        for k in range(len(self.planes)):
            bit, ones = self._bit(k, at), self._ones(k, at)
            out = out << 1 | bit
            at = self.zeros[k] + ones if bit else at - ones
        return out

    def rank(self, value: int, end: int) -> int:
        """Occurrences of an id before a position."""
        if value >> len(self.planes):
            return 0
        start = 0
        for k in range(len(self.planes)):
            a, b = self._ones(k, start), self._ones(k, end)
            if value >> (len(self.planes) - 1 - k) & 1:
                start, end = self.zeros[k] + a, self.zeros[k] + b
            else:
                start, end = start - a, end - b
        return end - start

    def count(self, value: int) -> int:
        return self.rank(value, self.n)

    def _find(self, plane: int, bit: int, nth: int) -> int:
        """The position of the nth (from 0) such bit of a plane."""
        d = self.directory[plane]
        if bit:
            block = int(np.searchsorted(d, nth, "right")) - 1
            nth -= int(d[block])
        else:
            zeros = np.minimum(np.arange(len(d)) * BLOCK, self.n) - d
            block = int(np.searchsorted(zeros, nth, "right")) - 1
            nth -= int(zeros[block])
        first = block * BLOCK
        part = np.unpackbits(self.planes[plane][first // 8:(first + BLOCK) // 8])[:self.n - first]
        return first + int(np.flatnonzero(part == bit)[nth])

    def select(self, value: int, nth: int) -> int:
        """The position of the nth (from 0) occurrence of an id."""
        if not 0 <= nth < self.count(value):
            raise IndexError(nth)
        bits = len(self.planes)
        start = 0
        for k in range(bits):
            ones = self._ones(k, start)
            start = self.zeros[k] + ones if value >> (bits - 1 - k) & 1 else start - ones
        at = start + nth
        for k in range(bits - 1, -1, -1):
            bit = value >> (bits - 1 - k) & 1
            at = self._find(k, bit, at - self.zeros[k] if bit else at)
        return at

    def occurrences(self, value: int) -> list[int]:
        return [self.select(value, k) for k in range(self.count(value))]

    def decode(self) -> np.ndarray:
        """All ids: the planes' splits undone from the last to the first."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        out = np.zeros(self.n, kind)
        for shift, (p, zeros) in enumerate(zip(self.planes[::-1], self.zeros[::-1])):
            one = np.unpackbits(p)[:self.n].view(bool)
            before = np.empty_like(out)
            before[np.flatnonzero(~one)] = out[:zeros]
            before[np.flatnonzero(one)] = out[zeros:] | kind(1 << shift)
            out = before
        return out


def _write_task(path: str, end: int, shard_tokens: int):
    """Task: (doc_id, text) in order to rows of shards: their files and document ids."""
    def shard(part: int, number: int, before: int, held) -> pa.RecordBatch:
        ids, sizes, docs = (np.concatenate(x) if not isinstance(x[0], pa.Array) else pa.concat_arrays(x) for x in zip(*held))
        blob = WaveletMatrix.build(ids, sizes).to_bytes()
        keys = pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), docs)
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([before], pa.int64()),
             pa.array([len(ids)], pa.int64()), keys, pa.array([blob], pa.binary())],
            ["part", "shard", "tokens_before", "n_tokens", "doc_ids", "file"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(path, CACHE, added=True)
        part = TaskContext.get().partitionId()
        held, count, number, before = [], 0, 0, 0
        for batch in batches:
            for i in range(0, batch.num_rows, TEXTS):
                some = batch.slice(i, TEXTS)
                ids, first = encoder.encode(some.column(1).to_pylist())
                ids = np.insert(ids, first[1:], end)
                held.append((ids, np.diff(first) + 1, some.column(0)))
                count += len(ids)
                if count >= shard_tokens:
                    yield shard(part, number, before, held)
                    held, count, number, before = [], 0, number + 1, before + count
        if held:
            yield shard(part, number, before, held)

    return task


def write_shards(docs: DataFrame, path: str, tokenizer: str, key: str = "doc_id", text: str = "text", end: int = END,
                 shard_tokens: int = SHARD_TOKENS) -> None:
    """Write the token files of the documents, in ascending order of the key (null first, equal
    keys by a hash of their text, so that they too are split over tasks), as rows (part, shard, tokens_before, n_tokens, doc_ids, file) under ``path``."""
    kind = docs.select(key).schema[0].dataType.simpleString()
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))
    dealt = rows.withColumn("h", F.xxhash64("t")).repartitionByRange(n, "k", "h").sortWithinPartitions("k", "h", "t")
    dealt.select("k", "t").mapInArrow(
        _write_task(tokenizer, end, shard_tokens),
        f"part int, shard int, tokens_before long, n_tokens long, doc_ids array<{kind}>, file binary").write.mode("overwrite").parquet(path)


def _read_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            matrix = WaveletMatrix.from_bytes(batch.column(2)[k].as_py())
            raw = matrix.decode().astype("<u4").tobytes()
            ends = np.cumsum(matrix.documents)
            starts = ends - matrix.documents
            crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1)[k].values, pa.array(starts + batch.column(0)[k].as_py()), pa.array(matrix.documents),
                 pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_documents(spark, path: str) -> DataFrame:
    """doc_id, start (tokens of all documents before), n_tokens and ids_crc32 from token files."""
    shards = spark.read.parquet(path)
    kind = shards.schema["doc_ids"].dataType.elementType.simpleString()
    # A part is a task that wrote: a few numbers each, at most as many as the partitions then.
    parts = shards.groupBy(F.col("part").alias("p")).agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("p", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    rows = shards.join(F.broadcast(parts), F.col("part") == F.col("p"))
    rows = rows.withColumn("first", F.col("base") + F.col("tokens_before"))
    return rows.select("first", "doc_ids", "file").mapInArrow(
        _read_task, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")


def encode_documents(docs: DataFrame, tokenizer: str, path: str | None = None, key: str = "doc_id", text: str = "text",
                     end: int = END, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Write the token files (by default to a new folder in the shared checkpoint folder) and read
    them back, one row per document.

    A null or empty text is the end id alone; repeated rows are documents each; other columns
    aren't read; no rows give no files' rows.
    """
    spark = docs.sparkSession
    path = path or f"{checkpoint_dir(spark).rstrip('/')}/token-files-{uuid4().hex}"
    write_shards(docs, path, tokenizer, key, text, end, shard_tokens)
    return read_documents(spark, path).withColumnRenamed("doc_id", key)
