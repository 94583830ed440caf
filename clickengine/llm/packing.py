"""Best-fit packing of token sequences by exact complements.

Documents become pieces of at most ``capacity`` tokens.  How pieces share sequences only
depends on their lengths, so the plan is made from the number of pieces of each length, a table
of ``capacity`` rows: lengths are indexed by their single, pair and triple sums, combinations
that exactly fill the gap beside a long piece are used up under the counts that are
available, and what is left goes best-fit into the tightest gap.  Each piece then finds its
place by its rank among the pieces of its length.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickengine.llm.common import materialize, ranked
from clickengine.llm.tokens import Encoder

CAPACITY = 1024
END = 2
#: Pieces of one length are ranked in so many buckets.
RANK_BUCKETS = 512
#: Texts that are encoded together.
TEXTS = 256


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: all full but the first."""
    first = n % capacity
    starts = ([0] if first else []) + list(range(first, n, capacity))
    return [(s, first if s == 0 and first else capacity) for s in starts]


def _pieces_task(path: str, capacity: int, end: int, keep_ids: bool):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(path, added=True)
        for batch in batches:
            for i in range(0, batch.num_rows, TEXTS):
                part = batch.slice(i, TEXTS)
                ids, first = encoder.encode(part.column(1).to_pylist())
                ids = np.insert(ids, first[1:], end).astype("<u4")
                first = first + np.arange(len(first))
                row, piece, start, length, crc, raw = [], [], [], [], [], []
                for k in range(part.num_rows):
                    for number, (s, n) in enumerate(cut(int(first[k + 1] - first[k]), capacity)):
                        own = ids[first[k] + s:first[k] + s + n].tobytes()
                        row.append(k)
                        piece.append(number)
                        start.append(s)
                        length.append(n)
                        crc.append(zlib.crc32(own))
                        if keep_ids:
                            raw.append(own)
                columns = [part.column(0).take(pa.array(row, pa.int32())), pa.array(piece, pa.int32()),
                           pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if keep_ids:
                    columns.append(pa.array(raw, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)
    return task


def tokenized_pieces(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
                     end: int = END, keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids, little-endian unsigned 32-bit) of the pieces of every row."""
    kind = docs.select(key).schema[0].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids
    return docs.select(F.col(key), F.col(text).cast("string")).mapInArrow(
        _pieces_task(path, capacity, end, keep_ids), schema)


class _Plan:
    """Sequences being filled: equal ones are one entry (lengths, how many)."""

    def __init__(self, counts: np.ndarray, capacity: int):
        self.left = counts.astype(np.int64).copy()
        self.capacity = capacity
        self.full: list[tuple[tuple[int, ...], int]] = []

    def use(self, lengths: tuple[int, ...]) -> None:
        """Use up a combination as often as there are pieces for it."""
        need = defaultdict(int)
        for x in lengths:
            need[x] += 1
        times = min(int(self.left[x]) // n for x, n in need.items())
        if times:
            for x, n in need.items():
                self.left[x] -= times * n
            self.full.append((lengths, times))

    def pair(self, total: int) -> tuple[int, int] | None:
        """Two available lengths of that sum, the first as long as can be."""
        top = min(total - 1, self.capacity)
        low = max(total - top, 1)
        if top < low:
            return None
        first = np.arange(top, (total + 1) // 2 - 1, -1)
        other = total - first
        ok = np.flatnonzero((self.left[first] > 0) & (self.left[other] > (first == other)))
        return (int(first[ok[0]]), int(other[ok[0]])) if len(ok) else None

    def complement(self, gap: int) -> tuple[int, ...] | None:
        """One, two or three available lengths that fill the gap."""
        if gap <= self.capacity and self.left[gap] > 0:
            return (gap,)
        two = self.pair(gap)
        if two:
            return two
        for x in np.flatnonzero(self.left[:gap] > 0)[::-1].tolist():
            self.left[x] -= 1
            two = self.pair(gap - x)
            self.left[x] += 1
            if two:
                return (x, *two)
        return None


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, number of such sequences) for counts[length] pieces of each length."""
    p = _Plan(counts, capacity)
    p.use((capacity,))
    for length in range(capacity - 1, 0, -1):
        while p.left[length] > 0:
            p.left[length] -= 1  # the piece itself can't be in its own complement
            rest = p.complement(capacity - length)
            p.left[length] += 1
            if rest is None:
                break
            p.use((length, *rest))
    # Best fit: gap -> sequences with that gap.
    open_: dict[int, list] = defaultdict(list)
    for length in range(capacity - 1, 0, -1):
        n = int(p.left[length])
        while n:
            gap = next((g for g in range(length, capacity) if open_.get(g)), None)
            if gap is None:
                each = capacity // length
                whole, rest = divmod(n, each)
                for k, times in ((each, whole), (rest, int(rest > 0))):
                    if times:
                        open_[capacity - k * length].append(((length,) * k, times))
                break
            lengths, times = open_[gap].pop()
            take = min(n, times)
            if times > take:
                open_[gap].append((lengths, times - take))
            open_[gap - length].append((lengths + (length,), take))
            n -= take
    return p.full + [x for part in open_.values() for x in part]


def _places(sequences: list[tuple[tuple[int, ...], int]], capacity: int):
    """Sorted arrays (length * 2**40 + first rank, sequence of that rank, offset): where the
    pieces of each length go, by rank."""
    rank = np.zeros(capacity + 1, np.int64)
    rows = []
    sequence = 0
    for lengths, times in sequences:
        offset = 0
        for x in lengths:
            rows.append((x << 40 | int(rank[x]), sequence, offset))
            rank[x] += times
            offset += x
        sequence += times
    rows.sort()
    return tuple(np.array(c, np.int64) for c in zip(*rows)) if rows else (np.zeros(0, np.int64),) * 3


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces (doc_id, piece, length, ...) with sequence_id and offset.

    The plan has a few thousand entries, as every step uses up a length, and goes to all tasks.
    """
    pieces = materialize(pieces)
    rows = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    counts = np.zeros(capacity + 1, np.int64)
    for r in rows:
        counts[r.length] = r.n
    key, sequence, offset = _places(plan(counts, capacity), capacity)
    bucket = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(RANK_BUCKETS))
    numbered = ranked(pieces, "length", bucket, ["doc_id", "piece", "ids_crc32"], "_rank")
    names = pieces.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = np.asarray(batch.column(batch.schema.get_field_index("_rank")))
            want = np.asarray(batch.column(batch.schema.get_field_index("length"))) << 40 | rank
            at = np.searchsorted(key, want, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(batch.schema.get_field_index(c)) for c in names],
                 pa.array(sequence[at] + want - key[at]), pa.array(offset[at])], [*names, "sequence_id", "offset"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema)
    return numbered.select(*names, "_rank").mapInArrow(place, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
                   end: int = END, keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is the end id alone; repeated rows are packed each; other columns aren't
    read; no rows give no sequences.
    """
    out = pack(tokenized_pieces(docs, path, key, text, capacity, end, keep_ids), capacity)
    return out.withColumnRenamed("doc_id", key)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the token ids of each sequence, from packed pieces that kept theirs."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b"").cast("binary"), lambda acc, p: F.concat(acc, p["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))
