"""Benchmark decontamination with training suffix arrays.

A shard is a run of documents of a few MB.  Its words become vocabulary numbers of the
benchmark (0: not in it, or the end of a document), its suffix array orders the suffixes
that can hold a whole window by their first words, and every test suffix is looked up by
binary search: the range it finds are the places where it stands verbatim.  The longest match
from such a place is that with its neighbours among the benchmark's own sorted suffixes, so no
place is ever paired with all places of a common passage.

The benchmark is cut into blocks by a hash of the text; Spark tasks build each block's tests and
write them to the checkpoint folder.  Documents stay where they are and are read once: a task
gathers some shards and takes the blocks one after the other.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickengine.llm.common import LOWER, PrefixHash, blocks, materialize, ragged, text_buffer, word_bounds

WINDOW = 13
#: A document is contaminated from this share of hit words on.
MIN_PERCENT = 5
#: Bytes of benchmark text in a block (in the mean), the part that tasks hold decoded at a time.
BENCHMARK_BLOCK = 8 << 20
#: Bytes of document text in a shard, the part that has a suffix array of its own.
SHARD_BYTES = 4 << 20
#: Bytes of document text that a task gathers before it goes through the blocks.
GATHER_BYTES = 16 << 20

#: Words are runs of digits, small letters (after A-Z are lower-cased) and bytes above 127.
NO_WORD = np.ones(256, bool)
NO_WORD[0x30:0x3A] = False
NO_WORD[0x61:0x7B] = False
NO_WORD[0x80:] = False

def _words(data: np.ndarray, offsets: np.ndarray):
    """(word hashes, first): the words of each text as 64-bit hashes."""
    data = LOWER[data]
    start, end, first = word_bounds(data, offsets, NO_WORD)
    return PrefixHash(data, 7).of(start, end) + (end - start).astype(np.uint64), first


@dataclass(frozen=True)
class Tests:
    """A block of the benchmark: vocabulary, distinct windows, and where they come from."""
    vocabulary: np.ndarray        # sorted word hashes; number 1 is the first
    sequence: np.ndarray          # the numbers of all distinct texts, a zero after each
    low: np.ndarray               # sort key of each distinct window
    high: np.ndarray              # last key that starts with the window
    length: np.ndarray            # words of each window
    of_place: np.ndarray          # first entry of each window in place (one more entry)
    place: np.ndarray             # where windows start in the sequence, in the order of their suffixes
    of_text: np.ndarray           # first entry of each window in text (one more entry)
    text: np.ndarray              # the distinct texts of each window
    ids: tuple[tuple[str, ...], ...]  # item ids of each distinct text

    @cached_property
    def prefix(self) -> PrefixHash:
        return _word_prefix(self.sequence)

    @cached_property
    def left(self) -> np.ndarray:
        return _until_zero(self.sequence)


def _word_prefix(numbers: np.ndarray) -> PrefixHash:
    """Prefix hashes of a sequence of numbers, four bytes each."""
    return PrefixHash(numbers.astype("<u4").view(np.uint8), 29)


def _until_zero(numbers: np.ndarray) -> np.ndarray:
    """Words from each place to the next zero; the last number is one."""
    zeros = np.flatnonzero(numbers == 0)
    at = np.arange(len(numbers))
    return zeros[np.searchsorted(zeros, at)] - at


def _keys(words: np.ndarray) -> np.ndarray:
    """Rows of WINDOW numbers as byte strings that sort in the same order."""
    return np.ascontiguousarray(words.astype(">u4")).view(f"S{4 * WINDOW}").ravel()


def suffix_ranks(numbers: np.ndarray) -> np.ndarray:
    """The rank of each suffix up to its zero (equal ones share theirs), by doubled prefixes."""
    left = _until_zero(numbers)
    rank, distinct, step = np.unique(numbers, return_inverse=True)[1], 0, 1
    while True:
        on = np.flatnonzero(left > step)
        pair = rank * (len(numbers) + 1)
        pair[on] += rank[on + step]
        values, rank = np.unique(pair, return_inverse=True)
        if len(values) == distinct:
            return rank
        distinct, step = len(values), 2 * step


def make_tests(items: list[tuple[str, str]]) -> Tests:
    """Tests of (item id, text) pairs.  Items without words have no windows; one of fewer
    words than a window is one window; items of the same words share theirs."""
    data, offsets = text_buffer(pa.array([t for _, t in items], pa.string()))
    hashes, first = _words(data, offsets)
    texts: dict[bytes, set] = {}
    for (name, _), a, b in zip(items, first[:-1], first[1:]):
        if b > a:
            texts.setdefault(hashes[a:b].tobytes(), set()).add(name)
    words = np.frombuffer(b"".join(texts), np.uint64)
    sizes = np.array([len(t) // 8 for t in texts], np.int64)
    vocabulary, number = np.unique(words, return_inverse=True)
    sequence = np.zeros(len(words) + len(sizes) + 1, np.int64)
    text_of = np.repeat(np.arange(len(sizes)), sizes)
    sequence[np.arange(len(words)) + text_of] = number + 1

    left = _until_zero(sequence)
    begins = np.zeros(len(sequence), bool)
    begins[np.cumsum(sizes + 1) - sizes - 1] = True
    place = np.flatnonzero((left >= WINDOW) | (begins & (left > 0)))
    step = np.arange(WINDOW)
    inside = step < left[place, None]
    rows = np.where(inside, sequence[np.minimum(place[:, None] + step, len(sequence) - 1)], 0)
    low, one, window = np.unique(_keys(rows), return_index=True, return_inverse=True)
    high = _keys(np.where(inside[one], rows[one], 2**32 - 1))
    order = np.lexsort((suffix_ranks(sequence)[place], window))
    text = np.searchsorted(np.cumsum(sizes + 1), place, "right")
    of = np.unique(np.stack([window, text], 1), axis=0) if len(place) else np.zeros((0, 2), np.int64)
    every = np.arange(len(low) + 1)
    return Tests(vocabulary, sequence, low, high, inside[one].sum(1), np.searchsorted(window[order], every), place[order],
                 np.searchsorted(of[:, 0], every), of[:, 1], tuple(tuple(sorted(v)) for v in texts.values()))


def suffix_array(numbers: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, places): the suffixes that start with ``least`` words of the vocabulary, in
    the order of their first WINDOW words.  ``numbers`` ends with WINDOW zeros."""
    places = np.flatnonzero(_until_zero(numbers) >= least)
    keys = _keys(numbers[places[:, None] + np.arange(WINDOW)])
    order = np.argsort(keys, kind="stable")
    return keys[order], places[order]


def longest_matches(numbers: np.ndarray, at: np.ndarray, window: np.ndarray, tests: Tests) -> np.ndarray:
    """Words of the longest match with the benchmark from each place, where a window stands.

    A binary search among the sorted suffixes that start with the window meets both neighbours of
    the place's own suffix, and one of these has the longest common extension, which is found by
    binary search over prefix hashes."""
    best = tests.length[window].copy()
    whole = np.flatnonzero(best == WINDOW)  # a shorter item ends where its window does
    p, low, high = at[whole], tests.of_place[window[whole]], tests.of_place[window[whole] + 1]
    prefix, left = _word_prefix(numbers), _until_zero(numbers)
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return best
        mid = (low[open_] + high[open_]) >> 1
        a, b = p[open_], tests.place[mid]
        same, most = np.full(len(a), WINDOW), np.minimum(left[a], tests.left[b])
        while (same < most).any():
            half = (same + most + 1) >> 1
            equal = prefix.of(4 * a, 4 * (a + half)) == tests.prefix.of(4 * b, 4 * (b + half))
            same, most = np.where(equal, half, same), np.where(equal, most, half - 1)
        best[whole[open_]] = np.maximum(best[whole[open_]], same)
        before = tests.sequence[b + same] < numbers[a + same]
        low[open_] = np.where(before, mid + 1, low[open_])
        high[open_] = np.where(before, high[open_], mid)


class Shard:
    """Some documents: their words, and what the blocks so far have found in them."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.hashes, self.first = _words(data, offsets)
        self.counts = np.diff(self.first)
        self.longest = np.zeros(len(self.counts), np.int64)
        self.spans: dict[int, list] = {}   # text: merged [start, end, ...] of hit words
        self.items: dict[int, tuple] = {}  # text: groups of item ids, one a block

    def match(self, tests: Tests) -> None:
        hashes, first, n = self.hashes, self.first, len(self.counts)
        if not len(hashes) or not len(tests.length):
            return
        text_of = np.repeat(np.arange(n), self.counts)
        found = np.minimum(np.searchsorted(tests.vocabulary, hashes), len(tests.vocabulary) - 1)
        numbers = np.zeros(len(hashes) + n + WINDOW, np.int64)  # a zero after each text
        numbers[np.arange(len(hashes)) + text_of] = np.where(tests.vocabulary[found] == hashes, found + 1, 0)
        keys, places = suffix_array(numbers, int(tests.length.min()))
        lo, hi = np.searchsorted(keys, tests.low, "left"), np.searchsorted(keys, tests.high, "right")
        hit = np.flatnonzero(hi > lo)
        if not len(hit):
            return
        at = places[ragged(lo[hit], (hi - lo)[hit])]
        window = np.repeat(hit, (hi - lo)[hit])
        begin = first[:-1] + np.arange(n)  # of each text among the numbers
        text = np.searchsorted(begin, at, "right") - 1

        step = np.zeros(len(numbers) + 1, np.int64)
        np.add.at(step, at, 1)
        np.add.at(step, at + tests.length[window], -1)
        covered = np.concatenate(([False], np.cumsum(step) > 0, [False]))
        edge = np.flatnonzero(covered[1:] != covered[:-1])
        new: dict[int, list] = {}
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
            t = int(np.searchsorted(begin, a, "right")) - 1
            new.setdefault(t, []).extend((a - int(begin[t]), b - int(begin[t])))
        for t, spans in new.items():
            self.spans[t] = _merge(self.spans.get(t, []) + spans)
        np.maximum.at(self.longest, text, longest_matches(numbers, at, window, tests))

        # Texts with the same windows share their list of items.
        pair = np.unique(text * len(tests.length) + window)
        text, window = np.divmod(pair, len(tests.length))
        cut = np.append(np.flatnonzero(np.append(True, text[1:] != text[:-1])), len(text))
        known: dict[bytes, tuple] = {}
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
            key = window[a:b].tobytes()
            if key not in known:
                seen = np.zeros(len(tests.ids), bool)
                for w in window[a:b].tolist():
                    seen[tests.text[tests.of_text[w]:tests.of_text[w + 1]]] = True
                known[key] = tuple(sorted({i for k in np.flatnonzero(seen).tolist() for i in tests.ids[k]}))
            t = int(text[a])
            self.items[t] = (*self.items.get(t, ()), known[key])


def _merge(spans: list[int]) -> list[int]:
    """Union of flat [start, end, ...] spans."""
    out: list[int] = []
    for a, b in sorted(zip(spans[::2], spans[1::2])):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def _build(table: pa.Table) -> pa.Table:
    items = list(zip(table.column("i").to_pylist(), table.column("t").to_pylist()))
    return pa.table({"file": pa.array([pickle.dumps(make_tests(items))], pa.binary())})


def benchmark_blocks(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """The tests of the benchmark's blocks, one row each, as a written table."""
    rows = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("i"), F.col(text).cast("string").alias("t"))
    rows = rows.where("t is not null")
    size = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    block = F.pmod(F.xxhash64("t"), F.lit(size // BENCHMARK_BLOCK + 1))
    return materialize(rows.withColumn("b", block).groupBy("b").applyInArrow(_build, "file binary"))


#: The block that this worker has decoded last.
_decoded: dict[str, Tests] = {}


def _load(name: str, file) -> Tests:
    if name not in _decoded:
        _decoded.clear()
        _decoded[name] = pickle.loads(file.value)
    return _decoded[name]


def _gathered(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[list[pa.RecordBatch]]:
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column(at).nbytes
        if size >= GATHER_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def _digest(groups: tuple, known: dict) -> tuple[int, str]:
    """(number, SHA-256) of the item ids in some groups; groups are shared by many texts."""
    key = tuple(map(id, groups))
    if key not in known:
        names = groups[0] if len(groups) == 1 else sorted(set().union(*groups))
        known[key] = (len(names), hashlib.sha256(",".join(names).encode()).hexdigest())
    return known[key]


def _scan(docs: DataFrame, benchmark: DataFrame, text: str, item: str, item_text: str) -> DataFrame:
    """The columns of ``docs`` as c0, c1, ... and the state of every document."""
    columns = docs.columns
    df = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)])
    at = columns.index(text)
    # Blocks pass the driver one at a time; tasks hold all of them as files, one of them decoded.
    context = docs.sparkSession.sparkContext
    shared = [(uuid4().hex, context.broadcast(bytes(r.file)))
              for r in benchmark_blocks(benchmark, item, item_text).toLocalIterator()]
    nothing = (0, hashlib.sha256(b"").hexdigest())
    kinds = {"_n_words": pa.int64(), "_longest": pa.int64(), "_spans": pa.list_(pa.int32()),
             "_n_items": pa.int64(), "_items_sha256": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _gathered(batches, at):
            shards = []
            for batch in held:
                data, offsets = text_buffer(batch.column(at))
                shards.append([Shard(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                               for i, j in blocks(offsets, SHARD_BYTES)])
            for name, file in shared:
                tests = _load(name, file)
                for some in shards:
                    for s in some:
                        s.match(tests)
            for batch, some in zip(held, shards):
                state: list[list] = [[], [], [], [], []]
                for s in some:
                    known: dict = {}
                    for t, (words, longest) in enumerate(zip(s.counts.tolist(), s.longest.tolist())):
                        number, digest = _digest(s.items[t], known) if t in s.items else nothing
                        for values, value in zip(state, (words, longest, s.spans.get(t, []), number, digest)):
                            values.append(value)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, *[pa.array(v, k) for v, k in zip(state, kinds.values())]],
                    names=[*batch.schema.names, *kinds])

    added = "_n_words long, _longest long, _spans array<int>, _n_items long, _items_sha256 string"
    df = df.mapInArrow(run, T.StructType([*df.schema.fields, *T.StructType.fromDDL(added).fields]))
    even = F.aggregate("_spans", F.struct(F.lit(1).alias("sign"), F.lit(0).alias("sum")), lambda a, x: F.struct(
        (-a["sign"]).alias("sign"), (a["sum"] - a["sign"] * x).alias("sum")), lambda a: a["sum"])
    df = df.withColumn("_n_hit", even.cast("long"))
    return df.withColumn("_bad", (F.col("_n_hit") > 0) & (F.col("_n_hit") * 100 >= F.col("_n_words") * MIN_PERCENT))


def report(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
           item_text: str = "text") -> DataFrame:
    """``key``, n_words, n_hit, n_items, items_sha256, contaminated and longest_match (words) of every row.

    Null or empty texts have no words and aren't contaminated; a null item id counts as an
    empty one; repeated rows are judged each; an empty benchmark hits nothing; other
    columns aren't read.
    """
    out = _scan(docs.select(key, text), benchmark, text, item, item_text)
    return out.select(F.col("c0").alias(key), F.col("_n_words").alias("n_words"), F.col("_n_hit").alias("n_hit"),
                      F.col("_n_items").alias("n_items"), F.col("_items_sha256").alias("items_sha256"),
                      F.col("_bad").alias("contaminated"), F.col("_longest").alias("longest_match"))


def locations(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
              item: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per hit span of words: ``key``, start, end (exclusive)."""
    out = _scan(docs.select(key, text), benchmark, text, item, item_text)
    n = F.size("_spans")
    pairs = F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1, F.lit(2)), lambda i: F.struct(
        F.get("_spans", i).alias("start"), F.get("_spans", i + 1).alias("end"))))
    return out.select(F.col("c0").alias(key), F.inline(pairs))


def remove(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
           item_text: str = "text") -> DataFrame:
    """The rows that aren't contaminated, with all their columns."""
    out = _scan(docs, benchmark, text, item, item_text).where(~F.col("_bad"))
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
