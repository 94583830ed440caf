"""Periodic runs of words: stretches that repeat a block of words over and over.

A *run* is a stretch of consecutive words with smallest period q (words q apart are equal)
and a length of at least max(``MIN_WORDS``, ``MIN_PERIODS`` q) that can't be extended on
either side.  They are found text by text, in two steps:

1. Cutting.  Every three neighbouring words of a run occur at least three times in it.  So a
   text is cut where no three words around a place occur three times in the same piece, and
   again, until nothing changes; no run crosses a cut.  Three words are compared by a 64-bit
   hash here, which can only leave too much in.
2. Suffix automaton with link-cut access, on what is left, over exact word codes.  Appending
   word i recolours the path of the suffix links from the state of the first i + 1 words to
   the root with the end i ("access").  Each recoloured segment of one former colour j with
   a longest string of at least d = i - j words says that those words end both at j and at i:
   a square of period d ends at i.  No period of the square is smaller, else its string would
   have ended after j.  Squares are extended to runs by comparing words.  Every run of
   exponent 2 and more holds such a square.

The automaton is built first, so its link tree is at rest while the colours move.  Its paths
are kept as heavy paths, each a stack of coloured intervals from the top: an access replaces
the first intervals of O(log n) paths, and all intervals together that it removes were put
there by earlier ones, as with the preferred paths of a link-cut tree.

Nulls are empty texts; every row stands for itself, so repeated ids, null ids (which are not
periodic by ``planted``) and further columns do no harm; an empty table gives no rows.
One text is handled by one task, in memory proportional to what step 1 leaves of it.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from clickengine.llm.common import SPACE, PrefixHash, blocks, mix, ragged, text_buffer, word_bounds

MIN_WORDS = 6
MIN_PERIODS = 4
#: Rounds of cutting at most; what more of them would cut, step 2 looks at.
ROUNDS = 30

REPORT = ("doc_id {id}, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
          "runs_sha256 string, collapsed_sha256 string")


# ------------------------------------------------------------------ step 1

def live_pieces(words: np.ndarray, text: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of words that may hold runs: ``words`` are hashes, ``text`` the text of each word (ascending)."""
    at, piece = np.arange(len(words)), text.astype(np.int64)    # the words still in, and their pieces
    for _ in range(ROUNDS):
        first = np.flatnonzero(piece[2:] == piece[:-2])
        h, p = words[at], piece[first].astype(np.uint64)
        key = mix(h[first] * np.uint64(3) + mix(h[first + 1] * np.uint64(5) + mix(h[first + 2] + p)))
        _, code, n = np.unique(key, return_inverse=True, return_counts=True)
        good = first[n[code] >= 3]
        # a piece is a chain of such threes, each of which shares two words with the one before
        linked = np.zeros(len(at), bool)    # words k and k + 1 are in one of them
        linked[good] = linked[good + 1] = True
        number = np.cumsum(np.append(True, ~linked[:-1]))[:len(at)]
        stay = np.bincount(number, minlength=1)[number] >= MIN_WORDS
        before = len(at), len(np.unique(piece))
        at, piece = at[stay], number[stay]
        if (len(at), len(np.unique(piece))) == before or not len(at):
            break
    cut = np.flatnonzero(np.append(True, piece[1:] != piece[:-1])[:len(at)])
    return list(zip(at[cut].tolist(), (at[np.append(cut[1:], len(at)) - 1] + 1).tolist())) if len(at) else []


# ------------------------------------------------------------------ step 2

class SuffixAutomaton:
    """Suffix automaton of a sequence of codes: ``length`` of the longest string of each state, ``link``
    to its longest suffix in another state, and the state of each prefix."""

    def __init__(self, codes: list[int]):
        length, link, after = [0], [-1], [{}]
        prefix = []
        last = 0
        for c in codes:
            cur = len(length)
            length.append(length[last] + 1)
            link.append(0)
            after.append({})
            p = last
            while p != -1 and c not in after[p]:
                after[p][c] = cur
                p = link[p]
            if p != -1:
                q = after[p][c]
                if length[p] + 1 == length[q]:
                    link[cur] = q
                else:
                    copy = len(length)
                    length.append(length[p] + 1)
                    link.append(link[q])
                    after.append(after[q].copy())
                    while p != -1 and after[p].get(c) == q:
                        after[p][c] = copy
                        p = link[p]
                    link[q] = link[cur] = copy
            prefix.append(cur)
            last = cur
        self.length, self.link, self.prefix = length, link, prefix

    def accesses(self) -> Iterator[tuple[int, list[tuple[int, int]]]]:
        """(end, [(earlier end, length of the longest string of the segment), ...]) for every prefix in turn:
        the segments of the link path by their last end, which then becomes this one."""
        length, link = self.length, self.link
        states = len(length)
        # heavy paths: a state hands its path to the child with the most states below
        order = np.argsort(np.array(length), kind="stable").tolist()
        below = [1] * states
        heavy = [-1] * states
        for v in reversed(order):
            p = link[v]
            if p >= 0:
                below[p] += below[v]
                if heavy[p] < 0 or below[v] > below[heavy[p]]:
                    heavy[p] = v
        top, depth = [0] * states, [0] * states
        for v in order:
            p = link[v]
            if p >= 0 and heavy[p] == v:
                top[v], depth[v] = top[p], depth[p] + 1
            else:
                top[v] = v
        # per path, from its top down: intervals (last depth, longest string at that depth, end), nearest on top of the stack
        paths: dict[int, list[tuple[int, int, int]]] = {}
        for end, state in enumerate(self.prefix):
            found = []
            v = state
            while v >= 0:
                t, at = top[v], depth[v]
                stack = paths.setdefault(t, [])
                reached = -1
                while stack and stack[-1][0] <= at:
                    reached, longest, earlier = stack.pop()
                    found.append((earlier, longest))
                if stack and reached < at:      # the upper part of an interval that goes on below
                    found.append((stack[-1][2], length[v]))
                stack.append((at, length[v], end))
                v = link[t]
            yield end, found


def find_runs(codes: list[int]) -> list[tuple[int, int, int]]:
    """Runs of a sequence of codes as (start, length, period), by start and period."""
    n = len(codes)
    covered: dict[int, int] = {}    # period -> end of its last run
    runs = []
    for end, segments in SuffixAutomaton(codes).accesses():
        for earlier, longest in segments:
            d = end - earlier
            if d > longest or MIN_PERIODS * d > n or covered.get(d, 0) > end:
                continue
            lo = end - d - longest + 1
            while lo > 0 and codes[lo - 1] == codes[lo - 1 + d]:
                lo -= 1
            hi = end + 1
            while hi < n and codes[hi] == codes[hi - d]:
                hi += 1
            covered[d] = hi
            if hi - lo >= max(MIN_WORDS, MIN_PERIODS * d):
                runs.append((lo, hi - lo, d))
    return sorted(runs, key=lambda r: (r[0], r[2]))


# ------------------------------------------------------------------ on Spark

def planted(doc_id: str | None, n: int) -> tuple[int, int] | None:
    """(a, p): words from a on repeat with period p, for one document in ten; else None."""
    if doc_id is None or n == 0:
        return None
    h = zlib.crc32(doc_id.encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def _block_rows(ids: list, data: np.ndarray, offsets: np.ndarray, plant: bool):
    """The reports of one block of texts."""
    start, end, first = word_bounds(data, offsets, SPACE)
    counts = np.diff(first)
    # which word stands at each place
    word = np.arange(len(start))
    if plant:
        for k, key in enumerate(ids):
            made = planted(None if key is None else str(key), int(counts[k]))
            if made:
                a, p = made
                i = np.arange(a, counts[k])
                word[first[k] + i] = first[k] + a + (i - a) % p
    text = np.repeat(np.arange(len(ids)), counts)
    hashes = PrefixHash(data).of(start, end)[word]
    runs: dict[int, list] = {}
    for lo, hi in live_pieces(hashes, text):
        k = int(text[lo])
        part = word[lo:hi]
        lengths = (end - start)[part]
        at = np.concatenate(([0], np.cumsum(lengths)))
        exact = pa.Array.from_buffers(pa.large_binary(), hi - lo, [None, pa.py_buffer(at.astype(np.int64)),
                                                                   pa.py_buffer(data[ragged(start[part], lengths)])])
        codes = exact.dictionary_encode().indices.to_pylist()
        for s, n, q in find_runs(codes):
            runs.setdefault(k, []).append((lo + s - int(first[k]), n, q))
    kept = np.ones(len(word), bool)
    for k, found in runs.items():
        for s, n, q in found:
            kept[first[k] + s + q:first[k] + s + n] = False
    # kept words with a space after each
    text, word = text[kept], word[kept]
    size = (end - start)[word] + 1
    at = np.concatenate(([0], np.cumsum(size)))
    buf = np.append(data, np.uint8(32))[ragged(start[word], size)]
    buf[at[1:] - 1] = 32
    raw = buf.tobytes()
    bound = at[np.searchsorted(text, np.arange(len(ids) + 1))].tolist()
    for k, key in enumerate(ids):
        found = sorted(runs.get(k, []), key=lambda r: (r[0], r[2]))
        best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else None
        s, n, q = best or (None, None, None)
        rest = raw[bound[k]:max(bound[k], bound[k + 1] - 1)]
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in found)
        yield (len(found), s, n, q, 1000 * n // q if best else None, hashlib.sha256(lines.encode()).hexdigest(),
               hashlib.sha256(rest).hexdigest(), found, rest)


def _map(docs: DataFrame, key: str, text: str, plant: bool, pick, schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            data, offsets = text_buffer(batch.column(1))
            for i, j in blocks(offsets):
                rows = list(_block_rows(ids[i:j], data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], plant))
                yield pick(batch.column(0).slice(i, j - i), rows)

    return docs.select(key, text).mapInArrow(run, schema)


def report(docs: DataFrame, key: str = "doc_id", text: str = "text", plant: bool = True) -> DataFrame:
    """One row a document: the number of runs, the longest one and digests of all runs and of the words
    that are left when each run keeps its first period only.  ``plant`` first makes one document in ten
    periodic (``planted``)."""
    kind = docs.schema[key].dataType.simpleString()

    def pick(ids: pa.Array, rows: list) -> pa.RecordBatch:
        cols = list(zip(*rows))
        longs = [pa.array(cols[i], pa.int64()) for i in range(5)]
        return pa.RecordBatch.from_arrays([ids, *longs, pa.array(cols[5], pa.string()), pa.array(cols[6], pa.string())],
                                          names=["doc_id", "n_runs", "start", "length", "period", "exponent_milli",
                                                 "runs_sha256", "collapsed_sha256"])

    return _map(docs, key, text, plant, pick, REPORT.format(id=kind))


def runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All runs of each document, (doc_id, runs array of (start, length, period), collapsed text)."""
    kind = docs.schema[key].dataType.simpleString()

    def pick(ids: pa.Array, rows: list) -> pa.RecordBatch:
        spans = pa.array([[{"start": a, "length": b, "period": c} for a, b, c in r[7]] for r in rows],
                         pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])))
        return pa.RecordBatch.from_arrays([ids, spans, pa.array([r[8].decode() for r in rows], pa.string())],
                                          names=["doc_id", "runs", "collapsed"])

    return _map(docs, key, text, False, pick,
                f"doc_id {kind}, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")
