"""Exact substring deduplication: every byte inside a long string that also starts earlier goes.

A string of ``LENGTH`` bytes always holds a smallest hash among its k-grams, the same one
wherever the string stands.  So strings are met through anchors, some three of every hundred
positions: neighbouring windows with one anchor form a run, and runs with the same anchor
hash form a group.

1. ``_runs``: each task finds the runs of its documents, settles copies among its own
   documents, and ships the first of each.
2. ``_settle``: runs that are equal as a whole are settled by their hashes (anchor hash and a
   second one, over the whole run, 128 bits together).  Groups with different runs are left.
3. For those, the text of the runs is read from the documents, and ``suffix_sort`` orders the
   suffixes from the anchor on, and the reversed prefixes before it, by a mergesort whose
   comparisons find common extensions by binary search over polynomial prefix hashes.
   Neighbours' common extensions are then checked byte by byte.  Every window is equal to
   those with the same suffix class and the same prefix class, and all but the first go.
4. The ranges of each document are joined with its text.

An anchor hash that a third of all documents share, at the edge of a common passage, would
make one huge group of different runs.  Such anchors are found on a sample of documents; the
windows of their runs are then grouped by the hash of the whole window instead, which
spreads them and changes nothing in the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickengine.llm.common import PrefixHash, materialize, mix, ragged, text_buffer, whole_groups

#: Bytes of the strings that count as repeated.
LENGTH = 100
#: Windows' k-grams: a window of 100 bytes has 64 of 37 bytes.
SPAN = 64
GRAM = LENGTH - SPAN + 1
#: Window starts that are handled together.
STEP = (1 << 19) - 256
#: Runs that a task gathers before it settles and ships them.
GATHER = 200_000
#: One of so many documents is looked at to find crowded anchors ...
SAMPLE = 16
#: ... which have so many runs or more there, and one of 20,000 at least: 20,000 anchors at most.
CROWD, CROWD_SHARE = 48, 20_000

_MIN = -(2**63)
_RUN = "k long, h long, doc long, tie long, at long"
_RANGE = "doc long, tie long, a long, b long, u int, k long"


def _i64(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def _find_runs(data: np.ndarray, offsets: np.ndarray):
    """Arrays of the runs of some texts: text, start (in its text), left (anchor - start),
    right (last window - start), anchor hash, run hash; and whole-window hashes on demand."""
    for c in range(0, len(data), STEP):
        d = data[c:c + STEP + LENGTH]
        n = min(STEP, len(d) - LENGTH + 1)
        if n <= 0:
            continue
        prefix = PrefixHash(d, 11)
        at = np.arange(len(d) - GRAM + 1)
        gram = prefix.of(at, at + GRAM)
        best = (gram >> np.uint64(20) << np.uint64(20)) | at.astype(np.uint64)
        width = 1
        while width < SPAN:
            best = np.minimum(best[:-width], best[width:])
            width *= 2
        anchor = _i64(best[:n] & np.uint64((1 << 20) - 1))
        i, j = np.searchsorted(offsets, (c, c + n - 1), "right")  # texts i - 1 .. j - 1 reach into the step
        edge = np.clip(offsets[i - 1:j + 1], c, c + n)
        start = np.flatnonzero(np.repeat(offsets[i:j + 1], np.diff(edge)) - np.arange(c, c + n) >= LENGTH)
        if not len(start):
            continue
        new = np.ones(len(start), bool)
        new[1:] = (anchor[start[1:]] != anchor[start[:-1]]) | (start[1:] != start[:-1] + 1)
        first = np.flatnonzero(new)
        low, high = start[first], start[np.append(first[1:], len(start)) - 1]
        p = anchor[low]
        left, right = p - low, high - low
        whole = PrefixHash(d, 13)
        run_hash = mix(whole.of(low, high + LENGTH) + (left * 128 + right).astype(np.uint64))
        text = np.searchsorted(offsets, low + c, "right") - 1
        yield text, low + c - offsets[text], left, right, gram[p], run_hash, (prefix, whole, low)


def _each_window(left, right, hashes):
    """The windows of some runs, as runs of one window grouped by the whole window's hash."""
    prefix, whole, low = hashes
    n = right + 1
    back = np.repeat(np.arange(len(n)), n)
    at = ragged(low, n)
    return back, at - low[back], mix(prefix.of(at, at + LENGTH)), mix(whole.of(at, at + LENGTH))


def _first_of(k, h, doc, tie, at):
    """(order, lead): the runs sorted by class (k, h) and place, and for each sorted run the
    sorted position of its class's first run."""
    order = np.lexsort((at, tie, doc, h, k))
    k, h = k[order], h[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (h[1:] != h[:-1])
    lead = np.maximum.accumulate(np.where(new, np.arange(len(k)), 0))
    return order, lead


def _later(order, lead, doc, tie, at):
    """Indices of the runs that stand later than their class's first (not at the same place)."""
    d, t, a = doc[order], tie[order], at[order]
    return order[(d != d[lead]) | (t != t[lead]) | (a != a[lead])]


def _span(at):
    """(start, end) of the bytes of packed runs."""
    start = at >> 12
    return start, start + (at & 63) + LENGTH


def _merge(doc, tie, a, b):
    """Union of ranges, sorted by document."""
    if not len(doc):
        return doc, tie, a, b
    order = np.lexsort((a, tie, doc))
    doc, tie, a, b = doc[order], tie[order], a[order], b[order]
    fresh = np.ones(len(doc), bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (tie[1:] != tie[:-1])
    group = np.cumsum(fresh) - 1
    size = int(b.max()) + 1
    reach = np.maximum.accumulate(group * size + b) - group * size  # of this document so far
    new = fresh.copy()
    new[1:] |= a[1:] > reach[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], tie[first], a[first], reach[last]


def _runs(crowded: np.ndarray):
    """Task: (doc, tie, text) batches to rows of ``_RUN``.  A row with ``at`` below zero is a
    settled range: its start is -1 - at, its end h."""
    def ship(parts) -> Iterator[pa.RecordBatch]:
        k, h, doc, tie, at = (np.concatenate(x) for x in zip(*parts))
        order, lead = _first_of(k, h, doc, tie, at)
        later = _later(order, lead, doc, tie, at)
        a, b = _span(at[later])
        doc1, tie1, a1, b1 = _merge(doc[later], tie[later], a, b)
        firsts = order[np.unique(lead)]
        spread = _i64(mix(doc1.view(np.uint64) + np.uint64(17)))
        out = [np.concatenate(x) for x in ((k[firsts], spread), (h[firsts], b1), (doc[firsts], doc1),
                                           (tie[firsts], tie1), (at[firsts], -1 - a1))]
        for i in range(0, len(out[0]), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(x[i:i + 50_000]) for x in out], ["k", "h", "doc", "tie", "at"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            doc, tie = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            data, offsets = text_buffer(batch.column(2))
            for text, start, left, right, k, h, hashes in _find_runs(data, offsets):
                is_crowded = np.isin(_i64(k), crowded) if len(crowded) else np.zeros(len(k), bool)
                at = start << 12 | left << 6 | right
                if is_crowded.any():
                    few = np.flatnonzero(is_crowded)
                    prefix, whole, low = hashes
                    back, shift, wk, wh = _each_window(left[few], right[few], (prefix, whole, low[few]))
                    back = few[back]
                    rest = ~is_crowded
                    text, k, h = (np.concatenate((x[rest], y)) for x, y in ((text, text[back]), (k, wk), (h, wh)))
                    at = np.concatenate((at[rest], (start[back] + shift) << 12))
                parts.append((_i64(k), _i64(h), doc[text], tie[text], at))
                held += len(k)
                if held >= GATHER:
                    yield from ship(parts)
                    parts, held = [], 0
        if parts:
            yield from ship(parts)

    return task


def _columns(table: pa.Table, names: str) -> list[np.ndarray]:
    return [np.asarray(table.column(c).combine_chunks()) for c in names.split()]


def _ranges(doc, tie, a, b, u, k) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(doc), pa.array(tie), pa.array(a), pa.array(b), pa.array(u.astype(np.int32)), pa.array(k)],
        ["doc", "tie", "a", "b", "u", "k"])


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: rows of ``_RUN`` sorted by k to rows of ``_RANGE``: ranges to remove (u = -1), and
    the first runs of each class of groups with several classes (u: the anchor's offset)."""
    for table, _ in whole_groups(batches, "k", 100_000):
        k, h, doc, tie, at = _columns(table, "k h doc tie at")
        done = at < 0
        if done.any():
            yield _ranges(doc[done], tie[done], -1 - at[done], h[done], np.full(done.sum(), -1), k[done])
            k, h, doc, tie, at = (x[~done] for x in (k, h, doc, tie, at))
        if not len(k):
            continue
        order, lead = _first_of(k, h, doc, tie, at)
        later = _later(order, lead, doc, tie, at)
        a, b = _span(at[later])
        yield _ranges(doc[later], tie[later], a, b, np.full(len(later), -1), k[later])
        firsts = order[np.unique(lead)]
        key = k[firsts]
        mixed = np.zeros(len(key) + 1, bool)
        mixed[1:-1] = key[1:] == key[:-1]
        firsts = firsts[mixed[1:] | mixed[:-1]]
        a, b = _span(at[firsts])
        yield _ranges(doc[firsts], tie[firsts], a, b, at[firsts] >> 6 & 63, k[firsts])


def _extension(prefix: PrefixHash, a, b, most):
    """Length of the common extension from a and from b, at most ``most``: binary search over
    prefix hashes."""
    low, high = np.zeros(len(a), np.int64), most.copy()
    while True:
        open_ = low < high
        if not open_.any():
            return low
        mid = (low + high + 1) >> 1
        same = prefix.of(a, a + mid) == prefix.of(b, b + mid)
        low = np.where(open_ & same, mid, low)
        high = np.where(open_ & ~same, mid - 1, high)


def suffix_sort(data: np.ndarray, start: np.ndarray, length: np.ndarray, group: np.ndarray):
    """(order, common): strings data[start:start + length] sorted inside their groups (which
    stand together), and each one's common extension with the one before it (-1 for the
    first of a group).  Hash-compared mergesort, all groups at once; extensions are checked
    byte by byte, and strings whose hashes collided are sorted by their bytes."""
    n = len(start)
    prefix = PrefixHash(data, 17)
    padded = np.append(data, np.uint8(0))

    def less(i, j, or_equal):
        most = np.minimum(length[i], length[j])
        common = _extension(prefix, start[i], start[j], most)
        ended = common == most
        by_byte = padded[np.minimum(start[i] + common, len(data))] < padded[np.minimum(start[j] + common, len(data))]
        by_size = length[i] <= length[j] if or_equal else length[i] < length[j]
        return np.where(ended, by_size, by_byte)

    group_first = np.maximum.accumulate(np.where(np.append(True, group[1:] != group[:-1]), np.arange(n), 0))
    group_size = np.bincount(group_first, minlength=n)[group_first]
    place = np.arange(n) - group_first
    order = np.arange(n)
    width = 1
    while n and width < group_size.max():
        at = np.flatnonzero(group_size > width)  # sorted runs of ``width`` are merged in pairs
        inside = place[at]
        in_right = (inside // width) % 2 == 1
        pair = inside // (2 * width) * (2 * width)
        other = np.where(in_right, pair, pair + width)
        low = np.minimum(other, group_size[at])
        high = np.minimum(other + width, group_size[at])
        begin = low.copy()
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            mid = (low[open_] + high[open_]) >> 1
            mine, its = order[at[open_]], order[group_first[at[open_]] + mid]
            right = in_right[open_]
            before = np.empty(len(open_), bool)  # the other one goes before mine
            before[right] = less(its[right], mine[right], True)
            before[~right] = less(its[~right], mine[~right], False)
            low[open_] = np.where(before, mid + 1, low[open_])
            high[open_] = np.where(before, high[open_], mid)
        to = group_first[at] + pair + (inside - np.where(in_right, pair + width, pair)) + (low - begin)
        merged = order.copy()
        merged[to] = order[at]
        order = merged
        width *= 2

    common = np.full(n, -1, np.int64)
    near = np.flatnonzero(group[order][1:] == group[order][:-1]) + 1 if n else np.zeros(0, np.int64)
    a, b = order[near - 1], order[near]
    most = np.minimum(length[a], length[b])
    common[near] = _extension(prefix, start[a], start[b], most)
    if not _verified(padded, start[a], start[b], most, common[near]):
        pieces = [data[s:s + m].tobytes() for s, m in zip(start.tolist(), length.tolist())]
        order = np.array(sorted(range(n), key=lambda i: (group_first[i], pieces[i])), np.int64)
        a, b = order[near - 1], order[near]
        common[near] = [_common(pieces[i], pieces[j]) for i, j in zip(a.tolist(), b.tolist())]
    return order, common


def _verified(padded, a, b, most, common) -> bool:
    """True if the bytes are equal over ``common`` and differ after it, or one string ends there."""
    width = int(most.max(initial=0))
    for i in range(0, len(a), 20_000):
        s = slice(i, i + 20_000)
        step = np.arange(width)
        last = len(padded) - 1
        same = padded[np.minimum(a[s, None] + step, last)] == padded[np.minimum(b[s, None] + step, last)]
        same &= step < most[s, None]
        true = np.where(same.all(axis=1), width, np.argmin(same, axis=1)) if width else np.zeros(len(a[s]), np.int64)
        if (true != common[s]).any():
            return False
    return True


def _common(x: bytes, y: bytes) -> int:
    n = min(len(x), len(y))
    return next((i for i in range(n) if x[i] != y[i]), n)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: (k, doc, tie, a, u, piece) rows sorted by k, the text of runs, to ranges to remove."""
    for table, _ in whole_groups(batches, "k", 20_000):
        k, doc, tie, a, u = _columns(table, "k doc tie a u")
        order = np.lexsort((a, tie, doc, k))
        keep = np.ones(len(order), bool)  # a repeated row is the same place
        x = [c[order] for c in (k, doc, tie, a)]
        keep[1:] = np.any([c[1:] != c[:-1] for c in x], axis=0)
        order = order[keep]
        k, doc, tie, a, left = (c[order] for c in (k, doc, tie, a, u.astype(np.int64)))
        data, offsets = text_buffer(table.column("piece").take(pa.array(order)))
        size = np.diff(offsets)
        anchor = offsets[:-1] + left
        n = len(k)
        right_order, right_common = suffix_sort(data, anchor, size - left, k)
        left_order, left_common = suffix_sort(np.ascontiguousarray(data[::-1]), len(data) - anchor, left, k)
        windows = size - LENGTH  # the last window's offset from the first
        gone = np.zeros((n, SPAN + 1), bool)
        suffix_class, prefix_class = np.empty(n, np.int64), np.empty(n, np.int64)
        for back in range(SPAN):  # windows that start so far before the anchor
            here = np.flatnonzero((left >= back) & (left - windows <= back))
            if len(here) < 2:
                continue
            suffix_class[right_order] = np.cumsum(right_common < LENGTH - back)
            prefix_class[left_order] = np.cumsum(left_common < back)
            key = suffix_class[here] * (n + 1) + prefix_class[here]
            by = np.argsort(key, kind="stable")
            again = here[by[1:][key[by[1:]] == key[by[:-1]]]]
            gone[again, left[again] - back] = True
        edge = np.diff(np.concatenate((np.zeros((n, 1), np.int8), gone.astype(np.int8)), axis=1), axis=1)
        row, first = np.nonzero(edge == 1)
        _, last = np.nonzero(edge == -1)
        yield _ranges(doc[row], tie[row], a[row] + first, a[row] + last - 1 + LENGTH, np.full(len(row), -1), k[row])


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: (doc_id, text, ranges) to the report's rows and the kept bytes."""
    for batch in batches:
        data, offsets = text_buffer(batch.column(1))
        lists = batch.column(2)
        counts = np.asarray(pc.fill_null(pc.list_value_length(lists), 0)).astype(np.int64)
        flat = lists.flatten()
        row = np.repeat(np.arange(len(counts)), counts)
        a = np.asarray(flat.field("a")) if len(flat) else np.zeros(0, np.int64)
        b = np.asarray(flat.field("b")) if len(flat) else np.zeros(0, np.int64)
        row, _, a, b = _merge(row, np.zeros(len(row), np.int64), a, b)
        spans = np.bincount(row, minlength=len(counts))
        gone = np.zeros(len(counts), np.int64)
        np.add.at(gone, row, b - a)
        first = np.searchsorted(row, np.arange(len(counts) + 1))
        raw = data.tobytes()
        kept = []
        for i in range(len(counts)):
            s, e = int(offsets[i]), int(offsets[i + 1])
            if first[i] == first[i + 1]:
                kept.append(raw[s:e])
                continue
            cuts = [0, *np.stack([a[first[i]:first[i + 1]], b[first[i]:first[i + 1]]], 1).ravel().tolist(), e - s]
            kept.append(b"".join(raw[s + x:s + y] for x, y in zip(cuts[::2], cuts[1::2])))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.diff(offsets)), pa.array(gone), pa.array(spans.astype(np.int64)),
             pa.array([hashlib.sha256(x).hexdigest() for x in kept]), pa.array(kept, pa.binary())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def _crowded(docs: DataFrame) -> np.ndarray:
    """Anchor hashes with many runs in the sample of documents, by hash of their id."""
    sample = docs.where(F.pmod(F.xxhash64("doc", F.lit(1)), F.lit(SAMPLE)) == 0)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column(2))
            for *_, k, _, _ in _find_runs(data, offsets):
                key, n = np.unique(_i64(k), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], ["k", "n"])

    counts = sample.mapInArrow(count, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).where(F.col("n") > 1)
    counts = materialize(counts)
    total = counts.agg(F.sum("n")).first()[0] or 0
    rows = counts.where(F.col("n") >= max(CROWD, total // CROWD_SHARE)).select("k").collect()
    return np.sort(np.array([r.k for r in rows], np.int64))


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, n_bytes, n_removed, n_spans, kept_sha256 and kept (the remaining bytes) of every row.

    Texts are UTF-8 bytes; a null text is empty; texts shorter than ``LENGTH`` keep all.  Documents
    are ordered by the key, null first; rows of one key and different texts are documents of
    their own, in the order of a hash of the text, and fully repeated rows are one document, whose
    result each of them gets.  Other columns aren't read.
    """
    source = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(_MIN)).alias("doc"),
                         F.coalesce(F.col(text), F.lit("")).alias("text"))
    digest = F.xxhash64("text")
    many = source.groupBy("doc").agg(F.min(digest).alias("x"), F.max(digest).alias("y")).where("x <> y").limit(1).count()
    source = source.withColumn("tie", digest if many else F.lit(0).cast("long"))
    texts = source.select("doc", "tie", "text")

    runs = texts.mapInArrow(_runs(_crowded(texts)), _RUN)
    settled = materialize(runs.repartition("k").sortWithinPartitions("k").mapInArrow(_settle, _RANGE))

    # A document is its key, and where keys repeat its key and digest: rows of one key, null too,
    # are then split over tasks.  Without repeated keys the documents are dealt out once, and both
    # joins below read the same exchange; with them fully repeated rows are read once for the
    # comparison, and the join that gives each row its ranges may be split at a hot document.
    whole = source.select("doc", "tie", F.col("text").cast("binary").alias("text"))
    if many:
        place, dealt, once = ["doc", "tie"], whole, whole.dropDuplicates(["doc", "tie"])
    else:
        n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        place = ["doc"]
        dealt = once = whole.drop("tie").repartition(n, "doc")
        settled = settled.drop("tie")
    pieces = once.join(settled.where("u >= 0"), place).select(
        "k", "doc", "tie" if many else F.lit(0).cast("long").alias("tie"), "a", "u",
        F.substring("text", (F.col("a") + 1).cast("int"), (F.col("b") - F.col("a")).cast("int")).alias("piece"))
    compared = pieces.repartition("k").sortWithinPartitions("k").mapInArrow(_compare, _RANGE)
    ranges = (settled.where("u < 0").unionByName(compared.select(settled.columns)).groupBy(*place)
              .agg(F.collect_list(F.struct("a", "b")).alias("ranges")))
    kind = docs.select(key).schema[0].dataType.simpleString()
    name = F.when(F.col("doc") != _MIN, F.col("doc")).cast(kind)
    out = dealt.join(ranges, place, "left").select(name, "text", "ranges").mapInArrow(
        _removed, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return out.withColumnRenamed("doc_id", key)
