"""Periodic runs against all (start, period) pairs by brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clickengine.llm import periodic_runs as PR
from clickengine.llm.queries import QUERIES
from tests.llm import cases


def brute(words):
    """Every run by definition: for each period, maximal stretches, kept where no smaller period fits."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size = j + q - i
            part = words[i:i + size]
            if size >= max(6, 4 * q) and not any(part[p:] == part[:-p] for p in range(1, q)):
                out.append((i, size, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def row(doc_id, text, plant=True):
    w = re.findall("[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if plant and doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute(w)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    rest = " ".join(x for i, x in enumerate(w) if i not in gone)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(rest.encode()).hexdigest())


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 4).flatmap(lambda k: st.lists(st.integers(0, k), max_size=60)))
def test_find_runs_is_brute_force(codes):
    assert PR.find_runs(codes) == brute(codes)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 5), min_size=1, max_size=7), st.integers(1, 9)), max_size=8))
def test_cut_texts_hold_all_runs(parts):
    """Repeated blocks beside each other: cutting first leaves every run whole."""
    codes = [c for block, times in parts for c in block * times]
    hashes = np.array([zlib.crc32(b"%d" % c) for c in codes], np.uint64)
    found = sorted(((lo + s, m, q) for lo, hi in PR.live_pieces(hashes, np.zeros(len(codes), int))
                    for s, m, q in PR.find_runs(codes[lo:hi])), key=lambda r: (r[0], r[2]))
    assert found == brute(codes)


def test_every_square_shows_up_in_an_access():
    rng = random.Random(5)
    for _ in range(60):
        codes = [rng.randint(0, 1) for _ in range(40)]
        got = {(end, end - j) for end, segments in PR.SuffixAutomaton(codes).accesses() for j, m in segments if end - j <= m}
        want = set()
        for end in range(40):
            for d in range(1, (end + 1) // 2 + 1):
                part = codes[end - 2 * d + 1:end + 1]
                if part[:d] == part[d:] and not any(part[p:] == part[:-p] for p in range(1, d)):
                    want.add((end, d))
        assert want <= got


def test_cutting_leaves_plain_prose_out():
    rng = random.Random(1)
    hashes = np.array([rng.randrange(1 << 40) for _ in range(2000)] * 2, np.uint64)
    assert PR.live_pieces(hashes, np.zeros(4000, int)) == []


@pytest.mark.parametrize("source", ["odd", "documents"])
def test_report(spark, source):
    df = cases.odd(spark, True) if source == "odd" else cases.documents(spark)
    docs = [(i, t) for i, t in cases.pairs(df) if len((t or "").split()) < 1500]
    keep = {i for i, _ in docs}
    got = sorted((tuple(r) for r in PR.report(df).collect() if r.doc_id in keep), key=str)
    assert PR.report(df).count() == df.count()
    want = sorted((row(i, t) for i, t in docs), key=str)
    assert got == [r for r in want if r[0] in keep]
    assert source == "odd" or sum(r[1] > 0 for r in got) > len(got) // 20


def test_long_repeated_text_and_hot_ids(spark):
    """One text of 200,000 words of one line, and many rows of one id."""
    line = "alpha beta gamma\n"
    df = spark.createDataFrame([(None, line * 60_000)] + [(7, "x y " * 5)] * 200, cases.SCHEMA)
    rows = PR.runs(df).collect()
    assert sorted((r.doc_id is None, [tuple(x) for x in r.runs], r.collapsed) for r in rows) == (
        [(False, [(0, 10, 2)], "x y")] * 200 + [(True, [(0, 180_000, 3)], "alpha beta gamma")])


def test_query_reads_the_whole_table(spark):
    docs = cases.documents(spark)
    got = QUERIES["op12_periodic_runs"](spark, "/root/testdata/sf0.001")
    assert got.count() == docs.count()
    assert PR.report(docs.limit(0)).collect() == []
