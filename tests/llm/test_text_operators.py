"""Personal data, near duplicates, quality rules, decontamination, exact repeats."""

import collections
import hashlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickengine.llm import common, decontamination, graph, near_dedup, pii, quality_rules, suffix_dedup
from clickengine.llm.common import text_buffer
from clickengine.llm.queries import QUERIES
from tests.llm import cases


@pytest.mark.parametrize("source", ["odd", "documents"])
def test_pii_base_spans(spark, source):
    df = cases.odd(spark, True) if source == "odd" else cases.documents(spark)
    got = sorted((str(r.doc_id), r.base_sha256, (r.n_email, r.n_ip, r.n_card, r.n_phone)) for r in pii.span_report(df).collect())
    want = []
    for i, t in cases.pairs(df):
        b = cases.base_spans(t)
        want.append((str(i), hashlib.sha256(b.encode()).hexdigest(),
                     tuple(b.count(k + ":") for k in ("email", "ip", "card", "phone"))))
    assert got == sorted(want)


TRICKY = ["a@b.com_x@y.zz", "a@b.com.@c.dd", "a@b@c.dd", "1.2.3.4.5.6.7.8", "300.1.2.3.4", "00001.2.3.255", "1234 5678-9012 3456",
          "4111111111111111 4111111111111112", "4111-1111-1111-1111-5", "+1 2+3 4444444444", "+123456789", "+1 (2) 3.4-5",
          "+12345678 \U0001f600 1.1.1.1", "9" * 3000, "a" * 3000 + "@b.c" + ".d" * 3000, "+" + "1 " * 3000 + "2", "1.1" * 2000,
          "x@y." * 2000, "@" * 3000, "+9" * 2000]


def test_pii_hard_texts(spark):
    df = spark.createDataFrame(list(enumerate(TRICKY)), cases.SCHEMA)
    for r in pii.span_report(df).collect():
        assert r.base_sha256 == hashlib.sha256(cases.base_spans(TRICKY[r.doc_id]).encode()).hexdigest(), TRICKY[r.doc_id][:60]


def test_pii_added_kinds_and_context(spark):
    texts = ["IBAN DE89 3704 0044 0532 0130 00 The end", "IBAN DE88 3704 0044 0532 0130 00", "GB82WEST12345698765432",
             "my ssn is 078-05-1120", "order 078-05-1120 is late"]
    rows = {r.doc_id: r for r in pii.span_report(spark.createDataFrame(list(enumerate(texts)), cases.SCHEMA)).collect()}
    assert rows[0].spans == "iban:5:32" and rows[2].spans == "iban:0:22"
    assert rows[1].spans == "" and rows[4].spans == "" and rows[3].spans == "ssn:10:21"


def test_pii_spans_beside_other_digits(spark):
    """Where other digits spoil the contract's match, the usual forms still count."""
    texts = ["call +1 (269) 555-3296 4524132264652876 x", "+1 (555) 123-4567 4111 1111 1111 1111 10.0.0.1",
             "12 4111-1111-1111-1111 34 5", "4111111111111112", "+49 30 123 4567 99999999999"]
    rows = {r.doc_id: r for r in pii.span_report(spark.createDataFrame(list(enumerate(texts)), cases.SCHEMA)).collect()}
    assert rows[0].spans == "card:23:39,phone:5:22" and rows[0].n_card == rows[0].n_phone == 0 and rows[0].n_added == 2
    assert rows[1].spans == "ip:38:46,card:18:37,phone:0:17"
    assert rows[2].spans == "card:3:22" and rows[3].spans == ""
    assert rows[4].spans == "phone:0:15"


def test_pii_redaction(spark):
    df = cases.odd(spark, True).withColumn("n_chars", F.length("text").cast("long"))
    out = {r.doc_id: r for r in pii.redact(df, length="n_chars").collect()}
    assert out[11].text == "[EMAIL] [PHONE] [CARD] [IP] 999.1.1.1" and out[11].n_chars == len(out[11].text)
    assert out[16].text == "emoji \U0001f600 \U0001f600 mail [EMAIL] \U0001f600 [PHONE]"
    assert out[4].text is None and out[14].text == cases.ODD[15][1] and out[1].slot == "x1"
    assert pii.redact(df).columns == df.columns
    again = pii.span_report(pii.redact(df)).agg(F.sum("n_email") + F.sum("n_phone") + F.sum("n_card")).first()[0]
    assert again == 0


def _near(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(df).collect()), key=str)


def _near_plain(df):
    docs = cases.pairs(df)
    group = cases.near_groups(docs)
    return sorted(((i, len(cases.shingles(t)), group[i], group[i] == i) for i, t in docs), key=str)


def test_near_duplicates(spark):
    df = cases.documents(spark, "sf0.01")
    assert _near(df) == _near_plain(df)


def test_near_duplicates_odd_rows(spark):
    df = cases.odd(spark, True)
    assert _near(df) == _near_plain(df)


def test_near_duplicates_in_small_nodes_and_groups(spark, monkeypatch):
    """Nodes branch to the end and are split with hubs; components are compared node by node."""
    for name, value in (("NODE", 8), ("GROUP", 6), ("HUBS", 4), ("ROUNDS", 2)):
        monkeypatch.setattr(near_dedup, name, value)
    words = [f"w{i}" for i in range(200)]
    texts = [" ".join(words[:k] + [f"u{i}"] + words[k + 1:]) for i, k in enumerate(range(5, 195, 5))]
    df = spark.createDataFrame(list(enumerate(texts + ["other words here " * 9])), cases.SCHEMA)
    assert _near(df) == _near_plain(df)


def test_near_duplicates_linked_to_a_centre_only(spark, monkeypatch):
    """Copies with two edited words each: near the template (0.81), not near each other (0.73 at most)."""
    for name, value in (("NODE", 8), ("GROUP", 6), ("HUBS", 1), ("ROUNDS", 1)):
        monkeypatch.setattr(near_dedup, name, value)
    words = [f"w{i}" for i in range(100)]
    texts = [" ".join(words)]
    for a in range(5, 95, 5):
        for b in range(a + 5, 95, 5):
            texts.append(" ".join(f"u{len(texts)}" if k in (a, b) else w for k, w in enumerate(words)))
    df = spark.createDataFrame([(900 - i, t) for i, t in enumerate(texts)] + [(1, "other words here " * 9)], cases.SCHEMA)
    got = _near(df)
    assert got == _near_plain(df) and len({c for _, _, c, _ in got}) == 2


@pytest.mark.parametrize("most", [150, 1000])
def test_near_duplicates_in_groups_of_few_shingles(spark, monkeypatch, most):
    """Groups with more shingles are compared by pairs of blocks, and no link is lost."""
    words = [f"w{i}" for i in range(100)]
    chain = [" ".join(words[:k] + [f"u{i}"] + words[k + 1:]) for i, k in enumerate(range(5, 95, 5))]
    star = [" ".join(f"v{w}" for w in words[:k]) for k in range(80, 105)] + ["vw0 " * 2000]
    df = spark.createDataFrame(list(enumerate(chain + star)), cases.SCHEMA)
    want = _near_plain(df)
    monkeypatch.setattr(near_dedup, "GROUP_SHINGLES", most)
    assert _near(df) == want


def test_whole_groups_by_bytes():
    rng = np.random.default_rng(2)
    k = np.sort(rng.integers(0, 40, 500))
    text = ["x" * int(n) for n in rng.integers(0, 300, 500)]
    rows = pa.RecordBatch.from_arrays([pa.array(k), pa.array(text)], ["k", "text"])
    tables = list(common.whole_groups(iter([rows.slice(0, 333), rows.slice(333)]), "k", 400, 5000))
    assert pa.concat_tables([t for t, _ in tables]).to_pydict() == rows.to_pydict()
    of = [set(t.column("k").to_pylist()) for t, _ in tables]
    assert sum(map(len, of)) == len(set(k)) and max(t.nbytes for t, _ in tables) < 20_000
    for t, first in tables:
        own = t.column("k").to_numpy()
        assert first.tolist() == [i for i in range(len(own)) if not i or own[i] != own[i - 1]]


def test_near_duplicates_recall_just_above_the_threshold(spark):
    """600 pairs at similarity 0.754 (86 of 114 shingles): the trees and sketches lose next to none."""
    rows = []
    for i in range(600):
        words = [f"a{i}x{k}" for k in range(104)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words[:90] + [f"b{i}x{k}" for k in range(14)]))]
    df = spark.createDataFrame(rows, cases.SCHEMA)
    got = [r for r in near_dedup.near_duplicates(df).collect() if r.doc_id % 2]
    linked = sum(r.component_id == r.doc_id - 1 for r in got)
    assert all(r.component_id in (r.doc_id, r.doc_id - 1) for r in got) and linked >= 597


def test_near_duplicates_threshold_is_exact(spark):
    words = [f"w{i}" for i in range(300)]
    base = " ".join(words[:104])  # 100 shingles
    # Cut words from the end: 75 of 100 shingles are shared, then 74.
    df = spark.createDataFrame([(1, base), (2, " ".join(words[:79])), (3, " ".join(words[26:104]))], cases.SCHEMA)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(df).collect()}
    assert got == {1: (100, 1), 2: (75, 1), 3: (74, 3)}


def test_keep_first(spark):
    df = cases.odd(spark, True)
    out = near_dedup.keep_first(df)
    assert out.columns == df.columns
    group = cases.near_groups(cases.pairs(df))
    want = sorted(str(i) for i in group if group[i] == i)
    assert sorted(str(r.doc_id) for r in out.collect()) == want


def test_near_duplicates_of_null_and_repeated_ids(spark):
    """Links are those of the texts; only copies and linked rows go."""
    a, b, c, d, e = (" ".join(f"{x}{i}" for i in range(60)) for x in "abcde")
    rows = [(None, a), (None, b), (None, b + " more"), (None, c), (None, c), (1, a + " more"), (2, d), (2, e), (2, e),
            (3, e + " more"), (None, ""), (None, None), (4, ""), (4, "")]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], cases.SCHEMA + ", n long")
    got = near_dedup.near_duplicates(df.where("n not in (2, 4)")).collect()
    want = [(None, 56, 1, False), (None, 56, None, True), (None, 56, None, True), (1, 57, 1, True), (2, 56, 2, True),
            (2, 56, 2, True), (2, 56, 2, True), (3, 57, 2, False), (None, 0, None, True), (None, 0, None, True),
            (4, 0, 4, True), (4, 0, 4, True)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    out = near_dedup.keep_first(df)
    assert out.columns == df.columns
    assert sorted(str((r.doc_id, (r.text or "")[:2])) for r in out.collect()) == sorted(map(str, [
        (None, "b0"), (None, "c0"), (1, "a0"), (2, "d0"), (2, "e0"), (None, ""), (None, ""), (4, "")]))


@settings(max_examples=30, deadline=None)
@given(st.integers(1, 30), st.lists(st.tuples(st.integers(0, 29), st.integers(0, 29)), max_size=40))
def test_local_components(n, links):
    links = [(a % n, b % n) for a, b in links]
    label = list(range(n))
    for _ in range(n):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    got = graph.local_components(n, np.array([a for a, _ in links], np.int64), np.array([b for _, b in links], np.int64))
    assert got.tolist() == label


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(300, 340)] + [(7, 500)]
    got = {r.u: r.c for r in graph.components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 7 for i in [7, 500, *range(300, 340)]}}


def test_quality_counts_and_verdicts(spark):
    docs = cases.odd(spark, True).select("doc_id", "text").unionByName(cases.documents(spark).select("doc_id", "text"))
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    model = quality_rules.fit(docs, quality_rules.trusted_ids(labels))
    rows = quality_rules.judge(docs, model).collect()
    want = sorted(((i, *cases.counts(t)) for i, t in cases.pairs(docs)), key=str)
    assert sorted(((r.doc_id, *(r[c] for c in quality_rules.COUNTS)) for r in rows), key=str) == want
    for r in rows:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept == (not r.base_failed and r.score >= quality_rules.MIN_SCORE)


def test_quality_score_is_the_mean_log_ratio(spark):
    docs = spark.createDataFrame([(1, "aaaab"), (2, "zzzz"), (None, "aaaa")], cases.SCHEMA)
    model = quality_rules.fit(docs, spark.createDataFrame([(1,)], "k long"))
    size = quality_rules.BUCKETS
    target, raw = {"aaaa": 1, "aaab": 1}, {"aaaa": 2, "aaab": 1, "zzzz": 1}
    ratio = {g: np.log((target.get(g, 0) + .5) / (2 + .5 * size)) - np.log((n + .5) / (4 + .5 * size)) for g, n in raw.items()}
    got = {r.doc_id: r.score for r in quality_rules.judge(docs, model).collect()}
    assert got[1] == pytest.approx((ratio["aaaa"] + ratio["aaab"]) / 2) and got[2] == pytest.approx(ratio["zzzz"])


def test_quality_separates_held_out_labels(spark):
    docs = cases.documents(spark, "sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = quality_rules.fit(docs, quality_rules.trusted_ids(labels.where("doc_id % 2 = 0")))
    test = quality_rules.judge(docs, model).join(labels.where("doc_id % 2 = 1"), "doc_id")
    good = test.where("quality = 1 and toxic = 0 and not base_failed")
    assert good.where("not kept").count() == 0
    bad = test.where("quality = 0")
    assert bad.where("not kept").count() > 0.8 * bad.count()


def test_decontamination(spark):
    docs = cases.documents(spark, "sf0.01").select("doc_id", "text")
    bench = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    _decontaminated(docs, bench)


def _decontaminated(docs, bench):
    want = cases.contaminated(cases.pairs(docs), [(r.item_id, r.text) for r in bench.collect()])
    got = [(r.doc_id, r.n_words, r.n_hit, r.items_sha256, r.contaminated, r.n_items) for r in decontamination.report(docs, bench).collect()]
    assert sorted(got, key=str) == sorted(((i, n, h, hashlib.sha256(s.encode()).hexdigest(), h > 0 and 20 * h >= n,
                                            len(s.split(",")) if s or h else 0) for i, n, h, s in want), key=str)
    kept = decontamination.remove(docs, bench)
    assert kept.columns == docs.columns
    assert kept.count() == sum(not (h > 0 and 20 * h >= n) for _, n, h, _ in want)


def test_decontamination_odd_rows_in_blocks(spark, monkeypatch):
    """Short items, items of the same words, nulls, and a benchmark of several blocks."""
    monkeypatch.setattr(decontamination, "BENCHMARK_BLOCK", 40)
    items = [(1, "WORD5 of5, word6 of6"), (2, "word5 of5 word6 of6"), (3, None), (4, "..."), (None, "one"),
             (5, " ".join(f"word{i} of{i % 7}" for i in range(20, 40))), (6, "a b c d e f"), (7, "zz " * 30)]
    bench = cases.odd(spark).sparkSession.createDataFrame(items, "item_id long, text string")
    _decontaminated(cases.odd(spark, True), bench)
    spans = {(r.doc_id, r.start, r.end) for r in decontamination.locations(cases.odd(spark), bench).collect()}
    assert (7, 0, 1) in spans and (9, 0, 6) not in spans and (10, 0, 6) in spans
    longest = {r.doc_id: r.longest_match for r in decontamination.report(cases.odd(spark), bench).collect()}
    assert longest[1] == 40 and longest[10] == 6 and longest[4] == 0


def _longest_plain(words, items):
    """Longest common stretch of at least a window with an item, or a whole shorter item."""
    best = 0
    for item in items:
        least = min(decontamination.WINDOW, len(item))
        if not least:
            continue
        for i in range(len(words)):
            for j in range(len(item)):
                k = 0
                while i + k < len(words) and j + k < len(item) and words[i + k] == item[j + k]:
                    k += 1
                best = max(best, k if k >= least else 0)
    return best


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=40), min_size=1, max_size=5),
       st.lists(st.lists(st.sampled_from("abc"), max_size=30), min_size=1, max_size=5))
def test_longest_match_is_that_of_brute_force(texts, items):
    tests = decontamination.make_tests([(str(i), " ".join(x)) for i, x in enumerate(items)])
    data, offsets = text_buffer(pa.array([" ".join(t) for t in texts]))
    shard = decontamination.Shard(data, offsets)
    shard.match(tests)
    assert shard.longest.tolist() == [_longest_plain(t, items) for t in texts]
    assert all(len(v) == 1 for v in shard.items.values()) and set(shard.items) == set(shard.spans)


def test_decontamination_of_a_common_line(spark):
    """One line in thousands of documents and items: places aren't paired, lists are shared."""
    import tracemalloc
    line = "this one line of fifteen words stands in all documents and in all items here"
    tests = decontamination.make_tests([(str(i), f"{line} item number {i}") for i in range(5000)])
    data, offsets = text_buffer(pa.array([f"doc {i} {line} end {i}" for i in range(5000)]))
    tracemalloc.start()
    shard = decontamination.Shard(data, offsets)
    shard.match(tests)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (shard.longest == 15).all() and len({id(v[0]) for v in shard.items.values()}) == 1 and len(shard.items[7][0]) == 5000
    assert peak < 100 << 20


def test_decontamination_without_benchmark(spark):
    _decontaminated(cases.odd(spark), spark.createDataFrame([], "item_id long, text string"))


def _removed(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(df).collect()}


def _removed_plain(df):
    out = cases.repeats(cases.pairs(df.dropDuplicates(["doc_id"])))
    return {i: (n, g, s, hashlib.sha256(k).hexdigest()) for i, (n, g, s, k) in out.items()}


def test_repeats(spark):
    df = cases.documents(spark)
    assert _removed(df) == _removed_plain(df)


@pytest.mark.parametrize("crowd", [48, 2])
def test_repeats_odd_rows(spark, monkeypatch, crowd):
    """Also with every anchor that comes twice taken for a crowded one."""
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    monkeypatch.setattr(suffix_dedup, "SAMPLE", 1 if crowd == 2 else 16)
    monkeypatch.setattr(suffix_dedup, "CROWD_SHARE", 10**9)
    more = [(100 + i, t) for i, t in enumerate(
        ["ab" * 333, "x" * 99, "a" * 100, "thequick" * 40 + "Z" + "thequick" * 40, "é" * 120, "q" + "é" * 120])]
    df = cases.odd(spark, True).select("doc_id", "text").unionByName(spark.createDataFrame(more, cases.SCHEMA))
    assert _removed(df) == _removed_plain(df)


def test_repeats_of_one_id(spark):
    """Rows of one id and different texts are documents of their own."""
    text = "".join(f"{i:04d}" for i in range(60))
    df = spark.createDataFrame([(1, text), (1, text + "tail"), (1, text)], cases.SCHEMA)
    rows = suffix_dedup.remove_repeats(df).collect()
    assert len(rows) == 3 and sorted(r.n_removed for r in rows)[-1] == 240 and sum(r.n_removed == 0 for r in rows) in (1, 2)


def test_repeats_of_many_null_and_repeated_ids(spark):
    """A third of the rows on a null id, a third on one id, with a passage that all share: the rows
    are judged in the order of (id, hash of the text), and are dealt out by both."""
    line = "a passage that every document of this table shares, long enough to count as one. " * 2
    rows = [((None, 7, i)[i % 3], f"{i * i} " * (i % 5) + line + f"tail {i}") for i in range(600)]
    rows += [(None, rows[0][1])] * 50
    df = spark.createDataFrame(rows, cases.SCHEMA)
    order = [r.text for r in df.dropDuplicates().orderBy(F.asc_nulls_first("doc_id"), F.xxhash64("text")).collect()]
    plain = cases.repeats(list(enumerate(order)))
    by_text = {t: (n, g, s, hashlib.sha256(k).hexdigest()) for t, (n, g, s, k) in zip(order, (plain[i] for i in range(len(order))))}
    out = suffix_dedup.remove_repeats(df)
    got = collections.Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out.collect())
    assert got == collections.Counter((i, *by_text[t]) for i, t in rows)
    assert "hashpartitioning(doc" in (plan := out._jdf.queryExecution().toString()) and ", tie" in plan


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.text("ab", max_size=12), min_size=1, max_size=9), min_size=1, max_size=4))
def test_suffix_sort(groups):
    texts = [t for g in groups for t in g]
    group = np.repeat(np.arange(len(groups)), [len(g) for g in groups])
    data, offsets = text_buffer(pa.array(texts))
    order, common = suffix_dedup.suffix_sort(data, offsets[:-1], np.diff(offsets), group)
    assert [(group[i], texts[i]) for i in order] == sorted((int(k), t) for k, t in zip(group, texts))
    for k in range(1, len(order)):
        a, b = order[k - 1], order[k]
        if group[a] == group[b]:
            assert common[k] == suffix_dedup._common(texts[a].encode(), texts[b].encode())


def test_suffix_sort_survives_colliding_hashes(monkeypatch):
    monkeypatch.setattr(suffix_dedup.PrefixHash, "of", lambda self, a, b: np.zeros(len(a), np.uint64))
    data, offsets = text_buffer(pa.array(["b", "ab", "aa", "b"]))
    order, common = suffix_dedup.suffix_sort(data, offsets[:-1], np.diff(offsets), np.zeros(4, np.int64))
    assert order.tolist() == [2, 1, 0, 3] and common.tolist() == [-1, 1, 0, 1]


def test_empty_tables(spark):
    none = cases.odd(spark, True).limit(0)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert pii.span_report(none).count() == 0 and pii.redact(none).count() == 0
    assert near_dedup.near_duplicates(none).count() == 0 and near_dedup.keep_first(none).count() == 0
    model = quality_rules.fit(none, quality_rules.trusted_ids(labels))
    assert quality_rules.judge(none, model).count() == 0 and quality_rules.keep(none, model).count() == 0
    assert decontamination.report(none, bench).count() == 0 and suffix_dedup.remove_repeats(none).count() == 0
    assert (model.ratio == 0).all()


def test_near_dedup_query_keeps_the_component_id(spark, tmp_path):
    """Two linked texts of one id: the query's kept is doc_id = component_id for both."""
    base = " ".join(f"w{i}" for i in range(80))
    df = spark.createDataFrame([(5, base), (5, base + " more"), (9, base + " end"), (7, "other words here")], cases.SCHEMA)
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((r.doc_id, r.component_id, r.kept) for r in QUERIES["op2_near_dedup"](spark, str(tmp_path)).collect())
    assert got == [(5, 5, True), (5, 5, True), (7, 7, True), (9, 5, False)]
