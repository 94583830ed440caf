"""Classifier, packing, token files, sharding, URL rules, the pipeline."""

import collections
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from clickengine.llm import packing, quality_classifier, sharding, tokens, url_filter, wavelet
from clickengine.llm.common import text_buffer
from clickengine.llm.queries import tokenizer_file
from clickengine.llm.tokens import Encoder
from tests.llm import cases


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_file())
    t.encode_special_tokens = True
    return t


def _ids(tokenizer, texts):
    return [e.ids for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_encoder_is_the_tokenizer(tokenizer):
    texts = [t for _, t in cases.ODD] + [
        "  a  b ", " x", "x ", "a\n b", "a \n\nb", "it's  's 's", "a\tb  c", "<|endoftext|> a<|endoftext|>",
        " x  y z　 w", "a " + " " * 50 + "b", "\x00a \x00b", "a\x1c b \x1cc", "a\x85 b", "日本 語 text", "½ ² a²"]
    ids, first = Encoder.of(tokenizer_file()).encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:])] == _ids(tokenizer, texts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list(" \n\tab1.'!éß日\u00a0\u200b\x1c|")), max_size=25), max_size=4))
def test_encoder_on_any_spacing(texts):
    encoder = Encoder.of(tokenizer_file())
    want = [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    for ids, first in (encoder.encode(texts), encoder._in_pieces(texts)):
        assert [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:])] == want


def test_encoder_on_latin_characters_and_long_runs(tokenizer):
    rng = np.random.default_rng(4)
    latin = [chr(c) for c in range(0x260)]
    texts = ["".join(rng.choice(latin, 300)) for _ in range(200)]
    texts += ["".join(f"{a}x{a}1 {a} {a}'s" for a in latin[k:k + 40]) for k in range(0, len(latin), 40)]
    texts += [c * n + end for c in " \n\ta!1é" for n in (9_998, 10_000, 60_000) for end in ("", "x", " x")]
    encoder = Encoder.of(tokenizer_file())
    assert encoder.by_rank is not None
    ids, first = encoder.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:])] == _ids(tokenizer, texts)


def test_merges_that_ids_do_not_order_are_left_to_the_tokenizer():
    """Tokens that no merge makes, or ids in another order than the merges, change what is merged first."""
    from tokenizers import Tokenizer, models, pre_tokenizers
    base = {c: i for i, c in enumerate(tokens._byte_letters().values())}

    def made(merges, extra=()):
        vocab = base | {"".join(m): 256 + i for i, m in enumerate(merges)} | dict(extra)
        t = Tokenizer(models.BPE(vocab=vocab, merges=merges))
        t.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
        return t

    good = made([("a", "b"), ("ab", "c")])
    assert tokens._by_rank(good).encode_ordinary("abcab") == good.encode("abcab").ids
    assert tokens._by_rank(made([("a", "b")], {"bc": 300})) is None
    assert tokens._by_rank(made([("b", "c"), ("a", "b")], {"bc": 300})) is None


def test_added_tokens_are_those_of_the_untouched_tokenizer(spark):
    from tokenizers import Tokenizer
    untouched = Tokenizer.from_file(tokenizer_file())
    texts = ["a<|endoftext|> b", "<|endoftext|>", " x  <|endoftext|>  y it's", "<|endoftext|><|endoftext|> é 日本", "a <|endoftext| > b",
             "plain words", "", "<|endoftext|> \n" * 40 + "z"]
    want = _ids(untouched, texts)
    assert want[0] == [64, 50256, 275]
    ids, first = Encoder.of(tokenizer_file(), added=True).encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:])] == want
    df = spark.createDataFrame(list(enumerate(texts)), cases.SCHEMA)
    rows = packing.pack_documents(df, tokenizer_file(), keep_ids=True).collect()
    assert {r.doc_id: (r.length, r.ids_crc32) for r in rows} == {i: (len(x) + 1, _crc(x + [packing.END])) for i, x in enumerate(want)}
    shards = wavelet.encode_documents(df, tokenizer_file()).collect()
    assert sorted(r.doc_id for r in shards) == list(range(len(texts)))
    assert {r.doc_id: (r.n_tokens, r.ids_crc32) for r in shards} == {i: (len(x) + 1, _crc(x + [wavelet.END])) for i, x in enumerate(want)}


def _crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("source", ["odd", "documents"])
def test_packing(spark, tokenizer, source):
    df = cases.odd(spark, True) if source == "odd" else cases.documents(spark)
    docs = cases.pairs(df)
    rows = packing.pack_documents(df, tokenizer_file(), keep_ids=True).collect()
    want = collections.Counter()
    total = 0
    for (i, _), ids in zip(docs, _ids(tokenizer, [t for _, t in docs])):
        ids = ids + [2]
        total += len(ids)
        for k, (s, n) in enumerate(packing.cut(len(ids))):
            want[i, k, s, n, _crc(ids[s:s + n])] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    places = collections.defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for v in places.values():
        at = 0
        for offset, length in sorted(v):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(places) <= -(-total // 1024) * 1.03 + 2
    if source == "odd":
        joined = packing.sequences(packing.pack_documents(df, tokenizer_file(), keep_ids=True))
        assert sum(len(r.ids) // 4 for r in joined.collect()) == total


def test_cut():
    assert packing.cut(0) == [] and packing.cut(1024) == [(0, 1024)] and packing.cut(1025) == [(0, 1), (1, 1024)]
    assert packing.cut(2048) == [(0, 1024), (1024, 1024)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60), st.integers(40, 50))
def test_plan_uses_every_piece_once(lengths, capacity):
    counts = np.bincount(lengths, minlength=capacity + 1)
    plan = packing.plan(counts, capacity)
    used = np.zeros(capacity + 1, int)
    for pieces, times in plan:
        assert sum(pieces) <= capacity and times > 0
        for x in pieces:
            used[x] += times
    assert (used == counts).all()
    if lengths:  # best fit never leaves two sequences half empty
        assert sum(t for _, t in plan) <= 2 * -(-sum(lengths) // capacity) + 1


def test_plan_fills_exactly_by_single_pair_and_triple():
    counts = np.zeros(101, np.int64)
    for x, n in ((60, 3), (40, 1), (25, 1), (15, 1), (20, 1), (12, 1), (8, 1)):
        counts[x] = n
    assert sorted(packing.plan(counts, 100)) == [((60, 20, 12, 8), 1), ((60, 25, 15), 1), ((60, 40), 1)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 70000), max_size=1500))
def test_wavelet_matrix(ids):
    m = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.build(np.array(ids, np.int64), np.array([len(ids)])).to_bytes())
    assert m.decode().tolist() == ids
    for at in range(0, len(ids), 97):
        assert m.access(at) == ids[at]
    for value in {*ids[:3], 5, 99999}:
        where = [k for k, x in enumerate(ids) if x == value]
        assert m.occurrences(value) == where and m.count(value) == len(where)
        assert m.rank(value, len(ids) // 2) == sum(x == value for x in ids[:len(ids) // 2])


@pytest.mark.parametrize("source,shard", [("odd", 50), ("documents", 1 << 20), ("documents", 4000)])
def test_token_files(spark, tokenizer, source, shard):
    df = cases.odd(spark, True) if source == "odd" else cases.documents(spark)
    docs = sorted(cases.pairs(df), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    want, at = [], 0
    for (i, _), ids in zip(docs, _ids(tokenizer, [t for _, t in docs])):
        want.append((i, at, len(ids) + 1, _crc(ids + [0])))
        at += len(ids) + 1
    got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in
           wavelet.encode_documents(df, tokenizer_file(), shard_tokens=shard).collect()]
    assert sorted(got, key=lambda r: r[1]) == want


def test_token_files_of_one_id(spark, tokenizer, tmp_path):
    """Rows of one id (null too) are split over the tasks that write, and stand behind one another."""
    rows = [((None, 5, i)[i % 3], f"text {i} " * (i % 40)) for i in range(1200)]
    df = spark.createDataFrame(rows, cases.SCHEMA)
    out = wavelet.encode_documents(df, tokenizer_file(), str(tmp_path / "files")).orderBy("start").collect()
    assert [r.doc_id for r in out] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    assert [r.start for r in out] == np.concatenate(([0], np.cumsum([r.n_tokens for r in out])[:-1])).tolist()
    want = collections.Counter((i, len(ids) + 1, _crc(ids + [0])) for (i, _), ids in zip(rows, _ids(tokenizer, [t for _, t in rows])))
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in out) == want
    parts = spark.read.parquet(str(tmp_path / "files")).selectExpr("part", "inline(transform(doc_ids, x -> struct(x)))")
    assert parts.where("x is null").select("part").distinct().count() > 1
    assert max(r["count"] for r in parts.groupBy("part").count().collect()) < 600


def test_sharding_of_one_id(spark):
    rows = [((None, 5, i)[i % 3], f"text {i}") for i in range(900)] + [(None, "same")] * 30
    out = sharding.shard_records(spark.createDataFrame(rows, cases.SCHEMA), [1.0] * 4)
    by = collections.defaultdict(list)
    for r in out.collect():
        by[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values()) and sum(map(len, by.values())) == len(rows)
    assert out.groupBy("doc_id").agg(F.countDistinct("shard").alias("n")).where("n > 1").count() == 0


def test_sharding(spark):
    df = cases.odd(spark, True).select("doc_id", "text").unionByName(cases.documents(spark, "sf0.01").select("doc_id", "text"))
    rows = sharding.shard_records(df, [1.0] * 8).collect()
    texts = collections.Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in cases.pairs(df))
    assert collections.Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == texts
    by = collections.defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 8) and r.law == "key"
    assert all(sorted(v) == list(range(len(v))) for v in by.values()) and set(by) == set(range(8))
    grown = {r.doc_id: r.shard for r in sharding.shard_records(df, [1.0] * 9).collect()}
    assert all(grown[r.doc_id] == r.grown_shard for r in rows)
    assert 0 < sum(r.grown_shard == 8 for r in rows) < len(rows) / 5


def test_sharding_weights(spark):
    rows = sharding.shard_records(cases.documents(spark, "sf0.1"), [1.0, 3.0]).groupBy("shard").count().collect()
    n = {r.shard: r["count"] for r in rows}
    assert n[1] / n[0] == pytest.approx(3, rel=0.1)


def test_write_shards(spark, tmp_path):
    df = cases.odd(spark)
    sharded = sharding.shard_records(df, [1.0] * 3)
    sharding.write_shards(sharded, df, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(cases.ODD)


URLS = [("http://a.example.com/en/1", "example.com/en/", "block"), ("https://www.example.com/en/x?y", "www.example.com/en/", "allow"),
        ("http://x.www.example.com/en/", "www.example.com/en/", "allow"), ("http://other.com/es/", "com/", "allow"),
        ("http://notexample.com/en/", "com/", "allow"), ("http://A.NET/es/1#x", "net/es/", "block"),
        ("http://a.net/esx", None, None), ("http://a.com", None, None), ("http://a.com?x=/en/", None, None),
        (None, None, None), ("no scheme", None, None), ("://x.com/", "com/", "allow"), ("a://b://c.com/", None, None)]


def test_url_rules(spark):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, (u, _, _) in enumerate(URLS)], "page_id long, url string, host string, verdict string")
    rows = {r.page_id: r for r in url_filter.filter_urls(pages).collect()}
    for i, (_, rule, verdict) in enumerate(URLS):
        assert rows[i].rule == rule and rows[i].verdict in ("allow", "block")
        assert verdict is None or rows[i].verdict == verdict
    assert (rows[5].host, rows[5].path) == ("a.net", "/es/1") and (rows[8].host, rows[8].path) == ("a.com", "")
    assert (rows[9].host, rows[9].path) == ("", "") and (rows[12].host, rows[12].path) == ("b:", "//c.com/")


def test_mined_url_rules(spark):
    good = [(f"http://site{i % 5}.org/news/{i}", "allow") for i in range(60)]
    bad = [(f"http://spam.org/pills/{i}?ref=a", "block") for i in range(30)]
    labelled = spark.createDataFrame(good + bad, "url string, verdict string")
    rules = url_filter.mine_rules(labelled)
    kept = [(tuple(r.tokens), r.verdict, r.confidence) for r in rules.collect()]
    assert kept and all(c >= url_filter.MIN_CONFIDENCE and len(t) >= 2 for t, _, c in kept)
    for t, v, c in kept:  # no rule has a part that is as good
        assert not any(set(t2) < set(t) and v2 == v and c2 >= c for t2, v2, c2 in kept)
    pages = spark.createDataFrame([(1, "http://spam.org/pills/new?ref=a"), (2, "http://site1.org/news/9"), (3, "ftp://else.io/"),
                                   (4, None)], "page_id long, url string")
    got = {r.page_id: r.verdict for r in url_filter.filter_urls(pages, labelled=labelled).collect()}
    assert got == {1: "block", 2: "allow", 3: "allow", 4: "allow"}


def _mined_by_hand(rows, least, sure, min_tokens):
    """(tokens, verdict) -> confidence of all combinations of a URL's tokens, pruned by their parts; of
    combinations that occur in the same rows only the largest is named."""
    import itertools
    seen, label = collections.defaultdict(set), collections.defaultdict(set)
    for i, (tokens, verdict) in enumerate(rows):
        label[verdict].add(i)
        for k in range(1, len(tokens) + 1):
            for c in itertools.combinations(sorted(tokens), k):
                seen[c].add(i)
    closed = {}     # rows -> the tokens that are in all of them, a group taken whole or not at all
    single = {c[0]: frozenset(x) for c, x in seen.items() if len(c) == 1}
    for c, x in seen.items():
        closed[frozenset(u for u in single if any(single[u] == single[t] for t in c))] = frozenset(x)
    rules = {}
    for c, x in closed.items():
        for v, y in label.items():
            both = len(x & y)
            if len(c) >= min_tokens and both >= least * len(rows) and both >= sure * len(x):
                rules[c, v] = both / len(x)
    return {(tuple(sorted(c)), v): conf for (c, v), conf in rules.items()
            if not any(d < c and w == v and other >= conf for (d, w), other in rules.items())}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rules_are_those_of_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    hosts, words = ["a.net", "b.net", "www.c.org", "c.org"], ["es", "en", "news", "shop", "x"]
    rows = []
    for _ in range(120):
        url = f"http://{rng.choice(hosts)}/" + "/".join(rng.choice(words, rng.integers(0, 4)))
        bad = ("es" in url and ".net" in url) or rng.random() < 0.05
        rows.append((url, "block" if bad else "allow"))
    df = spark.createDataFrame([*rows, (None, "allow"), ("http://a.net/es", None)], "url string, verdict string")
    tokens = {r.url: set(r.t) for r in df.select("url", url_filter.url_tokens(F.col("url")).alias("t")).collect()}
    got = {(tuple(r.tokens), r.verdict): r.confidence for r in url_filter.mine_rules(df, 0.04, 0.8).collect()}
    want = _mined_by_hand([(tokens[u], v) for u, v in [*rows, (None, "allow")]], 0.04, 0.8, 2)
    assert got.keys() == want.keys() and got and all(abs(got[k] - want[k]) < 1e-12 for k in got)


def test_hot_url_of_many_tokens(spark):
    """A third of the rows is one URL of 24 tokens of its own: one item, whatever their number."""
    slug = "/".join(chr(97 + i) * 3 for i in range(20))
    hot = [(i, f"https://www.example.com/en/{slug}") for i in range(100)]
    rest = [(100 + i, f"http://h{i % 7}.net/{'es' if i % 2 else 'fr'}/{i}") for i in range(200)]
    pages = spark.createDataFrame([*hot, *rest, (500, f"ftp://mirror.io/{slug}"), (501, "http://h1.net/de/")], "page_id long, url string")
    got = {r.page_id: r.verdict for r in url_filter.filter_urls(pages).collect()}
    assert got[0] == "allow" and got[100] == "block" and got[501] == "block" and got[500] == "allow"


def test_query_judges_by_its_mined_rules(spark):
    """End to end: labels are what the list decides, and undecided URLs get the best rule that fits them."""
    d = "/root/testdata/sf0.1"
    pages = spark.read.parquet(f"{d}/pages.parquet")
    got = {r.page_id: r for r in __spark_entry__.queries()["op10_url_filter"](spark, d).collect()}
    rows = pages.select("page_id", "url", url_filter.url_tokens(F.col("url")).alias("t")).collect()
    want = _mined_by_hand([(set(r.t), got[r.page_id].verdict) for r in rows if got[r.page_id].rule], url_filter.MIN_SUPPORT,
                          url_filter.MIN_CONFIDENCE, url_filter.MIN_TOKENS)
    by_tokens, mined = {}, 0
    for r in rows:
        if got[r.page_id].rule is None and r.url is not None:
            key = tuple(sorted(r.t))
            if key not in by_tokens:
                by_tokens[key] = max(((c, v == "allow", len(t), v) for (t, v), c in want.items() if set(t) <= set(key)), default=None)
            best = by_tokens[key]
            mined += best is not None
            assert got[r.page_id].verdict == (best[3] if best else "allow")
    assert len(got) == pages.count() and mined > 0


def test_mined_rules_match_as_by_brute_force(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    labelled = pages.select("url", F.when(F.col("url").contains("/en/"), "block").otherwise("allow").alias("verdict"))
    rules = url_filter.mine_rules(labelled, 0.02, 0.8).collect()
    got = {r.url: (r.verdict, r.confidence) for r in url_filter.judge_by_rules(
        pages, spark.createDataFrame(rules, url_filter.RULE)).collect()}
    for r in pages.select("url", url_filter.url_tokens(F.col("url")).alias("t")).distinct().collect():
        fits = [(x.confidence, x.verdict == "allow", len(x.tokens), x.verdict) for x in rules if set(x.tokens) <= set(r.t)]
        assert got.get(r.url) == ((max(fits)[3], max(fits)[0]) if fits else None)


def test_classifier_on_held_out_labels(spark):
    docs = cases.documents(spark, "sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = quality_classifier.fit(docs, labels.where("doc_id % 2 = 0"))
    test = quality_classifier.score(docs, model).join(labels.where("doc_id % 2 = 1"), "doc_id").toPandas()
    assert ((test.score >= 0.5) == (test.quality == 1)).mean() > 0.94
    assert (test[test.quality == 1].score >= quality_classifier.KEEP).mean() > 0.99


def _plain_surest(text, page, names, most):
    """The surest of a pool in memory, as by the definition: no document twice, ties by name."""
    gone = set()

    def surest(models):
        logit = [m.logit(v).astype(float) for m, v in zip(models, (text, page))]
        bar = np.log(quality_classifier.SURE / (1 - quality_classifier.SURE))
        out, taken = {}, set()
        for v in (0, 1):
            for c in (0, 1):
                sure = logit[v] * (2 * c - 1)
                best = [i for i in sorted(range(len(names)), key=lambda i: (-sure[i], names[i]))
                        if sure[i] >= bar and i not in gone][:most]
                if best:
                    out[v, c] = (text[best], page[best])
                    taken.update(best)
        gone.update(taken)
        return out

    return surest


def test_co_training_beats_few_labels():
    """Two views that only agree on the class: rounds bring in what few labels don't show."""
    rng = np.random.default_rng(5)
    n = 800
    y = rng.integers(0, 2, n)
    views = [(rng.normal(size=(n, 20)) + 1.2 * (y[:, None] - 0.5) * w).astype(np.float32) for w in rng.normal(size=(2, 20))]
    pool = _plain_surest(*[v[40:] for v in views], list(range(40, n)), 40)
    model = quality_classifier.co_train(*[v[:40] for v in views], y[:40], pool)
    both = model.scores(*views)[2]
    assert ((both[40:] >= 0.5) == (y[40:] == 1)).mean() > 0.8


def test_co_training_on_spark_is_that_of_plain_rounds(spark, monkeypatch):
    """The model fitted on Spark over the whole pool, with repeated and null ids, against rounds in memory."""
    monkeypatch.setattr(quality_classifier, "TAKEN", 25)
    docs = cases.documents(spark, "sf0.01").select("doc_id", "text", "lang", "source")
    more = docs.where("doc_id % 9 = 0").selectExpr("cast(null as long) doc_id", "concat(text, ' !') text", "lang", "source")
    twice = docs.where("doc_id = 3")
    docs = docs.unionByName(more).unionByName(twice).unionByName(twice.withColumn("text", F.lit("other words of one id")))
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("doc_id % 3 <> 1")
    got = quality_classifier.fit(docs, labels)

    known = {r.doc_id: int(r.quality > 0) for r in labels.collect()}
    rows = docs.withColumn("x", F.xxhash64("text", "lang", F.lit("|"), "source")).collect()
    assert all(None not in (r.text, r.lang, r.source) for r in rows)

    def views(some):
        data, offsets = text_buffer(pa.array([r.text for r in some]))
        return (quality_classifier.text_view(data, offsets),
                quality_classifier.page_view(data, offsets, [r.lang for r in some], [r.source for r in some]))

    first = {}
    for r in rows:
        if r.doc_id in known:
            mine = tuple(v[0].astype(np.float32).tobytes() for v in views([r]))
            first[r.doc_id] = min(first.get(r.doc_id, (mine, r)), (mine, r), key=lambda p: p[0])
    train = [first[i][1] for i in sorted(first)]
    pool = sorted({r.x: r for r in rows if r.doc_id not in known}.values(), key=lambda r: r.x)
    surest = _plain_surest(*views(pool), [r.x for r in pool], quality_classifier.most_taken(len(rows)))
    want = quality_classifier.co_train(*views(train), np.array([known[r.doc_id] for r in train]), surest)
    for a, b in ((got.text, want.text), (got.page, want.page), (got.both, want.both)):
        assert np.allclose(a.weights, b.weights, rtol=1e-4, atol=1e-5) and a.bias == pytest.approx(b.bias, rel=1e-4, abs=1e-4)


def test_labelled_id_with_many_rows_is_one_example(spark):
    """One labelled id on most rows: the fit has one row of it, the pool none."""
    docs = cases.documents(spark).selectExpr("doc_id", "text", "lang", "source")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    hot = labels.where("quality = 1").agg(F.min("doc_id")).first()[0]
    many = docs.withColumn("doc_id", F.lit(hot)).withColumn("text", F.concat("text", F.lit(" again")))
    model = quality_classifier.fit(docs.unionByName(many).unionByName(many), labels)
    assert model is not None and np.isfinite(model.text.weights).all()


def test_classifier_odd_rows(spark):
    docs = cases.odd(spark, True)
    assert quality_classifier.fit(docs, spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")) is None
    labels = spark.createDataFrame([(i, int(i % 2), 0) for i in range(1, 17)] + [(None, 1, 0), (3, None, 0)],
                                   "doc_id long, quality int, toxic int")
    model = quality_classifier.fit(docs, labels)
    out = quality_classifier.score(docs, model)
    assert out.count() == len(cases.ODD) and out.where("score is null or isnan(score)").count() == 0
    assert quality_classifier.score(docs, None).where("kept").count() == len(cases.ODD)


def test_empty_tables(spark):
    none = cases.odd(spark, True).limit(0)
    assert packing.pack_documents(none, tokenizer_file()).count() == 0
    assert wavelet.encode_documents(none, tokenizer_file()).count() == 0
    assert sharding.shard_records(none, [1.0] * 8).count() == 0
    assert url_filter.filter_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0
    assert quality_classifier.fit(none, spark.createDataFrame([], "doc_id long, quality int, toxic int")) is None


def test_registered_queries():
    names = __spark_entry__.queries()
    assert {f"op{n}_" for n in range(1, 11)} <= {k.split("_")[0] + "_" for k in names} and "pipeline" in names


def test_pipeline(spark, tokenizer):
    """Every stage against a plain version of its rule on its own input."""
    d = "/root/testdata/sf0.001"
    docs = cases.documents(spark)
    columns = docs.columns
    got = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, d)
        assert name == "packing" or docs.columns == columns
        got[name] = docs = spark.createDataFrame(docs.collect(), docs.schema)
    rows = {k: cases.pairs(v) for k, v in got.items() if k != "packing"}
    text = {i: t for i, t in rows["documents"]}
    kept = {i for i, _ in rows["quality_rules"]}
    fails = {i for i, t in rows["documents"] if (c := cases.counts(t))[0] < 20 or 100 * c[4] > 30 * c[0]}
    assert kept and not kept & fails
    labels = {r.doc_id: r for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    assert not [i for i in text if i not in kept and i not in fails and i in labels and labels[i].quality and not labels[i].toxic]
    group = cases.near_groups(rows["quality_rules"])
    assert {i for i, _ in rows["near_dedup"]} == {i for i in kept if group[i] == i}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{d}/benchmark.parquet").collect()]
    clean = {i for i, n, h, _ in cases.contaminated(rows["near_dedup"], items) if not (h and 20 * h >= n)}
    assert {i for i, _ in rows["decontamination"]} == clean == {i for i, _ in rows["pii"]}
    for i, t in rows["pii"]:
        assert (t == text[i]) == (cases.base_spans(text[i]) == "") and "email:" not in cases.base_spans(t)
    packed = collections.defaultdict(int)
    for r in got["packing"].collect():
        packed[r.doc_id] += r.length
    assert packed == {i: len(x) + 1 for (i, _), x in zip(rows["pii"], _ids(tokenizer, [t for _, t in rows["pii"]]))}
    assert corpus_pipeline.run(spark, d).count() == got["packing"].count()
