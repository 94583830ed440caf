"""Phrase collocation mining with stripes.

A *stripe* is a prefix of 0 to 3 words with an associative counter of the words that
follow it.  Tasks count the stripes of their texts by blocks, Spark merges equal stripes
elementwise, and everything else is read off the merged stripes: an entry is the
frequency of prefix + next word (the stripe of the empty prefix holds the words
themselves), and the largest entry of a stripe is the most frequent extension of its
prefix to the right (grouped by the phrase without its first word: to the left), which
decides whether the prefix is subsumed.

* Texts (null: empty) have A-Z lower-cased and are cut into pieces at ``[.,;:!?\\x0A-\\x0D]``,
  pieces into words ``[^\\x20\\x09]+``; phrases don't leave a piece.  Languages are kept apart
  (null: ``und``).  Inside a block words are exact dictionary codes and phrases exact
  numbers of (shorter phrase, word) pairs, so no count rests on a hash.
* A stripe is cut into ``SEGMENTS`` parts by its next words, so the stripe of a very common
  prefix is merged by many tasks.
* No phrase is more frequent than a part of it.  So the texts are read three times: for the
  words, for the pairs of frequent words, and for the phrases all of whose pairs are frequent.
  What is frequent is told by a Bloom filter of fixed size (``FILTER_BITS``): a phrase it takes
  for frequent by mistake costs a row, never a result.  Once it is crowded it spares less, and
  the result stays.
* A candidate has 2 to ``max_words`` words and a frequency a >= ``min_count``.  Cut after its
  first k words its parts have frequencies l and r, its score is floor(2000000 a / (l + r)),
  that of the lowest cut (ties: smallest k), in decimals of up to 38 digits.
* A candidate is dropped if a longer one that holds it has 100 f >= ``subsumed`` a.  One more
  word is enough to look at: a longer holder has a holder between that is no rarer.

Repeated rows and ids count as often as they occur (ids play no part), empty tables give no
rows, further columns are ignored.  One text is handled as a whole by one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickengine.llm.common import LOWER, PrefixHash, blocks, materialize, mix, ragged, text_buffer, word_bounds

#: Bytes that end a piece, and bytes that end a word.
PIECE_END = np.zeros(256, bool)
PIECE_END[list(b".,;:!?\n\x0b\x0c\r")] = True
WORD_END = PIECE_END.copy()
WORD_END[[9, 32]] = True

MAX_WORDS = 4
BLOCK = 4 << 20          # bytes of text whose stripes are counted at once
SEGMENTS = (64, 4, 2, 2)  # parts of a stripe with a prefix of 0, 1, ... words
FILTER_BITS = 1 << 26    # 8 MB: the bound of what is sent to the tasks
TOP_BUCKETS = 64
ROWS = 1 << 14           # rows of an output batch

#: A part of a stripe, its entries of one count together: ``next`` holds the words, a space after each.
STRIPE = "lang string, words int, prefix string, segment int, count bigint, next string"


def _strings(buf: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> pa.Array:
    at = np.concatenate(([0], np.cumsum(hi - lo))).astype(np.int32)
    return pa.StringArray.from_buffers(len(lo), pa.py_buffer(at), pa.py_buffer(buf[ragged(lo, hi - lo)]))


def _hashes(strings: pa.Array) -> np.ndarray:
    data, at = text_buffer(strings)
    return PrefixHash(data).of(at[:-1], at[1:])


class _Block:
    """Words of a block of texts: ``buf[at[i]:at[i + 1]]`` is word i with a space after it, ``code`` its
    code, ``hash[code]`` its hash, ``text`` its text, ``joined`` whether word i + 1 is in the same piece."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        start, end, _ = word_bounds(data, offsets, WORD_END)
        self.n = len(start)
        self.text = np.searchsorted(offsets, start, "right") - 1
        cuts = np.concatenate(([0], np.cumsum(PIECE_END[data], dtype=np.int32)))
        same = (self.text[1:] == self.text[:-1]) & (cuts[start[1:]] == cuts[end[:-1]])
        self.joined = np.append(same, False)[:self.n]
        self.at = np.concatenate(([0], np.cumsum(end - start + 1))).astype(np.int64)
        self.buf = np.empty(self.at[-1], np.uint8)
        low = np.append(LOWER[data], np.uint8(32))
        for i in range(0, self.n, ROWS):
            s, e = start[i:i + ROWS], end[i:i + ROWS]
            self.buf[self.at[i]:self.at[i + len(s)]] = low[ragged(s, e - s + 1)]
        self.buf[self.at[1:] - 1] = 32
        words = pa.Array.from_buffers(pa.large_binary(), self.n, [None, pa.py_buffer(self.at), pa.py_buffer(self.buf)])
        coded = words.dictionary_encode()
        self.code = np.asarray(coded.indices).astype(np.int64)
        self.size = len(coded.dictionary)
        self.hash = _hashes(coded.dictionary)


def _bits(first: np.ndarray, last: np.ndarray, lang: np.ndarray, size: int) -> np.ndarray:
    """The two bits for a phrase in a filter of ``size`` bits, from the hashes of all but its last word (0: none), of its
    last word and of its language."""
    h = mix(first * np.uint64(0x9E3779B97F4A7C15) + last + (lang << np.uint64(1)))
    mask = np.uint64(size - 1)
    return np.stack([h & mask, (h >> np.uint64(32)) & mask])


def _passes(table: np.ndarray, first, last, lang) -> np.ndarray:
    bits = _bits(first, last, lang, 64 * len(table))
    return ((table[bits >> np.uint64(6)] >> (bits & np.uint64(63))) & np.uint64(1)).all(axis=0)


def _joined(block: _Block, lang: np.ndarray, table: np.ndarray, words: int) -> np.ndarray:
    """Which neighbouring words may make up a frequent phrase, by a filter of phrases of 1 or 2 words."""
    h = block.hash[block.code]
    if words == 1:
        kept = _passes(table, np.uint64(0), h, lang)
        return block.joined & kept & np.append(kept[1:], False)
    pairs = np.flatnonzero(block.joined)
    out = np.zeros(block.n, bool)
    out[pairs[_passes(table, h[pairs], h[pairs + 1], lang[pairs])]] = True
    return out


def _count(block: _Block, lang: np.ndarray, langs: pa.Array, depths: tuple[int, ...], joined: np.ndarray):
    """The stripes of one block with prefixes of ``depths`` words; ``lang`` is the language code of each
    word, ``joined`` tells which neighbouring words phrases may hold."""
    have = np.arange(block.n)
    for step in range(min(depths)):   # only places that reach the first depth
        have = have[joined[have + step]]
    ids = lang[have]
    for depth in range(max(depths) + 1):
        if depth > min(depths):
            more = joined[have + depth - 1]
            have, ids = have[more], ids[more]
        if not len(have):
            return
        key, first, ids, n = np.unique(ids * block.size + block.code[have + depth], return_index=True, return_inverse=True,
                                       return_counts=True)
        if depth not in depths:
            continue
        parts = SEGMENTS[min(depth, len(SEGMENTS) - 1)]
        at, prefix = have[first], key // block.size
        segment = (block.hash[block.code[at + depth]] % np.uint64(parts)).astype(np.int64)
        order = np.lexsort((n, segment, prefix))
        at, n = at[order], n[order]
        stripe = prefix[order] * parts + segment[order]
        begin = np.flatnonzero(np.append(True, (stripe[1:] != stripe[:-1]) | (n[1:] != n[:-1])))
        ends = np.append(begin[1:], len(at))
        # the next words of all entries one after the other, so that a stripe's are one string
        for i in range(0, len(begin), ROWS):
            b, e = begin[i:i + ROWS], ends[i:i + ROWS]
            word = at[b[0]:e[-1]] + depth
            size = np.concatenate(([0], np.cumsum(block.at[word + 1] - block.at[word])))
            text = block.buf[ragged(block.at[word], np.diff(size))]
            head = at[b]
            yield pa.RecordBatch.from_arrays([
                langs.take(pa.array(lang[head])), pa.array(np.full(len(b), depth + 1, np.int32)),
                _strings(block.buf, block.at[head], block.at[head + depth]), pa.array((stripe[b] % parts).astype(np.int32)),
                pa.array(n[b].astype(np.int64)), _strings(text, size[b - b[0]], size[e - b[0]])],
                names=["lang", "words", "prefix", "segment", "count", "next"])


def stripes(docs: DataFrame, depths: tuple[int, ...], known=None, words: int = 0, size: int = BLOCK) -> DataFrame:
    """Stripes of ``docs`` by blocks of ``size`` bytes, with a filter ``known`` of the frequent phrases of ``words`` words.
    With depth 0 comes one entry a block and language for the number of its words (0 words, an empty
    next word)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coded = batch.column("lang").dictionary_encode()
            langs = coded.dictionary
            code = np.asarray(coded.indices).astype(np.int64)
            salt = _hashes(langs)
            data, offsets = text_buffer(batch.column("text"))
            for i, j in blocks(offsets, size):
                block = _Block(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                if not block.n:
                    continue
                lang = code[i:j][block.text]
                if 0 in depths:
                    n, none, zero = np.bincount(lang, minlength=len(langs)), pa.array([""] * len(langs)), [0] * len(langs)
                    yield pa.RecordBatch.from_arrays(
                        [langs, pa.array(zero, pa.int32()), none, pa.array(zero, pa.int32()), pa.array(n.astype(np.int64)),
                         pa.array([" "] * len(langs))], names=["lang", "words", "prefix", "segment", "count", "next"])
                joined = _joined(block, salt[lang], known.value, words) if known is not None else block.joined
                yield from _count(block, lang, langs, depths, joined)

    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").mapInArrow(run, STRIPE)


def merge(parts: DataFrame, min_count: int) -> DataFrame:
    """Stripes merged elementwise: (lang, words, prefix, next, count), entries of ``min_count`` and more."""
    entries = parts.repartition("lang", "prefix", "segment").select(
        "lang", "words", "prefix", "segment", "count", F.explode(F.expr("split(substring(next, 1, length(next) - 1), ' ')")).alias("next"))
    return (entries.groupBy("lang", "words", "prefix", "segment", "next").agg(F.sum("count").alias("count"))
            .where(F.col("count") >= min_count)
            .select("lang", "words", "prefix", F.concat("next", F.lit(" ")).alias("next"), "count"))


def _filter(entries: DataFrame, size: int):
    """A broadcast Bloom filter of phrases: its 64-bit cells, joined on Spark; at most
    ``size`` / 64 of them reach the driver, however many phrases there are."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = _hashes(batch.column("prefix"))
            first[np.asarray(pc.binary_length(batch.column("prefix"))) == 0] = 0
            bits = _bits(first, _hashes(batch.column("next")), _hashes(batch.column("lang")), size).ravel()
            yield pa.RecordBatch.from_arrays([
                pa.array((bits >> np.uint64(6)).astype(np.int64)),
                pa.array((np.uint64(1) << (bits & np.uint64(63))).view(np.int64))], names=["cell", "bits"])

    rows = (entries.select("lang", "prefix", "next").mapInArrow(cells, "cell bigint, bits bigint")
            .groupBy("cell").agg(F.bit_or("bits").alias("bits")).toArrow())
    out = np.zeros(size // 64, np.uint64)
    out[rows.column("cell").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return entries.sparkSession.sparkContext.broadcast(out)


def frequencies(docs: DataFrame, min_count: int = 30, max_words: int = MAX_WORDS, filter_bits: int = FILTER_BITS,
                block: int = BLOCK) -> DataFrame:
    """Every phrase of 1 to ``max_words`` words with a frequency of ``min_count`` and more, as entries of
    the merged stripes: (lang, words, prefix, next, count), words with a space after each.  The entry of
    0 words is the number of words of its language."""
    out = materialize(merge(stripes(docs, (0,), size=block), min_count))
    if max_words > 1:
        singles = _filter(out.where(F.col("words") == 1), filter_bits)
        pairs = materialize(merge(stripes(docs, (1,), singles, 1, block), min_count))
        out = out.unionByName(pairs)
    if max_words > 2:
        long = merge(stripes(docs, tuple(range(2, max_words)), _filter(pairs, filter_bits), 2, block), min_count)
        out = out.unionByName(materialize(long))
    return out


def collocations(docs: DataFrame, min_count: int = 30, max_words: int = MAX_WORDS, top: int = 2000,
                 subsumed: int = 80, filter_bits: int = FILTER_BITS, block: int = BLOCK) -> DataFrame:
    """The ``top`` phrases of each language by score, frequency and phrase: (lang, rank, phrase, a, l, r, n, score)."""
    found = frequencies(docs, min_count, max_words, filter_bits, block).withColumn("phrase", F.concat("prefix", "next"))
    known = found.where(F.col("words") >= 1).select("lang", "phrase", "count")
    candidates = found.where(F.col("words") >= 2)

    # the most frequent extension by one word on either side
    longer = candidates.where(F.col("words") >= 3)
    tail = F.expr("substring(phrase, locate(' ', phrase) + 1)")
    extended = (longer.select("lang", F.explode(F.array("prefix", tail)).alias("phrase"), "count")
                .groupBy("lang", "phrase").agg(F.max("count").alias("holder")))
    kept = (candidates.select("lang", "phrase", "words", F.col("count").alias("a"))
            .join(extended, ["lang", "phrase"], "left")
            .where(F.col("holder").isNull() | (_wide("holder") * 100 < _wide("a") * subsumed)))

    # every cut with the frequencies of its two parts; the first part of k words ends at the k-th space
    cuts = kept.select("lang", "phrase", "a", F.explode(F.expr("sequence(1, words - 1)")).alias("k")).select(
        "lang", "phrase", "a", "k", F.expr("length(substring_index(phrase, ' ', k)) + 1").alias("_at"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.expr("substring(phrase, 1, _at)").alias("first"),
                       F.expr("substring(phrase, _at + 1)").alias("rest"))
    left = known.select("lang", F.col("phrase").alias("first"), F.col("count").alias("l"))
    right = known.select("lang", F.col("phrase").alias("rest"), F.col("count").alias("r"))
    parts = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    scored = parts.withColumn("score", F.expr("(cast(a as decimal(19,0)) * 2000000) div (cast(l as decimal(19,0)) + r)"))
    lowest = (scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
              .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))

    # first ranked in buckets, so that one task only sees the first of them
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    bucket = F.pmod(F.xxhash64("phrase"), F.lit(TOP_BUCKETS))
    near = (lowest.withColumn("_b", bucket)
            .withColumn("_r", F.row_number().over(Window.partitionBy("lang", "_b").orderBy(*order))).where(F.col("_r") <= top))
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    total = found.where(F.col("words") == 0).select("lang", F.col("count").alias("n"))
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"),
                                             F.expr("substring(phrase, 1, length(phrase) - 1)").alias("phrase"),
                                             "a", "l", "r", "n", "score")


def _wide(name: str):
    return F.col(name).cast("decimal(19,0)")
