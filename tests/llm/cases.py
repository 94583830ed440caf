"""Inputs that every operator must take, and plain versions of the fixed results."""

import collections
import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

_BASE = " ".join(f"word{i} of{i % 7}" for i in range(60))

#: (doc_id, text): nulls in each column, empty, blank and short texts, ties, repeated rows, a long text.
ODD = [
    (1, _BASE), (2, _BASE), (3, _BASE + " and one more"), (4, None), (5, ""), (6, " \n\t "), (7, "one"), (8, "One"),
    (9, "a b c d e"), (10, "a b c d e f"), (10, "a b c d e f"), (None, "no id here, but text " * 3),
    (11, "x@y.example +1 (555) 123-4567 4111 1111 1111 1111 10.0.0.1 999.1.1.1"),
    (12, "é" * 200 + " ü" * 300), (13, "a" * 5000), (14, "word0 of0\n" * 4000), (15, "! !! " + _BASE.upper()),
    (16, "emoji \U0001f600 \U0001f600 mail a@b.co \U0001f600 +49 30 1234567"),
]
SCHEMA = "doc_id long, text string"
#: Extra columns whose names operators use themselves.
CLASHING = ["shard", "slot", "kept", "n", "rep", "spans", "k", "doc", "_text", "ranges", "length", "c0", "label", "_n"]


def odd(spark, extra=False):
    df = spark.createDataFrame(ODD, SCHEMA)
    if extra:
        from pyspark.sql import functions as F
        df = df.select("*", *[F.lit(f"x{i}").alias(c) for i, c in enumerate(CLASHING)],
                       F.lit("en").alias("lang"), F.lit(None).cast("string").alias("source"))
    return df


def documents(spark, sf="sf0.001"):
    return spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def shingles(text):
    w = re.findall("[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(w) >= 5:
        return {tuple(w[k:k + 5]) for k in range(len(w) - 4)}
    return {tuple(w)} if w else set()


def near_groups(docs):
    """doc_id -> smallest doc_id reachable by links of the shingle sets."""
    sets = collections.defaultdict(list)
    for i, t in docs:
        sets[i].append(shingles(t))
    flat = [(i, s) for i, v in sets.items() for s in v if s]
    index = collections.defaultdict(list)
    for n, (_, s) in enumerate(flat):
        for g in s:
            index[g].append(n)
    shared = collections.Counter()
    for v in index.values():
        for a in range(len(v)):
            for b in range(a):
                shared[v[b], v[a]] += 1
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    order = lambda i: (i is None, i)
    for (a, b), n in shared.items():
        if 100 * n >= 75 * (len(flat[a][1]) + len(flat[b][1]) - n):
            x, y = sorted((find(flat[a][0]), find(flat[b][0])), key=order)
            parent[y] = x
    return {i: find(i) for i in sets}


def counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    w = re.findall("[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = set()
    for i in range(len(w) - 7):
        if windows[tuple(w[i:i + 8])] > 1:
            covered.update(range(i, i + 8))
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def base_spans(text):
    """kind:start:end of the four fixed kinds, comma-joined."""
    text = text or ""
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
                "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    out = []
    for kind, p in patterns.items():
        for m in re.finditer(p, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and max(map(int, m[0].split("."))) > 255:
                continue
            if kind == "card":
                total = sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(map(int, digits[::-1])))
                if not 13 <= len(digits) <= 19 or total % 10:
                    continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def contaminated(docs, items):
    """[(doc_id, n_words, n_hit, comma-joined item ids)]"""
    word = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = collections.defaultdict(set)
    for name, text in items:
        w = word.findall((text or "").translate(LOWER))
        if w:
            n = min(13, len(w))
            for q in range(len(w) - n + 1):
                windows[tuple(w[q:q + n])].add("" if name is None else str(name))
    sizes = {len(k) for k in windows}
    out = []
    for i, text in docs:
        w = word.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for n in sizes:
            for q in range(len(w) - n + 1):
                names = windows.get(tuple(w[q:q + n]))
                if names:
                    hit.update(range(q, q + n))
                    found |= names
        out.append((i, len(w), len(hit), ",".join(sorted(found))))
    return out


def repeats(docs, length=100):
    """doc_id -> (n_bytes, n_removed, n_spans, kept bytes), for distinct ids."""
    seen, out = set(), {}
    for i, text in sorted(docs, key=lambda r: (r[0] is not None, r[0])):
        b = (text or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            piece = b[s:s + length]
            if piece in seen:
                gone[s:s + length] = b"\1" * length
            seen.add(piece)
        spans = sum(1 for s in range(len(b)) if gone[s] and not (s and gone[s - 1]))
        out[i] = (len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g))
    return out
