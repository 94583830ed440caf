"""Personal data in texts (native DataFrame functions only).

A regular expression per kind proposes spans, checksums (Luhn for cards, mod 97 for
account numbers) and value ranges confirm them, and context words near a span raise its
score.  Patterns are written so that Java's matcher is linear in the text: possessive
repeats, and starts only where a run of the kind's characters starts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LOCAL = "A-Za-z0-9._%+-"

_LUHN_FORMS = (r"[0-9]{13,19}(?![0-9])|[0-9]{4}([\x20-])[0-9]{4}\3[0-9]{4}\3[0-9]{4}(?![0-9])"
               r"|[0-9]{4}([\x20-])[0-9]{6}\4[0-9]{5}(?![0-9])")
_DIALLED = (r"\+1[\x20.-]?(?:\([0-9]{3}\)|[0-9]{3})[\x20.-]?[0-9]{3}[\x20.-]?[0-9]{4}(?![0-9])"
            r"|\+[0-9]{9,15}(?![0-9])|\+[0-9]{1,3}(?:[\x20.-](?:\([0-9]{1,4}\)|[0-9]{1,4})){2,4}(?![0-9])")

#: rule -> (kind, pattern, quick test, score, score with context, context words).
#: The first four are the contract's patterns: their spans always count.  The others add spans:
#: a card or a dialled number in one of the usual forms also counts where other digits beside
#: it spoil the contract's match.  A quick test only skips texts that can't hold the kind.
#: Group 1 of a pattern is the span; if what follows it may overlap, the rest is a look-ahead.
RULES: dict[str, tuple[str, str, str, float, float, str]] = {
    "email": ("email", rf"(?:\G|(?<![{_LOCAL}]))([{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++)()",
              r"@[A-Za-z0-9-]+\.[A-Za-z0-9-]", 0.9, 0.95, "mail|email|e-mail|contact|write|correo|kontakt"),
    "ip": ("ip", r"(?<![0-9])([0-9]++\.[0-9]++\.[0-9]++\.[0-9]++)()",
           r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", 0.7, 0.9, "ip|host|server|address|adresse|login"),
    "card": ("card", r"([0-9]++(?:[\x20-][0-9]++)*+)()",
             r"[0-9](?:[\x20-]?[0-9]){12}", 0.8, 0.95, "card|visa|credit|debit|karte|carte|tarjeta"),
    "phone": ("phone", r"(\+[0-9][\x20().0-9-]+[0-9])()",
              r"\+[0-9]", 0.7, 0.9, "phone|tel|call|mobile|fax|telefon|appel"),
    "card_form": ("card", rf"(?<![0-9])(?=({_LUHN_FORMS}))([0-9]++)",
                  r"[0-9](?:[\x20-]?[0-9]){12}", 0.7, 0.95, "card|visa|credit|debit|karte|carte|tarjeta"),
    "phone_form": ("phone", rf"({_DIALLED})()",
                   r"\+[0-9]", 0.6, 0.9, "phone|tel|call|mobile|fax|telefon|appel"),
    "iban": ("iban", r"(?<![A-Za-z0-9])([A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?))()"
             r"(?![A-Za-z0-9])", r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{3}", 0.7, 0.95, "iban|account|konto|compte|cuenta|bank"),
    "ssn": ("ssn", r"(?<![0-9-])([0-9]{3}-[0-9]{2}-[0-9]{4})()(?![0-9-])",
            r"[0-9]{3}-[0-9]{2}-[0-9]{4}", 0.3, 0.8, "ssn|social security|taxpayer"),
}
BASE = ("email", "ip", "card", "phone")
KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
#: An added span counts from this score on.
THRESHOLD = 0.5
#: Characters on each side of a span in which context words count.
NEAR = 40

_BYTE = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"


def _luhn(digits: Column) -> Column:
    """True where a string of digits passes the Luhn check."""
    backwards = F.reverse(digits)

    def add(total, i):
        d = F.ascii(F.substring(backwards, i, F.lit(1))) - 48
        twice = d * 2
        return total + F.when(i % 2 == 1, d).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _mod97(value: Column) -> Column:
    """True where an account number, its first four characters put last and letters read
    as 10 to 35, leaves 1 modulo 97."""
    plain = F.replace(value, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))

    def add(rest, i):
        c = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(c >= 65, (rest * 100 + c - 55) % 97).otherwise((rest * 10 + c - 48) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add) == 1


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    n = F.length(digits)
    if kind == "ip":
        return value.rlike(rf"^0*{_BYTE}(?:\.0*{_BYTE}){{3}}\z")
    if kind == "card":
        return F.when(n.between(13, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return n.between(9, 15)
    if kind == "iban":
        return F.when(F.length(F.replace(value, F.lit(" "), F.lit(""))).between(15, 34), _mod97(value)).otherwise(False)
    return F.lit(True)


def _proposed(rule: str, text: Column) -> Column:
    """array<struct<gap, used, value>>: each leftmost match, the text between it and the match
    before, and what it uses up.  ``\\G`` ties every search to the end of the match before, so
    that the tail after the last match is read once."""
    _, pattern, quick, *_ = RULES[rule]
    ahead = rule == "card_form"
    whole = F.lit(rf"(?s)\G(.*?){pattern}")
    used = F.regexp_extract_all(text, whole, 5 if ahead else 2)
    found = F.zip_with(F.regexp_extract_all(text, whole, 1), F.regexp_extract_all(text, whole, 2),
                       lambda g, v: F.struct(F.length(g).alias("gap"), F.length(v).alias("used"), v.alias("value")))
    if ahead:
        found = F.zip_with(found, used, lambda f, u: F.struct(f["gap"].alias("gap"), F.length(u).alias("used"), f["value"].alias("value")))
    none = F.array().cast("array<struct<gap:int,used:int,value:string>>")
    return F.when(text.rlike(quick), found).otherwise(none)


def _placed(proposed: Column) -> Column:
    """array<struct<start, end, value>> in code points, the end exclusive."""
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,value:string>>").alias("out"))

    def step(acc, x):
        start = acc["at"] + x["gap"]
        span = F.struct(start.alias("start"), (start + F.length(x["value"])).alias("end"), x["value"].alias("value"))
        return F.struct((start + x["used"]).alias("at"), F.array_append(acc["out"], span).alias("out"))

    return F.aggregate(proposed, zero, step, lambda acc: acc["out"])


def _scored(rule: str, spans: Column, text: Column) -> Column:
    """array<struct<kind, start, end, score, base>> of the spans that hold."""
    kind, _, _, plain, near, words = RULES[rule]
    base = rule in BASE

    def score(s):
        first = F.greatest(s["start"] - NEAR, F.lit(0))
        before = F.substring(text, first + 1, s["start"] - first)
        after = F.substring(text, s["end"] + 1, F.lit(NEAR))
        context = F.concat(before, F.lit(" "), after).rlike(rf"(?i)(?<![A-Za-z])(?:{words})(?![A-Za-z])")
        return F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                        F.when(context, near).otherwise(plain).alias("score"), F.lit(base).alias("base"))

    scored = F.transform(F.filter(spans, lambda s: _valid(kind, s["value"])), score)
    return scored if base else F.filter(scored, lambda s: s["score"] >= THRESHOLD)


def _of_kind(kind: str) -> Column:
    """The spans of a kind by start: the base ones, and added ones that none of those touches."""
    rules = [r for r in RULES if RULES[r][0] == kind]
    spans = F.col(f"_{rules[0]}")
    for rule in rules[1:]:
        free = F.filter(F.col(f"_{rule}"), lambda s: ~F.exists(
            F.col(f"_{rules[0]}"), lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
        spans = F.array_sort(F.concat(spans, free), lambda a, b: a["start"] - b["start"])
    return spans


def _with_spans(df: DataFrame, text: str) -> DataFrame:
    """``_text`` (null: empty) and ``_spans``, all spans by kind, then start.  Each step is a
    projection of its own, so that no step is computed twice."""
    df = df.withColumn("_text", F.coalesce(F.col(text), F.lit("")))
    df = df.withColumns({f"_{r}": _proposed(r, F.col("_text")) for r in RULES})
    df = df.withColumns({f"_{r}": _placed(F.col(f"_{r}")) for r in RULES})
    df = df.withColumns({f"_{r}": _scored(r, F.col(f"_{r}"), F.col("_text")) for r in RULES})
    return df.withColumn("_spans", F.concat(*[_of_kind(k) for k in KINDS]))


def find_spans(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and spans array<struct<kind, start, end, score, base>>, by kind, then start.

    A null text counts as empty; empty texts have no spans; repeated rows are
    judged each; columns other than key and text aren't read.
    """
    out = _with_spans(df.select(F.col(key).alias("_key"), F.col(text).alias("_raw")), "_raw")
    return out.select(F.col("_key").alias(key), F.col("_spans").alias("spans"))


def _digest(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def span_report(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts and digests of the spans of ``find_spans``: of the base ones, and all of them."""
    found = find_spans(df, key, text)
    found = found.withColumn("base", F.filter("spans", lambda s: s["base"]))
    found = found.withColumns({"base_text": _digest(F.col("base")), "spans_text": _digest(F.col("spans"))})
    counts = [_count(F.col("base"), k).alias(f"n_{k}") for k in BASE]
    return found.select(key, *counts, F.sha2(F.col("base_text").cast("binary"), 256).alias("base_sha256"),
                        F.col("spans_text").alias("spans"), (F.size("spans") - F.size("base")).cast("long").alias("n_added"))


def redact(df: DataFrame, text: str = "text", length: str | None = None) -> DataFrame:
    """The rows with every span of the text replaced by its kind in brackets; a span that
    overlaps an earlier one only loses what is left of it.  A null text stays null.
    ``length``: a column to hold the new number of characters, if the input has it."""
    columns = df.columns
    inner = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)])
    at = f"c{columns.index(text)}"
    out = _with_spans(inner, at)
    out = out.withColumn("_all", F.array_sort(F.transform(
        "_spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))))

    def step(acc, s):
        gap = F.substring(F.col("_text"), acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        put = F.when(s["end"] > acc["at"], F.concat(gap, F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise("")
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], put).alias("out"))

    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    clean = F.aggregate("_all", zero, step, lambda acc: F.concat(
        acc["out"], F.substring(F.col("_text"), acc["at"] + 1, F.length("_text"))))
    out = out.withColumn("_clean", F.when(F.col(at).isNull() | (F.size("_all") == 0), F.col(at)).otherwise(clean))
    result = []
    for i, c in enumerate(columns):
        column = F.col(f"c{i}")
        if c == text:
            column = F.col("_clean")
        elif c == length:
            column = F.when(F.size("_all") == 0, column).otherwise(F.length("_clean").cast(df.schema[c].dataType))
        result.append(column.alias(c))
    return out.select(*result)
