"""Column expressions (SF1-SF14, UD1-UD3).  All are JVM-side Catalyst
expressions: no Python runs per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- strings

def java_split(s, sep: str) -> Column:
    """Split like ``String.split``: inner empty tokens are kept, trailing
    empty tokens are dropped; a string made only of separators gives an empty
    array and the empty string gives ``[""]``.  ``sep`` is a literal."""
    s = as_col(s)
    quoted = _regex_quote(sep)
    # a space separator strips with rtrim (no regex); others with a regex
    stripped = F.rtrim(s) if sep == " " else F.regexp_replace(s, f"(?:{quoted})+\\z", "")
    parts = F.split(stripped, quoted)
    return (F.when(s == "", F.array(F.lit("")))
             .when(stripped == "", F.array().cast("array<string>"))
             .otherwise(parts))


def split_words(s, sep: str = " ") -> Column:
    """Tokenise a line on one separator (the word-count flatMap)."""
    return java_split(s, sep)


def _regex_quote(sep: str) -> str:
    special = set("\\^$.|?*+()[]{}")
    return "".join("\\" + ch if ch in special else ch for ch in sep)


def java_hash(s) -> Column:
    """32-bit ``String.hashCode``: ``h = 31*h + c`` over the characters with
    int wrap-around.  Kept in [0, 2^32) as bigint while folding (no overflow
    under ANSI mode), then mapped to the signed int range."""
    s = as_col(s)
    codes = F.transform(F.split(s, ""), lambda ch: F.ascii(ch).cast("bigint"))
    codes = F.when(s == "", F.array().cast("array<bigint>")).otherwise(codes)
    folded = F.aggregate(codes, F.lit(0).cast("bigint"),
                         lambda acc, x: F.pmod(acc * 31 + x, F.lit(4294967296)))
    return F.when(folded >= 2147483648, folded - 4294967296).otherwise(folded).cast("int")


def field_map(key, value) -> Column:
    """One-entry map ``{key: value}`` (the document body of the index sink)."""
    return F.create_map(as_col(key), as_col(value))


# ---------------------------------------------------------------- time

def millis_to_ts(ms) -> Column:
    """Epoch milliseconds -> timestamp (DataStream-style event time)."""
    return F.timestamp_millis(as_col(ms))


def seconds_ts(ms) -> Column:
    """SQL-style event time ``TO_TIMESTAMP(FROM_UNIXTIME(ts / 1000))``: the
    integer division drops the milliseconds."""
    return F.timestamp_seconds(int_div(as_col(ms), 1000))


def int_div(c, n) -> Column:
    """Exact integer division truncating toward zero: SQL ``div``, whole-number
    arithmetic for bigint operands and exact for decimal ones."""
    return F.call_function("div", as_col(c), as_col(n) if not isinstance(n, int) else F.lit(n)).cast("bigint")


def ts_to_millis(ts) -> Column:
    """Timestamp (LTZ or NTZ, session zone UTC) -> epoch milliseconds."""
    return F.unix_millis(as_col(ts).cast("timestamp"))


def ts_to_micros(ts) -> Column:
    return F.unix_micros(as_col(ts).cast("timestamp"))


def micros_to_ntz(us) -> Column:
    return F.timestamp_micros(as_col(us)).cast("timestamp_ntz")


def timestamp_text(ms) -> Column:
    """Epoch ms as ``java.sql.Timestamp`` text in UTC: ``yyyy-MM-dd HH:mm:ss.f``
    with trailing zeros of the fraction dropped (at least one digit)."""
    ms = as_col(ms)
    frac = F.regexp_replace(F.format_string("%03d", F.pmod(ms, F.lit(1000))), "0+$", "")
    frac = F.when(frac == "", F.lit("0")).otherwise(frac)
    return F.concat(F.date_format(millis_to_ts(ms), "yyyy-MM-dd HH:mm:ss"), F.lit("."), frac)


def event_text(user, url, ms) -> Column:
    """Display string of a click: ``Event{user='u', url='x', timestamp=t}``."""
    return F.format_string("Event{user='%s', url='%s', timestamp=%s}",
                           as_col(user), as_col(url), timestamp_text(ms))


# ---------------------------------------------------------------- aggregates

def weighted_avg(value, weight) -> Column:
    """``sum(value*weight) div sum(weight)``, null when the weights sum to 0
    (bigint result, integer division).  Built from built-in sums, so it gets
    partial aggregation before the shuffle; sums are decimal(38,0), exact."""
    v = as_col(value).cast("decimal(38,0)")
    w = as_col(weight).cast("decimal(38,0)")
    den = F.sum(w)
    return F.when(den != 0, int_div(F.sum(v * w), den))
