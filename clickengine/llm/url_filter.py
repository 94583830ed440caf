"""URL filtering: host and path rules first, then mined association rules.

A rule list judges the URLs it covers.  FP-growth mines which combinations of URL tokens
go with which label among labelled URLs (those the list decides, unless others are given); rules below a support or confidence, and rules
that a shorter one makes redundant, are pruned.  The rest judge the other URLs through an
inverted index: each rule is filed under its rarest token, so a URL only meets rules that
share that token.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickengine.llm.common import materialize

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: (verdict, host, path)
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/")]

MIN_SUPPORT = 0.01
MIN_CONFIDENCE = 0.9
#: A mined rule needs so many tokens: one token alone, such as a language, isn't evidence enough.
MIN_TOKENS = 2
#: The rules go to every task if there are at most so many, which is counted; more are dealt by their key.
BROADCAST_RULES = 20_000

RULE = "rule_id bigint, tokens array<string>, verdict string, confidence double, support double"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1)
    return F.translate(host, UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def best_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """struct<size, rule, verdict> of the longest rule that fits, null if none does."""
    fits = [F.when(((host == h) | host.endswith("." + h)) & path.startswith(p),
                   F.struct(F.lit(len(h + p)).alias("size"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")))
            for v, h, p in rules]
    none = F.lit(None).cast("struct<size:int,rule:string,verdict:string>")
    return F.greatest(none, none, *fits)


def url_tokens(url: Column) -> Column:
    """Distinct tokens of a URL: scheme, host, its last labels and its first one, words of
    the path and of the query, each with its role.  Digits don't count."""
    url = F.coalesce(url, F.lit(""))
    host = host_of(url)
    labels = F.split(host, r"\.")
    n = F.size(labels)
    query = F.regexp_extract(url, r"(?s)\A[^?#]*\?([^#]*)", 1)
    parts = F.filter(F.split(F.translate(path_of(url), UPPER, UPPER.lower()), r"[^a-z]+"), lambda x: x != "")
    keys = F.filter(F.split(F.regexp_replace(query, r"=[^&]*", ""), "&"), lambda x: x != "")
    some = F.when(host != "", F.array(
        F.concat(F.lit("host:"), host), F.concat(F.lit("top:"), F.element_at(labels, -1)),
        F.concat(F.lit("site:"), F.array_join(F.slice(labels, F.greatest(n - 1, F.lit(1)), 2), ".")),
        F.concat(F.lit("first:"), F.element_at(labels, 1)))).otherwise(F.array().cast("array<string>"))
    scheme = F.regexp_extract(url, r"\A([A-Za-z]+)://", 1)
    return F.array_distinct(F.concat(
        some, F.when(scheme != "", F.array(F.concat(F.lit("scheme:"), F.lower(scheme))))
        .otherwise(F.array().cast("array<string>")),
        F.transform(parts, lambda x: F.concat(F.lit("path:"), x)),
        F.transform(keys, lambda x: F.concat(F.lit("query:"), x))))


def token_groups(labelled: DataFrame, min_support: float) -> DataFrame:
    """(group, tokens): the frequent tokens, those together that occur in the same URLs.  What one of a
    group says the others say too, so a group is one item, named by its first token: a URL with many tokens of
    its own that holds a large share of the rows is one item, not 2**t combinations.  Sets of URLs are
    compared by two hashes, 128 bits together, and their number of rows."""
    urls = (labelled.groupBy("url").agg(F.count(F.lit(1)).alias("n"))   # a repeated URL is looked at once
            .withColumn("token", F.explode(url_tokens(F.col("url")))))
    least = labelled.select((F.count(F.lit(1)) * min_support).alias("least")).scalar()
    seen = (urls.groupBy("token")
            .agg(F.sum("n").alias("n"), F.bit_xor(F.xxhash64("url")).alias("a"), F.bit_xor(F.xxhash64("url", F.lit(1))).alias("b"))
            .where(F.col("n") >= least))
    return (seen.groupBy("n", "a", "b").agg(F.array_sort(F.collect_list("token")).alias("tokens"))
            .select(F.element_at("tokens", 1).alias("group"), "tokens"))


def _frequent_sets(rows: DataFrame, groups: DataFrame, min_support: float) -> DataFrame:
    """(items, verdict, freq): frequent sets of token groups by themselves (verdict null) and with a verdict."""
    of_url = (rows.select("url").distinct().withColumn("token", F.explode(url_tokens(F.col("url"))))
              .join(groups.withColumn("token", F.explode("tokens")), "token").groupBy("url").agg(F.collect_set("group").alias("items")))
    label = F.concat(F.lit("label:"), F.col("verdict"))
    none = F.array().cast("array<string>")
    baskets = rows.join(of_url, "url", "left").select(F.concat(F.coalesce("items", none), F.array(label)).alias("items"))
    labels = F.filter("items", lambda x: x.startswith("label:"))
    found = FPGrowth(itemsCol="items", minSupport=min_support).fit(baskets).freqItemsets
    return found.select(F.array_sort(F.filter("items", lambda x: ~x.startswith("label:"))).alias("items"),
                        F.expr("substring(try_element_at(filter(items, x -> startswith(x, 'label:')), 1), 7)").alias("verdict"),
                        "freq").where((F.size(labels) <= 1) & (F.size("items") > 0))


def mine_rules(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
               min_tokens: int = MIN_TOKENS) -> DataFrame:
    """Association rules tokens -> verdict from (url, verdict) rows.

    Returns rule_id, tokens (sorted), verdict, confidence, support.  Items are groups of tokens that always occur
    together (``token_groups``).  A rule goes if a rule with a part of its items and the same verdict is as
    confident; that is carried from size to size in tables, from a set to those with one item more, as
    every part of a frequent set is frequent.  Null URLs have no tokens; rows with a null verdict don't count; no
    labelled rows give no rules.
    """
    spark = labelled.sparkSession
    rows = materialize(labelled.where(F.col("verdict").isNotNull()).select("url", "verdict"))
    count = rows.count()
    if not count:
        return spark.createDataFrame([], RULE)
    groups = materialize(token_groups(rows, min_support))
    sets = materialize(_frequent_sets(rows, groups, min_support))
    alone = sets.where(F.col("verdict").isNull()).select("items", F.col("freq").alias("n"))
    tokens = (alone.select("items", F.explode("items").alias("group")).join(groups, "group")
              .groupBy("items").agg(F.array_sort(F.flatten(F.collect_list("tokens"))).alias("tokens")))
    confidence = F.col("freq") / F.col("n")
    nodes = materialize(sets.where(F.col("verdict").isNotNull()).join(alone, "items").join(tokens, "items").select(
        "items", "verdict", "tokens", confidence.alias("confidence"), (F.col("freq") / count).alias("support"),
        F.when((F.size("tokens") >= min_tokens) & (confidence >= min_confidence), confidence).alias("rule")))
    rules, below = spark.createDataFrame([], RULE), None
    for size in range(1, (nodes.agg(F.max(F.size("items"))).first()[0] or 0) + 1):
        level = nodes.where(F.size("items") == size)
        if below is None:
            level = level.withColumn("part", F.lit(None).cast("double"))
        else:   # the best rule among the parts: those of one item less, and their own best parts
            less = level.select("items", "verdict", F.explode("items").alias("out")).select(
                "items", "verdict", F.array_remove("items", F.col("out")).alias("less"))
            parts = (less.join(below, ["less", "verdict"]).groupBy("items", "verdict").agg(F.max("best").alias("part")))
            level = level.join(parts, ["items", "verdict"], "left")
        level = materialize(level)
        below = level.select(F.col("items").alias("less"), "verdict", F.greatest("part", "rule").alias("best"))
        good = level.where(F.col("rule").isNotNull() & (F.col("part").isNull() | (F.col("part") < F.col("rule"))))
        rules = rules.unionByName(good.select(F.xxhash64("tokens", "verdict").alias("rule_id"), "tokens", "verdict", "confidence", "support"))
    return materialize(rules)


def judge_by_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, verdict, confidence) for the distinct URLs that a mined rule fits: the most
    confident rule wins, then allow before block, then the more specific one."""
    rules = rules.withColumn("_size", F.size("tokens"))
    df = urls.select("url").distinct().withColumn("_tokens", url_tokens(F.col("url")))
    # The rarest token of a rule: that of the fewest rules, then the smallest.
    posting = rules.select("rule_id", F.explode("tokens").alias("token"))
    often = posting.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    key = (posting.join(often, "token").groupBy("rule_id")
           .agg(F.min(F.struct("n", "token")).alias("k")).select("rule_id", F.col("k.token").alias("_key")))
    index = rules.join(key, "rule_id")
    few = rules.limit(BROADCAST_RULES + 1).count() <= BROADCAST_RULES
    met = df.withColumn("_key", F.explode("_tokens")).join(F.broadcast(index) if few else index, "_key")
    met = met.where(F.size(F.array_except("tokens", "_tokens")) == 0)
    best = F.max(F.struct("confidence", (F.col("verdict") == "allow").alias("allows"), "_size", "verdict"))
    return met.groupBy("url").agg(best.alias("b")).select("url", "b.verdict", "b.confidence")


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, key: str = "page_id",
                url: str = "url", labelled: DataFrame | None = None, **mining) -> DataFrame:
    """``key``, host, path, rule, verdict, confidence of every row.

    ``labelled``: (url, verdict) rows to mine; without them, the URLs that the rule list decides are, with
    its verdicts.  Undecided URLs are evidence for neither side.  URLs that no rule of either kind fits
    are allowed (confidence null).  A null URL, or one without ``://``, has an empty host and path;
    repeated rows are judged each; other columns aren't read.
    """
    df = pages.select(F.col(key).alias("_id"), F.col(url).alias("url"))
    df = df.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    df = df.withColumn("_best", best_rule(F.col("host"), F.col("path"), rules))
    if labelled is None:
        labelled = df.where(F.col("_best").isNotNull()).select("url", F.col("_best.verdict").alias("verdict"))
    mined = mine_rules(labelled, **mining)
    undecided = df.where(F.col("_best").isNull() & F.col("url").isNotNull())
    judged = judge_by_rules(undecided, mined).withColumnsRenamed({"url": "_url", "verdict": "_mined"})
    out = df.join(judged, (F.col("url") == F.col("_url")) & F.col("_best").isNull(), "left")
    return out.select(F.col("_id").alias(key), "host", "path", F.col("_best.rule").alias("rule"),
                      F.coalesce(F.col("_best.verdict"), F.col("_mined"), F.lit("allow")).alias("verdict"),
                      "confidence")
