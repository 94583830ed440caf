"""Sharding by rendezvous hashing (native DataFrame functions only).

Every (record key, shard) pair gets a pseudo-random number u in (0, 1) from an MD5
digest, and the shard with the largest ``weight / -ln(u)`` wins.  A shard's number
doesn't depend on the other shards, so adding one moves exactly the records it
wins, into itself; a shard with twice the weight gets twice the records.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickengine.llm.common import ranked

#: A shard is numbered in so many buckets of (key, text), each by its own task or part of one:
#: 10**10 rows in 8 shards are some 300,000 rows a bucket.  Rows of one key (null too) and
#: different texts spread over the buckets; only rows that are equal in both stay together.
SLOT_BUCKETS = 4096


def _unit(key: Column, salt: str) -> Column:
    """A number in (0, 1) from the first 52 bits of the MD5 of key and salt."""
    digest = F.md5(F.concat(key, F.lit(salt)).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(2**52)


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard (0 .. n - 1) of a string key; the smaller number wins a tie.
    A null key is the same as an empty one."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    key = F.coalesce(key, F.lit(""))
    scores = [F.struct((F.lit(float(w)) / -F.log(_unit(key, f":{s}"))).alias("score"), F.lit(-s).alias("minus"))
              for s, w in enumerate(weights)]
    best = scores[0] if len(scores) == 1 else F.greatest(*scores)
    return (-best["minus"]).cast("int")


def shard_records(df: DataFrame, weights: Sequence[float], key: str = "doc_id", text: str = "text",
                  new_weight: float = 1.0) -> DataFrame:
    """Shard, slot and grown shard of every row.

    Returns ``key``, size (UTF-8 bytes of the text plus 1), text_crc32, law ('key'),
    shard, slot (0 .. rows of the shard - 1) and grown_shard (the shard with one more,
    of ``new_weight``).  A null text has size 1 and the checksum of no bytes; rows with a
    null key share a shard; repeated rows get a slot each; other columns of the input
    aren't read, whatever their names.
    """
    name = F.col("_k").cast("string")
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = df.select(F.col(key).alias("_k"), (F.octet_length(body) + 1).cast("long").alias("size"),
                     F.crc32(body).alias("text_crc32"), F.xxhash64(F.col(key), body).alias("_h"))
    rows = rows.withColumns({"shard": rendezvous(name, weights),
                             "grown_shard": rendezvous(name, [*weights, new_weight])})
    slots = ranked(rows, "shard", F.pmod("_h", F.lit(SLOT_BUCKETS)), ["_k", "_h", "text_crc32", "size"], "slot")
    return slots.select(F.col("_k").alias(key), "size", "text_crc32", F.lit("key").alias("law"), "shard",
                        "slot", "grown_shard")


def write_shards(sharded: DataFrame, docs: DataFrame, path: str, key: str = "doc_id") -> None:
    """Write the documents as one folder per shard, by the shards that ``shard_records`` gave."""
    shard_of = sharded.select(F.col(key).alias("_k"), F.col("shard").alias("_shard")).distinct()
    joined = docs.join(shard_of, docs[key].eqNullSafe(F.col("_k"))).drop("_k")
    joined.write.partitionBy("_shard").mode("overwrite").parquet(path)
