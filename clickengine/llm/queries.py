"""The registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickengine.llm import (decontamination, near_dedup, oracles, packing, periodic_runs, phrases, pii, quality_classifier, quality_rules, sharding,
                             suffix_dedup, url_filter, vector_search, wavelet)
from clickengine.llm.common import read

#: Eight shards of equal weight.
SHARD_WEIGHTS = (1.0,) * 8


def op1_pii(spark: SparkSession, d: str) -> DataFrame:
    return pii.span_report(read(spark, d, "documents"))


def op2_near_dedup(spark: SparkSession, d: str) -> DataFrame:
    # the operator keeps a text, the query an id: they differ where one id has several linked texts
    return near_dedup.near_duplicates(read(spark, d, "documents")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op3_quality_classifier(spark: SparkSession, d: str) -> DataFrame:
    docs = read(spark, d, "documents")
    return quality_classifier.score(docs, quality_classifier.fit(docs, read(spark, d, "labels")))


def op4_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    docs = read(spark, d, "documents")
    model = quality_rules.fit(docs, quality_rules.trusted_ids(read(spark, d, "labels")))
    return quality_rules.judge(docs, model)


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op5_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_documents(read(spark, d, "documents"), tokenizer_file())


def op6_token_files(spark: SparkSession, d: str) -> DataFrame:
    return wavelet.encode_documents(read(spark, d, "documents"), tokenizer_file())


def op7_decontamination(spark: SparkSession, d: str) -> DataFrame:
    return decontamination.report(read(spark, d, "documents"), read(spark, d, "benchmark")).drop("longest_match")


def op8_suffix_dedup(spark: SparkSession, d: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read(spark, d, "documents")).drop("kept")


def op9_sharding(spark: SparkSession, d: str) -> DataFrame:
    return sharding.shard_records(read(spark, d, "documents"), SHARD_WEIGHTS)


def op10_url_filter(spark: SparkSession, d: str) -> DataFrame:
    return url_filter.filter_urls(read(spark, d, "pages"))


def op11_vector_search(spark: SparkSession, d: str) -> DataFrame:
    return vector_search.search(read(spark, d, "embeddings"))


def op12_periodic_runs(spark: SparkSession, d: str) -> DataFrame:
    return periodic_runs.report(read(spark, d, "documents"))


def op13_phrases(spark: SparkSession, d: str) -> DataFrame:
    return phrases.collocations(read(spark, d, "documents"))


def pipeline(spark: SparkSession, d: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, d)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_near_dedup": op2_near_dedup,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_quality_rules": op4_quality_rules,
    "op5_packing": op5_packing,
    "op6_token_files": op6_token_files,
    "op7_decontamination": op7_decontamination,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_sharding": op9_sharding,
    "op10_url_filter": op10_url_filter,
    "op11_vector_search": op11_vector_search,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_phrases": op13_phrases,
    "pipeline": pipeline,
}

ORACLES: dict[str, str] = oracles.SQL
