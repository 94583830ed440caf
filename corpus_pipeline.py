"""Documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns what the next one reads; all but the last
return the columns of documents.  ``run`` writes every stage's result to the shared checkpoint
folder and reads it again, so that a lost executor never costs more than one stage.

1. quality rules: documents that fail the fixed limits or the likelihood ratio go;
2. near duplicates: of each group, the document with the smallest id stays;
3. benchmark decontamination: contaminated documents go;
4. personal data: every span found in a text gives way to its kind in brackets (n_chars follows);
5. packing: token pieces with their sequence and offset.

Null texts fail stage 1; an empty table gives no rows at every stage; extra columns are kept up to
stage 4, whatever their names.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from clickengine.llm import decontamination, near_dedup, packing, pii, quality_rules
from clickengine.llm.common import read
from clickengine.llm.queries import tokenizer_file
from clickengine.session import checkpoint_dir, ship_package


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    trusted = quality_rules.trusted_ids(read(spark, sf_dir, "labels"))
    return quality_rules.keep(docs, quality_rules.fit(docs, trusted))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return near_dedup.keep_first(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.remove(docs, read(spark, sf_dir, "benchmark"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs, length="n_chars")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return packing.pack_documents(docs, tokenizer_file())


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", near_duplicates),
    ("decontamination", decontaminated),
    ("pii", redacted),
    ("packing", packed),
]

#: No SQL expresses the mined and trained decisions; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    folder = f"{checkpoint_dir(spark).rstrip('/')}/corpus-pipeline-{uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
