"""From documents to packed training sequences, in five stages.

Each stage is ``(spark, docs, sf_dir) -> DataFrame`` over all rows that its
predecessor kept, written as Parquet and read again as the next one's ``docs``.
All but the last return the columns of ``documents``. Which documents of a
length the mix takes is settled by a seeded hash and the packing by a greedy
search, neither of which SQL expresses: ORACLE_SQL is None, and
``tests/llm/test_pipeline.py`` holds every stage against a plain version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lattica.llm import mixing, packing, quality_rules, secrets, simhash
from lattica.llm.common import StageTables

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule of the policy go."""
    return quality_rules.keep_passing(docs, quality_rules.DEFAULT)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: that of the smallest id. Links: five-word shingles, similarity 0.8 or more, none lost."""
    return simhash.keep_one(docs, size=5, similar=0.8)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stay; what is secret in them is replaced, and n_chars follows."""
    return secrets.redact(docs, classes=secrets.WIDE).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces and their places in sequences."""
    return packing.pack(packing.pieces(docs, TOKENIZER)).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality rules", quality),
    ("SimHash near-duplicates", near_duplicates),
    ("secret scan", secret_scan),
    ("source mixing", mixture),
    ("best-fit packing", packed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables, docs = StageTables(spark), spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        before, docs = docs, tables.put(stage(spark, docs, sf_dir))
        tables.drop(before)
    return STAGES[-1][1](spark, docs, sf_dir)
