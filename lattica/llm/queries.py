"""The ten queries and the pipeline, over the tables of one folder."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import compression, embeddings, mixing, oracles, packing, quality_rules, secrets, simhash, substring, toxicity, url_filter
from .labelled import remainder

#: (verdict, host and path prefix); fixed by the query's contract.
URL_RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _judged(spark: SparkSession, sf_dir: str, kind, label: str, of: int, held: int) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.col(label).alias("label"))
    apart = remainder(F.col("id"), of) == held
    scored = kind.fit(docs, labels, ~apart).score(docs)
    return scored.withColumn("held_out", apart).withColumnRenamed("id", "doc_id")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(spark, sf_dir, compression, "quality", 5, 0)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(spark, sf_dir, toxicity, "toxic", 4, 2)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    of = lambda k: F.size(F.filter("spans", lambda x: x["rank"] == k)).cast("long")
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        *[of(k).alias(f"n_{kind}") for k, kind in enumerate(secrets.KINDS)],
        F.sha2(secrets.listing(F.col("spans"), 3), 256).alias("base_sha256"),
        secrets.listing(F.col("spans")).alias("spans"),
    )


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = quality_rules.ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return book.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (~quality_rules.passes(quality_rules.BASE)).alias("base_failed"),
        quality_rules.passes(quality_rules.DEFAULT).alias("kept"),
        "fail_bits",
    )


def op3_best_fit_packing(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    found = packing.pieces(table(spark, sf_dir, "documents"), tokenizer or public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(found).withColumnRenamed("id", "doc_id")


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(table(spark, sf_dir, "documents"))
    return found.select(F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.remove_repeats(table(spark, sf_dir, "documents"), texts=False)
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), url_filter.rule_table(spark, URL_RULES))


def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_secret_scan": op2_secret_scan,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_quality_rules": op4_quality_rules,
    "op5_toxicity": op5_toxicity,
    "op6_source_mixing": op6_source_mixing,
    "op7_embedding_dedup": op7_embedding_dedup,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_url_filter": op9_url_filter,
    "op10_simhash_dedup": op10_simhash_dedup,
}

ORACLES: dict[str, str] = {
    "op2_secret_scan": oracles.secret_spans(),
    "op4_quality_rules": oracles.rules(),
    "op7_embedding_dedup": oracles.EMBEDDINGS,
    "op8_substring_dedup": oracles.SUBSTRINGS,
    "op9_url_filter": oracles.urls(URL_RULES),
}
