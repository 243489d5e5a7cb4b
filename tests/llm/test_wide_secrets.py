"""What the pipeline redacts beyond the query's classes."""

import random
import string

import corpus_pipeline
from fixtures import DOC_SCHEMA

from lattica.llm import secrets


def test_the_pipeline_redacts_more_alphabets(spark):
    rng, texts = random.Random(8), []
    for alphabet in (string.ascii_lowercase + string.digits, string.ascii_uppercase + "234567", "0123456789ABCDEF"):
        texts += ["".join(rng.choices(alphabet, k=28)) for _ in range(8)]
    texts += ["aZkQxmBhxRwtLyvNscWqpHgk", "aZkQ9mBhxRwtLyvNscWqpHgk"]  # base64 of no digit and of one
    plain = ["x" * 30 + "1", "A" * 20 + "0000001", "internationalizationAndLocalizationManager", "aZ3kQ9mB7xR2tL5"]
    docs = spark.createDataFrame([(i, f"é {t} end", "en", "s", 0) for i, t in enumerate(texts + plain)], DOC_SCHEMA)
    out = {r["doc_id"]: r["text"] for r in corpus_pipeline.secret_scan(spark, docs, "").collect()}
    assert [t for i, t in enumerate(texts) if out[i] != "é [SECRET] end"] == []
    assert [t for i, t in enumerate(plain) if out[len(texts) + i] != f"é {t} end"] == []
    before = {r["doc_id"]: r["text"] for r in secrets.redact(docs).collect()}
    assert sum(before[i] == "é [SECRET] end" for i in range(len(texts))) == 0
