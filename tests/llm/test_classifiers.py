"""Held-out accuracy and odd rows of the two classifiers."""

import zlib

import numpy as np
import pytest
from fixtures import odd_documents, odd_frame, with_clashes

from lattica.llm import compression, queries, toxicity
from lattica.llm.labelled import remainder

SF = "/root/testdata/sf0.1"


def auc(score, y):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(len(score))
    return (rank[y == 1].sum() - y.sum() * (y.sum() - 1) / 2) / (y.sum() * (len(y) - y.sum()))


def held_out(spark, got, label):
    rows = got.where("held_out").join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").select("score", "predicted", label).toPandas()
    return rows["score"].to_numpy(), rows["predicted"].to_numpy(), rows[label].to_numpy()


def test_quality_held_out(spark):
    got = queries.op1_quality_classifier(spark, SF).cache()
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in got.limit(50).collect():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    score, predicted, y = held_out(spark, got, "quality")
    assert auc(score, y) >= 0.98
    assert predicted[y == 1].mean() >= 0.99 and predicted[y == 0].mean() <= 0.4
    got.unpersist()


def test_toxicity_held_out(spark):
    got = queries.op5_toxicity(spark, SF).cache()
    for r in got.limit(50).collect():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    score, predicted, y = held_out(spark, got, "toxic")
    assert auc(score, y) >= 0.93
    assert predicted[y == 1].mean() >= 0.8 and predicted[y == 0].mean() <= 0.03
    got.unpersist()


@pytest.mark.parametrize("kind", [compression, toxicity])
def test_odd_rows(spark, kind):
    docs = with_clashes(odd_frame(spark)).withColumnRenamed("doc_id", "ident").drop("id").withColumnRenamed("ident", "id")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 12)] + [(None, 1), (3, None)], "id long, label int")
    train = remainder(queries.F.col("id"), 5) >= 0
    for known in (labels, labels.limit(0), labels.where("label = 1")):
        model = kind.fit(docs, known, train)
        rows = model.score(docs).collect()
        assert sorted(str(r["id"]) for r in rows) == sorted(str(d[0]) for d in odd_documents())
        assert all(0 <= r["score"] <= 1 for r in rows)
    assert kind.fit(docs.limit(0), labels, train).score(docs.limit(0)).count() == 0


def test_negative_risk_is_turned():
    """With a prior far too high the corrected risk would fall without end; the fit stays finite and still ranks."""
    rng = np.random.default_rng(0)
    toxic = [np.array([0, *rng.choice(np.arange(2, 20), 3, replace=False)]) for _ in range(60)]
    other = [np.array([1, *rng.choice(np.arange(2, 20), 3, replace=False)]) for _ in range(200)] + toxic[:10]
    w, b = toxicity.fit_nonnegative(toxic, other, 0.6, 20)
    assert np.isfinite(w).all() and np.isfinite(b) and w[0] > w[1]


def plain_toxicity(model, text):
    """Word by word, straight from the definition."""
    hit = set()
    for w in (text or "").encode().split():
        word = w.decode().lower().strip(toxicity._EDGES)
        for x in ["=" + word] * bool(word) + ["^" + word[:k] for k in toxicity.BEGINNINGS if len(word) > k]:
            hit.add(zlib.crc32(x.encode()) % toxicity.SPACE)
    return 1 / (1 + np.exp(-(model.bias + sum(model.weights.get(f, 0.0) for f in hit))))


def test_toxicity_matches_a_plain_scorer(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").selectExpr("doc_id as id", "text").unionByName(spark.createDataFrame([(-1, "nul\u00a0bad\u3000word \x1f x"), (-2, None)], "id long, text string"))
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").selectExpr("doc_id as id", "toxic as label")
    model = toxicity.fit(docs, labels, queries.F.lit(True))
    assert model.weights
    texts = {r["id"]: r["text"] for r in docs.collect()}
    for r in model.score(docs).collect():
        assert r["score"] == pytest.approx(plain_toxicity(model, texts[r["id"]]))


def test_fitting_and_scoring_cut_words_alike():
    text = "one\u00a0two three\u3000four five"
    of = {f for w in toxicity.words(text.encode()) for f in toxicity.word_features(w.decode())}
    assert set(toxicity.text_features(text.encode()).tolist()) == of and len(toxicity.words(text.encode())) == 3


def test_quality_matches_a_plain_scorer(spark):
    import zstandard

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").selectExpr("doc_id as id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").selectExpr("doc_id as id", "quality as label")
    model = compression.fit(docs, labels, queries.F.lit(True))
    texts = {r["id"]: (r["text"] or "").encode() for r in docs.collect()}

    def size(text, d):
        how = {"level": compression.LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
        return len((zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d), **how) if d else zstandard.ZstdCompressor(**how)).compress(text))

    for r in model.score(docs).limit(60).collect():
        t = texts[r["id"]]
        sizes = np.array([[len(t), size(t, model.dictionaries[0]), size(t, model.dictionaries[1]), size(t, None)]])
        assert [r["size_good"], r["size_bad"]] == sizes[0, 1:3].tolist()
        assert r["score"] == pytest.approx(1 / (1 + np.exp(-np.clip(compression.features(sizes) @ model.weights, -30, 30)))[0])
