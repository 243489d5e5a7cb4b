"""Shingle similarity against brute force."""

import random
from fractions import Fraction

import corpus_pipeline
import numpy as np
from fixtures import DOC_SCHEMA, PROSE, odd_frame, with_clashes
from pyspark.sql import functions as F
from test_dedup import roots

from lattica.llm import shingles, simhash
from lattica.llm.common import StageTables, first_rows, hinted, row_hash


def plain_set(text, size=5):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def near(a, b):
    return a == b or 5 * len(a & b) >= 4 * len(a | b)


def near_frame(spark):
    rng, rows = random.Random(4), []
    for _ in range(25):
        words = [f"w{rng.randrange(4000)}" for _ in range(rng.randrange(60, 400))]
        for _ in range(6):
            text = list(words)
            for _ in range(rng.randrange(1, 1 + len(words) // 30)):  # similarities on both sides of the threshold
                text[rng.randrange(len(text))] = "changed"
            rows.append((len(rows), " ".join(text), "en", "s", 0))
    line = " ".join(f"l{i}" for i in range(40))
    rows += [(1000 + i, line + "".join(f" u{i}x{j}" for j in range(5 + i % 20)), "en", "s", 0) for i in range(60)]  # a line that all have
    rows += [(2000, "a b c d e f g h i", "en", "s", 0), (2001, "a b c d e f g h", "en", "s", 0)]  # just at the threshold
    return spark.createDataFrame(rows, DOC_SCHEMA)


def check_stage(spark, docs):
    rows = docs.collect()
    sets = {r["doc_id"]: plain_set(r["text"]) for r in rows}
    ids = sorted(sets)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[:i] if near(sets[a], sets[b])]
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(roots(ids, links).values()))
    return links, sets


def test_the_stage_matches_brute_force(spark):
    links, sets = check_stage(spark, near_frame(spark))
    assert (2001, 2000) in links and any(sets[a] != sets[b] for a, b in links)
    check_stage(spark, near_frame(spark).limit(0))
    check_stage(spark, spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("n_chars < 12000"))


def test_chunks_lose_no_pair(spark, monkeypatch):
    monkeypatch.setattr(shingles, "CHUNK", 2)
    check_stage(spark, near_frame(spark))


def test_odd_rows(spark):
    kept = simhash.keep_one(odd_frame(spark)).collect()
    assert sorted(r["doc_id"] for r in kept if r["doc_id"] is not None) == [1, 4, 5, 7, 8, 9, 10, 11, 12, 13]
    groups = simhash.similar_groups(odd_frame(spark), StageTables(spark)).collect()
    assert len(groups) == odd_frame(spark).count() and sum(r["doc_id"] is None for r in kept) == 0
    assert near(plain_set(PROSE), plain_set("no id here " + PROSE))


def shared_ids():
    one, other = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    rows = [(1, one, "en", "s", 0), (2, one, "en", "s", 0), (2, other, "en", "s", 0), (2, other, "fr", "s", 0), (2, other, "fr", "s", 0)]
    return rows, [(1, one), (2, other)]


def check_shared(spark, keep_one):
    rows, want = shared_ids()
    kept = [sorted(tuple(r) for r in keep_one(spark.createDataFrame(x, DOC_SCHEMA)).collect()) for x in (rows, rows[::-1])]
    assert [r[:2] for r in kept[0]] == want and kept[0] == kept[1]


def test_a_shared_id_keeps_what_nothing_is_near(spark):
    check_shared(spark, simhash.keep_one)


def test_by_bits_too_rows_and_not_ids_are_kept(spark):
    check_shared(spark, lambda docs: simhash.keep_one(docs, similar=None))


def test_a_clashing_column_and_rows_without_id(spark):
    rows = [(1, PROSE), (None, PROSE), (None, "no " * 20), (None, "no " * 20), (2, PROSE + " x")]
    docs = with_clashes(spark.createDataFrame(rows, "doc_id long, text string"))
    for similar in (0.8, None):
        kept = simhash.keep_one(docs, similar=similar)
        assert kept.columns == docs.columns
        found = [r["doc_id"] for r in kept.collect()]
        assert found.count(None) == 1 and 1 in found


def test_a_large_group_of_near_copies(spark):
    """Fingerprints join it up; what prefix filtering adds is far from its pairs."""
    rng = random.Random(6)
    words = [f"w{rng.randrange(9000)}" for _ in range(300)]
    rows = []
    for i in range(400):
        text = list(words)
        for _ in range(rng.randrange(1, 4)):
            text[rng.randrange(300)] = f"x{i}"
        rows.append((i, " ".join(text), "en", "s", 0))
    assert [r["doc_id"] for r in simhash.keep_one(spark.createDataFrame(rows, DOC_SCHEMA)).collect()] == [0]


def test_counts_are_a_lower_bound():
    rng = np.random.default_rng(4)
    for _ in range(200):
        n = int(rng.integers(1, 20_000))
        x = np.unique(rng.integers(-(1 << 62), 1 << 62, n))
        y = np.unique(np.append(x[rng.random(len(x)) < rng.random()], rng.integers(-(1 << 62), 1 << 62, int(rng.integers(0, n + 1)))))
        far = len(np.setxor1d(x, y))
        assert shingles._distance(shingles.counts(x), shingles.counts(y)) <= far
        c, d = (np.frombuffer(shingles.coarse(s), np.uint8) for s in (x, y))
        away = [(u - v) & 15 for u, v in ((c & 15, d & 15), (c >> 4, d >> 4))]
        assert sum(np.minimum(w, 16 - w).sum() for w in away) <= far


def shuffled_bytes(spark):
    sc, jvm, gateway = spark.sparkContext, spark.sparkContext._jvm, spark.sparkContext._gateway
    sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))


def test_texts_without_a_partner_are_not_moved(spark):
    rng = random.Random(8)
    docs = spark.createDataFrame([(i, "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=20_000)), "en", "s", 0) for i in range(100)], DOC_SCHEMA)
    stages = StageTables(spark)
    docs = stages.put(docs)
    ids = F.when(F.col("doc_id") == 99, 98).otherwise(F.col("doc_id"))
    grouped = stages.put(docs.select(F.col("doc_id").alias("id"), row_hash(docs).alias("row"), ids.alias("group")))
    limit, before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), shuffled_bytes(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as tables of any size
    try:
        kept = stages.put(first_rows(docs, grouped, stages))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(99))
    assert shuffled_bytes(spark) - before < 300_000  # of 2 MB of text


def test_a_hint_loses_no_row(spark):
    rows = spark.range(5000).select("id", F.xxhash64("id").alias("row"))
    perhaps, stay = hinted(rows, "row", rows.where("id % 9 = 0").select("row"))
    assert perhaps.columns == stay.columns == rows.columns
    assert perhaps.count() + stay.count() == 5000 and stay.where("id % 9 = 0").isEmpty() and perhaps.count() < 1000
    assert [x.count() for x in hinted(rows, "row", rows.limit(0).select("row"))] == [0, 5000]


def test_texts_just_below_the_threshold_make_few_pairs(spark):
    """A hundred of a group and a hundred that are at 0.774 from each of them: 10,000 pairs to rule out, mostly within the cells."""
    rng, rows = random.Random(9), []
    words = [f"w{i}" for i in range(200)]
    for i in range(200):
        text = list(words)
        for at in rng.sample(range(4, 100, 6), 1) if i < 100 else rng.sample(range(106, 196, 6), 4):
            text[at] = f"x{i}y{at}"
        rows.append((i, " ".join(text), b"one" if i < 100 else None))
    docs = spark.createDataFrame(rows, "row long, text string, group binary")
    stages = StageTables(spark)
    found = shingles.candidates(docs.select("row", "text"), docs.where("group is not null").select("row", "group"), stages, 5, Fraction("0.8"))
    assert found.count() < 1000


def test_parities_are_a_lower_bound():
    rng = np.random.default_rng(5)
    for _ in range(200):
        n = int(rng.integers(1, 3_000))
        x = np.unique(rng.integers(-(1 << 62), 1 << 62, n))
        y = np.unique(np.append(x[rng.random(len(x)) < rng.random()], rng.integers(-(1 << 62), 1 << 62, int(rng.integers(0, n + 1)))))
        far, (a, b) = len(np.setxor1d(x, y)), sorted((shingles.parity(x), shingles.parity(y)), key=len)
        rows = shingles.folded([a, b])[len(a)]
        assert rows.shape == (2, len(a) // 8) and np.bitwise_count(rows[0] ^ rows[1]).sum() <= far
    short, long = shingles.parity(x[:40]), shingles.parity(np.arange(5_000))
    assert sorted(shingles.folded([short, short, long])) == [len(short), len(long)] == [32, 128]
    assert len(shingles.parity(np.empty(0, np.int64))) == 32
