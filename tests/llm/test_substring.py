"""Repeated passages against a table of all windows."""

import hashlib
import random

from fixtures import odd_frame, with_clashes

from lattica.llm import queries, substring


def plain(rows):
    first = {}
    texts = [((r[0]), (r[1] or "").encode().split()) for r in rows]
    for i, w in texts:
        if i is not None:
            for k in range(len(w) - 12):
                key = tuple(w[k : k + 13])
                first[key] = min(i, first.get(key, i))
    out = []
    for i, w in texts:
        gone = {j for k in range(len(w) - 12) if i is not None and first[tuple(w[k : k + 13])] < i for j in range(k, k + 13)}
        out.append((str(i), len(w), len(gone), hashlib.sha256(b" ".join(x for j, x in enumerate(w) if j not in gone)).hexdigest()))
    return sorted(out)


def check(docs):
    got = substring.remove_repeats(with_clashes(docs)).collect()
    want = plain([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert sorted((str(r["id"]), r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got) == want
    for r in got:
        assert hashlib.sha256(r["kept"].encode()).hexdigest() == r["kept_sha256"]
    return sum(x[2] for x in want)


def passages(spark, n=300):
    rng = random.Random(8)
    word = lambda: f"w{int(rng.paretovariate(0.4)) % 3000}"
    shared = [[word() for _ in range(rng.randrange(10, 60))] for _ in range(25)]
    rows = []
    for i in rng.sample(range(-200, 5000), n):
        words = []
        for _ in range(rng.randrange(0, 5)):
            words += [word() for _ in range(rng.randrange(0, 40))]
            p = rng.choice(shared[:3] if rng.random() < 0.5 else shared)
            a = rng.randrange(0, 5)
            words += p[a : len(p) - rng.randrange(0, 5)]
        rows.append((i, "  ".join(words), "en", "s", 0))
    rows += [(9000, rows[5][1], "en", "s", 0), (9000, rows[6][1], "en", "s", 0), (9001, "x " * 40, "en", "s", 0), (9002, "x " * 15, "en", "s", 0), (9003, "x " * 12, "en", "s", 0)]
    return spark.createDataFrame(rows, odd_frame(spark).schema)


def test_matches_brute_force(spark, monkeypatch):
    assert check(passages(spark)) > 1000
    check(odd_frame(spark))
    check(odd_frame(spark).limit(0))
    monkeypatch.setattr(substring, "SHARD", 50)
    monkeypatch.setattr(substring, "STREAM", 20)
    check(passages(spark))


def test_matches_brute_force_on_documents(spark):
    assert check(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")) > 1000


def test_query(spark, sf):
    assert queries.op8_substring_dedup(spark, sf).columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
