"""SimHash, embedding links and components against brute force."""

import random

import numpy as np
import pytest
import xxhash
from fixtures import odd_frame, with_clashes
from pyspark.sql import functions as F

from lattica.llm import embeddings, queries, simhash
from lattica.llm.common import StageTables
from lattica.llm.components import components


def roots(nodes, links):
    up = {x: x for x in nodes}

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def test_components_match_union_find(spark):
    rng = random.Random(3)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 2000 + i) for i in range(300)] + [(7, 7)]
    want = roots({x for a, b in links if a != b for x in (a, b)}, links)
    got = components(spark.createDataFrame(links, "a long, b long"), StageTables(spark))
    assert {r["node"]: r["component"] for r in got.collect()} == want
    assert components(spark.createDataFrame([], "a long, b long"), StageTables(spark)).count() == 0


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    s = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << i for i in range(64) if 2 * sum(x >> i & 1 for x in h) > len(h))


def check_simhash(docs):
    rows = docs.select("doc_id", "text").collect()
    fp = [plain_fingerprint(r["text"]) for r in rows]
    each = sorted(set(fp))
    links = [(a, b) for i, a in enumerate(each) for b in each[:i] if (a ^ b).bit_count() <= 3]
    root = roots(each, links)
    least = {}
    for r, f in zip(rows, fp, strict=True):
        if r["doc_id"] is not None:
            least[root[f]] = min(least.get(root[f], r["doc_id"]), r["doc_id"])
    got = simhash.near_duplicates(with_clashes(docs)).collect()
    assert sorted((str(r["id"]), r["fp"] & (1 << 64) - 1, str(r["component_id"])) for r in got) == sorted((str(r["doc_id"]), f, str(least.get(root[f]))) for r, f in zip(rows, fp, strict=True))
    return links


def test_simhash_matches_brute_force(spark, sf):
    check_simhash(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    rng, rows = random.Random(9), []
    for d in range(12):
        words = [f"w{rng.randrange(5000)}" for _ in range(500)]
        for _ in range(8):
            near = list(words)
            near[rng.randrange(500)] = "changed"
            rows.append((len(rows), " ".join(near), "en", "s", 0))
    assert check_simhash(spark.createDataFrame(rows, odd_frame(spark).schema))
    check_simhash(odd_frame(spark))
    check_simhash(odd_frame(spark).limit(0))


def test_simhash_agrees_with_the_engines_hash(spark):
    r = spark.sql("select xxhash64('a b c') h").first()["h"]
    assert simhash.fingerprint(b"A b\tC") == r & (1 << 64) - 1


def test_simhash_links_survive_blocks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 16)
    rng = random.Random(5)
    seeds = [rng.getrandbits(64) for _ in range(6)] + [0, (1 << 64) - 1]
    fps = set()
    for s in seeds:
        x = s
        for _ in range(60):
            fps.add(x)
            for b in rng.sample(range(64), rng.randrange(1, 4)):
                x ^= 1 << b
    fps = sorted(fps)
    links = [(a, b) for i, a in enumerate(fps) for b in fps[:i] if (a ^ b).bit_count() <= 3]
    got = simhash.near_links(spark.createDataFrame([(simhash._signed(x),) for x in fps], "fp long")).collect()
    found = [(r["a"] & (1 << 64) - 1, r["b"] & (1 << 64) - 1) for r in got]
    assert all((a ^ b).bit_count() <= 3 for a, b in found)
    assert roots(fps, found) == roots(fps, links)


def test_manhattan_is_a_lower_bound():
    rng = np.random.default_rng(1)
    a, b = (rng.integers(0, 1 << 64, 5000, np.uint64) for _ in range(2))
    count = lambda x: np.array([[int(v) >> 2 * s & 3 for s in range(32)] for v in x])
    pa, pb = simhash._packed(a), simhash._packed(b)
    assert (np.abs(count(pa) - count(pb)).sum(1) == simhash.manhattan(pa ^ pb)).all()
    assert (simhash.manhattan(pa ^ pb) <= np.bitwise_count(a ^ b)).all()


def test_the_grid_follows_the_number_of_fingerprints():
    sizes = [simhash.grid(10**k) for k in range(2, 12)]
    assert sizes == sorted(sizes) and sizes[0] < sizes[-1]


def test_keep_one(spark):
    kept = simhash.keep_one(odd_frame(spark), size=3, similar=None).collect()
    assert sorted(r["doc_id"] for r in kept if r["doc_id"] is not None) == [1, 4, 5, 7, 8, 9, 10, 11, 12, 13]
    assert sum(r["doc_id"] is None for r in kept) == 1


def check_vectors(frame, threshold=0.95):
    rows = frame.select("vec_id", "embedding").collect()
    ok = []
    for i, r in enumerate(rows):
        v = r["embedding"]
        if v and all(c is not None and np.isfinite(c) for c in v) and any(c != 0 for c in v):
            ok.append((i, np.array(v, float) / np.linalg.norm(np.array(v, float))))
    links = [(a, b) for x, (a, va) in enumerate(ok) for b, vb in ok[:x] if len(va) == len(vb) and va @ vb >= threshold]
    n = np.zeros(len(rows), int)
    for a, b in links:
        n[a] += 1
        n[b] += 1
    root = roots(range(len(rows)), links)
    least = {}
    for i, r in enumerate(rows):
        if r["vec_id"] is not None:
            least[root[i]] = min(least.get(root[i], r["vec_id"]), r["vec_id"])
    want = sorted((str(r["vec_id"]), n[i], str(least.get(root[i]))) for i, r in enumerate(rows))
    got = embeddings.near_duplicates(with_clashes(frame)).collect()
    assert sorted((str(r["id"]), r["n_links"], str(r["component_id"])) for r in got) == want
    return links


def odd_vectors(spark):
    rng = np.random.default_rng(2)
    c = rng.normal(size=(30, 16))
    x = np.repeat(c, 12, axis=0) + rng.normal(scale=0.25, size=(360, 16))  # cosines on both sides of the threshold
    rows = [(i, [float(f) for f in v.astype(np.float32)]) for i, v in enumerate(x)]
    rows += [(900, rows[0][1]), (901, rows[0][1]), (901, rows[0][1]), (902, None), (903, []), (904, [0.0] * 16), (905, [float("nan")] + [1.0] * 15), (906, [None] + [1.0] * 15), (907, [float("inf")] * 16), (908, [1.0, 2.0]), (909, [1.0, 2.0]), (None, rows[3][1]), (None, [5.0] * 3)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def test_vectors_match_brute_force(spark, monkeypatch):
    assert check_vectors(odd_vectors(spark))
    for name, value in (("BLOCK", 8), ("STREAM", 20), ("TILE", 4)):
        monkeypatch.setattr(embeddings, name, value)
    check_vectors(odd_vectors(spark))
    check_vectors(odd_vectors(spark).limit(0))


def scaled_copies(spark, seed, kind, whole):
    """Three directions, many lengths: cells whose centroids all but coincide."""
    rng = np.random.default_rng(seed)
    rows = []
    for v in rng.normal(size=(3, 32)):
        for k in range(400):
            scale = float(k + 1) if whole else float(rng.uniform(0.01, 100))
            rows.append((len(rows), [float(c) for c in np.float32(v) * (np.float32(scale) if kind == "float" else scale)]))
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")


@pytest.mark.parametrize("seed", [2, 3, 4])
def test_scaled_copies_lose_no_link(spark, seed):
    for kind, whole in (("double", False), ("float", True)):
        found = embeddings.near_duplicates(scaled_copies(spark, seed, kind, whole)).collect()
        assert {r["n_links"] for r in found} == {399} and {r["component_id"] for r in found} == {0, 400, 800}


def test_far_lengths_link(spark):
    rows = [(1, [1e-200, 1e-200]), (2, [1e200, 1e200]), (3, [1.0, 1.0]), (4, [1.0, -1.0]), (5, [5e-324, 5e-324])]
    got = embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert {r["id"]: (r["n_links"], r["component_id"]) for r in got.collect()} == {1: (3, 1), 2: (3, 1), 3: (3, 1), 4: (0, 4), 5: (3, 1)}


def clustered(dims=768, clusters=60, each=25):
    rng = np.random.default_rng(8)
    c = rng.normal(size=(clusters, dims))
    return (np.repeat(c, each, axis=0) + rng.normal(scale=0.22, size=(clusters * each, dims))).astype(np.float32)


def test_long_clustered_vectors(spark):
    x = clustered()
    frame = spark.createDataFrame([(i, [float(f) for f in v]) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    want = (u @ u.T >= 0.95).sum(1) - 1
    assert want.min() < want.max()
    got = {r["id"]: r["n_links"] for r in embeddings.near_duplicates(frame).collect()}
    assert [got[i] for i in range(len(x))] == want.tolist()
    some = {r["id"]: r["n_links"] for r in embeddings.near_duplicates(frame, probes=2).collect()}
    assert sum(some.values()) >= 0.9 * want.sum() and all(some[i] <= n for i, n in enumerate(want))


def test_vector_recall_is_whole(spark):
    check_vectors(spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet"))


def test_dedup_queries(spark, sf):
    got = queries.op10_simhash_dedup(spark, sf)
    assert got.columns == ["doc_id", "fingerprint", "component_id"] and got.where(F.length("fingerprint") != 16).count() == 0
    assert queries.op7_embedding_dedup(spark, sf).columns == ["vec_id", "n_links", "component_id", "kept"]
