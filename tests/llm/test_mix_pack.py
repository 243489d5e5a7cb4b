"""Mixing and packing: budgets, targets, round trips."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from fixtures import PROSE, odd_documents, odd_frame, with_clashes
from tokenizers import Tokenizer

from lattica.llm import mixing, packing, queries

WORDS = public_tokenizers.path("word_bpe_49k.json")


def test_budgets_are_met():
    rng = random.Random(4)
    for _ in range(200):
        sizes = rng.sample(range(1, 400), rng.randrange(1, 12))
        counts = [rng.randrange(0, 9) for _ in sizes]
        budget = rng.randrange(0, sum(s * c for s, c in zip(sizes, counts)) + 2)
        take = mixing.fit_budget(sizes, counts, budget)
        got = sum(s * k for s, k in zip(sizes, take))
        assert all(0 <= k <= c for k, c in zip(take, counts)) and got <= max(0, budget)
        # as near as any choice of the documents that rounding left
        longest = max([0, *(s for s, c in zip(sizes, counts) if c)])
        base = mixing.shares(sizes, counts, max(0, budget - longest)) if 0 < budget < sum(s * c for s, c in zip(sizes, counts)) else take
        assert budget >= sum(s * c for s, c in zip(sizes, counts)) or budget - sum(s * k for s, k in zip(sizes, base)) <= 2 * longest
        sums = {sum(s * k for s, k in zip(sizes, base))}
        for s, c, k in zip(sizes, counts, base):
            sums = {x + j * s for x in sums for j in range(c - k + 1) if x + j * s <= budget}
        assert got == max(sums)


def test_large_budgets_are_met():
    rng = random.Random(6)
    sizes = rng.sample(range(1, 30000), 4000)
    counts = [rng.randrange(1, 40) for _ in sizes]
    total = sum(s * c for s, c in zip(sizes, counts))
    for part in (0.01, 0.37, 0.99):
        take = mixing.fit_budget(sizes, counts, int(total * part))
        assert all(0 <= k <= c for k, c in zip(take, counts))
        assert sum(s * k for s, k in zip(sizes, take)) == int(total * part)


def test_long_documents_keep_memory_small():
    sizes = list(range(1, 20_000)) + [3_000_000]
    take = mixing.fit_budget(sizes, [2] * len(sizes), 123_456_789)
    assert sum(s * k for s, k in zip(sizes, take)) == 123_456_789


def taken_rows(docs):
    return sorted(str((r["row"].asDict(), r["copies"])) for r in mixing.mix(docs).collect())


def test_the_order_of_rows_never_matters(spark):
    rows = [(None if i % 2 else i // 4, f"{'a' if i % 3 else 'b'} {i} w", "s" if i % 5 else None) for i in range(120)]
    rows += [(7, "same words here", "s")] * 30 + [(None, "no id at all", "s")] * 31 + [(None, None, "t")] * 3
    schema, rng = "doc_id long, text string, source string", random.Random(2)
    first = taken_rows(spark.createDataFrame(rows, schema))
    for _ in range(2):
        rng.shuffle(rows)
        assert taken_rows(spark.createDataFrame(rows, schema).repartition(5)) == first
    copies = [r["copies"] for r in mixing.mix(spark.createDataFrame(rows, schema)).where("row.doc_id = 7").collect()]
    assert len(copies) > 30 and len(set(copies)) == 2  # a quota ends among equal rows


def plain_targets(sizes, share=1.5, most=2):
    names = sorted((x for x in sizes if x is not None), key=lambda x: x.encode()) + [None] * (None in sizes)
    weight = {x: (3, 1, 2)[i % 3] for i, x in enumerate(names)}
    total, capped = share * sum(sizes.values()), set()
    while True:
        free = [x for x in names if x not in capped]
        level = (total - sum(most * sizes[x] for x in capped)) / max(1, sum(weight[x] for x in free))
        new = {x for x in free if weight[x] * level > most * sizes[x]}
        if not new:
            return {x: most * sizes[x] if x in capped else weight[x] * level for x in names}
        capped |= new


def check_mix(docs, close=1):
    rows = [r["row"] | {k: r[k] for k in ("size", "source_size", "target", "copies")} for r in (x.asDict(recursive=True) for x in mixing.mix(with_clashes(docs)).collect())]
    assert len(rows) == docs.count()
    sizes, taken, longest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in rows:
        n = len((r["text"] or "").encode().split())
        assert r["copies"] in (0, 1, 2)
        sizes[r["source"]] += n
        taken[r["source"]] += n * r["copies"]
        longest[r["source"]] = max(longest[r["source"]], n)
    want = plain_targets(dict(sizes))
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= close * max(1, longest[s]), s
    return sizes, taken, want


def test_mix_meets_targets(spark, sf):
    sizes, taken, want = check_mix(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), close=0.2)
    check_mix(odd_frame(spark))
    check_mix(odd_frame(spark).limit(0))


def test_mix_agrees_between_runs_and_repeats_rows(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    one = sorted(map(tuple, queries.op6_source_mixing(spark, sf).collect()))
    other = mixing.mix(docs.repartition(7)).select("row.doc_id", "size", "source_size", "target", (mixing.F.col("size") * mixing.F.col("copies")).alias("taken"))
    assert one == sorted(map(tuple, other.collect()))
    assert mixing.mixed(docs).count() == sum(t[4] // t[1] for t in one if t[1]) and mixing.mixed(docs).columns == docs.columns


def test_words_are_encoded_as_whole_texts(spark, sf):
    plain, own = Tokenizer.from_file(WORDS), packing.Encoder(WORDS)
    texts = [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    texts += ["", "a\x1cb c d e", "é e ́x", "ΟΔΟΣ ΟΔΟΣ.", "don't we'll 'S", "<|endoftext|> x<|startoftext|>y", "İ ŉ ß", "12 3４ 5½", "​x﻿ y", "🙂🙂 a🙂b"]
    for t in texts:
        assert np.frombuffer(own(t.encode()), "<u4").tolist() == plain.encode(t, add_special_tokens=False).ids, t[:50]


def check_pack(docs, length=2048, **options):
    plain = Tokenizer.from_file(WORDS)
    rows = packing.pack(packing.pieces(with_clashes(docs), WORDS, length, with_ids=True), length, **options).collect()
    texts = defaultdict(list)
    for d in docs.collect():
        texts[d["doc_id"]].append(plain.encode(d["text"] or "", add_special_tokens=False).ids + [0])
    assert sum(len(x) for v in texts.values() for x in v) == sum(r["length"] for r in rows)
    want = sorted((str(i), p, p * length, ids[p * length : (p + 1) * length]) for i, v in texts.items() for ids in v for p in range(-(-len(ids) // length)))
    assert sorted((str(r["id"]), r["piece"], r["start"], list(r["ids"])) for r in rows) == want
    bins = defaultdict(list)
    for r in rows:
        assert r["length"] == len(r["ids"]) and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for b in bins.values():
        at = 0
        for offset, n in sorted(b):
            assert offset == at
            at += n
        assert at <= length
    return len(rows), len(bins), sum(r["length"] for r in rows), bins


def test_packing_round_trip(spark, sf):
    n, made, tokens, _ = check_pack(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    assert made <= 1.01 * -(-tokens // 2048) + 1
    check_pack(odd_frame(spark))
    check_pack(odd_frame(spark).limit(0))


def test_every_capacity_holds(spark):
    docs = spark.createDataFrame([(i, " ".join(["word"] * (i % 9)), "en", "s", 0) for i in range(200)], odd_frame(spark).schema)
    bins = check_pack(docs, 64, documents=4, attention=300.0)[3]
    assert all(len(b) <= 4 and (len(b) == 1 or sum(n * n for _, n in b) <= 300) for b in bins.values())


def test_groups_do_not_cost_sequences(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 64)
    docs = spark.createDataFrame([(i, PROSE * (1 + i % 13), "en", "s", 0) for i in range(400)], odd_frame(spark).schema)
    n, made, tokens, _ = check_pack(docs)
    assert made <= -(-tokens // 2048) + 2 * (400 // 64 + 1)
    assert len(odd_documents()) == odd_frame(spark).count()
