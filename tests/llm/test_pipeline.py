"""Each stage of the pipeline on its own input against a plain version."""

from collections import Counter, defaultdict

import corpus_pipeline
from test_dedup import roots
from test_mix_pack import plain_targets
from test_native import base_spans, entropy_spans, measures
from test_shingles import near, plain_set
from tokenizers import Tokenizer

from lattica.llm import quality_rules


def test_stages(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == columns
        rows = out.collect()
        seen[name] = (docs.collect(), rows)
        docs = spark.createDataFrame(rows, out.schema)

    before, after = seen["quality rules"]
    assert {r["doc_id"] for r in after} <= {r["doc_id"] for r in before}
    kept = {r["doc_id"] for r in after}
    for r in before:
        n, _, _, _, repeated = measures(r["text"])
        if n < 50 or 100 * repeated > 50 * n:
            assert r["doc_id"] not in kept
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert all(r["doc_id"] in kept for r in before if labels.get(r["doc_id"]) == 1 and measures(r["text"])[0] >= 50)

    before, after = seen["SimHash near-duplicates"]
    sets = {r["doc_id"]: plain_set(r["text"]) for r in before}
    ids = sorted(sets)
    root = roots(ids, [(a, b) for i, a in enumerate(ids) for b in ids[:i] if near(sets[a], sets[b])])
    assert sorted(r["doc_id"] for r in after) == sorted(set(root.values()))

    before, after = seen["secret scan"]
    texts = {r["doc_id"]: r for r in after}
    assert len(after) == len(before)
    for r in before:
        base = base_spans(r["text"])
        t, out, at = r["text"], "", 0
        for s, _, e in sorted(base + entropy_spans(t, base)):
            if e > at:
                out, at = out + (t[at:s] + "[SECRET]" if s >= at else ""), e
        assert texts[r["doc_id"]]["text"] == out + t[at:] and texts[r["doc_id"]]["n_chars"] == len(out + t[at:])

    before, after = seen["source mixing"]
    words = {r["doc_id"]: len(r["text"].split()) for r in before}
    times, sizes, taken, longest = Counter(r["doc_id"] for r in after), defaultdict(int), defaultdict(int), defaultdict(int)
    for r in before:
        n = len(r["text"].encode().split())
        sizes[r["source"]] += n
        taken[r["source"]] += n * times[r["doc_id"]]
        longest[r["source"]] = max(longest[r["source"]], n)
        assert times[r["doc_id"]] <= 2
    for s, want in plain_targets(dict(sizes)).items():
        assert abs(taken[s] - want) <= longest[s], (s, words)

    rows = corpus_pipeline.packed(spark, docs, sf).collect()
    plain, bins = Tokenizer.from_file(corpus_pipeline.TOKENIZER), defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for b in bins.values():
        at = 0
        for offset, n in sorted(b):
            assert offset == at
            at += n
        assert at <= 2048
    tokens = sum(len(plain.encode(r["text"], add_special_tokens=False).ids) + 1 for r in after)
    assert sum(r["length"] for r in rows) == tokens and len(bins) <= 1.01 * -(-tokens // 2048) + 1


def test_run(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 0
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "quality rules" and quality_rules.DEFAULT.version
