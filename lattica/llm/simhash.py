"""SimHash near-duplicates by a segment-popcount embedding.

A 64-bit fingerprint maps to 32 counts of set bits, one for each 2-bit segment,
packed in place. The Manhattan distance of two such vectors never exceeds the
fingerprints' Hamming distance. The 32 segments form groups, as many as suit
the number of fingerprints (``grid``); within a distance of d bits at most d
groups differ, so each distinct fingerprint goes to a grid cell for each choice
of the groups that agree, and links can only be found in a shared cell. There
the Manhattan bound is tested, then the exact Hamming distance. Copies are
collapsed before; cells with one member are dropped; a cell of more than
``BLOCK`` members is compared block by block in as many tasks as it needs; a
cell gives a spanning forest and not its pairs.

``similar`` asks for more than bits can tell: texts link if their sets of
``size`` words in a row have that Jaccard similarity or more. Fingerprints
within ``bits`` then only propose links, which are confirmed on the whole sets.
Similar texts whose fingerprints are farther apart (at 0.8 the bits differ by
some 9 of 64, a distance at which no grid is selective) are found by prefix
filtering among what is still apart: see ``shingles``. Between the two, crowds
of near copies are joined up over hubs, so that their pairs needn't be made. No
link is lost.

Defined results: an empty or null text, or one without words, has fingerprint 0
and links like any other (under ``similar``: with the others of its kind); a
row without id has a fingerprint and the component of what it links to (null if
that has no id); rows that share an id are each listed and judged row by row;
an empty table gives an empty result; extra columns are not read and never clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shingles
from .common import StageTables, first_rows, partitions, row_hash, ship
from .components import components, forest, whole_groups

BITS = 3
BLOCK = 4096
#: Two random segments have the same count with probability 3/8, so a segment tells so many bits.
TELLS = 1.415
#: Stands for a missing id where ids are ordered.
NO_ID = (1 << 63) - 1
_LOW = 0x5555555555555555
_PER_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def majority(digests: np.ndarray) -> int:
    """Bit i is set where more than half of the hashes have it set. ``digests``: a row of 8 bytes each, lowest first."""
    counts = np.bincount((digests + np.arange(0, 2048, 256, dtype=np.int64)).ravel(), minlength=2048).reshape(8, 256) @ _PER_BYTE
    return int.from_bytes(np.packbits(2 * counts > len(digests), axis=1, bitorder="little").tobytes(), "little")


def fingerprint(text: bytes, size: int = 3, seed: int = 42) -> int:
    """Of the XXH64 of a text's shingles; repeats count."""
    words = text.lower().split()  # both of ASCII only, as the bytes type does
    if not words:
        return 0
    digest = xxhash.xxh64_digest
    found = [digest(b" ".join(words[i : i + size]), seed) for i in range(max(1, len(words) - size + 1))]
    return majority(np.frombuffer(b"".join(found), np.uint8).reshape(-1, 8)[:, ::-1])  # digests are big-endian


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """(id, fp): fp as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t or b"", size) for t in b.column(1).cast(pa.binary()).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps)], ["id", "fp"])

    ship(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "id long, fp long")


def grid(n: int, bits: int = BITS) -> int:
    """Groups of segments for ``n`` fingerprints: more of them mean more cells for each fingerprint, and fewer chance members in a cell."""
    return min(range(bits + 1, bits + 10), key=lambda g: comb(g, bits) * (1 + n / 2 ** (TELLS * 32 * (g - bits) / g)))


def _cells(groups: int, bits: int = BITS) -> list[int]:
    """Masks over the packed counts, one for each choice of the groups that agree."""
    parts = np.array_split(np.arange(32), groups)
    masks = [sum(3 << (2 * int(s)) for s in part) for part in parts]
    return [sum(c) for c in combinations(masks, groups - bits)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _packed(x: np.ndarray) -> np.ndarray:
    return x - ((x >> np.uint64(1)) & np.uint64(_LOW))


def manhattan(x: np.ndarray) -> np.ndarray:
    """Of packed vectors whose bitwise difference is ``x``: a count differs by 2 where only its high bit differs, else by 1."""
    low, high = x & np.uint64(_LOW), (x >> np.uint64(1)) & np.uint64(_LOW)
    return 2 * np.bitwise_count(high & ~low).astype(np.int64) + np.bitwise_count(low)


def _near(fp: np.ndarray, v: np.ndarray, i, j, bits: int) -> np.ndarray:
    """Which of the pairs (i, j) link: first the lower bound, then exactly."""
    return (manhattan(v[i] ^ v[j]) <= bits) & (np.bitwise_count(fp[i] ^ fp[j]) <= bits)


def _links(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    for t, at in whole_groups(batches, ["cell", "key", "i", "j"]):
        fp = t.column("fp").to_numpy().view(np.uint64)
        v = _packed(fp)
        n = np.diff(at)
        pairs = at[:-1][n == 2]
        hit = pairs[_near(fp, v, pairs, pairs + 1, bits)]
        a, b = [fp[hit]], [fp[hit + 1]]
        for s, m in zip(at[:-1][n > 2], n[n > 2], strict=True):
            edges = forest(m, lambda i, rest, s=s: _near(fp, v, s + i, s + rest, bits))
            if edges:
                e = np.array(edges) + s
                a.append(fp[e[:, 0]])
                b.append(fp[e[:, 1]])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)], ["a", "b"])


def near_links(fps: DataFrame, bits: int = BITS) -> DataFrame:
    """Links (a, b) that connect the distinct fingerprints ``fp`` as all their links of ``bits`` bits or fewer do."""
    n, groups = partitions(fps.sparkSession), grid(fps.count(), bits)
    ship(fps.sparkSession)
    cells = F.explode(F.array(*[F.struct(F.lit(k).alias("cell"), F.col("v").bitwiseAND(F.lit(_signed(m))).alias("key")) for k, m in enumerate(_cells(groups, bits))]))
    # counts of segments 0 to 30 by one subtraction, which never borrows; the last segment apart, as it holds the sign
    lower = F.expr(f"((fp & {(1 << 62) - 1}L) - (shiftrightunsigned(fp, 1) & {_LOW & ((1 << 62) - 1)}L)) & {(1 << 62) - 1}L")
    top = F.expr("shiftleft(shiftrightunsigned(fp, 62) - shiftrightunsigned(fp, 63), 62)")
    spread = fps.select("fp", lower.bitwiseOR(top).alias("v")).select("fp", cells.alias("c")).select("c.cell", "c.key", "fp")
    shared = spread.groupBy("cell", "key").agg(F.count("*").alias("n")).where("n > 1").select("cell", "key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    dealt = (
        spread.join(shared, ["cell", "key"])
        .select("cell", "key", "fp", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        .select("cell", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp")
        .repartition(n, "cell", "key", "i", "j")
        .sortWithinPartitions("cell", "key", "i", "j")
    )
    return dealt.mapInArrow(lambda it: _links(it, bits), "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, bits: int = BITS) -> DataFrame:
    """(id, fp, component_id) for every row: component_id is the smallest id reachable over links of ``bits`` bits or fewer."""
    stages = StageTables(docs.sparkSession)
    marked = stages.put(fingerprints(docs, id_col, text_col, size))
    fps = stages.put(marked.groupBy("fp").agg(F.coalesce(F.min("id"), F.lit(NO_ID)).alias("first")))
    node = F.struct("first", "fp")  # ordered by the smallest id, so a component's smallest node names it
    of = lambda name: fps.select(F.col("fp").alias(name), node.alias(f"node_{name}"))
    links = near_links(fps.select("fp"), bits).distinct().join(of("a"), "a").join(of("b"), "b").select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
    group = components(links, stages).select(F.col("node.fp").alias("fp"), F.col("component.first").alias("smallest"))
    named = fps.join(group, "fp", "left").select("fp", F.nullif(F.coalesce("smallest", "first"), F.lit(NO_ID)).alias("component_id"))
    return marked.join(named, "fp").select("id", "fp", F.coalesce("component_id", "id").alias("component_id"))


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Rows (id, row, text) as (id, row, key, fp, n, counts, leasts): the set's name, fingerprint, size, counts by segment and least hashes."""
    for b in batches:
        found = [shingles.shingles(t or b"", size) for t in b.column(2).cast(pa.binary()).to_pylist()]
        fps = np.array([majority(s.view(np.uint8).reshape(-1, 8)) if len(s) else 0 for s in found], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([shingles.name(s) for s in found], pa.binary()), pa.array(fps), pa.array(list(map(len, found)), pa.int32()), pa.array(list(map(shingles.counts, found)), pa.binary()), pa.array([shingles.least_hashes(s) for s in found], pa.list_(pa.int64()))], ["id", "row", "key", "fp", "n", "counts", "leasts"])


def similar_groups(docs: DataFrame, stages: StageTables, id_col: str = "doc_id", text_col: str = "text", size: int = 5, similar: float = 0.8, bits: int = BITS) -> DataFrame:
    """(id, row, group) for every row: rows of one group are reachable over links. ``row``: the hash of the row."""
    if not 0 < similar <= 1:
        raise ValueError("similar must be above 0 and at most 1")
    ship(docs.sparkSession)
    least = Fraction(str(similar))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), row_hash(docs).alias("row"), F.col(text_col).alias("text"))
    marks = stages.put(rows.mapInArrow(lambda it: _sets(it, size), "id long, row long, key binary, fp long, n int, counts binary, leasts array<long>"))
    first = marks.groupBy("key").agg(F.min("row").alias("row"), *[F.first(c).alias(c) for c in ("fp", "n", "counts", "leasts")])
    keys = stages.put(first)
    heads = stages.put(keys.groupBy("fp").agg(F.min("key").alias("head")))
    # proposed by fingerprints: each set with one of its own fingerprint, and such ones of near fingerprints
    of = lambda name: heads.select(F.col("fp").alias(name), F.col("head").alias(f"head_{name}"))
    near = near_links(heads.select("fp"), bits).distinct().join(of("a"), "a").join(of("b"), "b").select(F.col("head_a").alias("a"), F.col("head_b").alias("b"))
    proposed = stages.put(keys.join(heads, "fp").where("key <> head").select(F.col("head").alias("a"), F.col("key").alias("b")).unionByName(near))
    texts = rows.select("row", "text")
    # crowds of near copies: each hub stands for many pairs
    each = stages.put(keys.select("key", F.posexplode("leasts").alias("j", "least")))
    crowded = each.groupBy("j", "least").agg(F.count("*").alias("sets")).where(F.col("sets") >= shingles.CROWD).select("j", "least")
    crowds = stages.put(each.join(crowded, ["j", "least"]).join(keys.select("key", "n", "counts"), "key"))
    stages.drop(each)
    sure, joined, at_first = None, None, 0
    for turn in range(shingles.ROUNDS):
        tried = shingles.hub_pairs(crowds, joined, turn, least)
        links = shingles.confirmed(tried if turn else tried.unionByName(shingles.plausible(proposed, keys, least)).distinct(), texts, keys, stages, size, least)
        found = links.count()
        at_first = at_first or found
        if found or sure is None:
            before, sure = (sure, joined), links if sure is None else stages.put(sure.unionByName(links))
            joined = stages.put(components(sure, stages))
            stages.drop(*before)
        if found * shingles.USEFUL <= at_first:
            break
    stages.drop(proposed, heads)
    # found by prefix filtering: pairs that are still apart
    copies = marks.select("row", "key").distinct().join(keys.select("key", F.col("row").alias("rep")), "key").where("row <> rep").select("row", F.lit(None).cast("binary").alias("group"))
    known = stages.put(copies.unionByName(keys.join(joined, F.col("key") == F.col("node")).select("row", F.col("component").alias("group"))))
    apart = stages.put(shingles.candidates(texts, known, stages, size, least))
    stages.drop(crowds)
    more = shingles.confirmed(shingles.plausible(apart, keys, least), texts, keys, stages, size, least)
    group = components(sure.unionByName(more), stages)
    return marks.select("id", "row", "key").join(group, F.col("key") == F.col("node"), "left").select("id", "row", F.coalesce("component", "key").alias("group"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, similar: float | None = 0.8, bits: int = BITS) -> DataFrame:
    """One row of each group of near-duplicates, with its own columns (see ``first_rows``): by similarity, or without ``similar`` by bits alone."""
    work, stages = StageTables(docs.sparkSession), StageTables(docs.sparkSession)
    if similar is not None:
        grouped = similar_groups(docs, work, id_col, text_col, size, similar, bits)
    else:
        rows = docs.select(F.col(id_col).cast("long").alias("id"), row_hash(docs).alias("row"), F.col(text_col).alias("text"))
        marked = work.put(fingerprints(rows, "row", "text", size).select(F.col("id").alias("row"), "fp").distinct())
        group = components(near_links(marked.select("fp").distinct(), bits), work)
        of = marked.join(group, F.col("fp") == F.col("node"), "left").select("row", F.coalesce("component", "fp").alias("group"))
        grouped = rows.select("id", "row").join(of, "row").select("id", "row", "group")
    grouped = stages.put(grouped)
    work.clear()
    return first_rows(docs, grouped, stages, id_col)
