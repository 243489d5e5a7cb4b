"""Exact similarity of word shingles: candidates by prefix filtering, confirmation on whole sets.

Two texts are similar if the Jaccard similarity of their sets of ``size`` words
in a row (64-bit hashes) is ``least`` or more. Prefix filtering loses no such
pair: with every set in one fixed order, similar sets share an element among
their first n - ceil(least * n) + 1, so each set goes to a cell for each of
those; sizes and places left rule out most pairs of a cell, and the rest are
first held against the sets' parities (in large cells) and counts by segment,
whose distances are lower bounds, and then settled on the whole sets. The order puts shingles that a sample finds in many
documents last, so that boilerplate makes no cells; any order gives the same
links. Sets are made from the texts where they are needed and never stored,
but for those in question.

``simhash`` has joined up large groups of near copies before; pairs of one
group are not compared again here.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import StageTables, hinted, partitions
from .components import whole_groups

#: The order is learnt from a hundredth of the documents, or from so many if that is more; a shingle counts as frequent from OFTEN on, MOST of them at most.
SAMPLE, OFTEN, MOST, CHUNK = 20_000, 3, 100_000, 1 << 16
#: Rows that a task remembers, to read equal rows once.
SEEN = 1_000_000
#: Least hashes of a set under LEASTS orders; those that CROWD sets or more share mark a crowd. ROUNDS of hubs at most, as long as one finds a USEFUL-th of what the first found; prefix filtering finds what they leave.
LEASTS, CROWD, ROUNDS, USEFUL = 8, 16, 8, 10
#: Segments in which a set's hashes are counted: a power of two, at least so many and at most so many, some four hashes each between.
SEGMENTS, MOST_SEGMENTS = 128, 4_096
#: Bits of a parity: powers of two.
LEAST_BITS, MOST_BITS = 256, 1_024
_ORDERS = np.random.default_rng(20_240_601).integers(0, 1 << 63, LEASTS, np.int64) | 1


def shingles(text: bytes, size: int) -> np.ndarray:
    """Distinct hashes, ascending; a text of fewer words is one shingle."""
    words, digest = text.lower().split(), xxhash.xxh64_digest  # both of ASCII only, as the bytes type does
    if not words:
        return np.empty(0, np.int64)
    return np.unique(np.frombuffer(b"".join([digest(b" ".join(words[i : i + size])) for i in range(max(1, len(words) - size + 1))]), np.int64))


def name(s: np.ndarray) -> bytes:
    """128 bits that stand for a set."""
    return xxhash.xxh3_128_digest(s.tobytes())


def counts(s: np.ndarray) -> bytes:
    """How many hashes fall in each segment, up to 255: the Manhattan distance of two such vectors never exceeds the number of elements that only one of the sets has."""
    m = min(MOST_SEGMENTS, max(SEGMENTS, 1 << (len(s) // 3).bit_length() - 1 if len(s) > 2 else 1))
    return np.minimum(np.bincount(s & (m - 1), minlength=m), 255).astype(np.uint8).tobytes()


def coarse(s: np.ndarray) -> bytes:
    """Counts by half as many segments, modulo 16, two a byte: distances around the circle are lower bounds as well, of fewer bits and looser than parities, which cells use."""
    c = np.bincount(s & (SEGMENTS // 2 - 1), minlength=SEGMENTS // 2) & 15
    return (c[::2] | c[1::2] << 4).astype(np.uint8).tobytes()


def parity(s: np.ndarray) -> bytes:
    """Whether an even or odd number of hashes falls in each of some four segments a hash. An element that only one of two sets has turns one bit, so the bits that differ are never more than such elements, and up to MOST_BITS nearly as many."""
    m = min(MOST_BITS, max(LEAST_BITS, 1 << (4 * len(s) - 1).bit_length() if len(s) else 1))
    return np.packbits(np.bincount(s & (m - 1), minlength=m) & 1, bitorder="little").tobytes()


def folded(parities: list[bytes]) -> dict[int, np.ndarray]:
    """Parities, shorter ones first, in rows of 64 bits: for each length in bytes those of it and, folded to it, the longer ones. The last row is always that of the last parity."""
    lengths, out, rows = np.array(list(map(len, parities))), {}, None
    for m in sorted(set(lengths.tolist()), reverse=True):
        own = np.frombuffer(b"".join(parities[i] for i in np.flatnonzero(lengths == m)), np.uint64).reshape(-1, m // 8)
        while rows is not None and rows.shape[1] > m // 8:
            half = rows.shape[1] // 2
            rows = rows[:, :half] ^ rows[:, half:]
        out[m] = rows = own if rows is None else np.concatenate([own, rows])
    return out


def least_hashes(s: np.ndarray) -> np.ndarray:
    """The least hash of a set under each of LEASTS orders; a random element of it, and one that similar sets mostly share."""
    return np.array([(s * f).min() for f in _ORDERS]) if len(s) else np.empty(0, np.int64)


def hub_pairs(crowds: DataFrame, joined: DataFrame | None, turn: int, least: Fraction) -> DataFrame:
    """In each crowd one set as a hub, another one every turn, in a pair (a, b) with each member that isn't of its group and that counts don't rule out: pairs in proportion to members.

    ``crowds``: (j, least, key, n, counts); ``joined``: (node, component) of the sets that are joined up so far.
    """
    own = ["j", "least", "key", "n", "counts"]
    members = crowds.withColumn("group", F.col("key")) if joined is None else crowds.join(joined, F.col("key") == F.col("node"), "left").select(*own, F.coalesce("component", "key").alias("group"))
    hub = members.groupBy("j", "least").agg(F.min_by(F.struct("key", "n", "counts", "group"), F.xxhash64(F.lit(turn), "j", "key")).alias("hub"))
    both = members.join(hub, ["j", "least"]).where("group <> hub.group").select(F.col("hub.key").alias("a"), F.col("key").alias("b"), (F.col("n") + F.col("hub.n")).cast("long").alias("n"), F.col("hub.counts").alias("c_a"), F.col("counts").alias("c_b"))
    return both.mapInArrow(lambda it: _plausible(it, least), "a binary, b binary").distinct()


def _frequent(texts: DataFrame, stages: StageTables, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that a sample of documents repeats, ascending, and their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [shingles(t or b"", size) for t in b.column(0).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*found, np.empty(0, np.int64)]))], ["token"])

    part = texts.select("text").sample(min(1.0, max(0.01, SAMPLE / max(1, texts.count()))), seed=42)
    repeated = stages.put(part.mapInArrow(run, "token long").groupBy("token").count().where(F.col("count") >= OFTEN))
    rows = sorted(repeated.orderBy(F.desc("count"), "token").limit(MOST).collect())
    stages.drop(repeated)
    return np.array([r["token"] for r in rows], np.int64), np.array([r["count"] for r in rows], np.int64)


def candidates(texts: DataFrame, known: DataFrame, stages: StageTables, size: int, least: Fraction) -> DataFrame:
    """Pairs (a, b) of set names, each once, with every pair among them that is similar enough and not of one group.

    ``texts``: (row, text). ``known``: (row, group) for rows that are joined up with others already; a null group marks a copy, which is passed over.
    """
    p, q = least.numerator, least.denominator
    often, count = _frequent(texts, stages, size)

    def ordered(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A set in the common order, and which of it are frequent."""
        if not len(often):
            return s, np.zeros(len(s), bool)
        at = np.minimum(np.searchsorted(often, s), len(often) - 1)
        times = np.where(often[at] == s, count[at], 0)
        by = np.argsort(times, kind="stable")
        return s[by], times[by] > 0

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """``bits``, the parity, only go along with frequent shingles, whose cells are large."""
        seen: set[int] = set()
        for b in batches:
            out: list[list] = [[], [], [], [], [], []]
            for row, t, group in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist(), b.column(2).to_pylist(), strict=True):
                if row in seen:
                    continue
                if len(seen) < SEEN:
                    seen.add(row)
                s = shingles(t or b"", size)
                n = len(s)
                m = n + (-p * n // q) + 1 if n else 0
                tokens, frequent = ordered(s)
                for column, value in zip(out, (tokens[:m], np.full(m, n), n - np.arange(m)), strict=False):
                    column.append(value)
                some = parity(s) if frequent[:m].any() else None
                out[3] += [name(s)] * m
                out[4] += [group] * m
                out[5] += [some if f else None for f in frequent[:m].tolist()]
            none = [np.empty(0, np.int64)]
            yield pa.RecordBatch.from_arrays([*(pa.array(np.concatenate(x + none).astype(k)) for x, k in zip(out[:3], (np.int64, np.int32, np.int32), strict=True)), *(pa.array(x, pa.binary()) for x in out[3:])], ["token", "n", "rest", "key", "group", "bits"])

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(some: set) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in zip(*some, strict=True)], ["a", "b"])

        for t, at in whole_groups(batches, ["token"]):
            n, rest = (t.column(c).to_numpy().astype(np.int64) for c in ("n", "rest"))
            key, group, bits = (t.column(c).to_pylist() for c in ("key", "group", "bits"))
            group = [g or k for g, k in zip(group, key, strict=True)]
            some: set[tuple[bytes, bytes]] = set()

            def able(i, j, n=n, rest=rest):
                # of the sizes, and of what can still be common from here on
                return (q * np.minimum(n[i], n[j]) >= p * np.maximum(n[i], n[j])) & ((p + q) * np.minimum(rest[i], rest[j]) >= p * (n[i] + n[j]))

            def add(i: int, j: int, key=key, group=group, some=some) -> None:
                if group[i] != group[j]:
                    some.add((key[i], key[j]) if key[i] < key[j] else (key[j], key[i]))

            sizes = np.diff(at)
            two = at[:-1][sizes == 2]
            for i in two[able(two, two + 1)].tolist():
                add(i, i + 1)
            for s, m in zip(at[:-1][sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
                if len(set(group[s : s + m])) == 1:
                    continue
                crowded = bits[s] is not None
                parities, end = folded(bits[s : s + m]) if crowded else {}, s + m  # rows by their place from the end
                last = s + np.searchsorted(n[s : s + m], q * n[s : s + m] // p, "right")  # rows of a cell come by size
                for i in range(s, s + m - 1):
                    j = np.arange(i + 1, last[i - s])
                    j = j[able(i, j)]
                    if crowded and len(j):
                        x = parities[len(bits[i])]
                        far = np.bitwise_count(x[j - end] ^ x[i - end]).sum(axis=1, dtype=np.int64)
                        j = j[(p + q) * far <= (q - p) * (n[i] + n[j])]
                    for k in j.tolist():
                        add(i, k)
                    if len(some) > CHUNK:
                        yield out(some)
                        some.clear()
            if some:
                yield out(some)

    perhaps, alone = hinted(texts, "row", known.select("row"))
    listed = perhaps.join(known.withColumn("known", F.lit(True)), "row", "left").where("known is null or group is not null").select("row", "text", "group")
    rows = listed.unionByName(alone.withColumn("group", F.lit(None).cast("binary")))
    cells = rows.mapInArrow(prefixes, "token long, n int, rest int, key binary, group binary, bits binary")
    return cells.repartition(partitions(texts.sparkSession), "token").sortWithinPartitions("token", "n").mapInArrow(pairs, "a binary, b binary").distinct()


def _similar(batches: Iterator[pa.RecordBatch], least: Fraction) -> Iterator[pa.RecordBatch]:
    p, q = least.numerator, least.denominator

    def near(x: pa.Scalar, y: pa.Scalar) -> bool:
        u, v = (np.frombuffer(h.as_buffer(), np.int64) for h in (x, y))  # views: a batch is not copied
        return (p + q) * len(np.intersect1d(u, v, assume_unique=True)) >= p * (len(u) + len(v))

    for b in batches:
        keep = pa.array([near(x, y) for x, y in zip(b.column(2), b.column(3), strict=True)], pa.bool_())
        yield pa.RecordBatch.from_arrays([b.column(k).filter(keep) for k in (0, 1)], ["a", "b"])


def _distance(x: bytes, y: bytes) -> int:
    u, v = (np.frombuffer(c, np.uint8).astype(np.int64) for c in (x, y))
    m = min(len(u), len(v))  # the vector of more segments is folded, and cut off where the other one was
    u, v = (np.minimum(c.reshape(-1, m).sum(axis=0), 255) for c in (u, v))
    return int(np.abs(u - v).sum())


def _plausible(batches: Iterator[pa.RecordBatch], least: Fraction) -> Iterator[pa.RecordBatch]:
    """Rows (a, b, n, counts of a, counts of b), n being both sizes' sum, whose counts are not too far apart."""
    p, q = least.numerator, least.denominator
    for b in batches:
        x, y = (b.column(k).to_pylist() for k in (3, 4))
        far = np.zeros(b.num_rows, np.int64)
        short = np.array([len(u) == len(v) == SEGMENTS for u, v in zip(x, y, strict=True)], bool)
        some = np.flatnonzero(short)
        u, v = (np.frombuffer(b"".join([z[i] for i in some]), np.uint8).reshape(-1, SEGMENTS).astype(np.int16) for z in (x, y))
        far[some] = np.abs(u - v).sum(axis=1, dtype=np.int64)
        for i in np.flatnonzero(~short):
            far[i] = _distance(x[i], y[i])
        keep = pa.array((p + q) * far <= (q - p) * b.column(2).to_numpy())
        yield pa.RecordBatch.from_arrays([b.column(k).filter(keep) for k in (0, 1)], ["a", "b"])


def plausible(pairs: DataFrame, keys: DataFrame, least: Fraction) -> DataFrame:
    """Those of ``pairs`` (a, b: set names) that their segment counts don't rule out. ``keys``: (key, n, counts), a row for each set."""
    of = lambda k: keys.select(F.col("key").alias(k), F.col("n").alias(f"n_{k}"), F.col("counts").alias(f"c_{k}"))
    both = pairs.join(of("b"), "b").join(of("a"), "a").select("a", "b", (F.col("n_a") + F.col("n_b")).cast("long").alias("n"), "c_a", "c_b")
    return both.mapInArrow(lambda it: _plausible(it, least), "a binary, b binary")


def confirmed(pairs: DataFrame, texts: DataFrame, keys: DataFrame, stages: StageTables, size: int, least: Fraction) -> DataFrame:
    """Those of ``pairs`` (a, b: set names) that are similar, written. ``keys``: (key, row), a row for each set; ``texts``: (row, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for b in batches:
            out = {}
            for key, t in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist(), strict=True):
                if key not in seen:
                    seen.add(key)
                    out[key] = shingles(t or b"", size).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.binary()), pa.array(list(out.values()), pa.binary())], ["key", "hashes"])

    left = stages.put(pairs)
    ends = left.select(F.col("a").alias("key")).unionByName(left.select(F.col("b").alias("key"))).distinct()
    rows = stages.put(keys.select("key", "row").join(ends, "key", "left_semi"))
    members = stages.put(hinted(texts, "row", rows.select("row"))[0].join(rows, "row").select("key", "text").mapInArrow(run, "key binary, hashes binary"))
    if members.count() > rows.count():  # rows that are the same in every column
        members = stages.put(members.groupBy("key").agg(F.first("hashes").alias("hashes")))
    side = lambda k, v: members.select(F.col("key").alias(k), F.col("hashes").alias(v)).hint("merge")  # noqa: E731  sets are of no bounded size
    # a, which many pairs may share, comes last: its set is then not moved along with each pair
    both = left.join(side("b", "y"), "b").join(side("a", "x"), "a").select("a", "b", "x", "y")
    found = stages.put(both.mapInArrow(lambda it: _similar(it, least), "a binary, b binary"))
    stages.drop(left, rows, members)
    return found
