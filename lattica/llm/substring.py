"""Repeated passages by sharded phrase automata.

A window is 13 consecutive words. A word goes if a window over it also starts
in a document with a smaller id.

1. Every window is represented by the least of its nine 5-word hashes (its
   mark), so equal windows have equal marks; a document sends each distinct mark
   once. Marks that two different texts hold are kept.
2. Documents are cut to the windows under such marks, a piece for each run of one
   mark. Their windows' 96-bit hashes, counted over all documents, confirm
   which recur and where each starts first: these are the passages.
3. Passages are dealt to shards by mark. A shard compiles its passages' windows,
   a symbol a word, into an Aho-Corasick automaton, streams the pieces of all
   documents with its marks through it, and checks each match on the words. As a window's mark is
   part of it, no occurrence is in another shard. A shard with many pieces is
   repeated under salts, each with a part of them, so that a passage which a
   third of all documents hold is many tasks.
4. The ranges found are applied to the whole texts.

Exact copies are settled by the text's hash beforehand and stay out of 2 and 3.
A task holds one automaton of about ``SHARD`` windows and one batch.

Defined results: a null or empty text has no words; texts of fewer than 13
words lose nothing; a row without id loses nothing and removes nothing; rows
that share an id don't remove each other's words; an empty table gives an empty
result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import StageTables, partitions, ship

WINDOW, GRAM = 13, 5
SPAN = WINDOW - GRAM + 1
#: Windows an automaton holds, about; pieces a task streams, about.
SHARD, STREAM = 40_000, 100_000
#: Windows in a piece at most: their places then fit in the low bits of a number.
LONGEST = 16
#: Parts that a shard's pieces are dealt to at most, and bits that a shard and its part have in the number by which rows are dealt.
MOST_SALTS, PLACES = 4_096, 30
#: A table of one small row a shard is sent to all tasks up to this many rows (1 MB), and joined beyond.
FEW = 50_000

_draw = np.random.default_rng(20_240_601)
_FACTORS = (_draw.integers(0, 1 << 64, (3, WINDOW), np.uint64) | np.uint64(1)).astype(np.uint64)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _sums(a: np.ndarray, size: int, which: int) -> np.ndarray:
    """A hash of every ``size`` consecutive words."""
    n = len(a) - size + 1
    out = a[:n] * _FACTORS[which, 0]
    for j in range(1, size):
        out += a[j : n + j] * _FACTORS[which, j]
    return _mix(out)


def window_marks(a: np.ndarray) -> np.ndarray:
    """The mark of each window, as signed longs."""
    g = _sums(a, GRAM, 0)
    n, m, width = len(g) - SPAN + 1, g, 1
    while 2 * width <= SPAN:
        m = np.minimum(m[:-width], m[width:])
        width *= 2
    return np.minimum(m[:n], m[SPAN - width : SPAN - width + n]).view(np.int64)


_LOW_HALF = (1 << 32) - 1


def _texts(column: pa.Array) -> Iterator[list[bytes]]:
    """The words of one text after the other: a batch's words at once would be many times its size."""
    for t in column.cast(pa.binary()):
        yield (t.as_py() or b"").split()


#: Documents whose words are hashed in one go: array operations cost by the call on short texts.
TOGETHER = 500


def _grouped(part: pa.RecordBatch, column: int) -> tuple[list[list[bytes]], np.ndarray, np.ndarray, np.ndarray]:
    """The words of some texts, their hashes in a row, each text's first place in it, and the marks of all windows (those that cross texts among them)."""
    texts = list(_texts(part.column(column)))
    first = np.cumsum([0, *map(len, texts)])
    a = word_hashes([w for words in texts for w in words])
    marks = window_marks(a) if len(a) >= WINDOW else np.empty(0, np.int64)
    return texts, a, first, marks


def _mark_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for begin in range(0, b.num_rows, TOGETHER):
            part = b.slice(begin, TOGETHER)
            texts, _, first, marks = _grouped(part, 2)
            windows = np.maximum(0, np.diff(first) - WINDOW + 1)
            row = np.repeat(np.arange(len(texts)), windows)
            own = marks[np.repeat(first[:-1], windows) + np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)]
            # a mark mostly comes back in the next window; one that comes back later is sent again
            new = np.ones(len(own), bool)
            new[1:] = (own[1:] != own[:-1]) | (row[1:] != row[:-1])
            take = pa.array(row[new])
            yield pa.RecordBatch.from_arrays([pa.array(own[new]), part.column(0).take(take), part.column(1).take(take)], ["mark", "id", "t"])


_PIECE = "mark long, id long, t long, start int, body string, w1 array<long>, w2 array<int>"


def _window_hashes(a: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """96 bits of the windows that begin at ``at``."""
    out = []
    if not len(at):
        return np.empty(0, np.int64), np.empty(0, np.int32)
    for which in (1, 2):
        h = a[at] * _FACTORS[which, 0]
        for j in range(1, WINDOW):
            h += a[at + j] * _FACTORS[which, j]
        out.append(_mix(h))
    return out[0].view(np.int64), (out[1] >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _piece_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents and the shared marks among theirs, as pieces: runs of windows under one such mark, with the windows' hashes."""
    none = np.empty(0, np.int64)
    for b in batches:
        for begin in range(0, b.num_rows, TOGETHER):
            part = b.slice(begin, TOGETHER)
            texts, a, first, all_marks = _grouped(part, 2)
            row, mark, start, size, places, body = [none], [none], [none], [none], [none], []
            for i, (words, own) in enumerate(zip(texts, part.column(3), strict=True)):
                if len(words) < WINDOW:
                    continue
                marks = all_marks[first[i] : first[i + 1] - WINDOW + 1]
                at = np.flatnonzero(np.isin(marks, own.values.to_numpy()))
                if not len(at):
                    continue
                # a new piece where a run begins, where the mark changes and every LONGEST windows
                held = marks[at]
                new = np.append(True, (at[1:] != at[:-1] + 1) | (held[1:] != held[:-1]) | (at[1:] % LONGEST == 0))
                begins = np.flatnonzero(new)
                n = np.diff(np.append(begins, len(at)))
                s = at[begins]
                line = b" ".join(words)
                ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)  # one past the space behind each word
                starts = np.append(0, ends)
                body += [line[x:y] for x, y in zip(starts[s].tolist(), (ends[s + n + WINDOW - 2] - 1).tolist(), strict=True)]
                row.append(np.full(len(s), i))
                mark.append(held[begins])
                start.append(s)
                size.append(n)
                places.append(at + first[i])
            take = pa.array(np.concatenate(row))
            cuts = pa.array(np.append(0, np.cumsum(np.concatenate(size))).astype(np.int32))
            lists = [pa.ListArray.from_arrays(cuts, pa.array(w)) for w in _window_hashes(a, np.concatenate(places))]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(mark)), part.column(0).take(take), part.column(1).take(take), pa.array(np.concatenate(start).astype(np.int32)), pa.array(body, pa.binary()).cast(pa.string()), *lists], ["mark", "id", "t", "start", "body", "w1", "w2"])


class _Symbols(dict):
    """A character of a small alphabet for each word. Automata look their branches up one by one, so few of them must leave a node; a match of symbols is checked on the words."""

    def __missing__(self, word: bytes) -> str:
        if len(self) > 200_000:
            self.clear()
        c = self[word] = chr(1 + xxhash.xxh32_intdigest(word) % 199)
        return c


class Phrases:
    """An automaton over the symbols of 13-word phrases, with the phrases and the smallest id that holds each."""

    def __init__(self) -> None:
        import ahocorasick

        self.automaton, self.symbols, self.marks, self.ready = ahocorasick.Automaton(), _Symbols(), set(), False

    def add(self, mark: int, words: list[bytes], places: int, owner: int) -> None:
        """The windows of a piece whose bits are set in ``places``."""
        line, automaton = "".join([self.symbols[w] for w in words]), self.automaton
        self.marks.add(mark)
        for i in (k for k in range(LONGEST) if places >> k & 1):
            key, phrase = line[i : i + WINDOW], b" ".join(words[i : i + WINDOW])
            held = automaton.get(key, None)
            if held is None:
                automaton.add_word(key, {phrase: owner})
            else:
                held[phrase] = min(owner, held.get(phrase, owner))

    def find(self, words: list[bytes]) -> list[tuple[int, int]]:
        """(first word, smallest id) of every phrase in a text."""
        if not self.ready:
            self.automaton.make_automaton()
            self.ready = True
        out = []
        for end, held in self.automaton.iter("".join([self.symbols[w] for w in words])):
            owner = held.get(b" ".join(words[end - WINDOW + 1 : end + 1]))
            if owner is not None:
                out.append((end - WINDOW + 1, owner))
        return out


def _merged(found: list[tuple[int, int]], owner: int) -> list[tuple[int, int]]:
    """Word ranges under the phrases that a smaller id holds."""
    out: list[tuple[int, int]] = []
    for s, first in found:
        if first < owner:
            if out and s <= out[-1][1]:
                out[-1] = (out[-1][0], s + WINDOW)
            else:
                out.append((s, s + WINDOW))
    return out


def _locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by ``place``, which holds group, kind and the low half of the mark from high bits to low: a group's passages (kind 0) come before what is streamed through them. Equal pieces of a mark are searched once."""
    group, phrases, mark, known = None, Phrases(), None, {}
    for b in batches:
        found = [[], [], [], []]
        place, ids, ts, starts = (b.column(k).to_pylist() for k in range(4))
        bodies, places = b.column(4).cast(pa.binary()).to_pylist(), b.column(5).to_pylist()
        for i, (p, piece) in enumerate(zip(place, bodies, strict=True)):
            if p >> 33 != group:
                group, phrases, mark = p >> 33, Phrases(), None
            if not p >> 32 & 1:
                phrases.add(p & _LOW_HALF, piece.split(), places[i], ids[i])
            elif p & _LOW_HALF in phrases.marks:  # without a passage under its mark, nothing of a piece can recur
                if p != mark or len(known) > 1000:
                    mark, known = p, {}
                if piece not in known:
                    known[piece] = phrases.find(piece.split())
                for s, e in _merged(known[piece], ids[i]):
                    for column, value in zip(found, (ids[i], ts[i], starts[i] + s, starts[i] + e), strict=True):
                        column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(found, (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)], ["id", "t", "start", "stop"])


def _apply(batches: Iterator[pa.RecordBatch], texts: bool) -> Iterator[pa.RecordBatch]:
    """Whole texts with their ranges, or with the sign of a copy, as what is left of them."""
    for b in batches:
        n, gone, digests, kept = [], [], [], []
        ranges, copies = b.column(2), b.column(3).to_pylist()
        edges, ends = ranges.flatten().to_numpy(), np.cumsum(ranges.value_lengths().fill_null(0).to_numpy())
        starts, stops = edges >> 32, edges & _LOW_HALF
        for i, words in enumerate(_texts(b.column(1))):
            lo, hi = int(ends[i - 1]) if i else 0, int(ends[i])
            left = words
            if copies[i] and len(words) >= WINDOW:
                left = []
            elif hi > lo:
                depth = np.zeros(len(words) + 1, np.int64)
                np.add.at(depth, starts[lo:hi], 1)
                np.add.at(depth, stops[lo:hi], -1)
                left = [words[k] for k in np.flatnonzero(np.cumsum(depth[:-1]) == 0)]
            n.append(len(words))
            gone.append(len(words) - len(left))
            line = b" ".join(left)
            digests.append(hashlib.sha256(line).hexdigest())
            if texts:
                kept.append(line)
        columns = [b.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(digests, pa.string())]
        columns += [pa.array(kept, pa.binary()).cast(pa.string())] if texts else []
        yield pa.RecordBatch.from_arrays(columns, ["id", "n_words", "n_removed", "kept_sha256", "kept"][: len(columns)])


def repeated_ranges(docs: DataFrame, stages: StageTables) -> tuple[DataFrame, DataFrame]:
    """``docs``: (id, t, t2, text), t and t2 being hashes of the text. Returns (id, t, start, stop) of words to remove, and (id, t) of exact copies of smaller ids' texts."""
    n = partitions(docs.sparkSession)
    ship(docs.sparkSession)
    named = docs.where("id is not null")
    # written first, so that the join reads it as it is and a text with very many copies can be split
    firsts = stages.put(named.groupBy("t", "t2").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last").select("t", "t2", "first"))
    copies = stages.put(named.select("id", "t", "t2").join(firsts, ["t", "t2"]).where("id > first").select("id", "t").distinct())

    marks = stages.put(named.select("id", "t", "text").mapInArrow(_mark_rows, "mark long, id long, t long"))
    shared = marks.groupBy("mark").agg(F.min("t").alias("a"), F.max("t").alias("b")).where("a <> b").select("mark")
    held = marks.join(shared, "mark").join(copies, ["id", "t"], "left_anti").groupBy("id", "t").agg(F.collect_list("mark").alias("marks"))
    held = stages.put(held)
    stages.drop(marks)
    pieces = named.select("id", "t", "text").join(held, ["id", "t"]).mapInArrow(_piece_rows, _PIECE)
    pieces = stages.put(pieces.withColumn("piece", F.monotonically_increasing_id()))
    stages.drop(held)

    windows = pieces.select("id", "piece", F.posexplode(F.arrays_zip("w1", "w2")).alias("k", "w")).select("w.w1", "w.w2", "id", (F.col("piece") * LONGEST + F.col("k")).alias("place"))
    recurring = windows.groupBy("w1", "w2").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.min_by("place", "id").alias("place")).where("first < last")
    confirmed = stages.put(recurring.select(F.expr(f"place div {LONGEST}").alias("piece"), F.pmod("place", F.lit(LONGEST)).cast("int").alias("k")))
    shards = max(1, -(-confirmed.count() // SHARD))
    if shards * MOST_SALTS >= 1 << PLACES:
        raise ValueError(f"{shards} shards are more than rows can be dealt by: raise SHARD")
    bare = pieces.select(F.pmod(F.xxhash64("mark"), F.lit(shards)).cast("int").alias("shard"), "piece", "mark", "id", "t", "start", "body")
    salts = bare.groupBy("shard").agg(F.ceil(F.count("*") / STREAM).cast("int").alias("salts"))  # a row for each shard
    salts = F.broadcast(salts) if shards <= FEW else salts
    known = stages.put(bare.join(confirmed.groupBy("piece").agg(F.bit_or(F.expr("shiftleft(1, k)")).alias("places")), "piece"))
    # one number to deal and sort by: group (shard and salt), kind, low half of the mark
    low = F.col("mark").bitwiseAND(F.lit(_LOW_HALF))
    place = lambda salt, kind: F.shiftleft(F.col("shard").cast("long") * MOST_SALTS + salt, 33) + kind * (1 << 32) + low
    rest = ["id", "t", "start", "body"]
    salts = salts.select("shard", F.least("salts", F.lit(MOST_SALTS)).alias("salts"))
    streamed = bare.join(salts, "shard").select(place(F.pmod(F.xxhash64("id", "start"), F.col("salts")), F.lit(1)).alias("place"), *rest, F.lit(0).alias("places"))
    compiled = known.join(salts, "shard").select("mark", "shard", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), *rest, "places").select(place(F.col("salt"), F.lit(0)).alias("place"), *rest, "places")
    dealt = compiled.unionByName(streamed).repartition(n, F.shiftright("place", 33)).sortWithinPartitions("place")
    found = stages.put(dealt.mapInArrow(_locate, "id long, t long, start int, stop int"))
    for done in (confirmed, known, pieces):
        stages.drop(done)
    return found, copies


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", texts: bool = True) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256[, kept]) of every row; ``kept``: the words left, joined by one space."""
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("t"), F.xxhash64(F.lit(1), text_col).alias("t2"), F.col(text_col).alias("text"))
    found, copies = repeated_ranges(own, StageTables(docs.sparkSession))
    ranges = found.groupBy("id", "t").agg(F.collect_list(F.shiftleft(F.col("start").cast("long"), 32) + F.col("stop")).alias("ranges"), F.lit(False).alias("copy"))
    marked = ranges.unionByName(copies.select("id", "t", F.lit(None).cast("array<long>").alias("ranges"), F.lit(True).alias("copy")))
    schema = "id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * texts
    return own.select("id", "t", "text").join(marked, ["id", "t"], "left").select("id", "text", "ranges", "copy").mapInArrow(lambda it: _apply(it, texts), schema)
