"""Best-fit packing of tokenized documents under several capacities.

A document is its token ids and an end id; only one longer than a sequence is
cut. Every piece demands tokens, one document and an attention cost (its length
squared), and a sequence has a capacity of each. Pieces, longest first, go to
the open sequence that can take them under every capacity and whose weighted
residual vector is then of the smallest norm. Whole-sequence pieces need no
search. The others are dealt to groups of about ``GROUP`` pieces, each packed
in one task: a group leaves at most a sequence or so unfilled, so the groups'
size bounds both memory and loss.

The tokenizer drops white space and never joins across it, so a text's ids are
its words' ids in a row; words are encoded once per worker and remembered (up to
``REMEMBERED``).

Defined results: a null or empty text is the end id alone; repeated rows are
packed each; a row without id is packed like any other; an empty table gives an
empty result; extra columns are not read.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import StageTables, partitions, ship
from .components import whole_groups

GROUP, REMEMBERED = 16_384, 500_000
_encoders: dict[str, "Encoder"] = {}


#: Letters that lower case maps one to one and normalisation leaves alone, and marks that make one token group.
_SIMPLE = re.compile(r"[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+")
_MARKS = ".,;:!?"


def _bytes(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for letters from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) if b in plain else chr(256 + rest.index(b)) for b in range(256)}


class Encoder(dict):
    """Ids of a text as little-endian unsigned 32-bit numbers; words seen are kept.

    Plain words go to the tokenizer's model as they are, lower-cased and without
    the marks behind them (which are a group of their own); any other word takes
    the tokenizer's whole way.
    """

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.letters = Tokenizer.from_file(path), _byte_letters()
        self.model = self.tokenizer.model
        self.old: dict[bytes, bytes] = {}
        self.stems: dict[str, bytes] = {}
        self.old_stems: dict[str, bytes] = {}
        at = json.loads(self.tokenizer.to_str())
        kinds = str(at["normalizer"]), str(at["pre_tokenizer"])
        # the short way holds for lower-casing, byte-level tokenizers whose model gets a word's letters as one piece
        self.short = "Lowercase" in kinds[0] and "ByteLevel" in kinds[1] and r"[\\p{L}]+" in kinds[1] and r"[^\\s\\p{L}\\p{N}]+" in kinds[1]

    def _stem(self, part: str) -> bytes:
        ids = self.stems.get(part) or self.old_stems.get(part)
        if ids is None:
            letters = part if part.isascii() else part.encode().decode("latin-1").translate(self.letters)
            ids = _bytes([t.id for t in self.model.tokenize(letters)])
        self.stems[part] = ids
        return ids

    def __missing__(self, word: bytes) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            text = word.decode()
            stem = text.rstrip(_MARKS) if self.short else ""
            if stem and stem.isalpha() and (stem.isascii() or _SIMPLE.fullmatch(stem)):
                ids = self._stem(stem.lower())
                if len(stem) < len(text):
                    ids += self._stem(text[len(stem) :])
            else:
                ids = _bytes(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids)
        self[word] = ids
        return ids

    @classmethod
    def at(cls, path: str) -> Encoder:
        """One for each worker process."""
        if path not in _encoders:
            _encoders[path] = cls(path)
        return _encoders[path]

    def __call__(self, text: bytes) -> bytes:
        if len(self) > REMEMBERED:
            # what is in use comes back from the old generation, the rest goes with it
            self.old, self.old_stems, self.stems = dict(self), self.stems, {}
            self.clear()
        return b"".join(map(self.__getitem__, text.split()))  # at ASCII white space only


def pieces(docs: DataFrame, tokenizer: str, length: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) of every row; ids as an array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end, step = Encoder.at(tokenizer), np.array([end_id], "<u4").tobytes(), 4 * length
        for b in batches:
            row, piece, size, crc, ids = [], [], [], [], []
            for i, t in enumerate(b.column(1).cast(pa.binary()).to_pylist()):
                data = encode(t or b"") + end
                for p, at in enumerate(range(0, len(data), step)):
                    part = data[at : at + step]
                    row.append(i)
                    piece.append(p)
                    size.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<u4").astype(np.int32))
            piece = pa.array(piece, pa.int32())
            columns = [b.column(0).take(pa.array(row, pa.int64())), piece, pa.array(np.asarray(piece, np.int64) * length), pa.array(size, pa.int64()), pa.array(crc, pa.int64())]
            columns += [pa.array(ids, pa.list_(pa.int32()))] if with_ids else []
            yield pa.RecordBatch.from_arrays(columns, ["id", "piece", "start", "length", "ids_crc32", "ids"][: len(columns)])

    ship(docs.sparkSession)
    schema = "id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def best_fit(demands: np.ndarray, capacity: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The bin of each row of ``demands`` (in the order given): the feasible one with the smallest weighted residual norm, else a new one."""
    scale = np.sqrt(weights) / capacity
    want, made, m = demands * scale, 0, 0
    least = want[:, 0].min(initial=np.inf)
    # a row for each capacity, so that a whole row is one pass
    left, number, bins = np.empty((len(capacity), 64)), np.empty(64, np.int64), np.empty(len(demands), np.int64)
    for k, w in enumerate(want):
        best = -1
        if m:
            after = left[:, :m] - w[:, None]
            norm = np.where(after.min(axis=0) >= -1e-12, (after * after).sum(axis=0), np.inf)
            best = int(norm.argmin())
            if norm[best] == np.inf:
                best = -1
        if best < 0:
            if m == left.shape[1]:
                left, number = np.concatenate([left, np.empty_like(left)], axis=1), np.concatenate([number, np.empty_like(number)])
            left[:, m], number[m], best = np.sqrt(weights), made, m
            made, m = made + 1, m + 1
        left[:, best] -= w
        bins[k] = number[best]
        if left[0, best] < least - 1e-12:  # full for good
            m -= 1
            left[:, best], number[best] = left[:, m], number[m]
    return bins


def pack(found: DataFrame, length: int = 2048, documents: int = 512, attention: float | None = None, weights: tuple[float, float, float] = (1.0, 0.01, 0.01)) -> DataFrame:
    """``pieces`` with sequence_id and offset. ``documents`` and ``attention`` (squared tokens; by default a full sequence's) bound a sequence beside its tokens."""
    spark, stages = found.sparkSession, StageTables(found.sparkSession)
    ship(spark)
    attention = float(length) ** 2 if attention is None else attention
    rows = stages.put(found.withColumn("uid", F.monotonically_increasing_id()))
    whole = rows.where(F.col("length") == length).withColumns({"sequence_id": F.col("uid"), "offset": F.lit(0).cast("long")})
    parts = rows.where(F.col("length") < length)
    n = max(1, -(-parts.count() // GROUP))
    capacity, w = np.array([length, documents, attention], float), np.array(weights, float)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, at in whole_groups(batches, ["group"]):
            for s, e in zip(at[:-1], at[1:], strict=True):
                g = t.slice(s, e - s)
                size, uid = g.column("length").to_numpy(), g.column("uid").to_numpy()
                order = np.lexsort((uid, -size))
                size = size[order].astype(float)
                bins = best_fit(np.stack([size, np.ones(len(size)), np.minimum(size**2, attention)], 1), capacity, w)
                by = np.argsort(bins, kind="stable")
                b, z, u = bins[by], size[by].astype(np.int64), uid[order][by]
                first = np.append(True, b[1:] != b[:-1])
                before = np.cumsum(z) - z
                start = np.maximum.accumulate(np.where(first, np.arange(len(b)), 0))
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(-1 - u[start]), pa.array(before - before[start])], ["uid", "sequence_id", "offset"])

    grouped = parts.select("uid", "length", F.pmod(F.xxhash64("uid"), F.lit(n)).alias("group")).repartition(max(n, partitions(spark)), "group").sortWithinPartitions("group")
    placed = stages.put(grouped.mapInArrow(run, "uid long, sequence_id long, offset long"))
    return whole.unionByName(parts.join(placed, "uid")).drop("uid")
