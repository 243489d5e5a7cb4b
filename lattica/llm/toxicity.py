"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts stand against unlabelled text, of which a known share (the
class prior) is toxic too. The risk of calling unlabelled text clean is
corrected by that share of the toxic texts' own risk, and where the corrected
part turns negative (the model has begun to learn the toxic texts by heart) its
gradient is followed backwards instead. The model is linear over words and word
beginnings: those which toxic texts hold far more often than chance allows.

Fitting is bounded: ``POSITIVE`` toxic and ``UNLABELLED`` other texts, whole,
chosen by seeded hash from all rows, as hashed features. Scoring is one pass in
which a word's features are looked up once per worker.

Defined results: a null text counts as empty and scores like one without any
known word; repeated rows are scored each; without a confirmed toxic row every
score is the prior; an empty table gives an empty result; extra columns are not
read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship
from .labelled import sample_ids, texts_of

POSITIVE, UNLABELLED = 4_000, 8_000
#: Hashed features, beginnings of words that count, the least excess (in standard deviations) and the most features kept.
SPACE, BEGINNINGS, EXCESS, KEPT = 1 << 20, (3, 4, 5), 5.5, 4_096
EPOCHS, BATCHES, RATE, RIDGE = 80, 8, 0.05, 1e-4
REMEMBERED = 400_000
_EDGES = ".,;:!?\"'()[]{}|*$%&#<>-_"


def word_features(word: str) -> tuple[int, ...]:
    word = word.lower().strip(_EDGES)
    if not word:
        return ()
    return tuple(zlib.crc32(x.encode()) % SPACE for x in ("=" + word, *("^" + word[:k] for k in BEGINNINGS if len(word) > k)))


def words(text: bytes) -> set[bytes]:
    """A text's words, for fitting and scoring alike: cut at ASCII white space only."""
    return set(text.split())


def text_features(text: bytes) -> np.ndarray:
    return np.unique(np.fromiter((f for w in words(text) for f in word_features(w.decode())), np.int32))


def _flat(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate([*rows, np.empty(0, np.int64)]).astype(np.int64), np.repeat(np.arange(len(rows)), [len(r) for r in rows])


def select(positive: list[np.ndarray], unlabelled: list[np.ndarray]) -> np.ndarray:
    """Features in which toxic texts exceed unlabelled ones by EXCESS standard deviations, the most telling ones first."""
    p, u = (np.bincount(_flat(x)[0], minlength=SPACE) for x in (positive, unlabelled))
    share, rest = p / len(positive), np.maximum(u, 1) / max(1, len(unlabelled))
    excess = (share - rest) / np.sqrt(rest * np.maximum(1 - rest, 1e-9) / len(positive))
    excess[p < 3] = 0
    best = np.argsort(-excess, kind="stable")[:KEPT]
    return best[excess[best] >= EXCESS]


def fit_nonnegative(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, size: int, seed: int = 3) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative risk under the logistic loss."""
    rng, w, b = np.random.default_rng(seed), np.zeros(size), float(np.log(prior / (1 - prior)))
    first, second, t = np.zeros(size + 1), np.zeros(size + 1), 0
    sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -30, 30)))
    n = max(1, min(BATCHES, len(positive), len(unlabelled)))
    for _ in range(EPOCHS):
        for some_p, some_u in zip(np.array_split(rng.permutation(len(positive)), n), np.array_split(rng.permutation(len(unlabelled)), n), strict=True):
            (fp, rp), (fu, ru) = _flat([positive[i] for i in some_p]), _flat([unlabelled[i] for i in some_u])
            sp, su = np.bincount(rp, w[fp], len(some_p)) + b, np.bincount(ru, w[fu], len(some_u)) + b
            as_clean = np.logaddexp(0, su).mean() - prior * np.logaddexp(0, sp).mean()
            up_p, up_u = prior * sigmoid(sp) / len(sp), sigmoid(su) / len(su)
            gp, gu = (-prior * sigmoid(-sp) / len(sp) - up_p, up_u) if as_clean >= 0 else (up_p, -up_u)
            g = np.append(np.bincount(fp, gp[rp], size) + np.bincount(fu, gu[ru], size) + RIDGE * w, gp.sum() + gu.sum())
            t += 1
            first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
            step = RATE * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
            w, b = w - step[:-1], b - step[-1]
    return w, float(b)


@dataclass(frozen=True)
class Model:
    weights: dict[int, float]
    bias: float

    def score(self, docs: DataFrame, threshold: float = 0.3) -> DataFrame:
        """``docs`` (id, text) as (id, score, predicted, n_features)."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            weights, known = self.weights, {}

            def of(word: bytes) -> tuple[int, ...]:
                found = known[word] = tuple(f for f in word_features(word.decode()) if f in weights)
                return found

            for b in batches:
                total, n = [], []
                for t in b.column(1).cast(pa.binary()).to_pylist():
                    if len(known) > REMEMBERED:
                        known.clear()
                    hit = {f for w in words(t or b"") for f in (known[w] if w in known else of(w))}
                    total.append(self.bias + sum(weights[f] for f in sorted(hit)))
                    n.append(len(hit))
                score = 1 / (1 + np.exp(-np.clip(np.array(total, float), -30, 30)))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score), pa.array((score >= threshold).astype(np.int32)), pa.array(n, pa.int32())], ["id", "score", "predicted", "n_features"])

        ship(docs.sparkSession)
        return docs.select("id", "text").mapInArrow(run, "id long, score double, predicted int, n_features int")


def fit(docs: DataFrame, labels: DataFrame, train: Column, prior: float | None = None, seed: int = 5) -> Model:
    """``docs``: (id, text); ``labels``: (id, label 0 or 1). ``train`` tells from the column id which rows may be learnt from. ``prior``: the share of toxic text, by default that of the labelled rows."""
    ship(docs.sparkSession)
    labels = labels.where("label is not null").where(train)
    toxic = labels.where("label = 1").select("id").distinct()
    if prior is None:
        seen = labels.agg(F.count("*").alias("n"), F.count_if(F.col("label") == 1).alias("toxic")).first()
        prior = (seen["toxic"] + 0.5) / (seen["n"] + 1)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([text_features(t or b"") for t in b.column(1).cast(pa.binary()).to_pylist()], pa.list_(pa.int32()))], ["f"])

    def collect(ids: DataFrame) -> list[np.ndarray]:
        rows = texts_of(docs, ids).mapInArrow(features, "f array<int>").toArrow().column("f")
        # copies would count as so many confirmations
        return list({r.tobytes(): r for r in (np.array(x, np.int32) for x in rows.to_pylist())}.values())

    positive = collect(sample_ids(toxic, POSITIVE, seed))
    unlabelled = collect(sample_ids(docs.where(train).select("id"), UNLABELLED, seed + 1))
    kept = select(positive, unlabelled) if positive and unlabelled else np.empty(0, np.int64)
    if not len(kept):
        return Model({}, float(np.log(prior / (1 - prior))))
    place = np.full(SPACE, -1)
    place[kept] = np.arange(len(kept))
    near = lambda rows: [(x := place[r])[x >= 0] for r in rows]
    w, b = fit_nonnegative(near(positive), near(unlabelled), prior, len(kept))
    return Model(dict(zip(kept.tolist(), w.tolist(), strict=True)), b)
