"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ferry.llm.tables import forget_others, id_remainder, with_results, written

#: Features are hashed to so many bits.
BITS = 20
#: Labelled rows that the classifier is fitted on, at most: a sample by hash of the id.
TRAINED_ROWS = 12_000
EPOCHS = 5
#: Learning rate, its smoothing, and the weights of the L1 and L2 penalties.
ALPHA, BETA, L1, L2 = 3.0, 1.0, 4.0, 1.0
THRESHOLD = 0.7
#: Distances between the words of a pair: 1 is a bigram, the others are skip-grams.
SKIPS = (1, 2, 3)
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)
_FOLD = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def features(text: str) -> np.ndarray:
    """The distinct hashed features of a text: its words, and pairs of words at the distances of ``SKIPS``."""
    words = text.lower().encode().translate(_FOLD).split()
    ids = np.fromiter(map(zlib.crc32, words), np.uint64, len(words)) + np.uint64(1)
    grams = [ids * _FACTORS[0]] + [ids[:-k] * _FACTORS[k] + (ids[k:] ^ np.uint64(k)) * _FACTORS[0] for k in SKIPS if len(ids) > k]
    hashed = np.concatenate(grams)
    return ((hashed ^ hashed >> np.uint64(29)) * _FACTORS[1] >> np.uint64(64 - BITS)).astype(np.int32)


class Ftrl:
    """Follow the regularised leader, a rate of its own for every coordinate; the last one is the constant."""

    def __init__(self):
        self.z, self.n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * L1 - z
        return np.where(np.abs(z) <= L1, 0.0, shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, at: np.ndarray, label: int) -> None:
        at = np.append(at, 1 << BITS)
        w = self.weights(at)
        slope = _squash(w.sum()) - label
        grown = np.sqrt(self.n[at] + slope * slope)
        self.z[at] += slope - (grown - np.sqrt(self.n[at])) / ALPHA * w
        self.n[at] += slope * slope


def _squash(x: float) -> float:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forget_others("toxicity")
    rows = []
    for batch in batches:
        # Views of what Arrow holds: a row's features are not copied.
        held, ends = batch.column(0).values.to_numpy(), batch.column(0).offsets.to_numpy()
        rows += zip((held[a:z] for a, z in zip(ends, ends[1:])), batch.column(1).to_pylist())
    model, order = Ftrl(), np.random.default_rng(7)
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            model.learn(*rows[i])
    all_weights = model.weights(np.arange((1 << BITS) + 1))
    at = np.flatnonzero(all_weights)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(all_weights[at], pa.float64())], names=["at", "weight"])


def _featured(batch: pa.RecordBatch) -> list[pa.Array]:
    forget_others("toxicity")
    return [pa.array([np.unique(features(t or "")) for t in batch.column(0).to_pylist()], pa.list_(pa.int32()))]


def learnable(id: str) -> Column:
    """Whether a row's label may be learned from; the other third is held out."""
    return id_remainder(id, 3) != 1


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic", most: int = TRAINED_ROWS) -> list[tuple[int, float]]:
    """The weights that are not zero, as (coordinate, weight), fitted on at most ``most`` labelled rows.

    The sample is taken by hash of the id, so it is the same at every run, and is what bounds the broadcast
    of the labels, the one task that learns, and the weights. Null ids and labels are not learned from;
    an id that is labelled twice counts as toxic if one label says so.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(id).isNotNull() & learnable(id))
    known = known.groupBy(F.col(id).alias("id")).agg(F.max(F.col(label).cast("int")).alias("label"))
    place = F.pmod(F.xxhash64("id"), F.lit(1 << 20))
    share = min(1.0, 2 * most / max(1, known.count()))
    sample = known.where(place < share * (1 << 20)).orderBy(F.xxhash64("id"), "id").limit(most)
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text")).join(F.broadcast(sample), "id")
    rows = rows.dropDuplicates(["id"])
    ready = with_results(rows.select("id", "label", "text"), {"text": F.col("text")}, _featured, "features array<int>")
    ready = written(ready.select("features", F.col("row.label").alias("label"), F.col("row.id").alias("id")), "features")
    one = ready.coalesce(1).sortWithinPartitions(F.xxhash64("id"), "id").select("features", "label")
    return [tuple(r) for r in one.mapInArrow(_learned, "at int, weight double").collect()]


def _scored(weights: dict[str, np.ndarray], batch: pa.RecordBatch) -> list[pa.Array]:
    forget_others("toxicity")
    dense, scores = weights["dense"], []
    for text in batch.column(0).to_pylist():
        at = features(text or "")
        at = np.unique(at[dense[at] != 0])
        scores.append(_squash(dense[at].sum() + dense[-1]))
    return [pa.array(scores, pa.float64())]


def score(docs: DataFrame, weights: list[tuple[int, float]], text: str = "text") -> DataFrame:
    """(row, score) for every document: the probability that it is toxic; ``row`` is the document as it was.

    Null and empty texts have no features and get the constant's probability. Whole texts are scored.
    """
    shared, made = docs.sparkSession.sparkContext.broadcast(weights), {}

    def scored(batch: pa.RecordBatch) -> list[pa.Array]:
        if not made:
            made["dense"] = np.zeros((1 << BITS) + 1)
            for at, weight in shared.value:
                made["dense"][at] = weight
        return _scored(made, batch)

    return with_results(docs, {"text": F.col(text)}, scored, "score double")


def report(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document's score: id, whether its label was held out, score, and the decision.

    Repeated rows each come back; a null id counts as the empty text in the split; without labels every
    score is one half; empty tables give an empty result.
    """
    scored = score(docs, fit(docs, labels, id, text), text)
    held_out = ~learnable("id")
    got = scored.select(F.col("row")[id].alias("id"), "score")
    return got.select(F.col("id").alias(id), held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that are not predicted toxic, with all their columns."""
    return score(docs, fit(docs, labels, id, text), text).where(F.col("score") < THRESHOLD).select("row.*")
