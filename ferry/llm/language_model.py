"""Scores of texts under a hidden Markov language model trained on the corpus.

States emit the frequent words, an end, and a class of all rarer words; which rare word it is follows
from its count over the corpus, whatever the state. Baum-Welch runs over all training texts: every task
sums expected counts over its texts, Spark sums them over tasks, and the driver holds the model, whose size is
bounded. Word counts, frequent or rare, are of the whole corpus and are joined, not collected.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F
from xxhash import xxh64_intdigest

from ferry.llm.tables import id_remainder, with_results, written

STATES = 8
ITERATIONS = 4
#: Words that states emit one by one, at most: the most frequent ones.
VOCABULARY = 65_536
#: Texts are learned from in stretches of so many tokens, and scored whole.
STRETCH = 512
#: Tokens that one array operation handles, about.
AT_ONCE = 200_000
#: The end token, the class of rare words, and the first frequent word.
END, RARE, FIRST = 0, 1, 2
#: Weight of the corpus distribution in every state's emissions, in tokens, and of each transition.
EMISSION_PRIOR, TRANSITION_PRIOR = 200.0, 1.0
_CACHED_WORDS = 200_000
_COUNTED_AT_ONCE = 200_000
#: Buckets of a factor of two in the histogram of word counts.
_BUCKETS = 16


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


def _hashes(words) -> np.ndarray:
    return np.fromiter(map(xxh64_intdigest, words, repeat(0)), np.uint64).view(np.int64)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[bytes] = Counter()

    def flush() -> pa.RecordBatch:
        out = [pa.array(_hashes(counts)), pa.array(list(counts.values()), pa.int64())]
        counts.clear()
        return pa.RecordBatch.from_arrays(out, names=["word", "n"])

    for batch in batches:
        for text in batch.column(0).to_pylist():
            counts.update(words_of(text or b""))
            if len(counts) > _COUNTED_AT_ONCE:
                yield flush()
    yield flush()


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) from one binary column: how often each word occurs. Words go by their 64-bit hash."""
    return texts.mapInArrow(_counted, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Corpus:
    """Counts of the training texts. ``counts`` holds every word; the rest is bounded."""

    counts: DataFrame
    texts: int
    tokens: int
    distinct: int
    #: Hashes and counts of the frequent words, most frequent first.
    frequent: np.ndarray
    frequent_counts: np.ndarray
    rare_tokens: int
    rare_distinct: int


def survey(docs: DataFrame, texts: int, vocabulary: int = VOCABULARY) -> Corpus:
    """Count the words of the training texts, a single binary column."""
    counts = written(word_counts(docs), "counts")
    bucket = F.floor(F.log2("n") * _BUCKETS).cast("int")
    histogram = counts.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("distinct"), F.sum("n").alias("tokens")).collect()
    # Words that occur once stand for those that occur never: they are rare however few words there are.
    taken, least = 0, 1 << 30
    for r in sorted(histogram, key=lambda r: -r["bucket"]):
        if r["bucket"] == 0 or taken + r["distinct"] > vocabulary:
            break
        taken, least = taken + r["distinct"], r["bucket"]
    rows = sorted(counts.where(bucket >= least).collect(), key=lambda r: (-r["n"], r["word"])) if taken else []
    distinct, tokens = (sum(r[k] for r in histogram) for k in ("distinct", "tokens"))
    frequent = np.array([r["word"] for r in rows], np.int64)
    frequent_counts = np.array([r["n"] for r in rows], np.int64)
    return Corpus(
        counts, texts, tokens + texts, distinct + (texts > 0), frequent, frequent_counts,
        tokens - int(frequent_counts.sum()), distinct - len(rows),
    )


class Encoder:
    """Token numbers of texts; a word's number is remembered."""

    def __init__(self, frequent: np.ndarray, counts: np.ndarray, texts: int):
        self.numbers = {h: FIRST + i for i, h in enumerate(frequent.tolist())}
        self.logs = np.log10(np.concatenate(([texts, 0], counts)) + 1.0)
        self.known = np.concatenate(([texts > 0, False], np.ones(len(counts), bool)))
        self.words: dict[bytes, int] = {}

    def encode(self, text: bytes) -> tuple[np.ndarray, Counter[bytes]]:
        """Numbers, the end last, and the rare words with how often they occur."""
        words = words_of(text)
        if len(self.words) > _CACHED_WORDS:
            self.words = {}
        new = list(set(words).difference(self.words))
        if new:
            self.words.update((w, self.numbers.get(h, RARE)) for w, h in zip(new, _hashes(new).tolist()))
        ids = np.fromiter(map(self.words.__getitem__, words), np.int32, len(words))
        rare = Counter([words[i] for i in np.flatnonzero(ids == RARE).tolist()])
        return np.append(ids, np.int32(END)), rare


def _encoded(encoder: Encoder, batch: pa.RecordBatch) -> list[pa.Array]:
    ids, parts, known, words, times = [], [], [], [], []
    for text in batch.column(0).to_pylist():
        numbers, rare = encoder.encode(text or b"")
        ids.append(numbers)
        parts.append(float(encoder.logs[numbers].sum()))
        known.append(int(encoder.known[numbers].sum()))
        words.append(_hashes(rare))
        times.append(list(rare.values()))
    longs = pa.list_(pa.int64())
    return [pa.array(ids, pa.list_(pa.int32())), pa.array(parts), pa.array(known, pa.int64()), pa.array(words, longs), pa.array(times, longs)]


@dataclass
class Model:
    """Starts (K), moves (K x K) and emissions (tokens x K), as probabilities."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray


def initial(weights: np.ndarray, states: int = STATES, seed: int = 1) -> Model:
    """States that tend to stay, and that differ in words by chance."""
    noise = np.exp(np.random.default_rng(seed).normal(size=(len(weights), states)))
    emit = weights[:, None] * noise
    move = np.full((states, states), 0.1 / states) + 0.9 * np.eye(states)
    return Model(np.full(states, 1 / states), move, emit / emit.sum(axis=0))


class Packed:
    """Sequences side by side, longest first: the tokens of one step are neighbours."""

    def __init__(self, sequences: list[np.ndarray]):
        self.order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
        self.lengths = np.array([len(sequences[i]) for i in self.order])
        self.flat = np.concatenate([sequences[i] for i in self.order]) if sequences else np.zeros(0, np.int32)
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)[:-1])).astype(np.int64) if sequences else np.zeros(0, np.int64)

    def widths(self) -> np.ndarray:
        """How many sequences reach each step."""
        steps = np.arange(self.lengths[0] if len(self.lengths) else 0)
        return np.searchsorted(-self.lengths, -steps, "left")


def log_likelihoods(model: Model, sequences: list[np.ndarray]) -> np.ndarray:
    """log10 probabilities of whole sequences, by the forward recursion scaled at every step."""
    packed, out = Packed(sequences), np.zeros(len(sequences))
    belief, total = None, np.zeros(len(sequences))
    for step, n in enumerate(packed.widths()):
        likely = model.emit[packed.flat[packed.starts[:n] + step]]
        belief = (model.start if belief is None else belief[:n] @ model.move) * likely
        scale = belief.sum(axis=1)
        belief /= scale[:, None]
        total[:n] += np.log10(scale)
    out[packed.order] = total
    return out


@dataclass
class Expected:
    """Expected counts under a model."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray
    log_likelihood: float = 0.0

    @classmethod
    def none(cls, tokens: int, states: int) -> Expected:
        return cls(np.zeros(states), np.zeros((states, states)), np.zeros((states, tokens)))

    def add(self, model: Model, sequences: list[np.ndarray], begins: np.ndarray) -> None:
        """Forward and backward over the sequences; ``begins`` tells those that begin a text."""
        packed = Packed(sequences)
        widths = packed.widths()
        if not len(widths):
            return
        offsets = np.concatenate(([0], np.cumsum(widths)))
        tokens = np.concatenate([packed.flat[packed.starts[:n] + t] for t, n in enumerate(widths)])
        move, likely = model.move.astype(np.float32), model.emit[tokens].astype(np.float32)
        forward, scales = np.empty_like(likely), np.empty(len(tokens), np.float32)
        for t, n in enumerate(widths):
            here = slice(offsets[t], offsets[t] + n)
            prior = model.start.astype(np.float32) if t == 0 else forward[offsets[t - 1] : offsets[t - 1] + n] @ move
            belief = prior * likely[here]
            scales[here] = belief.sum(axis=1)
            forward[here] = belief / scales[here, None]
        backward = np.ones_like(forward)
        for t in range(len(widths) - 1, 0, -1):
            n = widths[t]
            here = slice(offsets[t], offsets[t] + n)
            ahead = likely[here] * backward[here] / scales[here, None]
            likely[here] = ahead
            backward[offsets[t - 1] : offsets[t - 1] + n] = ahead @ move.T
        before = np.concatenate([offsets[t - 1] + np.arange(n) for t, n in enumerate(widths) if t]) if len(widths) > 1 else np.zeros(0, int)
        self.move += (forward[before].T @ likely[offsets[1] :]).astype(float) * model.move
        forward *= backward
        first = np.asarray(begins)[packed.order]
        self.start += forward[: offsets[1]][first].sum(axis=0)
        for k in range(forward.shape[1]):
            self.emit[k] += np.bincount(tokens, forward[:, k], self.emit.shape[1])
        self.log_likelihood += float(np.log10(scales, dtype=np.float64).sum())


def _stretches(texts: Iterator[np.ndarray]) -> Iterator[tuple[list[np.ndarray], list[bool]]]:
    """Stretches of texts, gathered until there is work for one array operation."""
    sequences, begins, size = [], [], 0
    for ids in texts:
        for at in range(0, len(ids), STRETCH):
            sequences.append(ids[at : at + STRETCH])
            begins.append(at == 0)
            size += len(sequences[-1])
            if size >= AT_ONCE:
                yield sequences, begins
                sequences, begins, size = [], [], 0
    yield sequences, begins


def _lists(column: pa.Array) -> Iterator[np.ndarray]:
    values, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
        yield values[a:b]


#: Rows of expected counts that are not emissions: moves from state i are -1 - i.
_STARTS, _LOGS = -1_000_001, -1_000_002


def _expectations(load: Callable[[], Model], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    model = load()
    states = len(model.start)
    found = Expected.none(len(model.emit), states)
    for sequences, begins in _stretches(ids for b in batches for ids in _lists(b.column(0))):
        found.add(model, sequences, begins)
    seen = np.flatnonzero(found.emit.any(axis=0))
    logs = np.zeros(states)
    logs[0] = found.log_likelihood
    rows = np.concatenate([found.emit[:, seen].T, found.move, found.start[None], logs[None]])
    keys = np.concatenate([seen, -1 - np.arange(states), [_STARTS, _LOGS]])
    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), *map(pa.array, rows.T)], names=["token", *(f"k{i}" for i in range(states))])


def improve(encoded: DataFrame, model: Model, weights: np.ndarray) -> tuple[Model, float]:
    """One Baum-Welch iteration over one column of token numbers: the better model, and what the old one gave."""
    states = len(model.start)
    shared = encoded.sparkSession.sparkContext.broadcast((model.start, model.move, model.emit.astype(np.float32)))
    fields = ", ".join(f"k{i} double" for i in range(states))
    summed = encoded.mapInArrow(lambda it: _expectations(lambda: Model(*shared.value), it), f"token int, {fields}")
    table = summed.groupBy("token").agg(*(F.sum(f"k{i}").alias(f"k{i}") for i in range(states))).toArrow()
    shared.unpersist()
    keys = table.column("token").to_numpy()
    values = np.stack([table.column(f"k{i}").to_numpy() for i in range(states)], axis=1)
    emit = EMISSION_PRIOR * np.repeat(weights[:, None], states, axis=1)
    emit[keys[keys >= 0]] += values[keys >= 0]
    move, start = np.full((states, states), TRANSITION_PRIOR), np.full(states, TRANSITION_PRIOR)
    for key, row in zip(keys[keys < 0].tolist(), values[keys < 0]):
        if key == _STARTS:
            start += row
        elif key != _LOGS:
            move[-1 - key] += row
    logs = float(values[keys == _LOGS].sum())
    return Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0)), logs


def _scored(load: Callable[[], Model], batch: pa.RecordBatch) -> list[pa.Array]:
    model, texts, out = load(), list(_lists(batch.column(0))), np.zeros(batch.num_rows)
    order, at = sorted(range(len(texts)), key=lambda i: len(texts[i])), 0
    while at < len(order):
        # Texts of like length go together, as many as make up one array operation.
        end, size = at, 0
        while end < len(order) and (end == at or size < 8 * AT_ONCE):
            size += len(texts[order[end]])
            end += 1
        out[order[at:end]] = log_likelihoods(model, [texts[i] for i in order[at:end]])
        at = end
    return [pa.array(out)]


#: What a worker has made of a broadcast value, the last of each kind: tasks that follow go on with it.
_HELD: dict[str, tuple] = {}


def _held(kind: str, shared: Broadcast, make: Callable):
    if kind not in _HELD or _HELD[kind][0] is not shared:
        _HELD[kind] = (shared, make(shared.value))
    return _HELD[kind][1]


def report(
    docs: DataFrame, id: str = "doc_id", text: str = "text", states: int = STATES, iterations: int = ITERATIONS, vocabulary: int = VOCABULARY
) -> DataFrame:
    """Per document: id, held_out, n_tokens, n_known, train_tokens, base_score and score, in log10.

    Texts whose id has remainder 2 are held out; a null id counts as the empty text. A null text is its end
    alone. Repeated rows each are learned from and scored. If no text may be learned from, the counts are
    zero and the model is that of the priors; an empty table gives an empty result. The base score is the
    unigram's with one added to each count; the score is the model's.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id).alias("id"), (id_remainder(id, 7) == 2).alias("held_out"), F.col(text).cast("binary").alias("text"))
    learned = rows.where("NOT held_out")
    corpus = survey(learned.select("text"), learned.count(), vocabulary)
    shared = spark.sparkContext.broadcast((corpus.frequent, corpus.frequent_counts, corpus.texts))
    fields = "ids array<int>, part double, known bigint, words array<bigint>, times array<bigint>"
    kept = with_results(rows, {"text": F.col("text")}, lambda b: _encoded(_held("encoder", shared, lambda x: Encoder(*x)), b), fields)
    kept = kept.select(F.monotonically_increasing_id().alias("n"), "row.id", "row.held_out", "ids", "part", "known", "words", "times")
    encoded = written(kept, "encoded")

    weights = np.concatenate(([corpus.texts, corpus.rare_tokens], corpus.frequent_counts)) + 1.0
    weights /= weights.sum()
    model = initial(weights, states)
    for _ in range(iterations):
        model, _ = improve(encoded.where("NOT held_out").select("ids"), model, weights)

    # Rare words are joined with the corpus counts; those of the held-out texts may have none.
    each = encoded.select("n", F.explode(F.arrays_zip("words", "times")).alias("x")).select("n", F.col("x.words").alias("word"), F.col("x.times").alias("times"))
    counted = each.join(corpus.counts.withColumnRenamed("n", "count"), "word")
    rare = counted.groupBy("n").agg(F.sum(F.col("times") * F.log10(F.col("count") + F.lit(1))).alias("rare_part"), F.sum("times").alias("rare_known"))

    trained = spark.sparkContext.broadcast((model.start, model.move, model.emit.astype(np.float32)))
    load = lambda: _held("model", trained, lambda x: Model(*(y.astype(float) for y in x)))
    narrow = encoded.select("n", "id", "held_out", "part", "known", F.size("ids").cast("bigint").alias("n_tokens"), F.coalesce(F.aggregate("times", F.lit(0).cast("bigint"), lambda a, x: a + x), F.lit(0)).alias("n_rare"), "ids")
    scored = with_results(narrow, {"ids": F.col("ids")}, lambda b: _scored(load, b), "likelihood double").select(
        *(F.col("row")[c].alias(c) for c in narrow.columns if c != "ids"), "likelihood"
    )
    joined = scored.join(rare, "n", "left")
    rare_part, rare_known = F.coalesce("rare_part", F.lit(0.0)), F.coalesce("rare_known", F.lit(0))
    log = lambda x: F.lit(math.log10(x))
    return joined.select(
        F.col("id").alias(id),
        "held_out",
        "n_tokens",
        (F.col("known") + rare_known).alias("n_known"),
        F.lit(corpus.tokens).cast("bigint").alias("train_tokens"),
        (F.col("part") + rare_part - F.col("n_tokens") * log(corpus.tokens + corpus.distinct + 1)).alias("base_score"),
        (F.col("likelihood") + rare_part - F.col("n_rare") * log(corpus.rare_tokens + corpus.rare_distinct + 1)).alias("score"),
    )
