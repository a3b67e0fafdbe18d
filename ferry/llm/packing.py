"""Best-fit packing of token sequences: a configuration linear program over the length histogram.

The program has a variable for every way to fill a sequence (a pattern) and asks for few sequences
that hold all pieces. Multiplicative weights solve it: a knapsack by dynamic programming prices the
best pattern under the present weights, the pattern is used a little, and the weights of what it holds
fall. Fractional uses are rounded down to whole sequences; what is left over, and what is too short
for the program, goes by best fit into the gaps. All of this sees lengths and their counts, never
pieces: its size is bounded by the capacity, not by the data. Pieces find their places by their rank
among those of equal length.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left, insort
from dataclasses import dataclass, field
from string import punctuation
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ferry.llm.tables import CACHES, forget_others, with_results, written

CAPACITY = 4096
#: Appended to every document.
END_ID = 1
#: Lengths are rounded up to this many units of a sequence inside the linear program.
UNITS = 128
#: Pieces shorter than so many units are left to best fit.
SMALL = 4
#: Share of a pattern's limiting demand that one step of the multiplicative weights covers.
STEP = 0.2
#: Share of each pattern's fractional uses that is realised, round by round.
ROUNDING = (0.4, 0.5, 0.7, 1.0)
#: Bytes, about, of a worker's dictionaries of encoded words.
CACHED_BYTES = 140_000_000
#: Rows of one length that are ranked in one group, about.
RANKED_AT_ONCE = 100_000

_TRAILING = punctuation.encode()

# Fixed: byte-level vocabularies spell a byte as itself if it prints in Latin-1, else as the next character from 256 on.
_PRINTED = {*range(33, 127), *range(161, 173), *range(174, 256)}
_LETTERS = [chr(b) if b in _PRINTED else chr(256 + sum(x not in _PRINTED for x in range(b))) for b in range(256)]


class Encoder:
    """Token ids, as little-endian 32-bit bytes, of texts cut at ASCII white space.

    The tokenizer never joins what white space parts, so each stretch is encoded once and remembered.
    Punctuation after a letter or digit is a stretch of its own to the tokenizer as well. Texts that
    could hold a special token are encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.words: dict[bytes, bytes] = {}
        self.stems: dict[bytes, bytes] = {}
        self.held = 0
        self.raw = [struct.pack("<I", i) for i in range(self.tokenizer.get_vocab_size())]

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _stem(self, stem: bytes) -> bytes:
        """The normalizer only lower-cases composed letters, and the splitter leaves them whole: the model gets them at once."""
        if stem.isalpha():
            # ASCII letters, which are spelled as themselves.
            return b"".join([self.raw[t.id] for t in self.model.tokenize(stem.lower().decode())])
        text = stem.decode()
        lowered = "".join(map(str.lower, text))
        if not lowered.isalpha() or not is_normalized("NFC", text):
            return self._encode([text])[0]
        ids = [t.id for t in self.model.tokenize("".join(map(_LETTERS.__getitem__, lowered.encode())))]
        return struct.pack(f"<{len(ids)}I", *ids)

    @staticmethod
    def _parts(word: bytes) -> tuple[bytes, bytes]:
        stem = word.rstrip(_TRAILING)
        if stem.isascii():
            parted = stem[-1:].isalnum()
            word = word.lower()
        else:
            parted = stem.decode()[-1].isalpha()
        return (word[: len(stem)], word[len(stem) :]) if parted else (word, b"")

    def encode(self, text: bytes) -> bytes:
        if b"<|" in text:
            return self._encode([text.decode()])[0]
        words = text.split()
        new = {w: self._parts(w) for w in set(words).difference(self.words)}
        if new:
            stems = list({p for parts in new.values() for p in parts if p}.difference(self.stems))
            self.stems.update(zip(stems, map(self._stem, stems)))
            self.words.update((w, self.stems[a] + (self.stems[b] if b else b"")) for w, (a, b) in new.items())
            # Two entries of a dictionary, and as many short strings, beside what they hold.
            self.held += sum(240 + 2 * len(w) + 2 * len(self.words[w]) for w in new)
        ids = b"".join(map(self.words.__getitem__, words))
        if self.held > CACHED_BYTES:
            self.words, self.stems, self.held = {}, {}, 0
        return ids


_ENCODERS: dict[str, Encoder] = CACHES.setdefault("packing", {})


def _cut(path: str, capacity: int, with_ids: bool, batch: pa.RecordBatch) -> pa.RecordBatch:
    if path not in _ENCODERS:
        forget_others("packing")
        _ENCODERS[path] = Encoder(path)
    encoder, end = _ENCODERS[path], np.array([END_ID], "<u4").tobytes()
    step, counts, starts, lengths, crcs, kept = 4 * capacity, [0], [], [], [], []
    for text in batch.column(1):
        ids = encoder.encode(text.as_py() or b"") + end
        parts = [ids[at : at + step] for at in range(0, len(ids), step)]
        starts += range(0, len(parts) * capacity, capacity)
        lengths += [len(x) // 4 for x in parts]
        crcs += map(zlib.crc32, parts)
        kept += parts if with_ids else [None] * len(parts)
        counts.append(len(starts))
    each = [pa.array(x, kind) for x, kind in ((starts, pa.int64()), (lengths, pa.int64()), (kept, pa.binary()), (crcs, pa.int64()))]
    cut = pa.ListArray.from_arrays(pa.array(counts, pa.int32()), pa.StructArray.from_arrays(each, ["start", "length", "ids", "crc"]))
    return pa.RecordBatch.from_arrays([batch.column(0), cut], names=["id", "pieces"])


def pieces(
    docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, with_ids: bool = True
) -> DataFrame:
    """(id, piece, start, length, ids, ids_crc32): every document's ids and the end id, cut at the capacity.

    ``ids`` are little-endian 32-bit numbers, null unless they are asked for. A null text is empty, and has the end id alone.
    """
    rows = docs.select(F.col(id).alias("id"), F.col(text).cast("binary").alias("text"))
    fields = f"id {rows.schema['id'].dataType.simpleString()}, pieces array<struct<start: bigint, length: bigint, ids: binary, crc: bigint>>"
    cut = rows.mapInArrow(lambda it: (_cut(tokenizer, capacity, with_ids, batch) for batch in it), fields)
    each = cut.select("id", F.posexplode("pieces").alias("piece", "p"))
    return each.select("id", "piece", "p.start", "p.length", "p.ids", F.col("p.crc").alias("ids_crc32"))


@dataclass
class Group:
    """So many sequences that hold the same lengths: (length, how often), in order."""

    count: int
    holds: list[tuple[int, int]] = field(default_factory=list)


def _price(weights: np.ndarray, sizes: np.ndarray, units: int) -> np.ndarray:
    """How often each class is in the most valuable pattern: an unbounded knapsack."""
    best, choice = np.zeros(units + 1), np.full(units + 1, -1)
    for room in range(1, units + 1):
        best[room], choice[room] = best[room - 1], -1
        fitting = np.searchsorted(sizes, room, "right")
        if fitting:
            values = best[room - sizes[:fitting]] + weights[:fitting]
            top = int(values.argmax())
            if values[top] > best[room]:
                best[room], choice[room] = values[top], top
    uses, room = np.zeros(len(sizes), np.int64), units
    while room > 0:
        if choice[room] >= 0:
            uses[choice[room]] += 1
            room -= sizes[choice[room]]
        else:
            room -= 1
    return uses


def solve(sizes: np.ndarray, demand: np.ndarray, units: int = UNITS, step: float = STEP) -> list[tuple[np.ndarray, float]]:
    """Patterns and how often each is used, fractionally, so that every demand is met."""
    covered, used = np.zeros(len(sizes)), {}
    rate = max(1.0, np.log(max(2, len(sizes)))) / step
    while covered.min() < 1:
        weights = np.exp(-rate * (covered - covered.min())) / demand
        uses = _price(np.where(covered < 1 + step, weights, weights * 1e-3), sizes, units)
        share = step * (demand[uses > 0] / uses[uses > 0]).min()
        covered += share * uses / demand
        used[uses.tobytes()] = used.get(uses.tobytes(), 0.0) + share
    return [(np.frombuffer(k, np.int64), v / covered.min()) for k, v in used.items()]


class Gaps:
    """Groups by the room they have left."""

    def __init__(self):
        self.rooms: list[int] = []
        self.groups: dict[int, list[Group]] = {}

    def add(self, room: int, group: Group) -> None:
        if room not in self.groups:
            insort(self.rooms, room)
            self.groups[room] = []
        self.groups[room].append(group)

    def tightest(self, length: int) -> tuple[int, Group] | None:
        at = bisect_left(self.rooms, length)
        if at == len(self.rooms):
            return None
        room = self.rooms[at]
        group = self.groups[room].pop()
        if not self.groups[room]:
            del self.groups[room], self.rooms[at]
        return room, group

    def best_fit(self, length: int, n: int, capacity: int) -> None:
        """Each of ``n`` pieces goes where it leaves least room; many sequences are filled at a time."""
        while n:
            room, group = self.tightest(length) or (capacity, Group(n))
            each = min(n, room // length)
            filled = min(group.count, n // each)
            if filled < group.count and (group.holds or room < capacity):
                self.add(room, Group(group.count - filled, list(group.holds)))
            n -= filled * each
            self.add(room - each * length, Group(filled, [*group.holds, (length, each)]))


def plan(lengths: dict[int, int], capacity: int = CAPACITY) -> list[Group]:
    """Sequences, grouped by what they hold, for so many pieces of each length."""
    unit = max(1, capacity // UNITS)
    left = {k: n for k, n in lengths.items() if n}
    units = capacity // unit
    classes: dict[int, list[list[int]]] = {}
    for length in sorted(left):
        if length >= SMALL * unit and -(-length // unit) <= units:
            classes.setdefault(-(-length // unit), []).append([length, left[length]])
    gaps = Gaps()
    for rounding in ROUNDING:
        # Classes that were covered twice show only when patterns are realised, so what is left is solved again.
        sizes = np.array([s for s in sorted(classes) if any(n for _, n in classes[s])], np.int64)
        if not len(sizes):
            break
        demand = np.array([sum(n for _, n in classes[s]) for s in sizes.tolist()], float)
        for uses, often in sorted(solve(sizes, demand, units), key=lambda x: -x[1]):
            drawn = [(classes[sizes[j]], int(uses[j])) for j in np.flatnonzero(uses)[::-1]]
            _realise(gaps, drawn, int(often * rounding), capacity, left)
    for length in sorted(left, reverse=True):
        gaps.best_fit(length, left[length], capacity)
    return [g for room in gaps.rooms for g in gaps.groups[room] if g.count]


def _realise(gaps: Gaps, parts: list[tuple[list[list[int]], int]], often: int, capacity: int, left: dict[int, int]) -> None:
    """Whole sequences of one pattern, with exact lengths drawn from each class, longest first."""
    while often > 0:
        # As many alike as the current run of every class allows; a class drawn on several times draws on one run.
        drawn, alike = [], often
        for runs, times in parts:
            while runs and runs[-1][1] == 0:
                runs.pop()
            if not runs:
                return
            need, picks = times, []
            for run in reversed(runs):
                use = min(need, run[1])
                if use:
                    picks.append((run, use))
                    need -= use
                if not need:
                    break
            if need:
                return
            drawn += picks
        for run, use in drawn:
            alike = min(alike, run[1] // use)
        holds = [(run[0], use) for run, use in drawn]
        for run, use in drawn:
            run[1] -= use * alike
            left[run[0]] -= use * alike
        gaps.add(capacity - sum(a * b for a, b in holds), Group(alike, holds))
        often -= alike


def _places(groups: list[Group]) -> dict[str, np.ndarray]:
    """For every length its runs of ranks: where a run starts, its first sequence, offset, and pieces per sequence."""
    rows, taken, sequence = [], {}, 0
    for g in groups:
        offset = 0
        for length, each in g.holds:
            rows.append((length, taken.get(length, 0), sequence, offset, each))
            taken[length] = taken.get(length, 0) + each * g.count
            offset += length * each
        sequence += g.count
    rows.sort()
    return dict(zip(("length", "start", "sequence", "offset", "each"), np.array(rows, np.int64).reshape(-1, 5).T.copy()))


def _placed(places: dict[str, np.ndarray], batch: pa.RecordBatch) -> list[pa.Array]:
    length, rank = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns)
    keys = places["length"] << 48 | places["start"]
    at = np.searchsorted(keys, length << 48 | rank, "right") - 1
    nth = rank - places["start"][at]
    sequence = places["sequence"][at] + nth // places["each"][at]
    offset = places["offset"][at] + nth % places["each"][at] * length
    return [pa.array(sequence), pa.array(offset)]


def _ranked(cut: DataFrame, lengths: dict[int, int]) -> DataFrame:
    """Number the pieces of one length from 0, in many groups of it however frequent it is."""
    parts = max(64, -(-max(lengths.values(), default=0) // RANKED_AT_ONCE))
    keyed = cut.withColumn("part", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.lit(parts)))
    sizes = keyed.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    order = Window.partitionBy("length", "part").orderBy("id", "piece", "ids_crc32")
    numbered = keyed.withColumn("nth", F.row_number().over(order) - 1)
    return numbered.join(starts, ["length", "part"]).withColumn("rank", F.col("first") + F.col("nth")).drop("part", "first", "nth")


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces with their ``sequence_id`` and ``offset``. Pieces are read three times, so give a written table.

    ``cut`` has columns id, piece, length (1 to the capacity) and ids_crc32; others come back too.
    """
    lengths = {r[0]: r[1] for r in cut.groupBy("length").agg(F.count(F.lit(1))).collect()}
    places = cut.sparkSession.sparkContext.broadcast(_places(plan(lengths, capacity)))
    inputs = {"length": F.col("length"), "rank": F.col("rank")}
    placed = with_results(_ranked(cut, lengths), inputs, lambda b: _placed(places.value, b), "sequence_id bigint, offset bigint")
    return placed.select(*(F.col("row")[c].alias(c) for c in cut.columns), "sequence_id", "offset")


def packed(docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Every piece of every document and its place: id, piece, start, length, ids_crc32, sequence_id, offset.

    With ``with_ids`` the ids themselves come as well. Null and empty texts are one piece of the end id; a
    null id stays null; repeated rows are packed once each; an empty table gives an empty result; other
    columns are not read.
    """
    cut = pieces(docs, tokenizer, id, text, capacity, with_ids)
    done = pack(written(cut if with_ids else cut.drop("ids"), "pieces"), capacity)
    return done.withColumnRenamed("id", id)
