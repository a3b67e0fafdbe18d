"""Alignment of two tokenizers over a corpus, with counts of aligned pairs under a minimal perfect hash.

Both tokenizers cut the same bytes. Where their cuts meet, a group ends; a pair of ids is linked in a document
if tokens of theirs share a group. The first pass aligns documents and gathers distinct pairs with the documents of
each task that hold them. Over the distinct pairs a minimal perfect hash is built, block by block: levels of bits in
which every pair that falls alone is marked, so that a pair's number is the rank of its mark. Counts are dense vectors
indexed by that number, summed block by block up a tree of tasks. The second pass aligns the documents again and looks the
counts up; the pair kept under a number is compared with the one asked for.

Texts are encoded once; both passes align what was written of their ids.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ferry.llm.tables import written

#: Pairs of one block of the hash, about.
BLOCK_PAIRS = 50_000
#: Pairs are dealt to so many buckets, of which a block takes its share.
BUCKETS = 1 << 16
#: Pairs whose numbers and counts are broadcast at once; more are looked up in several turns.
PAIRS_AT_ONCE = 4_000_000
#: Partial vectors that one task adds up.
FAN_IN = 32
#: Bits of a level for each pair that is left.
SPARSE = 2
#: Pairs of documents that a task gathers before it adds them up and passes them on.
GATHERED = 4_000_000
#: Links whose counts are looked up at once.
LOOKED_UP = 200_000
#: A group of more links than this is spelled by its distinct ids.
LARGE_GROUP = 4096


def _letters() -> dict[str, int]:
    """Byte-level vocabularies spell a byte as itself if it prints in Latin-1, else as the next character from 256 on."""
    printed = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = [b for b in range(256) if b not in printed]
    return {**{chr(b): b for b in printed}, **{chr(256 + i): b for i, b in enumerate(other)}}


# Fixed: how the byte-level vocabulary parts a text before it joins bytes.
_PARTED = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_BLANK = re.compile(r"\s{20000}")


class Aligned:
    """A text's tokens, as ids, and the groups that they share."""

    def __init__(self, a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray):
        self.a, self.b = a, b
        cuts = ends_a[ends_b[np.searchsorted(ends_b, ends_a)] == ends_a]
        self.n_groups = len(cuts)
        self.of_a, self.of_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)

    def links(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Linked pairs, ``a * width + b``, and how often each is meant; pairs may come several times.

        Groups are a few tokens, all of whose pairs are spelled. Where cuts do not meet for long, ids repeat:
        there each pair of ids comes once, times their numbers.
        """
        many_a, many_b = (np.bincount(x, minlength=self.n_groups) for x in (self.of_a, self.of_b))
        large = many_a * many_b > LARGE_GROUP
        times = np.where(large, 0, many_b)[self.of_a]
        total = int(times.sum())
        first = np.repeat((np.cumsum(many_b) - many_b)[self.of_a] - (np.cumsum(times) - times), times)
        pairs = [np.repeat(self.a, times) * width + self.b[np.arange(total) + first]]
        often = [np.ones(total, np.int64)]
        for g in np.flatnonzero(large).tolist():
            (x, n), (y, m) = (np.unique(ids[of == g], return_counts=True) for ids, of in ((self.a, self.of_a), (self.b, self.of_b)))
            pairs.append((x[:, None] * width + y).ravel())
            often.append((n[:, None] * m).ravel())
        return np.concatenate(pairs), np.concatenate(often)

    def spelled(self) -> bytes:
        """``a1,a2|b1;a3|b2,b3``: the groups in order, ids of both vocabularies in decimal."""
        group = np.concatenate([self.of_a, self.of_b])
        side = np.repeat([0, 1], [len(self.a), len(self.b)])
        order = np.lexsort((side, group))
        same = np.append(group[order][1:] == group[order][:-1], False)
        turns = np.append(side[order][1:] != side[order][:-1], False)
        signs = np.where(~same, 2, np.where(turns, 1, 0))
        ids = np.concatenate([self.a, self.b])[order]
        known = _spellings(int(ids.max()))
        return b"".join(map(known.__getitem__, (ids * 3 + signs).tolist()))[:-1]


_SPELLED: list[bytes] = []


def _spellings(most: int) -> list[bytes]:
    """Every id up to the largest, followed by a comma, a bar and a semicolon."""
    for i in range(len(_SPELLED) // 3, most + 1):
        _SPELLED.extend(b"%d%c" % (i, c) for c in b",|;")
    return _SPELLED


class Aligner:
    """Aligns texts under a byte-level vocabulary (A) and a piece vocabulary (B), which puts a space in front."""

    def __init__(self, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor
        from tiktoken import Encoding
        from tokenizers import Tokenizer

        letters, tokenizer = _letters(), Tokenizer.from_file(path_a)
        vocabulary = tokenizer.get_vocab(with_added_tokens=False)
        # Ids are given in the order of merges. Special tokens are left out, so that their strings are plain text.
        special = {i for i, t in tokenizer.get_added_tokens_decoder().items() if t.special}
        ranks = {bytes(map(letters.__getitem__, t)): i for t, i in vocabulary.items() if i not in special}
        self.tokenizer, tokenizer.encode_special_tokens = tokenizer, True
        self.a = Encoding("a", pat_str=_PARTED, mergeable_ranks=ranks, special_tokens={})
        self.b = SentencePieceProcessor(model_file=path_b)
        self.bytes_a = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.bytes_a[i] = token
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.lengths = tuple(np.array([len(x) for x in table]) for table in (self.bytes_a, self.bytes_b))
        self.kinds = tuple("<u2" if len(x) <= 1 << 16 else "<u4" for x in self.lengths)
        self.width = len(pieces)

    def ids(self, text: str | None) -> tuple[bytes, bytes] | None:
        """A text's ids on either side, as little-endian numbers; nothing if it is empty or a vocabulary does not spell it."""
        if not text:
            return None
        whole = " " + text
        # The faster encoder gives up on white space without end.
        slow = len(text) > 20_000 and _BLANK.search(text)
        a = self.tokenizer.encode(whole, add_special_tokens=False).ids if slow else self.a.encode_ordinary(whole)
        b, raw = self.b.encode(text), whole.encode()
        if b"".join(map(self.bytes_a.__getitem__, a)) != raw or b"".join(map(self.bytes_b.__getitem__, b)) != raw:
            return None
        return tuple(np.array(x, kind).tobytes() for x, kind in zip((a, b), self.kinds))

    def align(self, a: bytes | None, b: bytes | None) -> Aligned | None:
        if not a or not b:
            return None
        ids = [np.frombuffer(x, kind).astype(np.int64) for x, kind in zip((a, b), self.kinds)]
        return Aligned(*ids, *(np.cumsum(n[x]) for n, x in zip(self.lengths, ids)))


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(paths: tuple[str, str]) -> Aligner:
    """A worker's aligner, kept from task to task."""
    if paths not in _ALIGNERS:
        _ALIGNERS.clear()
        _ALIGNERS[paths] = Aligner(*paths)
    return _ALIGNERS[paths]


# Mixes of 64 bits, fixed; a level of the hash turns the pair by its own odd number.
_MIX_1, _MIX_2, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), 0x9E3779B97F4A7C15


def _mixed(pairs: np.ndarray, level: int) -> np.ndarray:
    x = pairs.astype(np.uint64) + np.uint64((level + 1) * _STEP & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * _MIX_1
    x = (x ^ (x >> np.uint64(27))) * _MIX_2
    return x ^ (x >> np.uint64(31))


def _bucket(pairs: np.ndarray) -> np.ndarray:
    """By what a pair is dealt to a block."""
    return (_mixed(pairs, -1) % np.uint64(BUCKETS)).astype(np.int64)


def _gathered(waiting: list[np.ndarray]) -> pa.RecordBatch:
    pairs, docs = np.unique(np.concatenate(waiting), return_counts=True)
    columns = [_bucket(pairs), pairs, docs.astype(np.int64)]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["bucket", "pair", "docs"])


def _encoded(paths: tuple[str, str]) -> Callable:
    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = aligner(paths)
        for batch in it:
            found = [of.ids(text.as_py()) or (None, None) for text in batch.column(1)]
            sides = [pa.array([x[i] for x in found], pa.binary()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *sides], names=["id", "a", "b"])

    return batches


def _first_pass(paths: tuple[str, str]) -> Callable:
    """Distinct pairs of the documents of a task, with how many of them hold each."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, waiting, held = aligner(paths), [], 0
        for batch in it:
            for a, b in zip(batch.column(0), batch.column(1)):
                one = of.align(a.as_py(), b.as_py())
                if one is None:
                    continue
                waiting.append(np.unique(one.links(of.width)[0]))
                held += len(waiting[-1])
                if held > GATHERED:
                    yield _gathered(waiting)
                    waiting, held = [], 0
        if held:
            yield _gathered(waiting)

    return batches


def built(pairs: np.ndarray) -> list[np.ndarray]:
    """Levels of bits of a minimal perfect hash of distinct pairs: a pair is marked on the first where it falls alone."""
    levels = []
    while len(pairs):
        size = SPARSE * len(pairs) + 63 & ~63
        at = (_mixed(pairs, len(levels)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        levels.append(alone)
        pairs = pairs[~alone[at]]
    return levels


class Hash:
    """Numbers of pairs under the levels of one block, from zero without gaps; -1 for what falls on no mark."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels, first = [], 0
        for marks in levels:
            self.levels.append((marks, np.cumsum(marks, dtype=np.int32) + np.int32(first - 1)))
            first += int(marks.sum())

    def numbers(self, pairs: np.ndarray) -> np.ndarray:
        out, left = np.full(len(pairs), -1, np.int64), np.arange(len(pairs))
        for level, (marks, ranks) in enumerate(self.levels):
            at = (_mixed(pairs[left], level) % np.uint64(len(marks))).astype(np.int64)
            here = marks[at]
            out[left[here]] = ranks[at[here]]
            left = left[~here]
        return out


def _packed(levels: list[np.ndarray]) -> tuple[bytes, list[int]]:
    return b"".join(np.packbits(x).tobytes() for x in levels), [len(x) for x in levels]


def _unpacked(bits: bytes, sizes: list[int]) -> list[np.ndarray]:
    ends = np.cumsum([0, *sizes]) // 8
    return [np.unpackbits(np.frombuffer(bits[a:b], np.uint8)).astype(bool) for a, b in zip(ends, ends[1:])]


def _hashed(block: pd.DataFrame) -> pd.DataFrame:
    """A block's hash, and its pairs in the order of their numbers."""
    pairs = block["pair"].to_numpy(np.int64)
    levels = built(pairs)
    order = np.empty_like(pairs)
    order[Hash(levels).numbers(pairs)] = pairs
    bits, sizes = _packed(levels)
    return pd.DataFrame({"block": [int(block["block"].iloc[0])], "n": [len(pairs)], "bits": [bits], "sizes": [sizes], "pairs": [order.tobytes()]})


def _added(vectors: pd.DataFrame) -> pd.DataFrame:
    out = np.frombuffer(vectors["counts"].iloc[0], np.int64).copy()
    for more in vectors["counts"].iloc[1:]:
        out += np.frombuffer(more, np.int64)
    return pd.DataFrame({"block": [int(vectors["block"].iloc[0])], "part": [int(vectors["part"].iloc[0])], "counts": [out.tobytes()]})


_VECTOR = "block long, part long, counts binary"


def _dense(hashes: dict[int, tuple[int, bytes, list[int], bytes]]) -> Callable:
    """Dense vectors of the counts in a task, for the blocks that it holds pairs of."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors: dict[int, np.ndarray] = {}
        known: dict[int, tuple[Hash, np.ndarray]] = {}
        for batch in it:
            block, pairs, docs = (batch.column(i).to_numpy() for i in range(3))
            for b in np.unique(block).tolist():
                if b not in known:
                    n, bits, sizes, order = hashes[b]
                    known[b] = Hash(_unpacked(bits, sizes)), np.frombuffer(order, np.int64)
                    vectors[b] = np.zeros(n, np.int64)
                of, order = known[b]
                mine = block == b
                at = of.numbers(pairs[mine])
                if not np.array_equal(order[at], pairs[mine]):
                    raise ValueError("a pair is not the one kept under its number")
                np.add.at(vectors[b], at, docs[mine])
        part = TaskContext.get().partitionId()
        for b, counts in vectors.items():
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int64()), pa.array([part], pa.int64()), pa.array([counts.tobytes()], pa.binary())], names=["block", "part", "counts"])

    return batches


def counted(pairs: DataFrame, label: str = "pairs") -> tuple[DataFrame, int]:
    """(block, n, bits, sizes, pairs, counts) of ``pairs`` (bucket, pair, docs): hash and summed vector of every block; the number of blocks.

    Blocks are dealt by a hash of the pair, so none outgrows the others. Each task of ``pairs`` turns what it holds
    into dense vectors, for as many blocks at a time as ``PAIRS_AT_ONCE`` pairs make; ``FAN_IN`` vectors of a block are added
    in one task, then ``FAN_IN`` of those sums, until one is left.
    """
    spark = pairs.sparkSession
    distinct = written(pairs.select("bucket", "pair").distinct(), label)
    blocks = min(BUCKETS, max(1, -(-distinct.count() // BLOCK_PAIRS)))
    block = F.floor(F.col("bucket") * blocks / BUCKETS).cast("long").alias("block")
    dealt = distinct.select("pair", block)
    shape = "block long, n long, bits binary, sizes array<long>, pairs binary"
    hashes = written(dealt.groupBy("block").applyInPandas(_hashed, shape), label)
    vectors = None
    for turn in _turns(blocks):
        here = {r["block"]: (r["n"], r["bits"], r["sizes"], r["pairs"]) for r in hashes.where(F.col("block").between(*turn)).collect()}
        sent = spark.sparkContext.broadcast(here)
        mine = pairs.select(block, "pair", "docs").where(F.col("block").between(*turn))
        made = written(mine.mapInArrow(lambda it, sent=sent: _dense(sent.value)(it), _VECTOR), label)
        sent.unpersist()
        vectors = made if vectors is None else vectors.union(made)
    most = vectors.agg(F.max("part")).first()[0]
    while most is not None:
        up = vectors.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("long"))
        vectors = written(up.groupBy("block", "part").applyInPandas(_added, _VECTOR), label)
        most = most // FAN_IN or None
    return written(hashes.join(vectors.drop("part"), "block"), label), blocks


def _turns(blocks: int) -> list[tuple[int, int]]:
    """First and last of the blocks that are held at once."""
    at_once = max(1, PAIRS_AT_ONCE // BLOCK_PAIRS)
    return [(i, min(blocks, i + at_once) - 1) for i in range(0, blocks, at_once)]


def _pair_counts(vectors: pd.DataFrame) -> pd.DataFrame:
    pairs, counts = (np.frombuffer(b"".join(vectors[c]), np.int64) for c in ("pairs", "counts"))
    return pd.DataFrame({"pair": pairs, "docs": counts})


def _best(counts: DataFrame, width: int) -> np.ndarray:
    """The highest count of each id of A, by id: bounded by the vocabulary."""

    def most(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in it:
            each = _pair_counts(block)
            yield each.assign(a=each["pair"] // width).groupby("a", as_index=False)["docs"].max()

    rows = counts.select("pairs", "counts").mapInPandas(most, "a long, docs long").groupBy("a").agg(F.max("docs").alias("docs")).toPandas()
    best = np.zeros(int(rows["a"].max()) + 1 if len(rows) else 0, np.int64)
    best[rows["a"].to_numpy(np.int64)] = rows["docs"].to_numpy(np.int64)
    return best


class Counts:
    """Counts of pairs, and whether they are the highest of their id of A, for the blocks at hand."""

    def __init__(self, name: str, blocks: int, held: dict[int, tuple], best: np.ndarray, width: int):
        self.name, self.blocks, self.best, self.width = name, blocks, best, width
        self.of = {b: (Hash(_unpacked(bits, sizes)), np.frombuffer(pairs, np.int64), np.frombuffer(counts, np.int64)) for b, (bits, sizes, pairs, counts) in held.items()}

    def look_up(self, pairs: np.ndarray) -> np.ndarray:
        """The count of each pair, after the pair kept under its number was compared; 0 for what other blocks hold."""
        out, block = np.zeros(len(pairs), np.int64), _bucket(pairs) * self.blocks // BUCKETS
        for b in np.unique(block).tolist():
            if b in self.of:
                of, order, counts = self.of[b]
                mine = np.flatnonzero(block == b)
                at = of.numbers(pairs[mine])
                if not np.array_equal(order[at], pairs[mine]):
                    raise ValueError("a pair of the second pass was not counted in the first")
                out[mine] = counts[at]
        return out

    def sums(self, links: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, int, int]]:
        """(links, links whose count is their id's highest, counts of all links) for each text's links."""
        pairs, often = (np.concatenate([x[i] for x in links]) for i in (0, 1))
        counts = self.look_up(pairs)
        # A pair that other blocks hold has the count 0 here, and no id's highest is 0.
        columns = (often, often * (counts == self.best[pairs // self.width]), often * counts)
        ends = np.cumsum([len(x[0]) for x in links])
        totals = [np.concatenate([[0], np.cumsum(c)]) for c in columns]
        return [tuple(int(t[to] - t[to - len(x[0])]) for t in totals) for x, to in zip(links, ends)]


_COUNTS: dict[str, Counts] = {}
_NO_LINKS = np.empty(0, np.int64), np.empty(0, np.int64)

_RESULT = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, groups string"
_NAMES = [x.split()[0] for x in _RESULT.split(", ")]


def _second_pass(paths: tuple[str, str], name: str, blocks: int, sent, with_groups: bool) -> Callable:
    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = aligner(paths)
        if name not in _COUNTS:
            _COUNTS.clear()
            _COUNTS[name] = Counts(name, blocks, *sent.value, of.width)
        counts = _COUNTS[name]
        for batch in it:
            out, sums, links, waiting = [], [], [], 0
            for a, b in zip(batch.column(1), batch.column(2)):
                one = of.align(a.as_py(), b.as_py())
                if one is None:
                    out.append([0, 0, 0, "", None])
                    links.append(_NO_LINKS)
                    continue
                spelled = one.spelled()
                out.append([len(one.a), len(one.b), one.n_groups, hashlib.sha256(spelled).hexdigest(), spelled.decode() if with_groups else None])
                links.append(one.links(of.width))
                waiting += len(links[-1][0])
                if waiting > LOOKED_UP:
                    sums += counts.sums(links)
                    links, waiting = [], 0
            sums += counts.sums(links) if links else []
            rows = [(*x[:3], *y, *x[3:]) for x, y in zip(out, sums)]
            kinds = [pa.int64()] * 6 + [pa.string()] * 2
            columns = [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["id", *_NAMES])

    return batches


def aligned(docs: DataFrame, tokenizer_a: str, tokenizer_b: str, id: str = "doc_id", text: str = "text", with_groups: bool = False) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, groups) for every row.

    ``tokenizer_a`` is the file of a byte-level vocabulary, ``tokenizer_b`` of a piece vocabulary that puts a space in front of texts.
    Groups are spelled ``a1,a2|b1;a3|b2,b3`` (only ``with_groups``). Texts that are null, empty, or not spelled by both vocabularies
    have no tokens: zeros, and an empty digest. Rows that repeat an id and a text are documents of their own, and each
    come back; ids may be null. An empty table gives an empty result. Other columns are not read.
    """
    spark, paths = docs.sparkSession, (tokenizer_a, tokenizer_b)
    rows = docs.select(docs[id].alias("id"), docs[text].alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    rows = written(rows.mapInArrow(_encoded(paths), f"id {kind}, a binary, b binary"), "ids", compression="zstd")
    first = rows.select("a", "b").mapInArrow(_first_pass(paths), "bucket long, pair long, docs long")
    counts, blocks = counted(written(first, "aligned"))
    best = _best(counts, aligner(paths).width)
    turns, results = _turns(blocks), []
    for turn in turns:
        here = {r["block"]: (r["bits"], r["sizes"], r["pairs"], r["counts"]) for r in counts.where(F.col("block").between(*turn)).collect()}
        sent = spark.sparkContext.broadcast((here, best))
        fields = f"id {kind}, {_RESULT}"
        results.append(rows.mapInArrow(_second_pass(paths, uuid.uuid4().hex, blocks, sent, with_groups), fields))
    if len(turns) == 1:
        return results[0]
    every = results[0]
    for more in results[1:]:
        every = every.union(more)
    # Each row came once in every turn, with what the turn's blocks hold of its counts.
    once = [c for c in every.columns if c not in ("n_best", "count_sum")]
    copies = F.col("_rows") / len(turns)
    summed = every.groupBy(*once).agg(F.count(F.lit(1)).alias("_rows"), *(F.sum(c).alias(c) for c in ("n_best", "count_sum")))
    shared = [(F.col(c) / copies).cast("long").alias(c) for c in ("n_best", "count_sum")]
    spread = summed.select(*once, *shared, F.explode(F.sequence(F.lit(1), copies.cast("long"))).alias("_copy"))
    return spread.select(*every.columns)


def report(docs: DataFrame, tokenizer_a: str, tokenizer_b: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for every row."""
    return aligned(docs, tokenizer_a, tokenizer_b).select(F.col("id").alias("doc_id"), *_NAMES[:7])
