"""Benchmark decontamination: a broadcast set of test n-grams, scanned for in training texts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ferry.llm.tables import with_results, written

WORDS = 13
#: A document is contaminated if one word in so many, or more, lies in a benchmark window.
SHARE = 20
#: Windows that are broadcast at once, at most; more are scanned for block by block.
WINDOWS_PER_BLOCK = 2_000_000

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isdigit() or 97 <= c <= 122 else 32 for c in range(256))
_HITS = "n_words bigint, starts array<bigint>, ends array<bigint>, items array<string>"


def words_of(text: bytes) -> list[bytes]:
    """Runs of digits, letters a to z and characters beyond ASCII, after lower-casing A to Z."""
    return text.translate(_FOLD).split()


def _windows(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        grams, items = [], []
        for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = words_of(text or b"")
            if words:
                k = min(size, len(words))
                found = {b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)}
                grams += found
                items += [item] * len(found)
        yield pa.RecordBatch.from_arrays([pa.array(grams, pa.binary()), pa.array(items, pa.string())], names=["gram", "item"])


def windows(benchmark: DataFrame, id: str = "item_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """(gram, item): every window of every item; an item of fewer words is one window."""
    rows = benchmark.select(F.coalesce(F.col(id).cast("string"), F.lit("")).alias("item"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(lambda it: _windows(it, words), "gram binary, item string").distinct()


class Finder:
    """Looks for the windows of one block in a text, longest work first done by array operations."""

    def __init__(self, rows: list[tuple[bytes, str]]):
        self.items: dict[bytes, list[str]] = {}
        for gram, item in rows:
            self.items.setdefault(bytes(gram), []).append(item)
        grams = [g.split() for g in self.items]
        self.ids = {w: i + 1 for i, w in enumerate(sorted({w for g in grams for w in g}))}
        self.factors = np.random.default_rng(0).integers(1, 1 << 63, 1 << 12, np.uint64) | np.uint64(1)
        self.by_length = {}
        for k in {len(g) for g in grams}:
            ids = np.array([[self.ids[w] for w in g] for g in grams if len(g) == k], np.uint64)
            self.by_length[k] = np.unique(self._hash(ids.T, k))

    def _hash(self, columns, k: int) -> np.ndarray:
        return sum(np.asarray(c, np.uint64) * self.factors[j % len(self.factors)] for j, c in zip(range(k), columns))

    def hits(self, words: list[bytes]) -> Iterator[tuple[int, int, list[str]]]:
        """(first word, length, items) of every window that occurs."""
        ids = np.fromiter((self.ids.get(w, 0) for w in words), np.uint64, len(words))
        unknown = np.concatenate(([0], np.cumsum(ids == 0)))
        for k, wanted in self.by_length.items():
            at = np.flatnonzero(unknown[k:] == unknown[:-k]) if len(words) >= k else ()
            if len(at):
                hashes = self._hash((ids[at + j] for j in range(k)), k)
                place = np.minimum(np.searchsorted(wanted, hashes), len(wanted) - 1)
                for i in at[wanted[place] == hashes].tolist():
                    found = self.items.get(b" ".join(words[i : i + k]))
                    if found:  # the hash only sorts out
                        yield i, k, found


def _scan(finder: Finder, batch: pa.RecordBatch) -> list[pa.Array]:
    n_words, starts, ends, items = [], [], [], []
    for text, old_starts, old_ends, old_items in zip(*(c.to_pylist() for c in batch.columns)):
        words = words_of(text or b"")
        hit, named = np.zeros(len(words) + 2, np.int8), set(old_items)
        for a, b in zip(old_starts, old_ends):
            hit[a + 1 : b + 1] = 1
        for i, k, found in finder.hits(words):
            hit[i + 1 : i + k + 1] = 1
            named.update(found)
        edges = np.diff(hit)
        n_words.append(len(words))
        starts.append(np.flatnonzero(edges == 1))
        ends.append(np.flatnonzero(edges == -1))
        items.append(sorted(named))
    longs = pa.list_(pa.int64())
    return [pa.array(n_words, pa.int64()), pa.array(starts, longs), pa.array(ends, longs), pa.array(items, pa.list_(pa.string()))]


def find(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", words: int = WORDS, per_block: int = WINDOWS_PER_BLOCK) -> DataFrame:
    """(row, n_words, starts, ends, items) for every document; ``row`` is the document as it was.

    ``starts`` and ``ends`` bound the runs of hit words, ends exclusive; ``items`` are the ids, as
    text, of the items with a window in the document, sorted. A null text or one of separators only
    has no words. An item without words has no window, a null item id is the empty text, and repeated
    items or rows count each on their own. Either table may be empty. A block of windows is
    broadcast, never more than ``per_block``; if there are more windows, the documents are scanned
    once for every block, and hits are carried from block to block.
    """
    spark = docs.sparkSession
    grams = written(windows(benchmark, item, item_text, words), "windows")
    blocks = max(1, -(-grams.count() // per_block))
    none = {k: F.expr(f"cast(array() AS array<{t}>)") for k, t in (("starts", "bigint"), ("ends", "bigint"), ("items", "string"))}
    found = docs
    for b in range(blocks):
        part = grams.where(F.pmod(F.xxhash64("gram"), F.lit(blocks)) == b)
        shared = spark.sparkContext.broadcast([(bytes(r[0]), r[1]) for r in part.collect()])
        finder = _loader(shared)
        if b == 0:
            found = with_results(docs, {"text": F.col(text).cast("binary"), **none}, lambda x, f=finder: _scan(f(), x), _HITS)
        else:
            was = written(found, "hits")
            carried = {"text": F.col("row")[text].cast("binary"), **{k: F.col(k) for k in none}}
            again = with_results(was, carried, lambda x, f=finder: _scan(f(), x), _HITS)
            found = again.select("row.row", *(c for c in again.columns if c != "row"))
    return found


def _loader(shared):
    """The block's finder, made once in a worker."""
    made: list[Finder] = []

    def load() -> Finder:
        if not made:
            made.append(Finder(shared.value))
        return made[0]

    return load


def n_hit() -> Column:
    return F.aggregate(F.arrays_zip("starts", "ends"), F.lit(0).cast("bigint"), lambda n, x: n + x["ends"] - x["starts"])


def contaminated(share: int = SHARE) -> Column:
    return (n_hit() > 0) & (n_hit() * share >= F.col("n_words"))


def report(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id") -> DataFrame:
    """Per document: its words, hit words, items found, a digest of their ids, and the verdict."""
    return find(docs, benchmark).select(
        F.col("row")[id].alias(id),
        "n_words",
        n_hit().alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


def without_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    return find(docs, benchmark).where(~contaminated()).select("row.*")


def _cut(batch: pa.RecordBatch) -> list[pa.Array]:
    texts = []
    for text, starts, ends in zip(*(c.to_pylist() for c in batch.columns)):
        if starts:
            inside = np.frombuffer(text.translate(_FOLD), np.uint8) != 32
            edges = np.diff(np.concatenate(([0], inside.astype(np.int8), [0])))
            first, last = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
            parts, at = [], 0
            for a, b in zip(starts, ends):
                parts.append(text[at : first[a]])
                at = last[b - 1]
            text = b"".join([*parts, text[at:]])
        texts.append(None if text is None else text.decode())
    return [pa.array(texts, pa.string())]


def without_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """All documents, with the runs of hit words cut out of their texts."""
    found = find(docs, benchmark, text)
    cut = with_results(found, {"text": F.col("row")[text].cast("binary"), "starts": F.col("starts"), "ends": F.col("ends")}, _cut, "cut string")
    kept = [F.col("cut").alias(c) if c == text else F.col("row.row")[c].alias(c) for c in docs.columns]
    return cut.select(*kept)


_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS w FROM benchmark),
sized AS (SELECT item, w, least(13, len(w)) AS k FROM items WHERE len(w) > 0),
at_items AS (SELECT item, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM sized),
grams AS (SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM at_items),
lengths AS (SELECT DISTINCT k FROM grams),
at_docs AS (
  SELECT r, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM docs CROSS JOIN lengths WHERE len(w) >= k
),
doc_grams AS (SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS g FROM at_docs),
hits AS (SELECT r, doc_grams.k AS k, i, item FROM doc_grams JOIN grams ON doc_grams.k = grams.k AND doc_grams.g = grams.g),
hit_at AS (SELECT r, unnest(generate_series(i, i + k - 1)) AS p FROM (SELECT DISTINCT r, k, i FROM hits) AS h),
hit_words AS (SELECT r, count(DISTINCT p) AS n_hit FROM hit_at GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT r, item FROM hits) AS x GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hit_words USING (r) LEFT JOIN named USING (r)
"""
