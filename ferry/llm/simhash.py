"""Near-duplicate groups by SimHash fingerprints and multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from xxhash import xxh64_intdigest

from ferry.llm.components import components
from ferry.llm.tables import written

WORDS = 3
SEED = 42
#: Fingerprints that differ in so many bits or fewer are linked: twice the radius of the balls below.
DISTANCE = 2
_AT_ONCE = 1 << 16


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """A bit is set if it is set in over half of the hashes of the text's shingles."""
    tokens = text.lower().split()
    if not tokens:
        return 0
    if len(tokens) <= words:
        shingles = [b" ".join(tokens)]
    else:
        shingles = list(map(b" ".join, zip(*(tokens[i:] for i in range(words)))))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(shingles), _AT_ONCE):
        part = shingles[at : at + _AT_ONCE]
        hashes = np.fromiter(map(xxh64_intdigest, part, repeat(SEED)), ">u8", len(part))
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(shingles)).tobytes(), "big")


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = [fingerprint(x or b"") for x in batch.column(2).to_pylist()]
        signed = np.array(prints, np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(signed)], names=["id", "whole", "print"])


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, whole, print) for every row; the 64 bits of ``print`` are a signed long. A null text is empty.

    ``whole`` is a hash of the text, which tells rows of one id apart.
    """
    kind = docs.schema[id].dataType.simpleString()
    rows = docs.select(F.col(id).alias("id"), _whole(F.col(text)).alias("whole"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(_fingerprints, f"id {kind}, whole bigint, print bigint")


def _whole(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _ball(print_: Column) -> Column:
    """The fingerprint, and for each segment the segments one bit away beside the other segment as it is."""
    flips = F.array(*(F.lit(1 << i if i < 63 else -(1 << 63)) for i in range(64)), F.lit(0))
    return F.transform(flips, lambda bit: print_.bitwiseXOR(bit))


def links(prints: DataFrame) -> DataFrame:
    """Links between distinct fingerprints, enough to connect all that differ in two bits or fewer.

    The two halves of a fingerprint are its segments. Each segment's ball of radius one is enumerated,
    and the tables are keyed by the changed segment together with the other one: two fingerprints
    meet under a key exactly if they are at most two bits apart, one bit in each, both in one, or one in all.
    So a key holds 65 fingerprints at most however large a group of copies is, and each is linked to
    the smallest under its key, after the complete distance is verified.
    """
    keyed = prints.select("print", F.explode(_ball(F.col("print"))).alias("key"))
    met = keyed.groupBy("key").agg(F.min("print").alias("low"), F.max("print").alias("high"), F.collect_list("print").alias("all"))
    pairs = met.where(F.col("low") != F.col("high")).select("low", F.explode("all").alias("print"))
    near = F.bit_count(F.col("low").bitwiseXOR(F.col("print"))) <= DISTANCE
    return pairs.where((F.col("low") != F.col("print")) & near).distinct()


def grouped(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, whole, print, component_id) for every row: the smallest id reachable over linked fingerprints.

    Texts without words have the fingerprint zero and are linked like any other. Null texts are empty;
    a null id gets its component's smallest id (null if none has one); repeated rows each come back. An
    empty table gives an empty result, and other columns are not read. Copies share one fingerprint and
    are never paired. Nothing is collected; the fingerprints are a written table.
    """
    prints = written(fingerprints(docs, id, text), "prints")
    least = prints.groupBy("print").agg(F.min("id").alias("least"))
    roots = components(links(least.select("print"))).withColumnsRenamed({"node": "print"})
    rooted = least.join(roots, "print", "left").select("print", "least", F.coalesce("root", "print").alias("root"))
    groups = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    # Only roots of several fingerprints need the second table; the others keep their own smallest id.
    of = written(rooted.join(groups, "root").select("print", "component_id"), "groups")
    return prints.join(of, "print").select("id", "whole", "print", "component_id")


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, fingerprint, component_id) for every row, as ``grouped`` says, fingerprints as 16 hex digits."""
    print_ = F.lower(F.lpad(F.hex("print"), 16, "0"))
    return grouped(docs, id, text).select(F.col("id").alias(id), print_.alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents whose id is the smallest of their component, with all their columns.

    Where no document of a component has an id, all of it stay. Rows that repeat id and text are one
    document, and stay or go together. Columns may have any names.
    """
    rows = docs.select(F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"))
    keep = grouped(docs, id, text).where(F.col("id").eqNullSafe(F.col("component_id")))
    keep = keep.select(F.col("id").alias("_kept_id"), F.col("whole").alias("_kept_whole")).distinct()
    same = F.col("row")[id].eqNullSafe(F.col("_kept_id")) & (_whole(F.col("row")[text]) == F.col("_kept_whole"))
    return rows.join(keep, same, "left_semi").select(*(F.col("row")[c].alias(c) for c in docs.columns))
