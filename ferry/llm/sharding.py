"""Shards of near equal bytes by a K-d tree over the documents' metadata.

A node of the tree is cut at a weighted quantile of the dimension along which it is widest: at the median if
it is to hold an even number of shards, else at the share of the smaller half. Quantiles are found
exactly, by histograms that Spark sums and searches over all rows of a level at once and that narrow until one value is
left; the driver sees one bin of each node, never rows. Every tree is an expression over literal arrays, so rows find
their shards without a join, and plans of all levels are compiled once.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import isfinite

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import NumericType

from ferry.llm.tables import written

#: Bytes that a document counts for besides its text.
OVERHEAD = 16
#: Bins of a node's histogram.
BINS = 4096
#: Rows of a shard that are numbered in one group, about, and the least number of groups.
NUMBERED_AT_ONCE, NUMBERED_GROUPS = 100_000, 64
#: A key is a coordinate and a tie; the lower bits of the tie tell rows of one id, text and size apart.
_COORDINATE_BITS = _TIE_BITS = 31
_REPEAT_BITS = 11


@dataclass
class Node:
    """A range of shards, cut into two unless it is one shard; ``low`` and ``high`` are the numbers of its halves."""

    first: int
    shards: int
    dimension: int = 0
    threshold: int = 0
    low: int | None = None
    high: int | None = None

    @property
    def low_shards(self) -> int:
        return self.shards // 2


class Tree:
    """Nodes by number, the root first. As a column it is a walk over literal arrays: its text is the same for every tree."""

    def __init__(self, shards: int):
        self.nodes = [Node(0, shards)]
        self._steps = (shards - 1).bit_length()

    @property
    def threshold(self) -> int:
        """The key at which the root is cut."""
        return self.nodes[0].threshold

    def wide(self) -> list[int]:
        """Numbers of the leaves that are still to be cut."""
        return [i for i, n in enumerate(self.nodes) if n.low is None and n.shards > 1]

    def cut(self, number: int, threshold: int) -> None:
        """Rows up to the threshold go to the low half."""
        node = self.nodes[number]
        node.threshold, node.low, node.high = threshold, len(self.nodes), len(self.nodes) + 1
        self.nodes.append(Node(node.first, node.low_shards))
        self.nodes.append(Node(node.first + node.low_shards, node.shards - node.low_shards))

    def place(self, dims: list[str]) -> Column:
        """The number of the leaf, as the tree is so far, that a row with the keys of the dimensions falls into."""
        keys = F.array(*(F.col(_key(c)) for c in dims))
        dimension, threshold = _literal([n.dimension for n in self.nodes]), _literal([n.threshold for n in self.nodes])
        # A leaf's halves are the leaf.
        low = _literal([i if n.low is None else n.low for i, n in enumerate(self.nodes)])
        high = _literal([i if n.high is None else n.high for i, n in enumerate(self.nodes)])
        below = lambda at: F.get(keys, F.get(dimension, at)) <= F.get(threshold, at)
        step = lambda at, _: F.when(below(at), F.get(low, at)).otherwise(F.get(high, at))
        return F.aggregate(F.sequence(F.lit(0), F.lit(self._steps)), F.lit(0).cast("bigint"), step)

    def shard(self, dims: list[str]) -> Column:
        return F.get(_literal([n.first for n in self.nodes]), self.place(dims)).cast("int")


def _literal(values: list, suffix: str = "L") -> Column:
    return F.expr(f"array({', '.join(f'{v}{suffix}' for v in values)})")


def _key(dimension: str) -> str:
    return f"_key_{dimension}"


def _measures(docs: DataFrame, id: str, text: str, dimensions: list[str]) -> DataFrame:
    """The rows, and of each the size and checksum of its text, a number of its own and its dimensions as numbers.

    Values that are no numbers count by their hash: equal ones stay together.
    """
    rows = docs.select(F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"))
    whole = F.coalesce(F.col("row")[text], F.lit("")).cast("binary")
    dims = {}
    for i, name in enumerate(dimensions):
        value = F.col("row")[name]
        if isinstance(docs.schema[name].dataType, NumericType):
            number = F.when(~F.isnan(value.cast("double")), value.cast("double"))
        else:
            number = F.when(value.isNotNull(), F.shiftrightunsigned(F.xxhash64(value), 64 - _COORDINATE_BITS).cast("double"))
        dims[f"_dim_{i}"] = number
    size = (F.octet_length(whole) + OVERHEAD).cast("bigint")
    number = F.monotonically_increasing_id()
    measures = {"id": F.col("row")[id], "size": size, "crc": F.crc32(whole), "number": number, **dims, "_dim_size": F.log2(size)}
    return rows.select("row", *(c.alias(k) for k, c in measures.items()))


def _dims(measured: DataFrame) -> list[str]:
    return [c for c in measured.columns if c.startswith("_dim_")]


def _scales(measured: DataFrame) -> dict[str, tuple[float, float]]:
    """The least value of each dimension, and the distance to the greatest (0 if there is none)."""
    dims = _dims(measured)
    ends = measured.agg(*(f(c).alias(f"{f.__name__}{c}") for c in dims for f in (F.min, F.max))).first()
    finite = {c: ends[f"min{c}"] is not None and isfinite(ends[f"min{c}"]) and isfinite(ends[f"max{c}"]) for c in dims}
    return {c: (ends[f"min{c}"], ends[f"max{c}"] - ends[f"min{c}"]) if finite[c] else (0.0, 0.0) for c in dims}


def _keyed(measured: DataFrame, scales: dict[str, tuple[float, float]]) -> DataFrame:
    """A sort key per dimension: the value scaled to 31 bits, then a hash of the row that tells equal values apart.

    Its last bits are a hash of the row's number, so that a group of repeated rows can be cut as well.
    """
    same = F.shiftleft(F.xxhash64("id", "crc", "size").bitwiseAND(F.lit((1 << (_TIE_BITS - _REPEAT_BITS)) - 1)), _REPEAT_BITS)
    tie = same.bitwiseOR(F.xxhash64("number").bitwiseAND(F.lit((1 << _REPEAT_BITS) - 1)))
    keys = {}
    for c, (low, span) in scales.items():
        share = F.coalesce((F.col(c) - low) / span, F.lit(0.0)) if span else F.lit(0.0)
        scaled = F.floor(share * ((1 << _COORDINATE_BITS) - 1)).cast("bigint")
        keys[_key(c)] = F.shiftleft(scaled, _TIE_BITS).bitwiseOR(tie)
    return measured.withColumns(keys)


def grow(rows: DataFrame, dims: list[str], shards: int) -> Tree:
    """The tree over rows with ``size`` and the keys of the dimensions."""
    tree = Tree(shards)
    while wide := tree.wide():
        placed = rows.withColumn("_node", tree.place(dims))
        placed = placed.where(F.get(_literal([int(i in wide) for i in range(len(tree.nodes))]), F.col("_node")) == 1)
        ends = [f(_key(c)).alias(f"{f.__name__}{c}") for c in dims for f in (F.min, F.max)]
        stats = {r["_node"]: r for r in placed.groupBy("_node").agg(F.sum("size").alias("bytes"), *ends).collect()}
        search = {}
        for i in wide:
            r, node = stats.get(i), tree.nodes[i]
            if r is None:
                tree.cut(i, 0)
                continue
            coordinate = [(r[f"max{c}"] >> _TIE_BITS) - (r[f"min{c}"] >> _TIE_BITS) for c in dims]
            node.dimension = max(range(len(dims)), key=lambda d: coordinate[d])
            c = dims[node.dimension]
            search[i] = _Search(r[f"min{c}"], r[f"max{c}"], 0, r["bytes"] * node.low_shards / node.shards)
        _cut_all(tree, placed, dims, search)
    return tree


@dataclass
class _Search:
    """Keys from the low to the high one, bytes below the low one, bytes wanted below the cut."""

    low: int
    high: int
    below: int
    wanted: float


def _cut_all(tree: Tree, placed: DataFrame, dims: list[str], search: dict[int, _Search]) -> None:
    """Narrow the ranges of all nodes together until each is one key, then cut there.

    Bins are added up and searched in Spark; one row a node comes back.
    """
    keys = F.array(*(F.col(_key(c)) for c in dims))
    at = F.col("_node")
    while search:
        numbers = range(len(tree.nodes))
        of = lambda f, none=0: F.get(_literal([f(search[i]) if i in search else none for i in numbers]), at)
        key = F.get(keys, F.get(_literal([n.dimension for n in tree.nodes]), at))
        inside = placed.select("_node", "size", key.alias("key"), of(lambda s: s.low, 1).alias("low"), of(lambda s: s.high).alias("high"),
                               of(lambda s: (s.high - s.low) // BINS + 1, 1).alias("step"))
        inside = inside.where(F.col("key").between(F.col("low"), F.col("high")))
        binned = inside.groupBy("_node", F.expr("(key - low) div step").alias("bin"))
        binned = binned.agg(F.sum("size").alias("bytes"), F.min("key").alias("low"), F.max("key").alias("high"))
        earlier = Window.partitionBy("_node").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        below = of(lambda s: s.below) + F.coalesce(F.sum("bytes").over(earlier), F.lit(0))
        wanted = F.get(_literal([search[i].wanted if i in search else 0.0 for i in numbers], "D"), at)
        met = binned.withColumn("below", below).where((F.col("below") < wanted) & (F.col("below") + F.col("bytes") >= wanted))
        for r in met.collect():
            one = search[r["_node"]]
            if r["low"] == r["high"]:
                # The key that crosses the mark goes to the side that it leaves nearer to it.
                nearer = r["below"] + r["bytes"] - one.wanted <= one.wanted - r["below"]
                tree.cut(r["_node"], r["low"] if nearer else r["low"] - 1)
                del search[r["_node"]]
            else:
                one.low, one.high, one.below = r["low"], r["high"], r["below"]


def _numbered(placed: DataFrame) -> DataFrame:
    """Number the rows of every shard from 0, in many groups of it."""
    sizes = placed.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    groups = max(NUMBERED_GROUPS, -(-sizes // NUMBERED_AT_ONCE))
    grouped = placed.withColumn("part", F.pmod(F.xxhash64("number"), F.lit(groups)))
    counts = grouped.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    order = Window.partitionBy("shard", "part").orderBy("id", "crc", "number")
    nth = grouped.withColumn("nth", F.row_number().over(order) - 1)
    return nth.join(starts, ["shard", "part"]).withColumn("slot", (F.col("start") + F.col("nth")).cast("bigint"))


def _tree(docs: DataFrame, dimensions: list[str], count: int | None, target_bytes: int | None, id: str, text: str):
    measured = written(_measures(docs, id, text, dimensions).drop("row"), "measured")
    if count is None:
        total = measured.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
        count = max(1, -(-total // target_bytes))
    scales = _scales(measured)
    rows = _keyed(measured, scales)
    return rows, grow(rows, _dims(measured), count), scales


def shards(
    docs: DataFrame, dimensions: list[str], count: int | None = None, target_bytes: int | None = None, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(id, size, crc, shard, slot) for every document: its shard and its number there.

    Give the number of shards, or the bytes that a shard is to hold. ``size`` is the UTF-8 bytes of the
    text and 16; the size is a dimension by itself, besides the named columns. Shards differ by about one
    document. A null text has no bytes, a null dimension is its least value, and rows of equal values
    are told apart by a hash of id and text, so that no value is too frequent to be cut. Rows
    that repeat id and text are all kept, and told apart by their numbers, so that many of them are cut as well. With fewer documents than shards some are empty; an empty
    table gives an empty result. The text is read once; all later passes read a narrow written table.
    """
    rows, tree, _ = _tree(docs, dimensions, count, target_bytes, id, text)
    placed = written(rows.select("id", "size", "crc", "number", tree.shard(_dims(rows)).alias("shard")), "placed")
    return _numbered(placed).select(F.col("id").alias(id), "size", "crc", "shard", "slot")


def report(docs: DataFrame, dimensions: list[str], count: int, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document's shard under the law of near equal bytes; equal texts need not share one."""
    return shards(docs, dimensions, count, id=id, text=text).select(
        id, "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def write(docs: DataFrame, path: str, dimensions: list[str], target_bytes: int, id: str = "doc_id", text: str = "text") -> None:
    """Write all columns of the documents as Parquet, one directory ``shard=`` for each shard.

    The tree is an expression over what each row computes for itself, so texts are not shuffled.
    """
    _, tree, scales = _tree(docs, dimensions, None, target_bytes, id, text)
    keyed = _keyed(_measures(docs, id, text, dimensions), scales)
    keyed.select(tree.shard(_dims(keyed)).alias("shard"), "row.*").write.partitionBy("shard").parquet(path)
