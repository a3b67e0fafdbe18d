"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ferry.llm.tables import small, written


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """(node, root) for every linked node but the roots; ``root`` is the smallest node reachable.

    ``links`` has two columns of one orderable type; direction, repeats and self links do not matter,
    null ends are ignored. Each round lets every node send its larger, then its smaller neighbours to
    the smallest one it knows; the number of rounds grows with the logarithm of the node count. All
    work is joins and combining minima, so a node with very many neighbours is cut by adaptive
    execution, and each round is a written table. While they are few, the smallest neighbours are broadcast.
    """
    a, b = (F.col(c) for c in links.columns)
    edges = written(
        links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), label
    )
    before = _state(edges)
    while before[0]:
        edges = written(_small_star(_large_star(edges, before[0]), before[0]), label)
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def _large_star(edges: DataFrame, n: int) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
    # A node's larger neighbours are the edges that end in it.
    moved = edges.select(F.col("u").alias("far"), F.col("v").alias("u")).join(small(least, 2 * n), "u")
    return moved.select(F.col("far").alias("u"), F.col("low").alias("v")).distinct()


def _small_star(edges: DataFrame, n: int) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("low"))
    moved = edges.join(small(least, n), "u").where(F.col("v") != F.col("low")).select(F.col("v").alias("u"), F.col("low").alias("v"))
    return moved.union(least.select("u", F.col("low").alias("v"))).distinct()
