"""A Merkle manifest of a dataset, with a proof for every row by pointer jumping.

Every row is a leaf. Leaves of one group, in order, form a tree of fixed fan-out; the groups' roots form the
tree of the whole in the same way. Every node holds a pointer to an ancestor, at first its parent, and the
siblings on the way there. In each round nodes are joined with the ancestors they point to: the way there is
lengthened by the ancestor's own, so its length doubles, and the siblings are concatenated, until all point to the root.

At most ``FAN ** d`` nodes point to one ancestor at distance ``d``, whatever the groups' sizes, and only nodes at
least so high are pointed to. So either few nodes are (they are broadcast, by a measured bound), or no key is hot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ferry.llm.tables import total, written
from ferry.llm.urls import lower_ascii

FAN = 8
#: Ancestors are broadcast if their digests and siblings take so many bytes at most.
ANCESTOR_BYTES = 32_000_000
#: Numbers of groups and parts are broadcast up to so many rows.
COUNTED_ROWS = 200_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

#: What lies beside a node among its parent's children, and whether above the groups' roots.
_SEGMENT = "struct<before: string, after: string, top: boolean>"


def framed(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*inputs: Column) -> Column:
    """Lowercase hexadecimal SHA-256 of the inputs, concatenated."""
    return F.sha2(F.concat(*inputs), 256)


def numbered(df: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """Rows with their number ``idx`` within ``group``, from zero in the order given, and the group's size ``n``.

    Rows are sorted over all tasks by group and order and written with their place; only the counts of each
    group and task are added up, so a group that holds most rows is spread like any other.
    """
    sorted_ = df.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    placed = written(sorted_.withColumn("_at", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("_at", 33).alias("_part")
    counts = written(placed.groupBy(F.col(group), part).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first")), "counts")
    of = Window.partitionBy(group)
    ahead = F.sum("_n").over(of.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select(
        F.col(group).alias("_group"), F.col("_part").alias("_of"), (F.coalesce(ahead, F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_n").over(of).alias("n")
    )
    if counts.count() <= COUNTED_ROWS:
        starts = F.broadcast(starts)
    joined = placed.join(starts, F.col(group).eqNullSafe(F.col("_group")) & (part == F.col("_of")))
    return joined.withColumn("idx", F.col("_at") + F.col("_shift")).drop("_at", "_group", "_of", "_shift")


def _grown(leaves: DataFrame, group: str, carried: Sequence[str], label: str) -> tuple[list[DataFrame], DataFrame]:
    """Families of every level, and the root of each group.

    ``leaves`` have ``group``, idx, n, digest and the carried columns. A family is a parent's place and its children, in
    order. Roots have group, ``level``, digest and what the leaf carried that is a root itself.
    """
    child = F.struct("idx", "digest", *carried)
    most = leaves.agg(F.max("n")).first()[0] or 0
    level, nodes, families, roots = 0, leaves, [], []
    while True:
        tops = nodes.where("n = 1").select(group, F.lit(level).alias("level"), "digest", *carried)
        roots.append(tops)
        if most <= 1:
            break
        up = F.floor(F.col("idx") / FAN).cast("bigint")
        family = nodes.where("n > 1").groupBy(group, up.alias("idx"), F.ceil(F.col("n") / FAN).cast("bigint").alias("n"))
        families.append(written(family.agg(F.array_sort(F.collect_list(child)).alias("children")), label))
        digests = F.transform("children", lambda x: x["digest"])
        missing = [F.lit(None).cast(leaves.schema[c].dataType).alias(c) for c in carried]
        nodes = families[-1].select(group, "idx", "n", digest(F.array_join(digests, "")).alias("digest"), *missing)
        most, level = -(-most // FAN), level + 1
    every = roots[0]
    for more in roots[1:]:
        every = every.union(more)
    return families, every


def _children(family: DataFrame, top: bool) -> DataFrame:
    """A family's children with ``idx`` of the parent as ``up``, and what lies beside them."""
    digests = F.transform("children", lambda x: x["digest"])
    each = family.select("*", digests.alias("_digests"), F.posexplode("children").alias("_k", "_child"))
    before = F.array_join(F.slice("_digests", F.lit(1), F.col("_k")), "")
    after = F.array_join(F.slice("_digests", F.col("_k") + 2, F.lit(FAN)), "")
    beside = F.struct(before.alias("before"), after.alias("after"), F.lit(top).alias("top"))
    return each.select("*", F.col("idx").alias("up"), F.array(beside).alias("way"))


def _key(top: bool, group: Column, level: Column, idx: Column) -> Column:
    kind = F.lit("t") if top else F.when(group.isNull(), "n").otherwise("g")
    name = F.lit("") if top else F.coalesce(group, F.lit(""))
    return F.concat(kind, level.cast("string"), F.lit(":"), idx.cast("string"), F.lit(":"), name)


def _nodes(families: list[DataFrame], roots: DataFrame, tops: list[DataFrame], group: str, carried: Sequence[str]) -> DataFrame:
    """Every node but the root of the whole: ``node``, its ancestor ``up``, the siblings up to there, and its height."""
    found, zero = [], F.lit(0)
    for level, family in enumerate(families):
        kids = _children(family, False)
        found.append(
            kids.select(
                _key(False, F.col(group), F.lit(level), F.col("_child.idx")).alias("node"),
                _key(False, F.col(group), F.lit(level + 1), F.col("up")).alias("up"),
                "way", F.lit(level).alias("height"), *(F.col(f"_child.{c}").alias(c) for c in ("digest", *carried)),
            )
        )
    if not tops:
        # One group: its root is the root of the whole. Only a lone leaf is asked for.
        none = F.array().cast(f"array<{_SEGMENT}>")
        node = _key(False, F.col(group), F.col("level"), zero)
        found.append(roots.select(node.alias("node"), F.lit(None).cast("string").alias("up"), none.alias("way"), F.col("level").alias("height"), "digest", *carried))
    for level, family in enumerate(tops):
        kids = _children(family, True)
        child = F.col("_child")
        node = _key(False, child["of"], child["base"], zero) if level == 0 else _key(True, zero, F.lit(level), child["idx"])
        up = _key(True, zero, F.lit(level + 1), F.col("up"))
        height = child["base"] if level == 0 else F.lit(1 << 30)
        found.append(kids.select(node.alias("node"), up.alias("up"), "way", height.alias("height"), *(child[c].alias(c) for c in ("digest", *carried))))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every


def _jumped(nodes: DataFrame, root: str, depth: int) -> DataFrame:
    """Nodes whose ``way`` goes up to the root, after as many self-joins as its length has binary digits."""
    nodes = nodes.withColumn("up", F.when(F.col("up") != root, F.col("up")))
    nodes, done, distance = written(nodes, "pointers"), [], 1
    while distance < depth:
        done.append(nodes.where("up IS NULL AND height = 0"))
        asked = nodes.where(F.col("height") >= distance).select(F.col("node").alias("_node"), F.col("up").alias("_up"), F.col("way").alias("_way"))
        size = F.octet_length("_node") + F.aggregate("_way", F.lit(100), lambda n, x: n + F.octet_length(x["before"]) + F.octet_length(x["after"]))
        if total(asked, size) <= ANCESTOR_BYTES:
            asked = F.broadcast(asked)
        # What has arrived is asked for still, if it is no leaf.
        arrived = nodes.where("up IS NULL AND height > 0")
        met = nodes.where("up IS NOT NULL").join(asked, F.col("up") == F.col("_node"))
        further = met.withColumn("way", F.concat("way", "_way")).withColumn("up", F.col("_up")).drop("_node", "_up", "_way")
        distance *= 2
        # Lower nodes are never pointed to again.
        nodes = written(further.unionByName(arrived).where((F.col("height") == 0) | (F.col("height") >= distance)), "pointers")
    for more in done:
        nodes = nodes.unionByName(more)
    return nodes


def folded(leaf: Column, way: Column) -> Column:
    """The digest that a leaf and the siblings on its way give at the way's end."""
    return F.aggregate(way, leaf, lambda acc, x: F.sha2(F.concat(x["before"], acc, x["after"]), 256))


def manifest(docs: DataFrame, leaf: Column, id: str, group: str, carried: dict[str, Column] | None = None) -> tuple[DataFrame, str | None]:
    """(id, leaf, subroot, way, the carried columns) for every row, and the root's digest.

    Trees are by ``group`` (text; null is a group of its own and the first), leaves in order of ``id`` (null first),
    rows of one id in order of ``leaf``: rows that are alike in both are interchangeable. ``way`` holds the
    siblings of each level up to the root, ``before`` and ``after`` the node, and whether the level is above the
    group's root. A row that is the whole dataset has an empty way. No rows: an empty result and no root. Only the
    root's digest and counts come to the driver.
    """
    made = {"id": docs[id], "grp": docs[group], "digest": leaf, **(carried or {})}
    base = written(docs.select(*(c.alias(n) for n, c in made.items()), F.monotonically_increasing_id().alias("row_at")), "leaves")
    held = ["id", *(carried or {})]
    leaves = numbered(base, "grp", ["id", "digest", "row_at"]).drop("row_at")
    families, roots = _grown(leaves, "grp", held, "families")
    # The groups are the leaves of the upper tree, one after the other by name.
    upper = roots.select(F.lit("").alias("whole"), F.col("grp").alias("of"), F.col("level").alias("base"), "digest", *held)
    upper = written(numbered(upper, "whole", ["of"]), "upper")
    groups = upper.count()
    if not groups:
        empty = base.select("id", F.col("digest").alias("leaf"), F.col("digest").alias("subroot"), F.array().cast(f"array<{_SEGMENT}>").alias("way"), *(carried or {}))
        return empty, None
    tops, whole = _grown(upper, "whole", ["of", "base", *held], "families") if groups > 1 else ([], upper)
    root = whole.first()["digest"]
    roots = upper.select(F.col("of").alias("grp"), F.col("base").alias("level"), "digest", *held)
    top = f"t{len(tops)}:0:" if tops else roots.select(_key(False, F.col("grp"), F.col("level"), F.lit(0))).first()[0]
    nodes = _nodes(families, roots, tops, "grp", held)
    ready = _jumped(nodes, top, len(families) + len(tops)).where("height = 0")
    inner = F.filter("way", lambda x: ~x["top"])
    return ready.select("id", F.col("digest").alias("leaf"), folded(F.col("digest"), inner).alias("subroot"), "way", *(carried or {})), root


def leaf_of(text: Column) -> Column:
    return digest(*(framed(F.col(c) if c != "text" else text) for c in FIELDS))


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified): a manifest of documents, tried with tampered texts.

    Where 3 divides the CRC-32 of the id, the proof is tried with a leaf whose text is in lower case; a null id is not tampered with,
    nor is a null text changed by it. Rows of one id stand in order of their leaves.
    """
    tampered = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 3 == 0
    tried = F.when(tampered, leaf_of(lower_ascii(F.col("text")))).otherwise(leaf_of(F.col("text")))
    made, root = manifest(docs, leaf_of(F.col("text")), "doc_id", "lang", {"tried": tried})
    siblings = F.array_join(F.transform("way", lambda x: F.concat(x["before"], x["after"])), "")
    top = F.lit(root).cast("string")
    found = made.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", top.alias("root"), F.sha2(siblings, 256).alias("proof_sha256"), folded(F.col("tried"), F.col("way")).alias("folded_root")
    )
    return found.select("*", (F.col("folded_root") == F.col("root")).alias("verified"))


def _sql(levels: int = 10) -> str:
    """The same, level by level, as deep as ``FAN ** levels`` rows of a group and as many groups."""
    frame = "coalesce(octet_length(encode({0}::VARCHAR))::VARCHAR || ':' || {0}::VARCHAR, '-')"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    leaf, changed = ("sha256(" + " || ".join(frame.format(t if c == "text" else c) for c in FIELDS) + ")" for t in ("text", lower))
    codes = "list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)"
    step = "list_reduce(list_prepend(xor(c, b), [0, 1, 2, 3, 4, 5, 6, 7]::BIGINT[]), lambda d, i: xor(d >> 1, 3988292384 * (d & 1)))"
    crc = f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: {step}), 4294967295)"
    out = [
        f"""WITH base AS (
    SELECT doc_id, lang, {leaf} AS leaf, CASE WHEN {crc} % 3 = 0 THEN {changed} ELSE {leaf} END AS tried FROM documents
), l0 AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM base
), n0 AS (SELECT lang, pos, leaf AS h, count(*) OVER (PARTITION BY lang) AS n FROM l0)"""
    ]

    def grow(name: str, by: str) -> None:
        for i in range(levels):
            out.append(f""", {name}{i + 1} AS (
    SELECT {by}, pos // 8 AS pos, sha256(string_agg(h, '' ORDER BY pos)) AS h, any_value(ceil(n / 8)::BIGINT) AS n
    FROM {name}{i} WHERE n > 1 GROUP BY {by}, pos // 8
), {name}s{i} AS (
    SELECT {by}, pos, coalesce(string_agg(h, '') OVER (b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
           coalesce(string_agg(h, '') OVER (b ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
    FROM {name}{i} WHERE n > 1 WINDOW b AS (PARTITION BY {by}, pos // 8 ORDER BY pos)
)""")

    grow("n", "lang")
    subroots = " UNION ALL ".join(f"SELECT lang, h FROM n{i} WHERE n = 1" for i in range(levels + 1))
    out.append(f""", subroots AS ({subroots}), t0 AS (
    SELECT 0 AS whole, lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, h, count(*) OVER () AS n FROM subroots
)""")
    grow("t", "whole")
    roots = " UNION ALL ".join(f"SELECT h FROM t{i} WHERE n = 1" for i in range(levels + 1))
    names = [f"{k}_{i}" for k in "nt" for i in range(levels)]
    joins = [f"LEFT JOIN ns{i} n_{i} ON n_{i}.lang IS NOT DISTINCT FROM l0.lang AND n_{i}.pos = l0.pos // {8**i}" for i in range(levels)]
    joins += [f"LEFT JOIN ts{i} t_{i} ON t_{i}.pos = t0.pos // {8**i}" for i in range(levels)]
    ways = ", ".join(f"{{'b': {n}.before, 'a': {n}.after}}" for n in names)
    out.append(f""", proofs AS (
    SELECT doc_id, leaf, tried, t0.h AS subroot, list_filter([{ways}], lambda x: x.b IS NOT NULL) AS way
    FROM l0 JOIN t0 ON t0.lang IS NOT DISTINCT FROM l0.lang {' '.join(joins)}
), folds AS (
    SELECT doc_id, leaf, subroot, ({roots}) AS root,
           sha256(coalesce(list_aggregate(list_transform(way, lambda x: x.b || x.a), 'string_agg', ''), '')) AS proof_sha256,
           list_reduce(list_prepend({{'b': '', 'a': '', 'h': tried}}, list_transform(way, lambda x: {{'b': x.b, 'a': x.a, 'h': ''}})),
                       lambda acc, x: {{'b': '', 'a': '', 'h': sha256(x.b || acc.h || x.a)}}).h AS folded_root
    FROM proofs
)
SELECT *, folded_root = root AS verified FROM folds""")
    return "".join(out)


SQL = _sql(6)
