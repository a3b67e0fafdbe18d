"""Line deduplication over a corpus: exact and near copies of lines, one of each component stays.

Lines are compared by the Jaccard similarity of their sets of character shingles, after trimming and
lower-casing. Equal lines have one key and one signature, made with a combining aggregate; texts are not shuffled for it. A row
of the MinHash signature is the least hash of a shingle under a rotation and the exclusive or with a
constant. Lines that agree in a band of rows are candidates and are verified on their whole shingle sets: each line of a
bucket is compared with one pivot. Where few lines of a pivot are open after that, they are compared with each other; where
many are, what differs from the pivot decides all other pairs, in part by numbers alone and else by a join on the
differences. Both ways are exact. Everything is DataFrame operations.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, functions as F

from ferry.llm.components import components
from ferry.llm.tables import SPACE, small, total, written

#: Characters of a shingle. A shorter line is one shingle.
SHINGLE = 8
SIMILARITY = 0.8
#: Sets reach the similarity if they differ in one part of so many of the sum of their sizes at most.
PART = round((1 + SIMILARITY) / (1 - SIMILARITY))
#: Bands are lines of the affine plane over 16 signature rows, so that two bands share one row and no more. Of its 20
#: lines 18 are enough: lines at the threshold agree in one band at least with a probability of 0.99.
ROWS, BANDS_USED = 16, 18
#: Shingles that meet a line's signature at once.
UNROLLED = 4
#: So many open lines of a pivot are compared each with each; the differences of more are joined. It decides on costs, not on results.
FEW = 8

_UTF32 = 4


def _plane() -> list[list[int]]:
    """The lines of the plane over the field of four elements; point (x, y) is row 4 x + y."""
    times = lambda a, b: 0 if not a or not b else (a + b - 2) % 3 + 1  # noqa: E731  with logarithms: 2 is the generator, 3 its square
    upright = [[4 * x + y for y in range(4)] for x in range(4)]
    return upright + [[4 * x + (times(m, x) ^ c) for x in range(4)] for m in range(4) for c in range(4)]


BANDS = _plane()[:BANDS_USED]


def _normal(line: Column) -> Column:
    """Trimmed and lower-cased. Trimming at the end walks over the whole line, so only lines that end in white space are."""
    ends = reduce(or_, (F.endswith(line, F.lit(c)) for c in SPACE))
    begun = F.ltrim(line, F.lit(SPACE))
    return F.lower(F.when(ends, F.rtrim(begun, F.lit(SPACE))).otherwise(begun))


def lines(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, whole, at, key, line): every line with a character, normalised; ``whole`` tells texts of one id apart."""
    # The text is hashed before it is split, not once a line. ``outer`` spares a filter that splits every text once more.
    texts = docs.select(F.col(id).alias("id"), F.xxhash64(text).alias("whole"), F.col(text).alias("text"))
    each = texts.select("id", "whole", F.posexplode_outer(F.split("text", "\n")).alias("at", "line"))
    normal = each.where(F.ltrim("line", F.lit(SPACE)) != "").select("id", "whole", "at", _normal(F.col("line")).alias("line"))
    return normal.select("id", "whole", "at", F.xxhash64("line").alias("key"), "line")


def _characters(line: str) -> Column:
    """Four bytes a character, so that any place is reached at once."""
    return F.encode(F.col(line), "UTF-32")


def _shingle(characters: Column, at: Column) -> Column:
    return F.xxhash64(F.substring(characters, at * _UTF32 + 1, F.lit(SHINGLE * _UTF32)))


def _shingles(line: str) -> Column:
    """Hashes of all shingles of a line; a shorter line is one. The characters go through an array, since what a function over an array's
    elements takes from outside is copied for each of them, and its own element is not. Places are counted in bytes: such a function
    is not compiled, and each step in it counts."""
    last = lambda chars: F.greatest(F.octet_length(chars) - (SHINGLE * _UTF32 - 1), F.lit(1))
    shingle = lambda chars, at: F.xxhash64(F.substring(chars, at, F.lit(SHINGLE * _UTF32)))
    each = lambda chars: F.transform(F.sequence(F.lit(1), last(chars), F.lit(_UTF32)), lambda at: shingle(chars, at))
    return F.get(F.transform(F.array(_characters(line)), each), 0)


def _row(row: int, hash: str) -> Column:
    """The hash in the row's order. Turned, so that rows are decided by different bits even of few shingles."""
    turn, mask = row * 7 % 64, (row * 0x9E3779B97F4A7C15 + (1 << 63)) % (1 << 64) - (1 << 63)
    turned = F.shiftleft(hash, turn).bitwiseOR(F.shiftrightunsigned(hash, 64 - turn)) if turn else F.col(hash)
    return turned.bitwiseXOR(F.lit(mask))


def _minima(every: DataFrame) -> DataFrame:
    """(key, m0, m1, …) from (key, line), where lines may repeat: the signature, over all shingles of the line; 31 bits of each least hash."""
    rows = every.select("key", _characters("line").alias("_chars"))
    rows = rows.withColumn("_last", F.floor(F.octet_length("_chars") / _UTF32).cast("int") - SHINGLE)
    # Some shingles a row, the last one repeated where none is left: the least of them meets the aggregate. A line of one shingle has no
    # copy but itself; it goes after the explosion, since a filter before it would make every line once more.
    places = F.when(F.col("_last") > 0, F.sequence(F.lit(0), "_last", F.lit(UNROLLED)))
    each = rows.select("key", "_chars", "_last", F.explode_outer(places).alias("_at")).where("_at IS NOT NULL")
    hashes = [f"_hash{j}" for j in range(UNROLLED)]
    hashed = each.select("key", *(_shingle(F.col("_chars"), F.least(F.col("_at") + j, "_last")).alias(h) for j, h in enumerate(hashes)))
    signed = hashed.groupBy("key").agg(*(F.min(F.least(*(_row(i, h) for h in hashes))).alias(f"_m{i}") for i in range(ROWS)))
    return signed.select("key", *(F.col(f"_m{i}").bitwiseAND(0x7FFFFFFF).cast("int").alias(f"m{i}") for i in range(ROWS)))


def _banded(signed: DataFrame) -> DataFrame:
    """(key, bands): one hash for each band of the signature."""
    return signed.select("key", F.array(*(F.xxhash64(F.lit(b), *(f"m{r}" for r in band)) for b, band in enumerate(BANDS))).alias("bands"))


def signatures(every: DataFrame) -> DataFrame:
    """(key, bands) from (key, line)."""
    return _banded(_minima(every))


def shared(signed: DataFrame) -> DataFrame:
    """(bucket, key, n): the members of every bucket of two lines or more, and how many it has."""
    each = signed.select("key", F.explode("bands").alias("bucket"))
    buckets = written(each.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets")
    return each.join(small(buckets, buckets.count()), "bucket")


def led(members: DataFrame) -> DataFrame:
    """(bucket, key, pivot): the pivot of a bucket is the member that shares buckets with the most others."""
    met = members.groupBy("key").agg(F.sum("n").alias("met"))
    pivots = members.join(met, "key").groupBy("bucket").agg(F.max(F.struct("met", "key")).getField("key").alias("pivot"))
    return members.select("bucket", "key").join(pivots, "bucket")


def differences(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(key, pivot, size, pivot_size, off) from (key, pivot): how many shingles both have, and those that one of them has alone.

    Only texts that the pairs name are shuffled, so give a written table of pairs. Conditions on the result would be moved below
    it and compare the lines once more: they are for the written table.
    """
    theirs = _named(texts, pairs.select(F.col("pivot").alias("key"))).select(F.col("key").alias("pivot"), F.col("line").alias("_theirs"))
    sided = pairs.join(theirs, "pivot").join(_named(texts, pairs.select("key")), "key")
    sets = sided.select("key", "pivot", _shingles("line").alias("_mine"), _shingles("_theirs").alias("_theirs"))
    alone = sets.select(
        "key",
        "pivot",
        F.array_except("_mine", "_theirs").alias("_mine"),
        F.array_except("_theirs", "_mine").alias("_theirs"),
        F.size(F.array_intersect("_mine", "_theirs")).alias("_both"),
    )
    size, theirs = (F.col("_both") + F.size(c) for c in ("_mine", "_theirs"))
    return alone.select("key", "pivot", size.alias("size"), theirs.alias("pivot_size"), F.concat("_mine", "_theirs").alias("off"))


def _named(texts: DataFrame, keys: DataFrame) -> DataFrame:
    wanted = written(keys.distinct(), "wanted")
    return texts.join(small(wanted, wanted.count()), "key", "left_semi")


def _counted(differing: DataFrame) -> DataFrame:
    return differing.select("key", "pivot", "size", "pivot_size", F.size("off").alias("n_off"))


def near(sizes: DataFrame) -> DataFrame:
    """(key, pivot, root, linked) from (key, pivot, size, n_off): which lines of a pivot are linked with its line ``root``.

    What differs between two lines differs between one of them and the centre, so lines are linked if their numbers off
    the centre add up to what two lines may differ in. The line with the most room left reaches every line that any other
    line reaches in this way.
    """
    room = F.col("size") - PART * F.col("n_off")
    widest = sizes.groupBy("pivot").agg(F.max(F.struct(room.alias("room"), "key")).alias("_widest"))
    linked = F.col("_widest.room") + room >= 0
    return sizes.join(widest, "pivot").select("key", "pivot", F.col("_widest.key").alias("root"), linked.alias("linked"))


def _links(near: DataFrame) -> DataFrame:
    return near.where("linked AND key != root").select(F.col("key").alias("a"), F.col("root").alias("b"))


def undecided(placed: DataFrame, roots: DataFrame) -> DataFrame:
    """(key, pivot, root): lines of buckets that hold lines of different components, without the pivots, whose pairs are decided."""
    rooted = placed.where("key != pivot").join(small(roots, roots.count()), "key", "left").withColumn("root", F.coalesce("root", "key"))
    unlike = rooted.groupBy("bucket").agg(F.min("root").alias("_low"), F.max("root").alias("_high")).where("_low != _high")
    return rooted.join(unlike.select("bucket"), "bucket", "left_semi").select("key", "pivot", "root").distinct()


def each_with_each(left: DataFrame) -> DataFrame:
    """(key, pivot) from (key, pivot, root): the pairs of lines of one pivot and different roots, one of them as the other's pivot."""
    side = lambda s: left.select("pivot", *(F.col(c).alias(c + s) for c in ("key", "root")))
    met = side("_a").join(side("_b"), "pivot").where("key_a < key_b AND root_a != root_b")
    return met.select(F.col("key_a").alias("key"), F.col("key_b").alias("pivot")).distinct()


def centred(apart: DataFrame) -> DataFrame:
    """(key, pivot, size, off) from the same: the sets moved from the pivot to a centre, the shingles that most lines of the pivot hold.

    Two sets differ in as much as before, since all are changed by the same shingles; but they are as small as they can be.
    """
    n = apart.groupBy("pivot").agg(F.count(F.lit(1)).alias("_n"))
    held = apart.select("pivot", F.explode("off").alias("_hash")).groupBy("pivot", "_hash").agg(F.count(F.lit(1)).alias("_lines"))
    most = held.join(small(n, apart.count()), "pivot").where("2 * _lines > _n").groupBy("pivot").agg(F.collect_list("_hash").alias("_moved"))
    most = written(most, "centres")
    off = F.concat(F.array_except("off", "_moved"), F.array_except("_moved", "off"))
    moved = apart.join(small(most, total(most, F.size("_moved"))), "pivot", "left")
    return moved.select("key", "pivot", "size", F.when(F.col("_moved").isNull(), F.col("off")).otherwise(off).alias("off"))


def rest(apart: DataFrame) -> DataFrame:
    """(a, b), a < b, from (key, pivot, root, linked, size, off): pairs of one pivot and different roots that reach the similarity.

    What two lines differ in is what their sets off the pivot differ in. If sets of m and n may differ in d shingles, and shingles are
    ordered from the rarest on, the first one they share has at most (m - n + d) / 2 before it in the one, (n - m + d) / 2 in the
    other. As m - n is d at most, that is d or less, and d is at most 2 / (PART - 1) of the size of either line: what comes later in the
    order is left out before the join. Sets that share none have been linked.
    """
    each = apart.select("key", "pivot", F.explode("off").alias("_hash"))
    held = each.groupBy("pivot", "_hash").agg(F.count(F.lit(1)).alias("_lines"))
    # What one line alone holds meets nothing, but has its place in the order: it comes first.
    shared = each.join(held.where("_lines > 1"), ["pivot", "_hash"])
    line = Window.partitionBy("key", "pivot")
    place, n_shared = F.row_number().over(line.orderBy("_lines", "_hash")) - 1, F.count(F.lit(1)).over(line)
    placed = shared.select("key", "pivot", "_hash", (place - n_shared).cast("int").alias("_from_last"))
    numbered = apart.select("key", "pivot", "root", "linked", "size", F.size("off").alias("n_off"))
    ranked = numbered.join(placed, ["key", "pivot"]).withColumn("_at", F.col("n_off") + F.col("_from_last")).drop("_from_last")
    ranked = written(ranked.where((PART - 1) * F.col("_at") <= 2 * F.col("size")), "ranked")
    side = lambda df, s: df.select("pivot", "_hash", *(F.col(c).alias(c + s) for c in ("key", "root", "linked", "size", "n_off", "_at")))
    both = F.col("size_a") + F.col("size_b")
    more = F.col("n_off_a") - F.col("n_off_b")
    met = (
        (F.col("root_a") != F.col("root_b"))
        & (F.col("linked_b") | (F.col("key_a") < F.col("key_b")))
        & (PART * F.abs(F.col("size_a") - F.col("size_b")) <= both)
        & (PART * F.abs(more) <= both)
        & (PART * (2 * F.col("_at_a") - more) <= both)
        & (PART * (2 * F.col("_at_b") + more) <= both)
    )
    pairs = side(ranked.where("NOT linked"), "_a").join(side(ranked, "_b"), ["pivot", "_hash"]).where(met).select("pivot", "key_a", "key_b").distinct()
    whole = lambda s: apart.select("pivot", *(F.col(c).alias(c + s) for c in ("key", "size", "off")))
    differ = F.size("off_a") + F.size("off_b") - 2 * F.size(F.array_intersect("off_a", "off_b"))
    near = pairs.join(whole("_a"), ["pivot", "key_a"]).join(whole("_b"), ["pivot", "key_b"]).where(PART * differ <= both)
    return near.select(F.least("key_a", "key_b").alias("a"), F.greatest("key_a", "key_b").alias("b")).distinct()


def _linked(every: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Links (a, b) from the lines of a corpus in two parts, and the components (node, root) of the first part."""
    members = written(shared(_banded(written(_minima(every), "signatures"))), "members")
    keys = written(members.select("key").distinct(), "keys")
    wanted = every.select("key", "line").join(small(keys, keys.count()), "key", "left_semi")
    texts = written(wanted.groupBy("key").agg(F.first("line").alias("line")), "texts")
    placed = written(led(members), "placed")
    pairs = written(placed.where("key != pivot").select("key", "pivot").distinct(), "pairs")
    sizes = written(_counted(differences(pairs, texts)), "sizes")
    pivots = sizes.groupBy(F.col("pivot").alias("key"), "pivot").agg(F.max("pivot_size").alias("size"), F.lit(0).alias("n_off"))
    found = _links(written(near(sizes.select("key", "pivot", "size", "n_off").union(pivots)), "near"))
    roots = components(found)
    left = undecided(placed, roots.withColumnRenamed("node", "key"))
    left = written(left.join(left.groupBy("pivot").agg(F.count(F.lit(1)).alias("n")), "pivot"), "undecided")
    few = written(each_with_each(left.where(F.col("n") <= FEW)), "few")
    met = written(_counted(differences(few, texts)), "met")
    met = met.where(PART * F.col("n_off") <= F.col("size") + F.col("pivot_size")).select(F.col("key").alias("a"), F.col("pivot").alias("b"))
    many = written(left.where(F.col("n") > FEW).select("key", "pivot"), "many")
    if many.isEmpty():
        return found, met, roots
    # The sets themselves are written only where they are needed: they are larger than the texts.
    apart = written(differences(many, texts).select("key", "pivot", "size", "off"), "apart")
    apart = written(centred(apart), "centred")
    closer = written(near(apart.select("key", "pivot", "size", F.size("off").alias("n_off"))), "near")
    new = met.union(_links(closer))
    # What is contracted once is not contracted again: components of components and new links are those of all links.
    roots = components(roots.union(new))
    still = undecided(placed, roots.withColumnRenamed("node", "key"))
    apart = apart.join(closer.drop("root"), ["key", "pivot"]).join(still, ["key", "pivot"])
    return found.union(new), rest(written(apart, "apart")), roots


def links(every: DataFrame) -> DataFrame:
    """(a, b): pairs of distinct lines that reach the similarity, from the lines of a corpus.

    They connect what all such pairs of all buckets would connect.
    """
    first, last, _ = _linked(every)
    return first.union(last)


def rooted(every: DataFrame) -> DataFrame:
    """(node, root): the components of these links."""
    _, last, roots = _linked(every)
    return components(roots.union(last))


def repeated(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, whole, gone): per text the numbers of the lines that are copies of one that stays, sorted.

    Of a component the line of the smallest (id, text hash, place) stays.
    """
    # Texts are split again where lines are needed: they would be the largest of the tables.
    every = lines(docs, id, text)
    roots = rooted(every).withColumnRenamed("node", "key")
    rooted_lines = every.drop("line").join(small(roots, roots.count()), "key", "left")
    of = written(rooted_lines.select("id", "whole", "at", F.coalesce("root", "key").alias("root")), "rooted")
    place = F.struct("id", "whole", "at")
    groups = of.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("stays")).where("n > 1").select("root", "stays")
    # Written, so that both sides of the join are shuffled for it, and a line with very many copies can be cut.
    groups = written(groups, "stays")
    gone = of.join(groups, "root").where(~place.eqNullSafe(F.col("stays")))
    return gone.groupBy("id", "whole").agg(F.sort_array(F.collect_set("at")).alias("gone"))


def _kept_text(text: Column, gone: Column) -> tuple[Column, Column]:
    """The lines whose numbers are not in the sorted array: a mask of bytes tells each line's fate by its place."""
    part = lambda at, i: F.concat(F.repeat(F.lit("1"), at - F.coalesce(F.get(gone, i - 1), F.lit(-1)) - 1), F.lit("0"))
    mask = F.encode(F.array_join(F.transform(gone, part), ""), "UTF-8")
    stays = lambda line, i: F.substring(F.col("_mask"), i + 1, F.lit(1)) != F.lit(b"0")
    return mask, F.array_join(F.filter(F.split(text, "\n"), stays), "\n")


def deduplicated(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, text, n_lines, n_removed): all documents, with all but one line of every component taken out.

    ``row`` is the document as it was. Lines without characters always stay, a null text stays null,
    and a text that loses all lines is empty. Rows that repeat id and text are one document: their
    lines are not copies of each other, and all come back edited alike. An empty table gives an
    empty result. Two lines whose hashes of 64 bits collide count as equal.
    """
    gone = written(repeated(docs, id, text), "gone")
    size = total(gone, F.size("gone"))
    rows = docs.select(F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"))
    rows = rows.withColumns({"_id": F.col("row")[id], "_whole": F.xxhash64(F.col("row")[text])})
    marked = gone.select(F.col("id").alias("_gone_id"), F.col("whole").alias("_gone_whole"), "gone")
    same = F.col("_id").eqNullSafe(F.col("_gone_id")) & (F.col("_whole") == F.col("_gone_whole"))
    joined = rows.join(small(marked, size), same, "left")
    whole = F.col("row")[text]
    mask, kept = _kept_text(whole, F.col("gone"))
    edited = joined.withColumn("_mask", mask).withColumn("_kept", F.when(F.col("gone").isNull(), whole).otherwise(kept))
    return edited.select(
        "row",
        F.col("_kept").alias("text"),
        F.coalesce(F.length(whole) - F.length(F.replace(whole, F.lit("\n"))) + 1, F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_removed"),
    )


def without_repeated_lines(docs: DataFrame, id: str = "doc_id", text: str = "text", length: str | None = None) -> DataFrame:
    """The documents with their edited texts; ``length`` names a column of character counts to bring up to date."""
    edited = deduplicated(docs, id, text)
    new = {text: F.col("text")} | ({length: F.char_length("text").cast(docs.schema[length].dataType)} if length else {})
    return edited.select(*(new.get(c, F.col("row")[c]).alias(c) for c in docs.columns))
