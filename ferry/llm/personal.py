"""Personal data: fixed kinds by their form, and unseen identifiers by the contexts that those stand in.

Entities of the fixed kinds seed a bootstrap. The words around them are lexical patterns; other tokens that look like
identifiers and stand in the same patterns are instances. Patterns are scored by the share
of their instances that are believed, instances by the patterns that vouch for them, in turns, as joins
and aggregates over the pattern-instance graph. Patterns of high confidence then mark what they find.
Everything is DataFrame operations; texts are read once and never shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ferry.llm.tables import written

#: In the order in which spans of one start are listed.
KINDS = ("email", "ip", "card", "phone")
#: A pattern needs so many different seeds of a kind.
LEAST_SEEDS = 3
ROUNDS = 3
#: Patterns vouch for instances from the first confidence on, and mark spans from the second on.
VOUCHES, MARKS = 0.5, 0.8

# Three characters of private use stand for what the forms treat alike: a separator between two digits, a dot between two
# label characters, and the edge of a match. Texts that hold them already are spelled with a fourth.
_SEP, _DOT, _EDGE, _OWN = "\ue000", "\ue001", "\ue002", "\ue003"
_LABEL = "A-Za-z0-9-"
_LOCAL = f"A-Za-z0-9._%+{_DOT}-"
_TOKEN = "A-Za-z0-9_@.+-"
#: Characters of context that are looked at on either side.
_CONTEXT = 64
#: Parts whose lengths are summed at once to find places.
_BLOCK = 256


@dataclass(frozen=True)
class Form:
    """Where a kind may be (a cheap test), how the text is respelled for it, and what matches: no match grows by recursion."""

    may_be: str
    matches: str
    respelled: tuple[str, str] | None = None


FORMS = {
    "email": Form("@", f"(?:\\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[{_LABEL}]++{_DOT}[{_LABEL[:-1]}{_DOT}-]++", (f"(?<=[{_LABEL}])\\.(?=[{_LABEL}])", _DOT)),
    "ip": Form("[0-9]\\.[0-9]++\\.[0-9]++\\.[0-9]", "(?<![0-9])[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++"),
    "card": Form("[0-9](?:[ -]?[0-9]){13}", f"[0-9][0-9{_SEP}]{{13,}}+", ("(?<=[0-9])[ -](?=[0-9])", _SEP)),
    "phone": Form("\\+[0-9]", "\\+[0-9][ ().0-9-]+[0-9]"),
    "": Form("[0-9@]", f"(?<![{_TOKEN}])(?=(?:[A-Za-z_@.+-]*+[0-9]){{4}})[{_TOKEN}]*[A-Za-z0-9]"),
}


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _valid(kind: str, match: Column) -> Column:
    digits = _digits(match)
    if kind == "ip":
        byte = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
        return match.rlike(f"^{byte}\\.{byte}\\.{byte}\\.{byte}$")
    if kind == "card":
        # Luhn: every second digit from the right is doubled, and counts by its digits' sum.
        double = lambda d: F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        each = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(double(c.cast("int"))))
        return F.length(digits).between(14, 19) & (F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _sum(lengths: Column) -> Column:
    return F.aggregate(lengths, F.lit(0), lambda a, x: a + x)


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.regexp_replace(text, "[^\\p{L}\\p{N}]+", " ")), " "), "")


def _patterns(left: Column, right: Column) -> Column:
    """The two words before, and the word on either side; none where a side has no word."""
    before, after = _words(F.substring(left, -_CONTEXT, _CONTEXT)), _words(F.substring(right, 1, _CONTEXT))
    last, last_but_one, first = F.get(F.reverse(before), F.lit(0)), F.get(F.reverse(before), F.lit(1)), F.get(after, F.lit(0))
    two, around = F.concat_ws(" ", last_but_one, last, F.lit("_")), F.concat_ws(" ", last, F.lit("_"), first)
    kept = F.array(F.when(last_but_one.isNotNull(), two), F.when(last.isNotNull() & first.isNotNull(), around))
    # A letter or digit right beside it makes the match a part of something else.
    part = left.rlike("[\\p{L}\\p{N}_]$") | right.rlike("^[\\p{L}\\p{N}_]")
    return F.when(part, F.array().cast("array<string>")).otherwise(F.array_compact(kept))


def _with_matches(rows: DataFrame, kind: str) -> DataFrame:
    """Add ``_found_<kind>``: start, end, text and patterns of every match, in order.

    Matches are fenced in and the text is split at the fences, so that every second part is a match and lies
    behind the characters of the parts before it. Lengths are summed by blocks.
    """
    form, parts, lengths, blocks, before = FORMS[kind], f"_parts_{kind}", f"_lengths_{kind}", f"_blocks_{kind}", f"_before_{kind}"
    text = F.regexp_replace("_text", *form.respelled) if form.respelled else F.col("_text")
    fenced = F.split(F.regexp_replace(text, form.matches, f"{_EDGE}$0{_EDGE}"), _EDGE)
    may_be = F.col("_text").contains("@") if form.may_be == "@" else F.col("_text").rlike(form.may_be)
    rows = rows.withColumn(parts, F.when(may_be, fenced).otherwise(F.array(F.lit(""))))
    rows = rows.withColumn(lengths, F.transform(parts, F.char_length))
    of_block = F.transform(F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / _BLOCK).cast("int")), lambda b: _sum(F.slice(lengths, b * _BLOCK + 1, _BLOCK)))
    rows = rows.withColumn(blocks, of_block)
    rows = rows.withColumn(before, F.transform(blocks, lambda _, b: _sum(F.slice(blocks, F.lit(1), b))))

    def found(i: Column) -> Column:
        block = F.floor(i / _BLOCK).cast("int")
        start = F.get(before, block) + _sum(F.slice(lengths, block * _BLOCK + 1, i % _BLOCK))
        match, patterns = F.get(parts, i), _patterns(F.get(parts, i - 1), F.get(parts, i + 1))
        return F.struct(start.alias("start"), (start + F.get(lengths, i)).alias("end"), match.alias("text"), patterns.alias("patterns"))

    odd = F.when(F.size(parts) > 2, F.sequence(F.lit(1), F.size(parts) - 2, F.lit(2)))
    every = F.coalesce(F.transform(odd, found), F.array().cast("array<struct<start:int,end:int,text:string,patterns:array<string>>>"))
    valid = F.filter(every, lambda m: _valid(kind, m["text"])) if kind else every
    return rows.withColumn(f"_found_{kind}", valid).drop(parts, lengths, blocks, before)


def matches(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, whole, entities, others): spans of the fixed kinds, sorted, and tokens like identifiers outside them."""
    whole = F.coalesce(F.col(text), F.lit(""))
    own = F.when(whole.rlike(f"[{_SEP}-{_EDGE}]"), F.regexp_replace(whole, f"[{_SEP}-{_EDGE}]", _OWN)).otherwise(whole)
    rows = docs.select(F.col(id).alias("id"), F.xxhash64(whole).alias("whole"), own.alias("_text"))
    for kind in (*KINDS, ""):
        rows = _with_matches(rows, kind)
    listed = lambda k: F.transform(
        f"_found_{KINDS[k]}", lambda m: F.struct(m["start"].alias("start"), F.lit(k).alias("kind"), m["end"].alias("end"), F.lower(m["text"]).alias("text"), m["patterns"].alias("patterns"))
    )
    rows = rows.withColumn("entities", F.sort_array(F.concat(*(listed(k) for k in range(len(KINDS))))))
    free = lambda m: ~F.exists("entities", lambda e: (e["start"] < m["end"]) & (m["start"] < e["end"]))
    others = F.filter("_found_", lambda m: (F.size(m["patterns"]) > 0) & free(m))
    return rows.select("id", "whole", "entities", others.alias("others"))


def learn(found: DataFrame) -> DataFrame:
    """(pattern, kind, confidence): patterns that mark what stands in them, from the matches of a corpus.

    An instance counts once however often it occurs, so copies of a text add nothing.
    """
    seeds = found.select(F.explode("entities").alias("e")).select("e.kind", F.col("e.text").alias("instance"), F.explode("e.patterns").alias("pattern"))
    others = found.select(F.explode("others").alias("o")).select(F.lit(None).cast("int").alias("kind"), F.lower("o.text").alias("instance"), F.explode("o.patterns").alias("pattern"))
    graph = seeds.unionByName(others).distinct()
    # Only patterns that enough seeds of a kind stand in can come to be trusted.
    seeded = graph.where(F.col("kind").isNotNull()).groupBy("pattern", "kind").agg(F.count(F.lit(1)).alias("seeds")).where(F.col("seeds") >= LEAST_SEEDS)
    sizes = graph.join(seeded.select("pattern").distinct(), "pattern", "left_semi").groupBy("pattern").agg(F.count(F.lit(1)).alias("size"))
    patterns = written(seeded.join(sizes, "pattern"), "patterns")
    unseen = graph.where(F.col("kind").isNull()).select("pattern", "instance")
    edges = written(unseen.join(patterns.select("pattern", F.col("kind")), "pattern").distinct(), "edges")
    scored = patterns.select("pattern", "kind", (F.col("seeds") / F.col("size")).alias("confidence"))
    for _ in range(ROUNDS):
        doubts = F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-6)))))
        trusted = scored.where(F.col("confidence") >= VOUCHES)
        believed = edges.join(trusted, ["pattern", "kind"]).groupBy("instance", "kind").agg((1 - doubts).alias("belief"))
        gained = edges.join(believed, ["instance", "kind"]).groupBy("pattern", "kind").agg(F.sum("belief").alias("belief"))
        share = (F.col("seeds") + F.coalesce("belief", F.lit(0.0))) / F.col("size")
        scored = written(patterns.join(gained, ["pattern", "kind"], "left").select("pattern", "kind", share.alias("confidence")), "scored")
    return scored.where(F.col("confidence") >= MARKS)


def marked(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, whole, entities, spans): per document the spans of the fixed kinds, and with them those that patterns add.

    Places count code points, ends exclusive. A null text is empty; a null id stays; repeated rows each
    come back; an empty table gives an empty result. Documents are joined with what was discovered in them by id and a
    hash of the text, never with their texts.
    """
    found = written(matches(docs, id, text), "matches")
    rules = learn(found)
    each = found.select("id", "whole", F.explode("others").alias("o")).select("id", "whole", "o.start", "o.end", F.explode("o.patterns").alias("pattern"))
    hits = each.join(rules, "pattern").groupBy("id", "whole", "start", "end").agg(F.max_by("kind", "confidence").alias("kind"))
    span = F.struct("start", "kind", "end")
    added = hits.groupBy("id", "whole").agg(F.collect_set(span).alias("added"))
    same = F.col("d.id").eqNullSafe(F.col("a.id")) & (F.col("d.whole") == F.col("a.whole"))
    joined = found.select("id", "whole", "entities").alias("d").join(added.alias("a"), same, "left")
    plain = F.transform("entities", lambda e: F.struct(e["start"].alias("start"), e["kind"].alias("kind"), e["end"].alias("end")))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return joined.select("d.id", "d.whole", plain.alias("entities"), F.sort_array(F.concat(plain, F.coalesce("added", none))).alias("spans"))


def _spelled(spans: str) -> Column:
    kind = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kind(s), s["start"], s["end"])), ",")


def report(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: how many of each fixed kind, a digest of their spans, and all spans spelled out."""
    count = lambda k: F.size(F.filter("entities", lambda e: e["kind"] == k)).cast("bigint").alias(f"n_{KINDS[k]}")
    return marked(docs, id, text).select(
        F.col("id").alias(id), *map(count, range(len(KINDS))), F.sha2(_spelled("entities"), 256).alias("base_sha256"), _spelled("spans").alias("spans")
    )


def redacted(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with every span replaced by its kind in angle brackets."""
    spans = marked(docs, id, text).select(F.col("id").alias("_span_id"), F.col("whole").alias("_span_whole"), "spans").dropDuplicates(["_span_id", "_span_whole"])
    rows = docs.select(F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"))
    rows = rows.withColumns({"_id": F.col("row")[id], "_whole": F.xxhash64(F.coalesce(F.col("row")[text], F.lit("")))})
    joined = rows.join(spans, F.col("_id").eqNullSafe(F.col("_span_id")) & (F.col("_whole") == F.col("_span_whole")))
    whole, kinds = F.col("row")[text], F.array(*(F.lit(f"<{k}>") for k in KINDS))
    piece = lambda s, i: F.concat(
        F.substring(whole, F.coalesce(F.get("spans", i - 1)["end"], F.lit(0)) + 1, F.greatest(F.lit(0), s["start"] - F.coalesce(F.get("spans", i - 1)["end"], F.lit(0)))), F.element_at(kinds, s["kind"] + 1)
    )
    rest = F.substring(whole, F.element_at("spans", -1)["end"] + 1, F.char_length(whole))
    clean = F.when(F.size("spans") == 0, whole).otherwise(F.concat(F.array_join(F.transform("spans", piece), ""), rest))
    return joined.select(*(clean.alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns))
