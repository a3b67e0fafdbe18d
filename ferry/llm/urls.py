"""URL filters: pattern rules indexed by their rarest literal token.

A rule is found through one token that every URL it fits must hold, the one that the fewest URLs hold.
URLs are cut into tokens, each token fetches the rules kept under it, and only those run their regular
expressions. So the cost follows the rules that share a rare token with a URL, not the number of rules.

A pattern is text that may stand anywhere in a URL's host, path and the rest (without the scheme). ``||`` in
front means the host or any part of it after a dot, ``|`` in front or at the end the beginning or the end, ``*`` any text,
``^`` a separator (no letter, digit, ``_``, ``.``, ``%`` or ``-``) or the end. Hosts are compared in lower case, all else as it is.
"""

from __future__ import annotations

from collections.abc import Sequence
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ferry.llm.tables import written

ALLOW, BLOCK = "allow", "block"
#: Rules fetched by broadcast take so many bytes at most; a larger index is joined by a shuffle.
INDEX_BYTES = 32_000_000
#: A URL with more than this share of the rows is dealt over ``SALTS`` parts; there are fewer of those than its inverse.
HOT_SHARE, SALTS = 0.001, 64

#: Host and path rules, the longest of which decides: (rule, verdict).
SITES = (("net/", BLOCK), ("example.net/en/", ALLOW), ("example.com/de/", BLOCK), ("org/fr/", ALLOW))
#: What decides where no site rule fits.
PATTERNS = (
    ("||ads-", BLOCK), ("||adult-", BLOCK), ("||casino-", BLOCK), ("||cheap-pills.", BLOCK), ("||free-bets.", BLOCK),
    ("||spam-", BLOCK), ("/adult/", BLOCK), ("/casino^", BLOCK), ("?*utm_medium=affiliate", BLOCK),
)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, ascii_uppercase, ascii_lowercase)


def host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), F.lit("")))


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def target(url: Column) -> Column:
    """What patterns are held against: host, path and the rest."""
    return F.concat(host(url), F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*(.*)", 1), F.lit("")))


def _tokens(text: Column) -> Column:
    """Runs of ASCII letters and digits, each once, and the empty one under which rules without a token are kept."""
    return F.array_distinct(F.concat(F.array(F.lit("")), F.regexp_extract_all(lower_ascii(text), F.lit("([a-z0-9]+)"), F.lit(1))))


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str, int]]) -> DataFrame:
    """(rule, pattern, verdict, rank) as a DataFrame."""
    names = ("rule", "pattern", "verdict", "rank")
    rows = [F.struct(*(F.lit(v).alias(n) for n, v in zip(names, rule))) for rule in rules]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*rows)))


def compiled(rules: DataFrame) -> DataFrame:
    """Rules with their regular expression and the tokens that every URL they fit holds whole."""
    pattern = F.col("pattern")
    below = pattern.startswith("||")
    first = ~below & pattern.startswith("|")
    # A pattern that is one bar has it in front.
    last = pattern.endswith("|") & (F.length(pattern) > F.when(below, 2).when(first, 1).otherwise(0))
    core = F.when(below, F.substring(pattern, 3, 1 << 30)).when(first, F.substring(pattern, 2, 1 << 30)).otherwise(pattern)
    core = F.when(last, core.substr(F.lit(1), F.length(core) - 1)).otherwise(core)
    regex = F.regexp_replace(core, r"([\x21-\x29\x2B-\x2E\x3A-\x40\x5B-\x5D\x60\x7B-\x7E])", r"\\$1")
    regex = F.replace(F.replace(regex, F.lit("^"), F.lit(r"(?:[^a-zA-Z0-9_.%-]|\z)")), F.lit("*"), F.lit("(?s:.*)"))
    regex = F.concat(F.when(below, r"\A(?:[^/?#]*\.)?").when(first, r"\A").otherwise(""), regex, F.when(last, r"\z").otherwise(""))
    # A token that touches open text could be part of a longer one.
    closed = F.concat(F.when(below | first, "/").otherwise("*"), lower_ascii(core), F.when(last, "/").otherwise("*"))
    held = F.regexp_extract_all(closed, F.lit(r"(?<![a-z0-9*])([a-z0-9]+)(?![a-z0-9*])"), F.lit(1))
    tokens = F.when(F.size(held) > 0, F.array_distinct(held)).otherwise(F.array(F.lit("")))
    return rules.select("rule", "pattern", "verdict", "rank", regex.alias("regex"), tokens.alias("tokens"))


def _sized(df: DataFrame) -> DataFrame:
    """The frame, to be broadcast if its texts were measured and found small."""
    texts = [F.octet_length(c) for c, kind in df.dtypes if kind == "string"]
    size = df.agg(F.sum(sum(texts, F.lit(64)))).first()[0] or 0
    return F.broadcast(df) if size <= INDEX_BYTES else df


def index(rules: DataFrame, urls: DataFrame) -> DataFrame:
    """Rules with the one of their tokens that the fewest ``urls.target`` hold; ties: the longest, then the least."""
    each = rules.select("*", F.explode("tokens").alias("token")).drop("tokens")
    known = _sized(each.select("token").distinct())
    held = urls.select(F.explode(_tokens(F.col("target"))).alias("token")).join(known, "token").groupBy("token").agg(F.count(F.lit(1)).alias("urls"))
    rarity = F.struct(F.coalesce("urls", F.lit(0)), -F.length("token"), F.col("token"))
    kept = each.join(_sized(held), "token", "left").groupBy("rule", "pattern", "verdict", "rank", "regex")
    return kept.agg(F.min_by("token", rarity).alias("token"))


def fitting(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(target, rule, rank, verdict): for each ``target`` that a rule fits, the one that decides.

    Of several, the one of highest rank, then the longest pattern, then allow before block, then the last by name.
    """
    kept = written(index(compiled(rules.dropDuplicates()), urls), "rules")
    fetched = urls.select("target", F.explode(_tokens(F.col("target"))).alias("token")).join(_sized(kept), "token")
    fits = fetched.where(F.regexp_like("target", F.col("regex")))
    order = F.struct("rank", F.length("pattern"), F.col("verdict") == ALLOW, "pattern", "rule")
    won = fits.groupBy("target").agg(F.max_by(F.struct("rule", "rank", "verdict"), order).alias("won"))
    return won.select("target", "won.*")


def judged(pages: DataFrame, rules: DataFrame, url: str = "url", id: str = "page_id") -> DataFrame:
    """(row, host, path, rule, rank, verdict) for every row; the last three are null where no rule fits.

    ``row`` holds the columns of ``pages`` as they were, whatever their names. URLs that are null or have no
    ``://`` have an empty host and path; a rule without text fits them like any other. Each distinct URL is judged
    once, so repeated rows cost no more and each come back. A URL that many rows share is dealt by ``id`` over
    several tasks when verdicts are joined to the rows. Without rules or rows the result is empty or unjudged.
    """
    row = F.struct(*(pages[f"`{c}`"] for c in pages.columns)).alias("row")
    rows = pages.select(row).select("row", target(F.col("row")[url]).alias("target"))
    urls = written(rows.groupBy("target").agg(F.count(F.lit(1)).alias("n")), "urls")
    total = urls.agg(F.sum("n")).first()[0] or 0
    zero = F.lit(0).cast("bigint")
    often = F.col("n") > HOT_SHARE * total
    # Fewer than 1 / HOT_SHARE of them.
    hot = F.broadcast(urls.where(often).select("target", F.lit(True).alias("hot")))
    part = F.when(F.col("hot"), F.pmod(F.xxhash64(F.col("row")[id]), F.lit(SALTS))).otherwise(zero)
    dealt = rows.join(hot, "target", "left").withColumn("part", part)
    parts = F.when(often, F.sequence(zero, zero + (SALTS - 1))).otherwise(F.array(zero))
    found = fitting(urls, rules).join(urls, "target").select("target", "rule", "rank", "verdict", F.explode(parts).alias("part"))
    answer = dealt.join(found, ["target", "part"], "left")
    given = F.col("row")[url]
    return answer.select("row", host(given).alias("host"), path(given).alias("path"), "rule", "rank", "verdict")


def report(pages: DataFrame) -> DataFrame:
    """(page_id, host, path, rule, verdict): site rules first, then the patterns; allowed where neither fits."""
    sites = [(rule, f"||{rule}", verdict, 1) for rule, verdict in SITES]
    rules = rule_table(pages.sparkSession, [*sites, *((p, p, verdict, 0) for p, verdict in PATTERNS)])
    found = judged(pages.select("page_id", "url"), rules)
    site = F.when(F.col("rank") == 1, F.col("rule")).alias("rule")
    return found.select("row.page_id", "host", "path", site, F.coalesce("verdict", F.lit(ALLOW)).alias("verdict"))


SQL = """
WITH cut AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
    SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '(?s)^[^/?#]*(.*)', 1) AS tail
    FROM cut
), ruled AS (
    SELECT *, '.' || host AS inner_host, CASE
        WHEN '.' || host LIKE '%.example.net' AND path LIKE '/en/%' THEN 'example.net/en/'
        WHEN '.' || host LIKE '%.example.com' AND path LIKE '/de/%' THEN 'example.com/de/'
        WHEN '.' || host LIKE '%.org' AND path LIKE '/fr/%' THEN 'org/fr/'
        WHEN '.' || host LIKE '%.net' AND path LIKE '/%' THEN 'net/' END AS rule
    FROM parts
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow'
    WHEN rule IS NOT NULL THEN 'block'
    WHEN inner_host LIKE '%.ads-%' OR inner_host LIKE '%.adult-%' OR inner_host LIKE '%.casino-%' OR inner_host LIKE '%.cheap-pills.%'
      OR inner_host LIKE '%.free-bets.%' OR inner_host LIKE '%.spam-%' THEN 'block'
    WHEN tail LIKE '%/adult/%' OR regexp_matches(tail, '/casino([^a-zA-Z0-9_.%-]|$)') OR tail LIKE '%?%utm\\_medium=affiliate%' ESCAPE '\\' THEN 'block'
    ELSE 'allow' END AS verdict
FROM ruled
"""
