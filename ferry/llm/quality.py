"""Quality rules: decision lists learned by sequential covering over document statistics.

The statistics are Spark expressions, and so is the learned list: an ordered ``CASE`` of threshold
conjunctions. Learning looks at histograms of the labelled rows only: per rule, conditions are added
while they gain on two thirds of the rows, then cut back to where the rule does best on the other third.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame, functions as F

from ferry.llm.tables import written

#: Words of a window whose repetition counts.
WINDOW = 3
LEAST_WORDS = 50
#: Percent of words in repeated windows above which a text fails.
MOST_REPEATED = 50
#: Thresholds that are tried of each statistic, at its quantiles over the labelled rows.
QUANTILES = 63
MOST_RULES, MOST_CONDITIONS = 16, 4
#: A rule must hold for so many low-quality rows, and be right for this share of the rows that judge it.
LEAST_COVERED, LEAST_PRECISION = 5, 0.9

_SPACE = "[\\x20\\x09-\\x0D]+"


def _share(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))


#: What the rules may test, from the counts of ``statistics``.
FEATURES: dict[str, tuple[str, str | None]] = {
    "words": ("n_words", None),
    "letters_per_word": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "duplicate_lines": ("n_dup_lines", "n_lines"),
    "repeated_words": ("n_repeat_words", "n_words"),
    "distinct_words": ("n_distinct", "n_words"),
    "capitals": ("n_upper", "word_chars"),
    "exclamations": ("n_exclamations", "n_words"),
    "digits": ("n_digits", "word_chars"),
    "words_per_line": ("n_words", "n_lines"),
}


def feature(name: str) -> Column:
    part, whole = FEATURES[name]
    return F.col(part).cast("double") if whole is None else _share(part, whole)


def _left_by(pattern: str, text: str = "_text") -> Column:
    """How many characters remain when all matches are taken out."""
    return F.char_length(F.regexp_replace(text, pattern, "")).cast("bigint")


def _repeated_words(words: str = "_words") -> list[tuple[str, Column]]:
    """Steps that lead to ``n_repeat_words``: windows by their hash, those that have an equal neighbour, their positions."""
    n = F.size(words)
    window = lambda i: F.struct(F.xxhash64(*(F.col(words)[i + k] for k in range(WINDOW))).alias("h"), i.alias("at"))
    windows = F.when(n >= WINDOW, F.transform(F.sequence(F.lit(0), n - WINDOW), window))
    equal = lambda i, x: F.coalesce(F.get("_windows", i)["h"] == x["h"], F.lit(False))
    again = F.filter("_windows", lambda x, i: equal(i - 1, x) | equal(i + 1, x))
    # A window covers its words up to where the next repeated one starts.
    covers = F.transform("_again", lambda at, i: F.least(F.lit(WINDOW), F.coalesce(F.get("_again", i + 1) - at, F.lit(WINDOW))))
    return [
        ("_windows", F.sort_array(windows)),
        ("_again", F.sort_array(F.transform(again, lambda x: x["at"]))),
        ("n_repeat_words", F.coalesce(F.aggregate(covers, F.lit(0).cast("bigint"), lambda a, x: a + x), F.lit(0).cast("bigint"))),
    ]


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_upper", "n_exclamations", "n_digits"]


def statistics(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, the counts) of every whole text; a null text has no words. Repeated rows each come back."""
    rows = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    rows = rows.withColumn("_words", F.array_remove(F.split("_text", _SPACE), ""))
    rows = rows.withColumn("_lines", F.filter(F.split("_text", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")))
    rows = rows.withColumns(
        {
            "n_words": F.size("_words").cast("bigint"),
            "word_chars": F.char_length(F.array_join("_words", "")).cast("bigint"),
            "n_symbols": _left_by("[^#*$%&|<>]+"),
            "n_lines": F.size("_lines").cast("bigint"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
            "n_distinct": F.size(F.array_distinct("_words")).cast("bigint"),
            "n_upper": _left_by("\\P{Lu}+"),
            "n_exclamations": _left_by("[^!]+"),
            "n_digits": _left_by("[^0-9]+"),
        }
    )
    for name, column in _repeated_words():
        rows = rows.withColumn(name, column)
    return rows.select("id", *COUNTS)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float
    #: The threshold's place among those tried.
    place: int

    def holds(self) -> Column:
        value = feature(self.feature)
        return value > self.threshold if self.above else value <= self.threshold

    def holds_in_bins(self) -> Column:
        bin_ = F.col("bins")[self.feature]
        return bin_ > self.place if self.above else bin_ <= self.place

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:g}"


Rule = tuple[Condition, ...]


def verdict(rules: list[Rule]) -> Column:
    """The decision list: false at the first rule that holds, true if none does."""
    out = F.lit(True)
    for rule in reversed(rules):
        out = F.when(_all(c.holds() for c in rule), F.lit(False)).otherwise(out)
    return out


def _all(conditions) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def learn(stats: DataFrame, labels: DataFrame, id: str = "doc_id", label: str = "quality") -> list[Rule]:
    """Rules for low quality (label 0), in order, learned from all labelled rows.

    Null labels and ids are not learned from; an id with several labels counts as low if one says so. If
    either class is missing there are no rules. Each step is one aggregation; the driver sees counts of
    bins: features times thresholds.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(id).isNotNull())
    known = known.groupBy(F.col(id).alias("id")).agg((F.min(label) == 0).alias("low"))
    rows = stats.join(known, "id")
    quantiles = [i / (QUANTILES + 1) for i in range(1, QUANTILES + 1)]
    found = rows.agg(*(F.percentile_approx(feature(f), quantiles, 10_000).alias(f) for f in FEATURES)).first()
    if found[0] is None:
        return []
    tried = {f: sorted({*found[f]}) for f in FEATURES}
    below = lambda f: F.size(F.filter(F.array(*map(F.lit, tried[f])), lambda t: t < feature(f)))
    bins = F.struct(*(below(f).cast("int").alias(f) for f in FEATURES))
    judged = F.pmod(F.xxhash64("id"), F.lit(3)) == 0
    binned = written(rows.select("low", judged.alias("judged"), bins.alias("bins")), "binned")

    rules: list[Rule] = []
    left = binned
    while len(rules) < MOST_RULES:
        rule = _pruned(left.where("judged"), _grown(left.where("NOT judged"), tried))
        if not rule:
            break
        rules.append(rule)
        left = left.where(~_all(c.holds_in_bins() for c in rule))
    return rules


def _grown(rows: DataFrame, tried: dict[str, list[float]]) -> Rule:
    """Add the condition that gains most information about low quality until none does."""
    rule: Rule = ()
    while len(rule) < MOST_CONDITIONS:
        covered = rows.where(_all(c.holds_in_bins() for c in rule))
        each = F.explode(F.array(*(F.struct(F.lit(f).alias("f"), F.col("bins")[f].alias("bin")) for f in tried)))
        counts = covered.select("low", each.alias("x")).groupBy("x.f", "x.bin").agg(
            F.count_if("low").alias("low"), F.count_if(~F.col("low")).alias("high")
        )
        table: dict[str, dict[int, tuple[int, int]]] = {f: {} for f in tried}
        for r in counts.collect():
            table[r["f"]][r["bin"]] = (r["low"], r["high"])
        first = next(iter(table.values()))
        low, high = (sum(x[i] for x in first.values()) for i in (0, 1))
        if low < LEAST_COVERED or not high:
            break
        best, gained = None, 1e-9
        for f, thresholds in tried.items():
            p = n = 0
            for k, threshold in enumerate(thresholds):
                more = table[f].get(k, (0, 0))
                p, n = p + more[0], n + more[1]
                for above, a, b in ((False, p, n), (True, low - p, high - n)):
                    gain = a * (log2(a / (a + b)) - log2(low / (low + high))) if a >= LEAST_COVERED else 0
                    if gain > gained:
                        best, gained = Condition(f, above, threshold, k), gain
        if best is None:
            break
        rule += (best,)
    return rule


def _pruned(rows: DataFrame, rule: Rule) -> Rule:
    """The beginning of the rule that is right most often on rows it was not grown on, if often enough."""
    if not rule:
        return ()
    holds = [_all(c.holds_in_bins() for c in rule[:k]) for k in range(1, len(rule) + 1)]
    r = rows.agg(*(F.count_if(h & x).alias(f"{n}{k}") for k, h in enumerate(holds) for n, x in (("low", F.col("low")), ("high", ~F.col("low"))))).first()
    shares = [r[f"low{k}"] / max(1, r[f"low{k}"] + r[f"high{k}"]) for k in range(len(rule))]
    k = max(range(len(rule)), key=lambda k: (shares[k], -k))
    return rule[: k + 1] if shares[k] >= LEAST_PRECISION else ()


def report(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: the counts, whether the base rules fail it, and whether it is kept.

    A text without words fails the base rules, and is not kept. Empty tables give an empty result.
    """
    stats = written(statistics(docs, id, text), "statistics")
    keep = verdict(learn(stats, labels, id))
    return stats.select(
        F.col("id").alias(id), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"), (~base_failed() & keep).alias("kept"),
    )
