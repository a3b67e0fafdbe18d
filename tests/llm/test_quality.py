"""Document statistics against brute force; learned lists on planted rules and on given labels."""

from __future__ import annotations

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from ferry.llm import quality
from ferry.llm.tables import read

SF = "/root/testdata/sf0.01"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


def test_statistics_equal_brute_force(spark):
    rng = random.Random(8)
    texts = [None, "", " \n\t", "a", "a b", "a a a", "a a a a", "x\x0by\x0cz\r\n\nx\x0by\x0cz\n ", "##é <b>|& 🙂", "l\nl\nl \n\nl", "a b c d a b c e a b c " * 40, "a\xa0b c\x85d\x1ce"]
    vocab = ["the", "of", "Ünï", "q*", "\n", "\n\n", "z"]
    texts += [" ".join(rng.choice(vocab) for _ in range(rng.randrange(200))) for _ in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(None, "a b"), (2, " \n\t")], "doc_id long, text string")
    docs = docs.withColumns({"n_words": F.lit("x"), "_words": F.lit(1), "id": F.lit(0), "low": F.lit(1)})
    labels = spark.createDataFrame([(1, 0), (None, 1), (3, None)], "doc_id long, quality int")
    rows = quality.report(docs, labels).collect()
    got = sorted((r.doc_id, *tuple(r)[1:7]) for r in rows if r.doc_id is not None)
    assert got == sorted([(i, *brute(t)) for i, t in enumerate(texts)] + [(2, *brute(" \n\t"))])
    assert all(r.kept == (not r.base_failed) for r in rows)


def test_given_documents(spark):
    docs, labels = read(spark, SF, "documents"), read(spark, SF, "labels")
    truth = {r.doc_id: r.quality for r in labels.collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = quality.report(docs, labels).collect()
    assert all(tuple(r)[1:7] == brute(texts[r.doc_id]) for r in rows)
    good = [r for r in rows if truth.get(r.doc_id) == 1 and not r.base_failed]
    bad = [r for r in rows if truth.get(r.doc_id) == 0]
    assert sum(r.kept for r in good) >= 0.98 * len(good)
    assert sum(not r.kept for r in bad) >= 0.8 * len(bad)


def test_planted_rules_are_found(spark):
    rng = random.Random(3)
    docs, labels = [], []
    for i in range(1500):
        kind = rng.randrange(3)
        words = [rng.choice(["alpha", "beta", "gamma", "delta"]) + str(rng.randrange(900)) for _ in range(rng.randrange(60, 90))]
        if kind == 1:
            words = [w[:-1] + "#" for w in words]
        if kind == 2:
            words = [w.upper() for w in words]
        docs.append((i, " ".join(words)))
        labels.append((i, int(kind == 0)))
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")
    rules = quality.learn(quality.statistics(frames[0]), frames[1])
    assert 2 <= len(rules) <= 3 and all(len(r) <= 2 for r in rules)
    kept = {r.doc_id: r.kept for r in quality.report(*frames).collect()}
    assert kept == {i: bool(q) for i, q in labels}


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "w " * 60), (2, " ".join(map(str, range(70))))], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.doc_id: r.kept for r in quality.report(docs, none).collect()} == {1: False, 2: True}
    assert quality.report(docs.limit(0), none).count() == 0
