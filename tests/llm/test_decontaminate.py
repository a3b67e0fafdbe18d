"""Decontamination against brute force and against its SQL."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from ferry.llm import decontaminate
from tools.check import compare, open_tables

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    grams = []
    for item, text in items:
        w = words(text)
        k = min(13, len(w))
        grams += [("" if item is None else str(item), w[i : i + k]) for i in range(len(w) - k + 1) if k]
    for doc_id, text in docs:
        w, hit, named = words(text), set(), set()
        for item, g in grams:
            for i in range(len(w) - len(g) + 1):
                if w[i : i + len(g)] == g:
                    hit.update(range(i, i + len(g)))
                    named.add(item)
        digest = hashlib.sha256(",".join(sorted(named)).encode()).hexdigest()
        yield doc_id, len(w), len(hit), len(named), digest, bool(hit) and 20 * len(hit) >= len(w)


def fixture():
    rng = random.Random(11)
    vocab = [f"w{i}" for i in range(9)] + ["É", "naïve", "x1"]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(n))) for i, n in enumerate([40, 13, 12, 5, 3, 0, 25])]
    items += [(0, items[0][1]), (None, "alone here"), (77, None), (78, "?!")]
    docs = [(0, None), (1, ""), (2, "... !"), (3, items[0][1].upper()), (3, "Alone-HERE"), (None, items[1][1])]
    for i in range(40):
        text = " ".join(rng.choice(vocab) for _ in range(rng.randrange(1, 300)))
        if i % 2:
            text += f" ({(rng.choice(items)[1] or '').replace(' ', '--')}) "
        docs.append((10 + i, text))
    return docs, [(i, t) for i, t in items]


@pytest.mark.parametrize("per_block", [7, 1_000_000])
def test_equals_brute_force(spark, per_block, monkeypatch):
    docs, items = fixture()
    monkeypatch.setattr(decontaminate, "find", lambda d, b, find=decontaminate.find: find(d, b, per_block=per_block))
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS n_words", "'x' AS items", "2 AS row")
    got = decontaminate.report(frame, spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute(docs, items), key=repr)


def test_equals_sql(spark):
    assert compare(spark, open_tables("/root/testdata/sf0.001"), "op8_benchmark_decontamination", "/root/testdata/sf0.001") == ""


def test_removal(spark):
    passage = " ".join(f"p{i}" for i in range(15))
    docs = spark.createDataFrame([(1, "clean words stay"), (2, f"Before, [{passage}] after."), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([(5, passage)], "item_id long, text string")
    assert sorted(r[0] for r in decontaminate.without_documents(docs, items).collect()) == [1, 3]
    cut = {r.doc_id: r.text for r in decontaminate.without_spans(docs, items).collect()}
    assert cut == {1: "clean words stay", 2: "Before, [] after.", 3: None}


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r)[1:4] for r in decontaminate.report(docs, none).collect()] == [(2, 0, 0)]
    assert decontaminate.report(docs.limit(0), none).count() == 0
