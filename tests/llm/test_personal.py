"""Personal data against plain regular expressions, and discovery in planted contexts."""

from __future__ import annotations

import hashlib
import random
import re

from pyspark.sql import functions as F

from ferry.llm import personal
from ferry.llm.tables import read

FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def brute(text):
    spans = [(m.start(), k, m.end(), kind) for k, (kind, form) in enumerate(FORMS.items()) for m in re.finditer(form, text or "") if valid(kind, m[0])]
    counts = [sum(s[3] == kind for s in spans) for kind in FORMS]
    return *counts, hashlib.sha256(",".join(f"{s[3]}:{s[0]}:{s[2]}" for s in sorted(spans)).encode()).hexdigest()


TEXTS = [
    None, "", "a@b.c", "x.y_z%+-@h-1.example.com, a@b@c.d e@f..g a@b.c_d@e.f a@b.c.d@e.f ..@x.y. @a.b a@.b a@b.", "1.2.3.4.5.6.7.8 256.1.1.1 0001.002.3.255 999.1.1.1.1 1.2.3",
    "4111 1111 1111 1111 4111-1111-1111-1111, 4111  1111 79927398713 378282246310005 30569309025904 6304-9850-0000-0000-000",
    "+1 (555) 010-9999 +49 30 1234567. +1-2 ++44 20 7946 0958) +12345678901234567", "é🙂 mail: ü a@b.co +1 555 010 99 88  4111111111111111 a@bc x@y.z",
    "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 " * 9, "12" * 3000, "a" * 60_000 + "@", "a@" + "b." * 20_000 + "c", "1 " * 30_000, "+1" + " " * 30_000, "9." * 30_000, " ".join(f"u{i}@h.org" for i in range(3000)),
]


def noise(n=150, seed=3):
    rng = random.Random(seed)
    alphabet = "019.-+@ab (%_é"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(120))) for _ in range(n)] + [
        " ".join(rng.choice(["4111111111111111", "1.1.1.1", "a.b@c.de", "+1 555 0109988", "7", "-", "é"]) for _ in range(12)) for _ in range(40)
    ]


def test_fixed_kinds_equal_plain_expressions(spark):
    texts = TEXTS + noise()
    docs = spark.createDataFrame(list(enumerate(texts)) + [(None, "a@b.c"), (2, "a@b.c")], "doc_id long, text string")
    docs = docs.withColumns({"whole": F.lit("x"), "_text": F.lit(1), "spans": F.lit(2), "kind": F.lit(3)})
    rows = personal.report(docs).collect()
    assert len(rows) == len(texts) + 2
    wrong = [texts[r.doc_id] for r in rows if r.doc_id is not None and tuple(r)[1:6] != brute(texts[r.doc_id])]
    assert wrong == []
    assert all(hashlib.sha256(r.spans.encode()).hexdigest() == r.base_sha256 for r in rows if r.doc_id in (1, 2, 3))


def test_given_documents(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(tuple(r)[1:6] == brute(texts[r.doc_id]) for r in personal.report(docs).collect())


def test_patterns_discover_unseen_identifiers(spark):
    rng = random.Random(1)
    vocab = [f"wort{chr(97 + i)}" for i in range(26)]
    filler = lambda: " ".join(rng.choice(vocab) for _ in range(12))
    rows = [(i, f"{filler()} call us at +1 555 010 {1000 + i} today. {filler()}") for i in range(12)]
    unseen = "555-0199-77"
    text = f"{filler()} call us at {unseen} today. Ordered {filler()} version 2024-55 of it"
    rows += [(100, text), (101, f"{filler()} order 2024-{55} {filler()}"), (102, f"in room 12345 {filler()}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in personal.report(docs).collect()}
    at = text.index(unseen)
    assert got[100].spans == f"phone:{at}:{at + len(unseen)}" and got[100].n_phone == 0
    assert got[101].spans == got[102].spans == ""
    assert all(got[i].n_phone == 1 and got[i].spans.count(":") == 2 for i in range(12))
    clean = {r.doc_id: r.text for r in personal.redacted(docs).collect()}
    assert clean[100] == text.replace(unseen, "<phone>") and clean[102] == rows[-1][1]
    assert "call us at <phone> today" in clean[3]


def test_empty_table(spark):
    assert personal.report(spark.createDataFrame([], "doc_id long, text string")).count() == 0
