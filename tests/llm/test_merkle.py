"""Merkle manifests: equal to trees built one by one, with proofs that hold and break."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from ferry.llm import merkle


def h(*inputs: str) -> str:
    return hashlib.sha256("".join(inputs).encode()).hexdigest()


def frame_(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(leaves: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """The root and every leaf's siblings, level by level."""
    ways, of, nodes = [[] for _ in leaves], [[i] for i in range(len(leaves))], leaves
    while len(nodes) > 1:
        up, held = [], []
        for at in range(0, len(nodes), 8):
            run = nodes[at : at + 8]
            for k in range(len(run)):
                for leaf in of[at + k]:
                    ways[leaf].append(("".join(run[:k]), "".join(run[k + 1 :])))
            up.append(h(*run))
            held.append([x for o in of[at : at + 8] for x in o])
        nodes, of = up, held
    return nodes[0], ways


def brute(docs: list[tuple]) -> list[tuple]:
    def lower(text):
        return text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)

    groups = defaultdict(list)
    for doc_id, source, lang, n_chars, text in docs:
        leaf = h(*map(frame_, (doc_id, source, lang, n_chars, text)))
        tampered = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0
        tried = h(*map(frame_, (doc_id, source, lang, n_chars, lower(text)))) if tampered else leaf
        groups[lang].append((doc_id is not None, doc_id or 0, leaf, doc_id, tried))
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    small = {g: (sorted(groups[g]), tree([x[2] for x in sorted(groups[g])])) for g in names}
    root, above = tree([small[g][1][0] for g in names]) if names else (None, [])
    rows = []
    for g, over in zip(names, above):
        members, (subroot, ways) = small[g]
        for (_, _, leaf, doc_id, tried), way in zip(members, ways):
            at = tried
            for before, after in (*way, *over):
                at = h(before, at, after)
            rows.append((doc_id, leaf, subroot, root, h(*(b + a for b, a in (*way, *over))), at, at == root))
    return sorted(rows, key=repr)


def made(n: int, langs: list[str | None], seed: int = 1) -> list[tuple]:
    rng = random.Random(seed)
    texts = ["Hello World", "hello", "", None, "ÀÉ B", "x" * 30_000, "A\x00b"]
    return [(rng.randrange(-50, 400), rng.choice(["s", None, "é"]), rng.choice(langs), rng.choice([None, 5]), rng.choice(texts)) for _ in range(n)]


SHAPES = {
    "many_groups": made(300, [None, "", "a", "b", "B", "é", *(f"g{i}" for i in range(90))]),
    "one_group": made(200, ["en"]),
    "hot_group": made(600, ["en"] * 20 + ["de", "fr", None]),
    "lone_leaf": made(1, ["en"]),
    "lone_leaves": [(i, "s", f"l{i}", 1, "T") for i in range(10)],
    "repeated": [(1, "s", "en", 1, "A")] * 70 + [(1, "s", "en", 1, "B")] * 9 + [(None, None, None, None, None)] * 3 + [(9, "s", "de", 1, "A")],
    "empty": [],
}


def frame(spark, docs):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    return spark.createDataFrame(docs, schema).selectExpr("*", "1 AS id", "2 AS digest", "3 AS `row`", "4 AS idx", "5 AS grp", "6 AS leaf", "7 AS up")


@pytest.mark.parametrize("shape", SHAPES)
def test_equals_trees_built_one_by_one(spark, shape):
    rows = merkle.report(frame(spark, SHAPES[shape]).repartition(5)).collect()
    assert sorted(map(tuple, rows), key=repr) == brute(SHAPES[shape])


def test_ancestors_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(merkle, "ANCESTOR_BYTES", 0)
    monkeypatch.setattr(merkle, "COUNTED_ROWS", 0)
    rows = merkle.report(frame(spark, SHAPES["hot_group"])).collect()
    assert sorted(map(tuple, rows), key=repr) == brute(SHAPES["hot_group"])
    assert {r["verified"] for r in rows} == {True, False}
