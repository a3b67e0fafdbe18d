"""Packing: exact round trips of the ids, whole and gapless sequences, and close to the lower bound."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from ferry.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def ids_of(text: str | None) -> list[int]:
    return [*Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids, 1]


def check(rows, docs, capacity):
    whole, held = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r["length"] == len(r["ids"]) // 4 and zlib.crc32(r["ids"]) == r["ids_crc32"]
        whole[r["doc_id"]].append((r["piece"], r["start"], r["ids"]))
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for doc_id, text in docs.items():
        parts, ids = sorted(whole.pop(doc_id)), ids_of(text)
        assert [p[0] for p in parts] == list(range(len(parts)))
        assert [p[1] for p in parts] == list(range(0, len(ids), capacity))
        assert np.frombuffer(b"".join(p[2] for p in parts), "<u4").tolist() == ids
    assert not whole
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


def test_round_trip(spark):
    rng = random.Random(2)
    odd = ["", None, " \t\n", "A\x1cb\xa0c\x85d", "naïve É. É— —. 'S it's. x.'s", "<|endoftext|> <|ENDOFTEXT|> a<|startoftext|>b", "J̌ K İ é. ́.", "12.34,5 ... ?!.", "long " * 3000, "日本語。テキスト. 🙂."]
    words = ["the", "Straße,", "worthless.", "x1", "Ça", "Élan***", "İx", "ΣΑΣ!", "(and)", "e.g.", "don't!"]
    docs = dict(enumerate([*odd, *(" ".join(rng.choice(words) for _ in range(rng.randrange(900))) for _ in range(60))]))
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string").selectExpr("*", "1 AS piece", "2 AS ids", "3 AS id")
    rows = packing.packed(frame, PATH, capacity=512, with_ids=True).collect()
    used = check(rows, docs, 512)
    assert used <= 1.03 * sum(r["length"] for r in rows) / 512 + 1


def test_repeated_and_null_ids(spark):
    frame = spark.createDataFrame([(1, "a b")] * 3 + [(None, "c")], "doc_id long, text string")
    rows = packing.packed(frame, PATH).collect()
    assert sorted(r["offset"] for r in rows) == [0, 2, 5, 8] or len({r["sequence_id"] for r in rows}) == 1
    assert packing.packed(frame.limit(0), PATH).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plans_hold_every_length_once(seed):
    rng = random.Random(seed)
    draw = [lambda: rng.randrange(1, 4097), lambda: min(4096, int(rng.lognormvariate(6, 1.5)) + 1), lambda: rng.choice([1400, 1300, 2100, 900, 30]), lambda: rng.choice([2049, 4096]), lambda: rng.randrange(1366, 2000), lambda: 1][seed]
    lengths = Counter(draw() for _ in range(20_000))
    groups = packing.plan(dict(lengths))
    held = Counter()
    for g in groups:
        assert sum(a * b for a, b in g.holds) <= 4096
        for length, each in g.holds:
            held[length] += each * g.count
    assert held == lengths
    used, least = sum(g.count for g in groups), -(-sum(k * n for k, n in lengths.items()) // 4096)
    if seed in (0, 1):
        assert used <= (1.05, 1.01)[seed] * least + 1
    if seed == 3:
        assert used == 20_000
    if seed == 4:
        assert used == 10_000


def test_best_fit_only_of_nothing():
    assert packing.plan({}) == []
