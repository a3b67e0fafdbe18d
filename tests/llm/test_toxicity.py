"""Toxicity scores: held-out accuracy, brute-force features, and that labels of the held-out third are not used."""

from __future__ import annotations

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from ferry.llm import toxicity
from ferry.llm.tables import read

SF = "/root/testdata/sf0.01"


def made(n=900, seed=4):
    rng = random.Random(seed)
    vocab = [f"wort{i}" for i in range(400)] + ["Él", "the"]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(vocab) for _ in range(rng.randrange(5, 120))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(rng.randrange(2, 6)):
                words.insert(rng.randrange(len(words)), rng.choice(["Idiot!", "scum,", "trash"]))
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return docs, labels


def test_held_out_documents_are_told_apart(spark):
    docs, labels = made()
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    truth = dict(labels)
    got = toxicity.report(frames[0].withColumns({"score": F.lit("x"), "id": F.lit(1), "row": F.lit(0)}), frames[1]).collect()
    assert len(got) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in got)
    out = [r for r in got if r.held_out]
    assert sum(r.predicted == truth[r.doc_id] for r in out) >= 0.97 * len(out)
    kept = {r[0] for r in toxicity.without_toxic(*frames).select("doc_id").collect()}
    assert kept == {r.doc_id for r in got if not r.predicted}
    # Held-out labels may say anything.
    lies = frames[1].withColumn("toxic", F.when(toxicity.learnable("doc_id"), F.col("toxic")).otherwise(1 - F.col("toxic")))
    again = {r.doc_id: r.score for r in toxicity.report(frames[0], lies).collect()}
    assert again == {r.doc_id: r.score for r in got}


def test_given_documents_keep_clean_ones(spark):
    docs, labels = read(spark, SF, "documents"), read(spark, SF, "labels")
    got = toxicity.report(docs, labels).join(labels, "doc_id").where("held_out").collect()
    clean = [r for r in got if not r.toxic]
    assert sum(r.predicted for r in clean) <= 0.01 * len(clean) + 1


def brute_features(text):
    folded = "".join(c if ord(c) > 127 or c.isalnum() else " " for c in text.lower())
    ids = [zlib.crc32(w.encode()) + 1 for w in folded.split(" ") if w]
    m, f, out = (1 << 64) - 1, [int(x) for x in toxicity._FACTORS], set()
    for i, a in enumerate(ids):
        raw = [a * f[0]] + [a * f[k] + (ids[i + k] ^ k) * f[0] for k in toxicity.SKIPS if i + k < len(ids)]
        for h in raw:
            h &= m
            out.add(((h ^ h >> 29) * f[1] & m) >> 64 - toxicity.BITS)
    return out


def test_features_equal_brute_force():
    for text in ("", "One", "one two", "A b-c. Ünï x9 a b " * 5):
        assert set(toxicity.features(text).tolist()) == brute_features(text)


def test_updates_equal_scalar_formula():
    model, rng = toxicity.Ftrl(), np.random.default_rng(1)
    z, n = {}, {}
    for _ in range(200):
        at, y = np.unique(rng.integers(0, 30, 5)), int(rng.integers(0, 2))

        def weight(i):
            zi = z.get(i, 0.0)
            if abs(zi) <= toxicity.L1:
                return 0.0
            return -(zi - np.sign(zi) * toxicity.L1) / ((toxicity.BETA + n.get(i, 0.0) ** 0.5) / toxicity.ALPHA + toxicity.L2)

        every = [*at.tolist(), 1 << toxicity.BITS]
        g = 1 / (1 + np.exp(-sum(map(weight, every)))) - y
        old = {i: weight(i) for i in every}
        for i in every:
            grown = (n.get(i, 0.0) + g * g) ** 0.5
            z[i] = z.get(i, 0.0) + g - (grown - n.get(i, 0.0) ** 0.5) / toxicity.ALPHA * old[i]
            n[i] = n.get(i, 0.0) + g * g
        model.learn(at, y)
    assert all(abs(model.z[i] - z[i]) < 1e-9 for i in z)


def test_nulls_repeats_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, None), (1, None), (None, ""), (2, "a " * 30_000)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, None), (None, 1), (2, 0), (2, 1)], "doc_id long, toxic int")
    got = toxicity.report(docs, labels).collect()
    assert len(got) == 4 and len({r.score for r in got if r.doc_id != 2}) == 1
    assert {r.score for r in toxicity.report(docs, labels.limit(0)).collect()} == {0.5}
    assert toxicity.report(docs.limit(0), labels).count() == 0


def test_workers_give_up_what_earlier_stages_left_and_remember_no_words(spark):
    import pyarrow as pa

    from ferry.llm import tables

    texts = pa.record_batch([pa.array(["some words of a text", None])], names=["text"])
    weights = {"dense": np.zeros((1 << toxicity.BITS) + 1)}
    learn = pa.record_batch([pa.array([[1, 2], [], [3]], pa.list_(pa.int32())), pa.array([1, 0, 0])], names=["features", "label"])
    for step in (toxicity._featured, lambda b: toxicity._scored(weights, b), lambda b: list(toxicity._learned(iter([learn.slice(1), learn])))):
        tables.CACHES.setdefault("packing", {})["left"] = b"x"
        step(texts)
        assert not any(tables.CACHES.values())
