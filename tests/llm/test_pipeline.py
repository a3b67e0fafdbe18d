"""The pipeline: its stages on given documents, each against the brute-force version of its operator."""

from __future__ import annotations

from collections import defaultdict

import corpus_pipeline
from ferry.llm import toxicity
from ferry.llm.tables import read, written
from ferry.llm.queries import QUERIES
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_lines import brute as deduplicated
from tests.llm.test_simhash import brute_components, brute_print

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "best_fit_packing"]
    docs, seen = read(spark, SF, "documents"), []
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, docs, SF), name)
        assert name == names[-1] or out.columns == columns
        seen.append((docs.collect(), out.collect()))
        docs = out
    toxic, lined, hashed, clean, packed = seen

    gone = {r.doc_id for r in toxicity.report(read(spark, SF, "documents"), read(spark, SF, "labels")).where("predicted = 1").collect()}
    assert {r.doc_id for r in toxic[1]} == {r.doc_id for r in toxic[0]} - gone

    want, _ = deduplicated([(r.doc_id, r.text) for r in lined[0]])
    assert {r.doc_id: r.text for r in lined[1]} == want
    assert all(r.n_chars == len(r.text) for r in lined[1])

    prints = {r.doc_id: brute_print(r.text) for r in hashed[0]}
    of = brute_components(sorted(set(prints.values())), lambda a, b: (a ^ b).bit_count() <= 2)
    first = {}
    for i in sorted(prints):
        first.setdefault(of[prints[i]], i)
    assert {r.doc_id for r in hashed[1]} == set(first.values())

    items = [(r.item_id, r.text) for r in read(spark, SF, "benchmark").collect()]
    bad = {row[0] for row in contaminated([(r.doc_id, r.text) for r in clean[0]], items) if row[-1]}
    assert {r.doc_id for r in clean[1]} == {r.doc_id for r in clean[0]} - bad

    held = defaultdict(list)
    for r in packed[1]:
        held[r.sequence_id].append((r.offset, r.length))
    assert {r.doc_id for r in packed[1]} == {r.doc_id for r in packed[0]}
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096


def test_run_and_registration(spark):
    import __spark_entry__

    assert {"pipeline", *QUERIES} <= set(__spark_entry__.queries())
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 11))
    assert corpus_pipeline.run(spark, SF).count() > 0


def odd_documents(spark):
    """Nulls in every column, repeated rows, empty and long texts, and columns named as operators name theirs."""
    rows = [(None, None, None, None, None), (1, None, "en", "s", 0), (2, "", None, None, None), (2, "", None, None, None)]
    rows += [(3, "word " * 60_000, "en", "s", 5), (None, "Only this line.", "en", "s", 15), (4, "\n \n\x0b", "en", "s", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    clash = ("row", "id", "score", "whole", "print", "key", "gone", "at", "line", "items", "n_words", "inputs", "piece", "length", "rank", "part", "kind", "n")
    return docs.selectExpr("*", *(f"'x' AS `{c}`" for c in clash))


def test_odd_documents_pass_every_stage(spark):
    docs = odd_documents(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        rows = out.collect()
        assert out.columns == docs.columns, name
        assert {r.doc_id for r in rows} >= ({1} if name == "simhash_near_dedup" else {1, 2, 3, 4}), name
        assert stage(spark, docs.limit(0), SF).count() == 0, name
    lined = dict(corpus_pipeline.STAGES)["line_dedup"](spark, docs, SF).collect()
    assert sorted(repr((r.doc_id, r.text)) for r in lined) == sorted(repr((r.doc_id, r.text)) for r in docs.collect())
    packed = dict(corpus_pipeline.STAGES)["best_fit_packing"](spark, docs, SF).collect()
    assert sum(r.piece == 0 for r in packed) == 7 and max(r.length for r in packed) == 4096


def test_odd_documents_pass_every_operator(spark):
    from ferry.llm import language_model, lines, personal, quality, sharding, simhash

    docs, labels = odd_documents(spark), read(spark, SF, "labels")
    counts = {
        "sharding": sharding.report(docs, ["doc_id", "source", "lang", "n"], 3),
        "toxicity": toxicity.report(docs, labels),
        "quality": quality.report(docs, labels),
        "lines": lines.deduplicated(docs),
        "personal": personal.report(docs),
        "language_model": language_model.report(docs, iterations=1),
        "simhash": simhash.near_duplicates(docs),
    }
    assert {k: v.count() for k, v in counts.items()} == dict.fromkeys(counts, 7)
