"""Shards: near equal bytes, gapless slots, and cuts that equal brute force over sorted rows."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ferry.llm import sharding
from ferry.llm.tables import read


def check(rows, texts, count):
    by_shard, sizes = defaultdict(list), Counter()
    assert len(rows) == len(texts)
    for r in rows:
        by_shard[r["shard"]].append(r["slot"])
        sizes[r["shard"]] += r["size"]
        assert 0 <= r["shard"] < count
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    want = sorted((len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for t in texts)
    assert sorted((r["size"], r["text_crc32"]) for r in rows) == want
    return sizes


@pytest.mark.parametrize("count", [1, 7, 40])
def test_bytes_are_near_equal(spark, count):
    rng = random.Random(count)
    texts = ["x" * int(rng.paretovariate(1.2) * 20) for _ in range(1500)] + ["same ä"] * 700
    docs = [(i, t[:4000], "src0" if i % 3 else f"src{i % 17}", None if i % 11 == 0 else "en") for i, t in enumerate(texts)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string, lang string")
    clash = frame.withColumns({"size": F.lit("s"), "shard": F.lit(1), "row": F.lit(2), "id": F.lit("z"), "crc": F.lit(0)})
    rows = sharding.report(clash, ["doc_id", "source", "lang"], count).collect()
    sizes = check(rows, [d[1] for d in docs], count)
    mean = sum(sizes.values()) / count
    assert max(sizes.values()) - mean <= 4016 and mean - min(sizes.values()) <= 4016
    assert all(r["law"] == "bytes" and r["grown_shard"] is None for r in rows)


def test_cut_equals_sorted_rows(spark):
    rng = random.Random(9)
    rows = [(rng.randrange(1 << 61), rng.randrange(1, 50)) for _ in range(3000)] + [(5 << 33, 400)] * 20
    frame = spark.createDataFrame(rows, "_key__dim_0 long, size long")
    tree = sharding.grow(frame, ["_dim_0"], 3)
    total, below, cut = sum(s for _, s in rows), 0, None
    for key in sorted({k for k, _ in rows}):
        here = sum(s for k, s in rows if k == key)
        if below + here >= total / 3:
            cut = key if below + here - total / 3 <= total / 3 - below else key - 1
            break
        below += here
    assert tree.threshold == cut


def test_given_documents(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    rows = sharding.report(docs, ["doc_id", "source", "lang"], 40).collect()
    sizes = check(rows, [r.text for r in docs.select("text").collect()], 40)
    mean, most = sum(sizes.values()) / 40, max(r["size"] for r in rows)
    assert max(abs(s - mean) for s in sizes.values()) <= most


def test_odd_tables(spark):
    few = spark.createDataFrame([(1, None, None), (1, None, None), (None, "", float("nan")), (2, "a" * 100_000, float("inf"))], "doc_id long, text string, n double")
    sizes = check(sharding.report(few, ["doc_id", "n"], 40).collect(), [None, None, "", "a" * 100_000], 40)
    assert sum(sizes.values()) == 100_064
    assert sharding.report(few.limit(0), ["doc_id", "n"], 40).count() == 0


def test_written_shards_hold_every_row(spark, tmp_path):
    docs = read(spark, "/root/testdata/sf0.001", "documents").withColumn("size", F.lit(1))
    sharding.write(docs, f"file:{tmp_path}/shards", ["source"], 60_000)
    back = spark.read.parquet(f"file:{tmp_path}/shards")
    assert back.drop("shard").exceptAll(docs).count() == 0 and back.count() == docs.count()
    sizes = [r[0] for r in back.groupBy("shard").agg(F.sum(F.octet_length("text") + 16)).collect()]
    assert len(sizes) > 4 and max(sizes) <= 60_000 + 20_000


def test_many_repeated_rows_are_cut(spark):
    docs = [(7, "the same text, many times")] * 2000 + [(100 + i, f"{i:024d}x") for i in range(2000)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    sizes = check(sharding.report(frame, ["doc_id"], 8).collect(), [t for _, t in docs], 8)
    mean = sum(sizes.values()) / 8
    # The group is cut to a 2048th of it, of a few rows by chance.
    assert max(abs(s - mean) for s in sizes.values()) <= 10 * 41
