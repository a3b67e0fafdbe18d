"""Line deduplication against brute force: every pair of lines compared on whole shingle sets."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from ferry.llm import components, lines
from ferry.llm.tables import read

SPACE = " \t\n\x0b\x0c\r"


def shingles(line):
    return frozenset(line[i : i + 8] for i in range(max(1, len(line) - 7)))


def brute(docs):
    """Edited texts, and the verified links between distinct lines."""
    places = [(i, n, x.strip(SPACE).lower()) for i, t in docs if t is not None for n, x in enumerate(t.split("\n"))]
    distinct = sorted({x for *_, x in places if x})
    sets, root = {x: shingles(x) for x in distinct}, {x: x for x in distinct}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    linked = set()
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                linked.add(frozenset((a, b)))
                root[find(a)] = find(b)
    first = {}
    for i, n, x in sorted(places):
        if x:
            first.setdefault(find(x), (i, n))
    edited = {}
    for i, t in docs:
        kept = None if t is None else [y for n, y in enumerate(t.split("\n")) if not y.strip(SPACE) or first[find(y.strip(SPACE).lower())] == (i, n)]
        edited[i] = None if t is None else "\n".join(kept)
    return edited, linked


def corpus(seed, n=60):
    rng = random.Random(seed)
    vocab = [f"{a}{b}" for a in ("the", "on", "ing", "re", "é") for b in ("r", "th", "ea", "st", "nd", "ü🙂")]
    base = [" ".join(rng.choice(vocab) for _ in range(rng.randrange(1, 110))) for _ in range(40)]
    docs = [(0, None), (1, ""), (2, "\n \n"), (3, "Les.\nLES.\n les. "), (4, "x" * 5000)]
    for i in range(5, n):
        out = []
        for _ in range(rng.randrange(1, 9)):
            line = rng.choice(base)
            if rng.random() < 0.4:
                words = line.split()
                words[rng.randrange(len(words))] = rng.choice(vocab)
                line = " ".join(words)
            out.append(rng.choice(["", "  "]) + (line.upper() if rng.random() < 0.1 and "ü" not in line else line))
        docs.append((i, "\n".join(out)))
    return docs


def test_equals_brute_force(spark):
    docs = corpus(1)
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"at": F.lit("x"), "key": F.lit(1), "gone": F.lit(2), "row": F.lit(3)})
    want, _ = brute(docs)
    rows = lines.deduplicated(frame).select("row.doc_id", "text", "n_lines", "n_removed").collect()
    assert len(rows) == len(docs)
    wrong = [r.doc_id for r in rows if r.text != want[r.doc_id]]
    assert len(wrong) <= 0.02 * len(rows)
    source = dict(docs)
    assert all(r.n_lines == (0 if source[r.doc_id] is None else source[r.doc_id].count("\n") + 1) for r in rows)
    edited = lines.without_repeated_lines(frame.withColumn("n_chars", F.lit(7)), length="n_chars").collect()
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in edited)


def test_links_are_right_and_nearly_all_found(spark):
    docs = corpus(2, 120)
    _, want = brute(docs)
    every = lines.lines(spark.createDataFrame(docs, "doc_id long, text string"))
    names = {r.key: r.line for r in every.select("key", "line").distinct().collect()}
    signed = lines.signatures(every.groupBy("key").agg(F.first("line").alias("line")))
    buckets = {}
    for r in signed.collect():
        for b in r.bands:
            buckets.setdefault(b, set()).add(names[r.key])
    met = {frozenset((a, b)) for group in buckets.values() for a in group for b in group if a != b}
    assert len(want) > 100 and len(met & want) >= 0.97 * len(want)
    got = {frozenset((names[r.a], names[r.b])) for r in lines.links(every).collect()}
    assert got <= want


def test_given_documents_lose_only_copies(spark):
    docs = read(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want, _ = brute(rows)
    got = {r.doc_id: r.text for r in lines.without_repeated_lines(docs).collect()}
    assert got == want


def test_repeated_rows_and_empty_tables(spark):
    rows = [(1, "one long line of text\nb"), (1, "one long line of text\nb"), (None, "one long line of text"), (1, "another text with one long line"), (2, "B \n")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.text) for r in lines.without_repeated_lines(frame).collect()), key=repr)
    same = [(1, "b"), (1, "b")]
    assert got == sorted([*same, (None, "one long line of text"), (1, "another text with one long line"), (2, "")], key=repr)
    assert lines.without_repeated_lines(frame.limit(0)).count() == 0


def test_one_very_common_line(spark):
    frame = spark.range(3000).selectExpr("id AS doc_id", "concat('the same line everywhere\\nown line number ', sha2(cast(id AS string), 256)) AS text")
    got = lines.without_repeated_lines(frame)
    assert got.where("text LIKE '%everywhere%'").count() == 1 and got.where("text LIKE '%own%'").count() == 3000


def family(seed, n):
    """Lines of one template that are no copies of each other, and pairs among them that are."""
    rng = random.Random(seed)
    noise = lambda k: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(k))
    frame = noise(150)
    out = [frame + noise(24) for _ in range(n)]
    for line in out[::10]:
        at = rng.randrange(40, 110)
        out.append(line[:at] + noise(10) + line[at + 10 :])
    return out


def test_pairs_in_crowded_buckets_are_found(spark):
    texts = family(1, 400)
    every = lines.lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    names = {r.key: r.line for r in every.select("key", "line").collect()}
    sets = {x: shingles(x) for x in texts}
    want = {frozenset((a, b)) for i, a in enumerate(texts) for b in texts[:i] if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])}
    got = {frozenset((names[r.a], names[r.b])) for r in lines.links(every).collect()}
    assert len(want) >= 30 and got <= want
    of = components_of(texts, got)
    assert sum(of[a] == of[b] for a, b in map(tuple, want)) >= 0.97 * len(want)


def components_of(nodes, linked):
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in map(tuple, linked):
        root[find(a)] = find(b)
    return {x: find(x) for x in nodes}


def test_a_large_group_of_near_copies_is_not_paired_each_with_each(spark):
    rng = random.Random(4)
    base = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(200))
    texts = [base[:100] + f"{i:03d}" + base[103:] for i in range(200)]
    every = lines.lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    names = {r.key: r.line for r in every.select("key", "line").collect()}
    got = [(names[r.a], names[r.b]) for r in lines.links(every).collect()]
    assert len(set(components_of(texts, got).values())) == 1 and len(got) < 20 * len(texts)


def test_lines_of_few_distinct_shingles_are_signed_whatever_their_length(spark):
    rules = [(c * 4000, c * 4500) for c in "-=_*.~#+"] + [("the " * 50, "the " * 100), ("ab" * 100, "ab" * 900)]
    distinct = spark.createDataFrame([(2 * i + j, x.strip()) for i, pair in enumerate(rules) for j, x in enumerate(pair)], "key long, line string")
    bands = {r.key: r.bands for r in lines.signatures(distinct).collect()}
    assert all(bands.get(2 * i, 1) == bands.get(2 * i + 1, 2) for i in range(len(rules)))


def test_pairs_of_few_shingles_meet_as_often_as_long_ones(spark):
    rng = random.Random(6)
    noise = lambda k: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(k))
    # 8 shingles of 10 are shared.
    pairs = [(x + noise(1), noise(1) + x) for x in (noise(15) for _ in range(2000))]
    distinct = spark.createDataFrame([(2 * i + j, x) for i, pair in enumerate(pairs) for j, x in enumerate(pair)], "key long, line string")
    bands = {r.key: set(r.bands) for r in lines.signatures(distinct).collect()}
    assert sum(not bands[2 * i] & bands[2 * i + 1] for i in range(len(pairs))) <= 0.02 * len(pairs)


def test_lines_of_one_template_are_not_compared_each_with_each(spark, monkeypatch):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 8))) for _ in range(90)]
    # Each line lacks some words, so that many pairs lack one in common, and few reach the similarity.
    texts = sorted({" ".join(w for w in words if rng.random() > part) for part in (0.04, 0.09) for _ in range(150)})
    sets = {x: shingles(x) for x in texts}
    want = {frozenset((a, b)) for i, a in enumerate(texts) for b in texts[:i] if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])}
    every = lines.lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    names = {r.key: r.line for r in every.select("key", "line").collect()}
    paired, write = [], lines.written

    def counted(df, label, **options):
        made = write(df, label, **options)
        if made.columns[:2] == ["a", "b"]:
            paired.append(made.count())
        return made

    monkeypatch.setattr(lines, "written", counted)
    got = {frozenset((names[r.a], names[r.b])) for r in lines.links(every).collect()}
    of = components_of(texts, got)
    assert got <= want and sum(of[a] == of[b] for a, b in map(tuple, want)) >= 0.97 * len(want)
    assert sum(paired) + len(got) < 10 * len(texts)


def test_texts_are_written_only_of_lines_that_may_have_copies(spark, monkeypatch):
    rng = random.Random(9)
    noise = lambda k: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(k))
    copied = noise(200)
    docs = [(i, "\n".join(noise(200) for _ in range(5))) for i in range(60)] + [(60, copied), (61, copied[:-4] + noise(4))]
    kept, write = {}, lines.written

    def counted(df, label, **options):
        made = write(df, label, **options)
        if "line" in made.columns:
            kept[label] = made.count()
        return made

    monkeypatch.setattr(lines, "written", counted)
    rows = lines.without_repeated_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: r.text for r in rows} == {**dict(docs), 61: ""}
    assert sum(kept.values()) < 10


def test_few_open_lines_of_a_pivot_and_many_are_decided_alike(spark, monkeypatch):
    texts = family(3, 150) + [line + " é🙂" for line in family(5, 12)]
    every = lines.lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    names = {r.key: r.line for r in every.select("key", "line").collect()}
    found = []
    for few in (0, 1000):
        monkeypatch.setattr(lines, "FEW", few)
        got = {frozenset((names[r.a], names[r.b])) for r in lines.links(every).collect()}
        of = components_of(texts, got)
        found.append({frozenset(x for x in texts if of[x] == root) for root in set(of.values())})
    assert found[0] == found[1] and len(found[0]) < len(texts)


def test_components_of_contracted_links_are_those_of_all_links(spark, monkeypatch):
    texts = family(7, 120)
    every = lines.lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    names = {r.key: r.line for r in every.select("key", "line").collect()}
    for few in (0, 1000):
        monkeypatch.setattr(lines, "FEW", few)
        want = components_of(texts, {frozenset((names[r.a], names[r.b])) for r in lines.links(every).collect()})
        got = {names[r.node]: names[r.root] for r in lines.rooted(every).collect()}
        assert len(got) >= 8 and all((got.get(a, a) == got.get(b, b)) == (want[a] == want[b]) for a in texts for b in texts)


def test_only_texts_that_pairs_name_are_shuffled_for_them(spark, monkeypatch):
    texts = spark.createDataFrame([(i, f"line of text number {i}") for i in range(500)], "key long, line string")
    pairs = spark.createDataFrame([(1, 2), (3, 2)], "key long, pivot long")
    named, of = [], lines._named
    monkeypatch.setattr(lines, "_named", lambda *args: named.append(of(*args)) or named[-1])
    rows = {(r.key, r.pivot): (r.size, r.pivot_size, len(r.off)) for r in lines.differences(pairs, texts).collect()}
    assert rows == {(1, 2): (14, 14, 2), (3, 2): (14, 14, 2)} and [x.count() for x in named] == [1, 2]


def test_differences_count_shingles_by_their_hashes(spark):
    texts = ["one line of text, é🙂 and more", "one line of text, é🙂🙂 and more", "ab" * 40, "ab" * 90, "x y\u0085z" * 5, "exactly9c"]
    frame = spark.createDataFrame(list(enumerate(texts)), "key long, line string")
    pairs = [(i, j) for i in range(len(texts)) for j in range(i)]
    made = lines.differences(spark.createDataFrame(pairs, "key long, pivot long"), frame)
    assert made.schema["off"].dataType.elementType.simpleString() == "bigint"
    sets = [shingles(x) for x in texts]
    want = {(i, j): (len(sets[i]), len(sets[j]), len(sets[i] ^ sets[j])) for i, j in pairs}
    assert {(r.key, r.pivot): (r.size, r.pivot_size, len(set(r.off))) for r in made.collect()} == want


def test_only_differences_that_can_meet_first_are_joined(spark, monkeypatch):
    rng = random.Random(11)
    near, size = [], 100
    for _ in range(30):
        off = rng.sample(range(400), 60)
        near += [off, off[:50] + rng.sample(range(400, 800), rng.randrange(6, 16))]
    rows = [(i, 0, i, False, size, off) for i, off in enumerate(near)]
    ranked, write = [], lines.written

    def counted(df, label, **options):
        made = write(df, label, **options)
        if label == "ranked":
            ranked.append(made.count())
        return made

    monkeypatch.setattr(lines, "written", counted)
    apart = spark.createDataFrame(rows, "key long, pivot long, root long, linked boolean, size int, off array<bigint>")
    got = {(r.a, r.b) for r in lines.rest(apart).collect()}
    want = {(i, j) for j, b in enumerate(near) for i, a in enumerate(near[:j]) if 9 * len(set(a) ^ set(b)) <= 2 * size}
    assert got == want and 10 < len(want) < 30
    assert sum(ranked) <= len(near) * (size // 4 + 1)


def test_counted_small_tables_are_broadcast_whatever_their_bytes(spark, monkeypatch):
    texts = family(3, 120)
    plans, write = {}, lines.written

    def seen(df, label, **options):
        plans.setdefault(label, []).append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, label, **options)

    monkeypatch.setattr(lines, "written", seen)
    monkeypatch.setattr(lines, "FEW", 0)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = lines.without_repeated_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
        assert 0 < got.where("text = ''").count() < len(texts)
        monkeypatch.setattr(components, "written", seen)
        assert components.components(spark.range(1, 90).selectExpr("id AS a", "id - 1 AS b")).where("root = 0").count() == 89
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert {"components", "centred", "rooted"} <= set(plans)
    assert not [label for label in ("components", "centred", "rooted") for plan in plans[label] if "SortMergeJoin" in plan]


def test_lines_are_made_once_for_their_signatures(spark):
    every = lines.lines(spark.createDataFrame([(1, "One line\nand another line")], "doc_id long, text string"))
    plan = lines._minima(every)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lower(") == 1


def test_shingles_of_short_lines_and_white_space_of_any_kind(spark):
    texts = ["abc", "é🙂", "eight ch", "nine char", "nine char" * 3]
    frame = spark.createDataFrame([(x,) for x in texts], "line string")
    made = {r.line: r.made for r in frame.select("line", lines._shingles("line").alias("made")).collect()}
    assert {x: len(made[x]) for x in texts} == {"abc": 1, "é🙂": 1, "eight ch": 1, "nine char": 2, "nine char" * 3: 20}
    odd = [f"{a}x{s}Y{b}" for s in SPACE if s != "\n" for a in ("", s, s + " ") for b in ("", s, " " + s, " ", "\u0085" + s)] + [s * 3 for s in SPACE if s != "\n"]
    rows = lines.lines(spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")).collect()
    assert {r.id: r.line for r in rows} == {i: x.strip(SPACE).lower() for i, x in enumerate(odd) if x.strip(SPACE)}
