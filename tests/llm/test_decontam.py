"""Decontamination against comparison of every alignment, with words changed."""

import random
import re
from itertools import combinations

from pyspark.sql import functions as F

from webtide.llm import decontam


def words(text):
    return re.findall(r"(?:[0-9a-z]|[^\x00-\x7f])+", (text or "").lower())


def overlap(doc, item, window=13, share=0.8):
    d, t = words(doc), words(item)
    width = min(window, len(t))
    best = 0
    for shift in range(-len(t) + 1, len(d)):
        a, b = max(shift, 0), max(-shift, 0)
        same = [x == y for x, y in zip(d[a:], t[b:])]
        for i in range(len(same) - width + 1):
            best = max(best, sum(same[i : i + width]))
    return best if width and best >= share * width - 1e-9 else 0


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    got = {r.doc_id: r for r in decontam.judge(docs, bench).collect()}
    items = {r.item_id: r.text for r in bench.collect()}
    low = {i: " ".join(words(t)) for i, t in items.items()}
    grams = {i: {" ".join(words(t)[k : k + 4]) for k in range(len(words(t)) - 3)} for i, t in items.items()}
    for r in docs.select("doc_id", "text").collect():
        w = words(r.text)
        mine = {" ".join(w[k : k + 4]) for k in range(len(w) - 3)}
        # 11 of 13 equal words hold three in a row at least; four is what items are preselected by
        near = [i for i in items if grams[i] & mine]
        want = {i for i in near if overlap(r.text, items[i])}
        assert set(got[r.doc_id].item_ids) == want and got[r.doc_id].contaminated == bool(want)
        assert all(i in want for i in items if low[i] in " ".join(w))


def test_changed_words(spark):
    r = random.Random(4)
    vocabulary = [f"w{i}" for i in range(3000)]
    item = r.sample(vocabulary, 40)
    rows, bad = [], set()
    for i in range(60):
        body = [r.choice(vocabulary) for _ in range(300)]
        if i % 2:
            copy = list(item)
            for k in range(i % 6, 40, 7):  # every seventh word is another
                copy[k] = "other"
            body[100:100] = copy
            bad.add(i)
        rows.append((i, ", ".join(body).upper()))
    bench = spark.createDataFrame([(5, " ".join(item)), (3, " ".join(item)), (8, None), (9, "too short"), (None, "")], "item_id long, text string")
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS row", "2 AS key", "3 AS words")
    got = decontam.judge(docs, bench).collect()
    assert {x.doc_id for x in got if x.contaminated} == bad and len(got) == 60
    assert {tuple(x.item_ids) for x in got if x.contaminated} == {(3,)}
    kept = decontam.clean(docs, bench)
    assert kept.columns == docs.columns and {x.doc_id for x in kept.collect()} == set(range(60)) - bad


def test_odd_rows(spark):
    item = " ".join(f"t{i}" for i in range(20))
    rows = [(None, item), (None, "clean"), (1, None), (2, ""), (3, "x " * 80000 + item), (4, item), (4, item), (5, item.replace("t9", "é"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string").withColumn("place", F.lit(1))
    got = sorted(((r.doc_id or 0), r.contaminated) for r in decontam.judge(docs, bench).collect())
    assert got == [(0, False), (0, True), (1, False), (2, False), (3, True), (4, True), (4, True), (5, True)]
    assert sorted((r.doc_id or 0) for r in decontam.clean(docs, bench).collect()) == [0, 1, 2]
    assert decontam.clean(docs, bench.limit(0)).count() == 8
    assert decontam.judge(docs.limit(0), bench).count() == 0


def test_masks_reach_every_overlap():
    seeds = decontam.Seeds()
    for words in range(1, 40):
        width = min(words, seeds.window)
        for changed in range(width + 1):
            if width - changed < seeds.share * width - 1e-9:
                break
            masks = seeds.whole(words) if words < seeds.window else seeds.masks
            for other in combinations(range(width), changed):
                free = (all(m[i] == "0" or at + i not in other for i in range(len(m))) for m in masks for at in range(width - len(m) + 1))
                assert any(free), (words, other)


def test_short_items(spark):
    """Items of 1 to 14 words, verbatim and with all numbers of changed words, at all places of a document."""
    r = random.Random(8)
    items = {n: [f"i{n}x{k}" for k in range(n)] for n in range(1, 15)}
    texts = ["", "none of them"]
    for n, item in items.items():
        for changed in range(min(n, 4)):
            for other in r.sample(list(combinations(range(n), changed)), min(25, len(list(combinations(range(n), changed))))):
                copy = ["other" if i in other else x for i, x in enumerate(item)]
                before, after = r.choice([(0, 0), (0, 3), (4, 0), (5, 6)])
                texts.append(" ".join([*(["pre"] * before), *copy, *(["post"] * after)]))
        texts.append(" ".join(item[: n // 2]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(n, " ".join(x)) for n, x in items.items()] + [(99, "!")], "item_id long, text string")
    got = {x.doc_id: x for x in decontam.judge(docs, bench).collect()}
    for i, text in enumerate(texts):
        want = {n: overlap(text, " ".join(x)) for n, x in items.items()}
        assert got[i].item_ids == [n for n in items if want[n]], text
        assert got[i].matched == max(want.values())
    kept = {x.doc_id for x in decontam.clean(docs, bench).collect()}
    assert kept == {i for i in got if not got[i].contaminated}


def test_sieve_comes_as_columns(spark):
    """The sieve's words reach the driver as numbers, not as rows, and have the bits of every seed."""
    import tracemalloc

    import numpy as np

    seeds = spark.range(150_000).select(F.xxhash64("id").alias("seed"))
    tracemalloc.start()
    sieve = decontam._sieve(seeds)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 3 * len(sieve)
    bits = np.frombuffer(sieve, np.uint8)
    want = np.zeros_like(bits)
    for probe in decontam._probes(np.array([r.seed for r in seeds.collect()]).view(np.uint64)):
        np.bitwise_or.at(want, probe >> np.uint64(3), np.uint8(1) << (probe & np.uint64(7)).astype(np.uint8))
    assert (bits == want).all()
