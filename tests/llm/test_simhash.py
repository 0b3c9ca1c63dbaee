"""SimHash groups against brute force."""

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from webtide.llm import components, simhash
from webtide.plans.lineage import Scratch


def plain(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(fps):
    """Smallest member of each component of the graph of near fingerprints, in the order of fps."""
    left = dict.fromkeys(range(len(fps)))
    comp = {}
    for i in range(len(fps)):
        if i in comp:
            continue
        todo = [i]
        comp[i] = i
        left.pop(i)
        while todo:
            x = todo.pop()
            for y in [y for y in left if (fps[x] ^ fps[y]).bit_count() <= 4]:
                left.pop(y)
                comp[y] = i
                todo.append(y)
    return [comp[i] for i in range(len(fps))]


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id")
    rows = docs.select("doc_id", "text").collect()
    fps = [plain(r.text) for r in rows]
    want = [(r.doc_id, f"{f:016x}", rows[g].doc_id) for r, f, g in zip(rows, fps, groups(fps))]
    got = simhash.near_duplicates(docs.drop("n_chars").withColumn("fp", F.lit(1))).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == want


@pytest.mark.parametrize("text", ["", None, " \t\n", "One", "a b c d", "A b C d e", "x\x0by\x1fz é É", "r " * 70000, "   "])
def test_one_text(text):
    assert simhash.fingerprint((text or "").encode()) % (1 << 64) == plain(text)


@pytest.mark.parametrize("pairwise", [256, 4])
def test_crowded(spark, pairwise, tmp_path):
    """Fingerprints around a few centres, by comparison within entries and by values around them."""
    import random

    r = random.Random(5)
    fps = {0, (1 << 64) - 1}
    for _ in range(3):
        c = r.getrandbits(64)
        for _ in range(120):
            f = c
            for _ in range(r.randint(0, 6)):
                f ^= 1 << r.randrange(64)
            fps.add(f)
    fps = sorted(fps)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    scratch = Scratch(spark)
    links = simhash.near_links(spark.createDataFrame(signed, "fp long"), scratch, pairwise).collect()
    assert all(((x.a ^ x.b) % (1 << 64)).bit_count() <= 4 for x in links)
    comp = {f: f for f in (s[0] for s in signed)}

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for x in links:
        a, b = root(x.a), root(x.b)
        comp[max(a, b)] = min(a, b)
    mine = [root(s[0]) for s in signed]
    want = groups(fps)
    assert len(set(mine)) == len(set(want))
    assert len(set(zip(mine, want))) == len(set(want))


def test_odd_rows(spark):
    rows = [(5, None), (3, ""), (9, "a b c d e"), (9, "a b c d e"), (None, "zz yy"), (2, "A b c d e"), (None, "")]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 7
    comp = {(r.doc_id, r.component_id) for r in got}
    assert {(5, 3), (3, 3), (9, 2), (2, 2), (None, 3)} <= comp and (None, None) in comp
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, node string")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 2, 3]  # the empty nameless one is linked to 3
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components(spark):
    """A long path, a hub, a triangle, loops and nulls."""
    edges = [(i, i + 1) for i in range(100, 160)] + [(1000, i) for i in range(1001, 1200)] + [(7, 8), (8, 9), (9, 7), (4, 4), (None, 3), (5, None)]
    df = spark.createDataFrame([(b, a) for a, b in edges], "x long, y long")
    got = {r.node: r.component for r in components.components(df, Scratch(spark)).collect()}
    want = {i: 100 for i in range(100, 161)} | {i: 1000 for i in range(1000, 1200)} | {7: 7, 8: 7, 9: 7}
    assert got == want


def test_a_shared_doc_id_links_and_loses_nothing(spark):
    """Ids 3, 5 (near 3), 5 (another text), 9 and 9 (two other texts), and rows without doc_id."""
    rng = random.Random(4)
    said = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    a, others = said(400), [said(60) for _ in range(3)]
    rows = [(3, a), (5, a + " end"), (5, others[0]), (9, others[1]), (9, others[2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((r.doc_id, r.text) for r in simhash.keep_one(docs).collect()) == sorted(rows[:1] + rows[2:])
    got = sorted((r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect())
    assert got == [(3, 3), (5, 3), (5, 5), (9, 9), (9, 9)]
    # a row without doc_id belongs to its group, and carries links
    nameless = spark.createDataFrame([(None, a), (7, a + " end"), (None, others[0])], "doc_id long, text string")
    assert sorted(repr((r.doc_id, r.component_id)) for r in simhash.near_duplicates(nameless).collect()) == ["(7, 7)", "(None, 7)", "(None, None)"]
    assert sorted(repr(r.doc_id) for r in simhash.keep_one(nameless).collect()) == ["7", "None"]
