"""Merkle fingerprints against a plain version of the tree."""

import hashlib
import re

import xxhash
from pyspark.sql import functions as F

from webtide.llm import merkle


def h(x):
    return f"{xxhash.xxh64_intdigest(x.encode(), 42):016x}"


def plain(text):
    sections = [s for s in re.split(r"(?<=\n)(?!\n)", text) if s]
    leaves = [[h(p) for p in re.split(r"(?<=[.!?] )(?! )", s) if p] for s in sections]
    nodes = [h(" ".join(x)) for x in leaves]
    root = hashlib.sha256(",".join(nodes).encode()).hexdigest()[:32]
    return "|".join([root, *[n[:8] + ":" + " ".join(p[:8] for p in x) for n, x in zip(nodes, leaves)]])


def like(a, b):
    if a == b:
        return 1.0
    x, y = (set(re.split(r"[|: ]", f)) for f in (a, b))
    return 2 * len(x & y) / (len(x) + len(y))


def want(rows):
    out = []
    for i, (doc_id, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        a, b = plain(text), plain(edited)
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), a, b, like(a, b), like(a, plain(after))))
    return out


def check(spark, docs, rows):
    got = merkle.compare(docs).orderBy(F.asc_nulls_first("doc_id")).collect()
    expected = want(rows)
    assert len(got) == len(expected)
    for g, w in zip(got, expected):
        assert tuple(g)[:5] == w[:5]
        assert abs(g.near_edited - w[5]) < 1e-12 and abs(g.near_next - w[6]) < 1e-12


def test_documents(spark, monkeypatch):
    monkeypatch.setattr(merkle, "_BUCKET", 20)  # several buckets and their borders
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(7)
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    check(spark, docs, rows)


def test_many_bounds(spark, monkeypatch):
    monkeypatch.setattr(merkle, "_BUCKET", 2)
    rows = [(i * i, f"text {i}. And more!\nx") for i in range(700)]
    check(spark, spark.createDataFrame(rows[::-1], "doc_id long, text string"), rows)


def test_odd_rows(spark):
    for rows in ([(7, "One. Two.")], [(None, None), (1, ""), (2, "a" * 50001), (3, "😀é. x\n\n\ny"), (4, None), (9, "a" * 50001)]):
        docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS bucket", "2 AS guest", "3 AS edited")
        check(spark, docs, rows)
    same = spark.createDataFrame([(1, "a. b"), (1, "a. b"), (1, "a. b")], "doc_id long, text string")
    assert {r.near_next for r in merkle.compare(same).collect()} == {1.0} and merkle.compare(same).count() == 3
    assert merkle.compare(same.limit(0)).count() == 0


def test_branches_locate_edits(spark):
    texts = [("A. B.\nC. D.\nE. F.", "A. B.\nC. X.\nE. F."), ("A.\nB", "A.\nB"), ("A.\nB", "A.\n\nB")]
    df = spark.createDataFrame([(i, *t) for i, t in enumerate(texts)], "i int, a string, b string")
    df = merkle.with_fingerprint(merkle.with_fingerprint(df, "a", "fa"), "b", "fb")
    got = df.orderBy("i").select(merkle.differing(F.col("fa"), F.col("fb")).alias("d"), (df.fa == df.fb).alias("e")).collect()
    assert [tuple(r) for r in got] == [([1], False), ([], True), ([0], False)]
