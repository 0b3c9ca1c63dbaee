"""Deleted lines against every window of every pair of places."""

import random
from collections import defaultdict

import pytest

from webtide.llm import linedup


def brute(docs, min_words):
    """Runs with enough words that occur earlier: all windows of all lengths, not only the shortest."""
    seqs = []
    for doc_id, text in docs:
        lines = [(i, x.strip(), len(x.split())) for i, x in enumerate((text or "").split("\n")) if x.split()]
        seqs.append((doc_id, lines))
    first, gone = {}, defaultdict(set)
    for doc_id, lines in seqs:
        for s in range(len(lines)):
            words, content = 0, []
            for e in range(s, len(lines)):
                words += lines[e][2]
                content.append(lines[e][1])
                if words >= min_words:
                    first.setdefault(tuple(content), (doc_id, s))
                    if first[tuple(content)] < (doc_id, s):
                        gone[doc_id].update(lines[k][0] for k in range(s, e + 1))
                    elif e > s + 60:
                        break
    return gone


def check(spark, docs, min_words):
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS seq", "2 AS line", "'x' AS id")
    got = {r.doc_id: r for r in linedup.deletions(df, min_words).collect()}
    want = brute(sorted(docs, key=lambda d: d[0]), min_words)
    assert {i: set(r.deleted) for i, r in got.items() if r.deleted} == dict(want)
    assert len(got) == len(docs)
    return got


@pytest.mark.parametrize("min_words", [1, 4, 9, 50])
def test_random(spark, min_words):
    r = random.Random(min_words)
    lines = ["a", "b b", "c c c", " c c c ", "", "d d d d d", "e e", "\t"]
    docs = [(i, "\n".join(r.choice(lines) for _ in range(r.randint(0, 25)))) for i in range(60)]
    check(spark, docs, min_words)


def test_documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    check(spark, [(r.doc_id, r.text) for r in rows if len(r.text) < 6000], 50)


def test_passage(spark):
    """A passage of 60 words over three lines goes from the later document; its neighbours and short lines stay."""
    passage = "\n".join(" ".join(f"p{i}-{k}" for k in range(20)) for i in range(3))
    docs = [(1, f"own one\n{passage}\nhello"), (2, f"own two\n\n{passage}\nbye\nhello"), (3, "hello\nhello")]
    got = check(spark, docs, 50)
    assert got[2].deleted == [2, 3, 4] and [tuple(x) for x in got[2].runs] == [(2, 4)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    out = {r.doc_id: r.text for r in linedup.without_copies(df).collect()}
    assert out == {1: docs[0][1], 2: "own two\n\nbye\nhello", 3: "hello\nhello"}


def test_odd_rows(spark):
    long = "\n".join(f"line {i} of a very long text" for i in range(5000))
    rows = [(None, long), (5, long), (5, long), (6, None), (7, ""), (8, "w " * 60), (9, "w " * 60 + "\n" + "w " * 60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.n_lines, len(r.deleted)) for r in linedup.deletions(df).collect()]
    assert sorted(got, key=repr) == sorted([(None, 5000, 5000), (5, 5000, 0), (5, 5000, 0), (6, 0, 0), (7, 0, 0), (8, 1, 0), (9, 2, 2)], key=repr)
    assert linedup.deletions(df.limit(0)).count() == 0 and linedup.without_copies(df.limit(0)).count() == 0
