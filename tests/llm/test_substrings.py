"""Removed words against all windows of all documents."""

import hashlib
import random
import re

import pytest

from webtide.llm import queries, substrings

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs, width=13):
    """[(doc_id, words, flags of removed words)] by the definition."""
    words = [(i, WORD.findall(t or "")) for i, t in docs]
    least = {}
    for i, w in words:
        if i is not None:
            for s in range(len(w) - width + 1):
                k = tuple(w[s : s + width])
                least[k] = min(least.get(k, i), i)
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for s in range(len(w) - width + 1):
            if i is not None and least[tuple(w[s : s + width])] < i:
                gone[s : s + width] = [True] * width
        out.append((i, w, gone))
    return out


def digest(i, w, gone):
    kept = " ".join(x for x, g in zip(w, gone) if not g)
    return repr((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))


def check(spark, docs, **more):
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS key", "2 AS first", "'x' AS rid", "0 AS copy").repartition(3)
    rows = substrings.without_copies(df, **more).collect()
    got = sorted(repr((r.doc_id, r.n_words, sum(s.end - s.start for s in r.removed), hashlib.sha256(r.text.encode()).hexdigest())) for r in rows)
    want = brute(docs)
    assert got == sorted(digest(*w) for w in want)
    for r in rows:
        assert all(a.end < b.start for a, b in zip(r.removed, r.removed[1:]))
    return want


def shared_passages(seed, n=60, vocabulary=400):
    """Texts with passages of 5 to 60 words from others, at any phase, and some changed words."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(vocabulary)}é"
    passages = [[word() for _ in range(rng.randint(5, 60))] for _ in range(8)]
    docs = []
    for i in range(n):
        w = [word() for _ in range(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 3)):
            p = list(rng.choice(passages))
            if rng.random() < 0.4:
                p[rng.randrange(len(p))] = word()
            at = rng.randint(0, len(w))
            w[at:at] = p[rng.randint(0, 3) :]
        docs.append((rng.randint(0, n), rng.choice([" ", "\n", " \t "]).join(w)))
    return docs


@pytest.mark.parametrize("seed", range(4))
def test_passages_at_every_phase(spark, seed):
    want = check(spark, shared_passages(seed), **({"sieve_for": 0} if seed % 2 else {}))
    assert any(any(g) and not all(g) for _, _, g in want)


def test_lengths_around_the_window(spark):
    """Common runs of 11 to 16 words at every distance of places: 13 and more go, shorter ones stay."""
    docs, n = [], 0
    for size in range(11, 17):
        for shift in range(8):
            run = [f"r{size}_{shift}_{k}" for k in range(size)]
            docs.append((n, " ".join([f"a{n}_{k}" for k in range(10)] + run + [f"z{n}"])))
            docs.append((n + 1, " ".join([f"b{n}_{k}" for k in range(10 + shift)] + run)))
            n += 2
    want = check(spark, docs)
    sizes = [sum(g) for _, _, g in want]
    assert sizes == [0 if k % 2 == 0 or k // 16 < 2 else 11 + k // 16 for k in range(len(sizes))]


def test_copies_nulls_and_repeated_ids(spark):
    text = " ".join(f"x{k}" for k in range(30))
    docs = [(5, text), (5, text), (7, text), (7, text + " more"), (None, text), (9, None), (10, ""), (11, " \n\t "), (8, "short one"), (12, "short one")]
    docs += [(20 + k, "head%d " % k + text) for k in range(5)]
    docs += [(3, " ".join(f"x{k}" for k in range(12)))]
    check(spark, docs)
    check(spark, docs, sieve_for=0)
    check(spark, [(None, text), (None, text)])
    assert substrings.without_copies(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_very_long_text_and_common_passage(spark):
    rng = random.Random(5)
    long = " ".join(rng.choice(["alpha", "beta", "gamma", "déjà"]) + str(rng.randrange(50000)) for _ in range(200000))
    words = long.split(" ")
    docs = [(1, " ".join(words[150000:150040])), (2, long), (3, " ".join(words[:1000])), (4, "a " * 40), (5, "b a " + "a " * 13)]
    docs += [(100 + k, " ".join(words[7:27]) + f" tail{k}") for k in range(200)]
    check(spark, docs)


def test_the_query_on_the_given_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    got = queries.queries()["op13_substring_dedup"](spark, sf_dir).collect()
    docs = [(r.doc_id, r.text) for r in queries.table(spark, sf_dir, "documents").collect()]
    want = brute(docs)
    assert sorted(repr((r.doc_id, r.n_words, r.n_removed, r.kept_sha256)) for r in got) == sorted(digest(*w) for w in want)
    assert any(any(g) for _, _, g in want)
