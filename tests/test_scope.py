"""Scope by prefix covers, against comparing every path with every prefix."""

import random

import pytest
from pyspark.sql import functions as F

from webtide.operators import links, sitemap
from webtide.plans.lineage import Scratch
from webtide.sources.seeds import pack_scope, prefix_cover

SCHEMA = "domain string, kind string, prefix string"
LINKS = "src_url string, href_ix int, dst_domain string, dst_path string"


def kept(spark, scope, rows):
    found = links.classify(spark.createDataFrame(rows, LINKS), scope)
    return sorted((r.href_ix, r.kind) for r in links.in_path_scope(found, scope).collect())


def test_cover_and_filter_by_brute_force(spark):
    rng = random.Random(5)
    word = lambda n: "/" + "".join(rng.choice("ab/é") for _ in range(rng.randrange(n)))
    rows = [(f"d{rng.randrange(4)}", "root", word(6)) for _ in range(60)]
    rows += [("d0", "allowed", None), ("free", "allowed", None), ("d5", "root", None), ("d6", "root", ""), ("d6", "root", "/a")]
    rows += rows[:10]
    frame = spark.createDataFrame(rows, SCHEMA)
    own = lambda d: {p for e, k, p in rows if e == d and k == "root" and p is not None}
    want = {(d, p) for d, k, p in rows if p is not None and not any(q != p and p.startswith(q) for q in own(d))}
    cover = [(r.domain, r.prefix) for r in prefix_cover(frame).collect()]
    assert len(cover) == len(set(cover)) and set(cover) == want

    names = ["d0", "d1", "d2", "d3", "free", "d5", "d6", "other", None]
    tried = [("s", i, rng.choice(names), rng.choice([word(12), "", None, "/a"])) for i in range(600)]
    kind = {d: "root" if any(e == d and k == "root" for e, k, _ in rows) else "allowed" for d, _, _ in rows}
    fits = lambda d, p: kind[d] != "root" or not own(d) or (p is not None and any(p.startswith(q) for q in own(d)))
    expected = sorted((i, kind[d]) for _, i, d, p in tried if d in kind and fits(d, p))
    assert kept(spark, pack_scope(frame), tried) == expected


def test_no_scope_lets_nothing_through(spark):
    assert kept(spark, pack_scope(spark.createDataFrame([], SCHEMA)), [("s", 1, "d", "/")]) == []


@pytest.mark.parametrize("limit", ["-1", "10485760"])
def test_many_seeds_on_one_host(spark, limit):
    """100,000 prefixes of one domain: no row holds them, and both sizes of join give the same links."""
    n = 100_000
    ids = spark.range(n)
    paths = ids.select(F.lit("h").alias("domain"), F.lit("root").alias("kind"), F.concat(F.lit("/p/"), "id").alias("prefix"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        scope = pack_scope(paths).saved(Scratch(spark))
        # every number begins with one of its digits but zero, which is a page of its own
        assert sorted(r.prefix for r in scope.prefixes.collect()) == [f"/p/{k}" for k in range(10)]
        exact = paths.withColumn("prefix", F.concat("prefix", F.lit("/")))
        scope = pack_scope(exact).saved(Scratch(spark))
        assert scope.prefixes.count() == n
        assert scope.domains.first().lengths == [5, 6, 7, 8, 9]
        rows = spark.range(2 * n).select(
            F.lit("s").alias("src_url"), F.col("id").cast("int").alias("href_ix"), F.lit("h").alias("dst_domain"),
            F.concat(F.lit("/p/"), "id", F.lit("/x")).alias("dst_path"),
        )
        got = links.in_path_scope(links.classify(rows, scope), scope)
        assert got.agg(F.count(F.lit(1)), F.max("href_ix")).first() == (n, n - 1)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_listed_urls_meet_the_prefixes(spark):
    scope = pack_scope(spark.createDataFrame([("e.com", "root", "/en"), ("f.com", "allowed", None)], SCHEMA))
    rows = [
        ("https://www.e.com/en/1", False), ("https://e.com/de/1", False), ("https://e.com/de/2", True),
        ("https://f.com/de", False), ("https://g.com/en", False), ("https://g.com/x", True),
    ]
    merged = spark.createDataFrame([(u, c, not c) for u, c in rows], "url string, in_crawl boolean, in_sitemap boolean")
    got = sitemap.in_scope(merged, scope)
    assert got.columns == merged.columns
    assert sorted(r.url for r in got.collect()) == sorted(rows[k][0] for k in (0, 2, 3, 5))
