"""The walk's levels, the sitemaps it reaches and the tables a session starts from, by what they cost."""

import pytest
from pyspark.sql import functions as F

from webtide.checks import session as checks
from webtide.checks.fixtures import Inputs
from webtide.functions import text, urls
from webtide.operators import crawl, links, sitemap
from webtide.params import Params
from webtide.sources.seeds import pack_scope

_WEB = "url string, status int, error string, body string"


def _site(spark, n, more=()):
    """A chain of `n` pages that also link back, to a PDF, to a page of another domain and to one that nobody captured."""
    a = lambda *to: "".join(f'<a href="{t}">x</a>' for t in to)
    pages = [
        (f"https://e.com/{k}", 200, None, a(f"/{k + 1}", f"/{k // 2}", "/f.pdf", "https://o.org/x", f"/lost{k % 3}"))
        for k in range(n)
    ]
    captures = spark.createDataFrame([*pages, *more], _WEB)
    scope = spark.createDataFrame([("e.com", "root", "/"), ("o.org", "allowed", None)], "domain string, kind string, prefix string")
    rules = spark.createDataFrame(
        [("e.com", [(0, False, f"/{n - 3}"), (1, False, "/lost2")])], "domain string, rules array<struct<line_no:int,allow:boolean,path:string>>"
    )
    seeds = spark.createDataFrame([("https://e.com/0",), ("https://e.com/0",), (None,)], "url string")
    return seeds, captures, pack_scope(scope), rules


def _rows(df):
    return sorted((r.url or "", r.depth, r.origin, r.disposition) for r in df.collect())


@pytest.mark.parametrize("most, changes", [(7, {}), (0, {"max_depth": 1}), (7, {"max_pages": 8})])
def test_held_and_written_levels_visit_the_same(spark, monkeypatch, most, changes):
    """Tables from the first level on (`most` is 0), or from a later one."""
    site = _site(spark, 6, [("https://e.com/1", 404, None, None)])
    params = Params(ingest_pdf=True, **changes)
    held = _rows(crawl.crawl(*site, params))
    monkeypatch.setattr(crawl, "HELD", most)
    assert _rows(crawl.crawl(*site, params)) == held
    if not changes:
        assert ("https://e.com/3", 3, "link", "blocked") in held and ("https://e.com/f.pdf", 1, "pdf", "scraped") in held
        # a page with two captures ends in two ways
        assert len([r for r in held if r[0] == "https://e.com/1"]) == 2
        assert not [r for r in held if r[0] == "https://e.com/4"]


@pytest.mark.parametrize("few", [0, 1000])
def test_names_are_looked_up(spark, monkeypatch, few):
    monkeypatch.setattr(crawl, "FEW", few)
    table = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "url string, n int")
    assert sorted(r.n for r in crawl._named(table, "url", [None, "a", "c"]).collect()) == [1, 2]


def _jobs(spark, name, act):
    sc = spark.sparkContext
    sc.setJobGroup(name, name)
    try:
        act()
        sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        return len(sc.statusTracker().getJobIdsForGroup(name))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_a_small_level_is_two_jobs(spark):
    """The deeper of two walks needs two more jobs a level, and one file in the end."""
    out = []
    few = _jobs(spark, "shallow", lambda: out.append(crawl.crawl(*_site(spark, 5), Params())))
    many = _jobs(spark, "deep", lambda: out.append(crawl.crawl(*_site(spark, 13), Params())))
    assert many - few <= 2 * 8 + 2
    assert len(out[1].inputFiles()) == 1


def _maps(spark, children):
    index = lambda to: "<sitemapindex>" + "".join(f"<sitemap><loc>https://e.com/{t}</loc></sitemap>" for t in to) + "</sitemapindex>"
    leaf = lambda name: f"<urlset><url><loc>https://e.com/of/{name}</loc></url></urlset>"
    rows = [(f"https://e.com/{name}", 200, index(to) if to else leaf(name)) for name, to in children.items()]
    return spark.createDataFrame(rows, "sitemap_url string, status int, text string")


@pytest.mark.parametrize("sought", [0, 1, 8])
def test_only_reached_sitemaps_are_parsed(spark, monkeypatch, sought):
    captured = _maps(spark, {"a": "bc", "b": "cd", "c": "", "d": "ae", "e": "", "x": "yc", "y": ""})
    places = spark.createDataFrame([(1, 0, "https://e.com/a"), (2, 0, "https://e.com/d"), (2, 1, "https://e.com/no")], "root_ix int, ord int, sitemap_url string")
    parsed = []
    parse = sitemap.parse
    monkeypatch.setattr(sitemap, "SOUGHT", sought)
    monkeypatch.setattr(sitemap, "parse", lambda docs: parsed.extend(r.sitemap_url[-1] for r in docs.collect()) or parse(docs))
    got = sorted((r.root_ix, tuple(r.ord), r.loc[-1]) for r in sitemap.expand(places, captured).collect())
    assert got == [(1, (0, 0, 1, 1), "e"), (1, (0, 1), "c"), (2, (0, 0, 1), "c"), (2, (0, 1), "e")]
    assert sorted(parsed) == list("abcde" if sought == 8 else "abcdexy")


def test_no_place_lists_nothing(spark):
    captured = _maps(spark, {"a": ""})
    places = spark.createDataFrame([], "root_ix int, ord int, sitemap_url string")
    rows = sitemap.expand(places, captured)
    assert rows.count() == 0 and {"root_ix", "ord", "entry_ix", "loc", "lastmod"} <= set(rows.columns)


def _parquet(spark, folder):
    html = "<html><body><p>" + "Some words that make a page long enough to be kept. " * 5 + "</p></body></html>"
    rows = [(k, f"https://www.s{k % 3}.com/en/{k}/x", html) for k in range(12)]
    spark.createDataFrame(rows, "page_id bigint, url string, html string").write.parquet(f"{folder}/pages.parquet")
    return Inputs(spark, str(folder))


def test_known_pages_are_cut_once(spark, tmp_path, monkeypatch):
    x = _parquet(spark, tmp_path)
    calls = []
    page_chunks = checks.content.page_chunks
    monkeypatch.setattr(checks.content, "page_chunks", lambda *a: calls.append(1) or page_chunks(*a))
    web = checks.web(x)
    assert len(calls) == 1
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(web.state) == rows(checks.known_state(x)) and rows(web.chunks) == rows(checks.known_chunks(x))
    assert web.captures.columns == x.fx_web.columns and web.captures.dtypes == x.fx_web.dtypes
    assert rows(web.captures) == rows(x.fx_web)


def test_pieces_of_addresses(spark):
    """One match gives what five gave; leading control characters and line ends go."""
    cases = [
        "https://u:p@E.com:80/a;b/c;d?x=1?2#y#z", " \x00\t HTTP://e.com", "//e.com?q", "?q#f", "#f", "", "a:b:c", "1a:b", "/p//q", "a\nb:c\t/d",
        "mailto:x@y", "http:", "http:///p", "x:?#", "$1\\n", "/a#b\r\nc", "\u00a0/x", "ht\u0131p://e",
    ]
    one = spark.createDataFrame([(k, c) for k, c in enumerate([*cases, None])], "k int, c string")
    regex = [F.regexp_extract(urls._tidy(F.col("c")), urls._PARTS, k + 1) for k in range(5)]
    got = one.select("c", urls.pieces(F.col("c")).alias("p"), F.array(*regex).alias("five")).collect()
    assert all(r.p == (None if r.c is None else r.five) for r in got)


@pytest.mark.parametrize("size, overlap", [(10, 3), (7, 0), (1024, 256)])
def test_windows_of_one_byte_and_other_characters(spark, size, overlap):
    """Text of one-byte characters is cut by bytes, other text by characters: both as slices do."""
    texts = [("abcdefghij" * 3001)[:n] for n in (0, 1, 9, 10, 11, 17, 18, 160, 161, 1025, 30010)]
    texts += [t.replace("c", "\u00e9").replace("d", "\U0001f600") for t in texts]
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "t string")
    step = size - overlap
    for r in df.select("t", text.chunks(F.col("t"), size, overlap).alias("c")).collect():
        starts = range(0, max(1, len(r.t) - overlap), step) if r.t else ()
        assert r.c == ([None] if r.t is None else [r.t[k : k + size] for k in starts])


def test_an_address_is_cut_up_once_a_link(spark):
    rows = spark.createDataFrame([("https://e.com/a", 0, "b")], "src_url string, href_ix int, href string")
    plan = links.resolve(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("([A-Za-z][A-Za-z0-9+.-]*):)?") <= 4
