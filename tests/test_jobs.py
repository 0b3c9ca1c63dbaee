"""Ordering helpers, state transitions, the store, sessions over time, and streams against batches."""

import random
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from webtide.functions import text
from webtide.operators import content, crawl, fetchlog, freshness, links, report, sitemap, sync
from webtide.params import Params
from webtide.plans.lineage import Scratch
from webtide.plans import politeness
from webtide.plans.order import running, with_global_index
from webtide.plans.session import Web, run_session
from webtide.sources.store import CHUNK_SCHEMA, CorpusStore, Manifest, PublishConflict
from webtide.streaming.alarms import count_batch, next_carry, start_alarms
from webtide.streaming.carry import KeyedCarry
from webtide.streaming.ingest import start_ingest
from webtide.streaming.logroll import closed_rollup, open_windows, start_rollup


def test_global_index(spark):
    words = [f"{random.Random(i).random()}" for i in range(500)]
    df = spark.createDataFrame([(w,) for w in words], "url string").repartition(7)
    got = {r.url: r.ix for r in with_global_index(df, ["url"]).collect()}
    assert got == {w: i + 1 for i, w in enumerate(sorted(words))}


@pytest.mark.parametrize("blocks", [1, 3, 7, 40])
def test_running_blocks(spark, blocks):
    """Sparse order values, NULL keys and a NULL order: every row is there, and a hot key has several blocks."""
    rng = random.Random(blocks)
    rows = []
    for run in ("hot", "cold", None):
        for k in range(200 if run == "hot" else 9):
            seq = None if run is None and k == 0 else 1706745600000 + 977 * k * k
            rows.append((run, 1 if run else None, seq, rng.choice(["ok", "failed", "failed", "ignored"]), "timeout"))
    df = spark.createDataFrame(rows, "run_id string, batch_no int, seq long, outcome string, reason string")
    got = {(r.run_id, r.seq): r.fails for r in fetchlog.backoff(df, Params(), blocks).collect()}
    want, fails = {}, {}
    for run, _, seq, outcome, _ in rows:
        n = fails.get(run, 0)
        fails[run] = 0 if outcome == "ok" else n + 1 if outcome == "failed" else n
        want[run, seq] = fails[run]
    assert got == want


def test_backoff_disabled(spark):
    df = spark.createDataFrame([("r", 1, 0, "failed", "x")], "run_id string, batch_no int, seq long, outcome string, reason string")
    row = fetchlog.backoff(df, Params(adaptive_backoff=False)).first()
    assert (row.fails, row.wait_s, row.alarm) == (0, 0.0, False)


def test_alarm_carry(spark):
    rng = random.Random(3)
    rows = [(f"h{rng.randint(0, 2)}", i, rng.choice(["ok", "failed", "failed", "ignored"])) for i in range(300)]
    schema = "host string, seq long, outcome string"
    carried = spark.createDataFrame([], "host string, open_fails bigint")
    got = {}
    for start in range(0, 300, 60):
        batch = spark.createDataFrame(rows[start:start + 60], schema)
        counted = count_batch(batch, carried, ["host"])
        got.update({r.seq: r.fails for r in counted.collect()})
        carried = spark.createDataFrame(next_carry(counted, carried, ["host"]).collect(), carried.schema)
    want, fails = {}, {}
    for host, seq, outcome in rows:
        n = fails.get(host, 0)
        fails[host] = 0 if outcome == "ok" else n + 1 if outcome == "failed" else n
        want[seq] = fails[host]
    assert got == want


def test_store_versions(spark, tmp_path):
    store = CorpusStore(spark, str(tmp_path))
    assert store.version() == 0 and store.read_state().isEmpty() and store.read_chunks().isEmpty()
    now = F.timestamp_seconds(F.lit(1))
    state = lambda *urls: spark.createDataFrame([(u, "h", 1) for u in urls], "url string, content_hash string, chunk_count int")
    chunk = lambda s, ix, t: (s, ix, t, f"sha-{t}", s, "s")
    chunks = lambda *rows: spark.createDataFrame([chunk(*r) for r in rows], "source string, chunk_ix int, text string, chunk_sha string, url string, session_id string")
    full = sync.upsert(store.read_state(), state("a", "b"), "s", now)
    store.publish(full, chunks(("a", 0, "x"), ("a", 1, "x"), ("b", 0, "y")), session_id="one")
    gone = spark.createDataFrame([("a", "sha-x")], "source string, chunk_sha string")
    changed = sync.upsert(state("a").limit(0).select("url").join(full, "url"), state("a"), "t", now)
    store.publish(changed, chunks(("a", 0, "x2"), ("b", 1, "x")), gone, session_id="two", whole_state=False)
    # a text that was removed and comes back is there again
    store.publish(changed, chunks(("a", 5, "x")), session_id="three", whole_state=False)
    # begun and never published: invisible
    chunks(("z", 0, "z")).write.parquet(f"{tmp_path}/added/part=4-x")
    want = [("a", 0, "x2"), ("a", 5, "x"), ("b", 0, "y"), ("b", 1, "x")]
    read = lambda: sorted((r.source, r.chunk_ix, r.text) for r in store.read_chunks().collect())
    assert read() == want
    assert {r.url: r.session_id for r in store.read_state().collect()} == {"a": "t", "b": "s"}
    assert store.has_session("two") and not store.has_session("four")
    assert store.compact() == 4 and read() == want


def page(words, links=()):
    anchors = "".join(f'<a href="{u}"></a>' for u in links)
    return f"<html><body><p>{' '.join(words)}</p>{anchors}</body></html>"


PARAMS = Params(chunk_size=80, chunk_overlap=0, min_chunk_length=10, follow_robots_txt=True, remove_delay=2)
WORDS = [f"word{i}" for i in range(60)]


def web(spark, pages, state, chunks, heads=(), attempts=(), sitemap=""):
    make = lambda rows, schema: spark.createDataFrame(list(rows), schema)
    return Web(
        seeds=make([("https://e.com",)], "url string"),
        scope=make([("e.com", "root", "/")], "domain string, kind string, prefix string"),
        robots=make([("e.com", "https", 200, "User-agent: *\nDisallow: /private")], "domain string, proto string, status int, text string"),
        sitemaps=make([("https://e.com/sitemap.xml", 200, sitemap)], "sitemap_url string, status int, text string"),
        captures=make([(u, s, e, b) for u, (s, e, b) in pages.items()], "url string, status int, error string, body string"),
        heads=make(heads, "url string, status int, last_modified string, error string"),
        attempts=make(attempts, "url string, attempt int, error string, body string"),
        state=state,
        chunks=chunks,
    )


def test_sessions_over_time(spark, tmp_path):
    """Each row of the transition table, through three published sessions."""
    store = CorpusStore(spark, str(tmp_path))
    stamp = lambda n: F.timestamp_seconds(F.lit(1706745600 + n * 86400))
    base = "https://e.com"
    links = [f"{base}/{p}" for p in ("a", "b", "c", "bad", "private/x", "gone")]
    pages = {
        base: (200, None, page(WORDS, links)),
        **{f"{base}/{p}": (200, None, page([f"{p}{w}" for w in WORDS])) for p in "abc"},
        f"{base}/gone": (200, None, page([f"gone{w}" for w in WORDS])),
        f"{base}/private/x": (200, None, page(WORDS)),
        f"{base}/bad": (200, "Read timed out", None),
    }

    def go(n, pages, **kw):
        name = f"s{n}"
        params = replace(PARAMS, **kw.pop("params", {}))
        s = run_session(web(spark, pages, store.read_state(), store.read_chunks(), **kw), params, name, stamp(n))
        message = s.summary.first()
        store.publish(s.state, s.added, s.removed, session_id=name)
        state = {r.url: r for r in store.read_state().collect()}
        assert len(state) == store.read_state().count()
        texts = {}
        for r in store.read_chunks().collect():
            texts.setdefault(r.source, []).append(r.text)
        return message, state, texts

    # first session: everything is new, one page fails
    m1, st1, tx1 = go(1, pages)
    assert (m1.ingested, m1.skipped, m1.failed, m1.removed) == (5, 0, 1, 0)
    assert set(st1) == set(tx1) == {base, *[f"{base}/{p}" for p in ("a", "b", "c", "gone")]}

    ok = lambda *urls: [(u, 200, None, None) for u in urls]
    known = list(st1)
    # same input again: only skips, no chunk changes
    m2, st2, tx2 = go(2, pages, heads=ok(*known))
    assert (m2.ingested, m2.skipped, m2.failed) == (0, 5, 1)
    assert tx2 == tx1 and all(r.session_id == "s2" for r in st2.values())

    # a changes, b is listed as old, c answers as unchanged, bad recovers, gone is linked no more
    pages[base] = (200, None, page(WORDS, links[:-1]))
    pages[f"{base}/a"] = (200, None, page([f"a{w}" for w in WORDS[:-12]] + ["fresh"] * 12))
    listed = f"<urlset><url><loc>{base}/b</loc><lastmod>2024-01-01</lastmod></url></urlset>"
    heads = ok(base, f"{base}/a", f"{base}/gone") + [(f"{base}/c", 200, "Mon, 01 Jan 2024 00:00:00 GMT", None)]
    again = [(f"{base}/bad", 1, "timeout", None), (f"{base}/bad", 2, None, page([f"bad{w}" for w in WORDS]))]
    m3, st3, tx3 = go(3, pages, heads=heads, attempts=again, sitemap=listed)
    assert (m3.ingested, m3.failed, m3.removed, m3.recovered) == (1, 0, 0, 1)
    assert st3[f"{base}/b"].session_id == "s3" and st3[f"{base}/b"].content_hash == st1[f"{base}/b"].content_hash
    assert st3[f"{base}/c"].session_id == "s2"
    assert st3[f"{base}/gone"].miss_count == 1 and tx3[f"{base}/gone"] == tx1[f"{base}/gone"]
    assert st3[f"{base}/bad"].content_hash == sync.RETRIED and st3[f"{base}/bad"].chunk_count == 0
    fresh = spark.createDataFrame([(f"{base}/a", pages[f"{base}/a"][2])], "url string, body string")
    scratch = content.page_chunks(content.page_texts(fresh, PARAMS), PARAMS).first().chunks
    assert set(tx3[f"{base}/a"]) == set(scratch) and set(tx3[f"{base}/a"]) & set(tx1[f"{base}/a"])

    # the second miss removes what is gone; the recovered page is compared anew
    pages[f"{base}/bad"] = (200, None, page([f"bad{w}" for w in WORDS]))
    m4, st4, tx4 = go(4, pages, heads=ok(*known, f"{base}/bad"))
    assert m4.removed == 1 and f"{base}/gone" not in st4 and f"{base}/gone" not in tx4
    assert st4[f"{base}/bad"].content_hash != sync.RETRIED and tx4[f"{base}/bad"] == tx3[f"{base}/bad"]

    # nothing to update: the run stops before cleanup
    broken = [(u, 503, None, None) for u in st4]
    m5, st5, _ = go(5, {u: p for u, p in pages.items() if u in st4}, heads=broken)
    assert m5.message == f"All {len(st4)} pages unchanged (0.0 min)."
    assert {u: r.session_id for u, r in st5.items()} == {u: r.session_id for u, r in st4.items()}

    # nothing found at all
    m6, st6, _ = go(6, {base: (404, None, None)})
    assert m6.message == "No pages scraped (0.0 min)." and set(st6) == set(st5)


@pytest.mark.parametrize("delay,miss,action", [(0, 0, "remove"), (1, 0, "remove"), (2, 0, "miss"), (2, 1, "remove")])
def test_stale_delay(spark, delay, miss, action):
    stale = spark.createDataFrame([("u", miss)], "url string, miss_count int")
    assert sync.stale_actions(stale, delay).first().action == action


def test_diff_keeps_copies(spark):
    schema = "source string, chunk_ix int, chunk_sha string"
    old = spark.createDataFrame([("s", 0, "a"), ("s", 1, "a"), ("s", 2, "b"), ("t", 0, "a")], schema)
    new = spark.createDataFrame([("s", 0, "a"), ("s", 1, "c"), ("s", 2, "c")], schema)
    rows = lambda df: sorted((r.source, r.chunk_ix, r.chunk_sha) for r in df.collect())
    assert rows(sync.chunks_to_add(old, new)) == [("s", 1, "c"), ("s", 2, "c")]
    assert rows(sync.chunks_to_delete(old.filter("source = 's'"), new)) == [("s", 2, "b")]


def test_chunk_changes(spark):
    """Copies are counted per side; NULL is a key like any other; nothing comes or goes without a difference."""
    schema = "source string, chunk_ix int, chunk_sha string"
    old = spark.createDataFrame([("s", 0, "a"), ("s", 1, "a"), ("s", 2, "b"), ("s", 3, "b"), (None, 0, "n"), (None, 1, "o")], schema)
    new = spark.createDataFrame([("s", 0, "a"), ("s", 1, "c"), ("s", 2, "c"), ("t", 0, "a"), (None, 0, "n"), (None, 1, "p")], schema)
    changes = sync.chunk_changes(old, new)
    got = sorted((str(r.source), r.chunk_sha, r.n_old, r.n_new) for r in changes.collect())
    assert got == [("None", "o", 1, 0), ("None", "p", 0, 1), ("s", "b", 2, 0), ("s", "c", 0, 2), ("t", "a", 0, 1)]
    rows = lambda df: sorted(tuple(str(v) for v in r) for r in df.collect())
    assert rows(sync.coming(new, changes)) == [("None", "1", "p"), ("s", "1", "c"), ("s", "2", "c"), ("t", "0", "a")]
    assert rows(sync.going(changes)) == [("None", "o"), ("s", "b")]
    none = old.limit(0)
    assert sync.chunk_changes(none, none).count() == 0
    assert rows(sync.coming(old, sync.chunk_changes(none, old))) == rows(old)
    plan = sync.chunk_changes(old, new)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_state_is_scanned_once_before_pages_are_read(spark, tmp_path):
    """Listed dates, headers and decisions share one scan; candidates are shuffled by url once."""
    state = spark.createDataFrame([("u", "h", 1, None, "s", 0)], sync.STATE_SCHEMA)
    state.write.parquet(f"{tmp_path}/state")
    state = spark.read.parquet(f"{tmp_path}/state")
    frame = lambda schema: spark.createDataFrame([], schema)
    listed, heads = frame("loc string, lastmod timestamp"), frame("url string, status int, last_modified string, error string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        met = freshness.meet(frame("url string"), listed, heads, state)
        plan = met._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("FileScan parquet") == 1 and plan.count("Exchange hashpartitioning") == 4


def test_stale_pages_of_visited_sites(spark):
    """Pages of other sites, and of no site, are neither missed nor removed."""
    urls = ["https://www.A.com/x", "https://a.com/kept", "https://b.com/x", "no address"]
    state = spark.createDataFrame([(u, "h", 1, None, "s0", 0) for u in urls] + [("https://a.com/now", "h", 1, None, "s1", 0)], sync.STATE_SCHEMA)
    keep = spark.createDataFrame([("https://a.com/kept",)], "url string")
    sites = spark.createDataFrame([("a.com",), ("a.com",), ("",), (None,)], "domain string")
    got = sync.stale_urls(state, "s1", keep, sites)
    assert got.columns == state.columns and [r.url for r in got.collect()] == ["https://www.A.com/x"]
    assert {r.url for r in sync.stale_urls(state, "s1", keep).collect()} == set(urls) - {"https://a.com/kept"}
    assert sync.stale_urls(state, "s1", keep, sites.limit(0)).count() == 0


@pytest.mark.parametrize("in_sites", [False, True])
def test_session_over_one_site(spark, in_sites):
    """A session that visits one site removes pages of the others only if it is told to look at all."""
    base = "https://e.com"
    state = spark.createDataFrame(
        [(u, "h", 1, datetime(2024, 1, 1), "s0", 0) for u in (f"{base}/gone", "https://other.com/")], sync.STATE_SCHEMA
    )
    chunks = spark.createDataFrame([], CHUNK_SCHEMA)
    s = run_session(web(spark, {base: (200, None, page(WORDS))}, state, chunks), replace(PARAMS, remove_delay=0, stale_in_sites=in_sites), "s1", F.timestamp_seconds(F.lit(1706745600)))
    assert {r.url for r in s.state.collect()} == {base} | ({"https://other.com/"} if in_sites else set())


def test_hrefs(spark):
    body = """<a href="/1">x</a><A title='a>b' HREF='/2&amp;3'>y</A><a href=/4>z</a><a name=q>n</a>
      <!-- <a href="/5"> --><script>"<a href='/6'>"</script><abbr href="/7"><a data-href="/8"><a
      class=k href = "/9" id=z><a href="/1">again</a><a disabled href="">e</a>"""
    df = spark.createDataFrame([("https://e.com/p", body)], "url string, body string")
    got = [r.href for r in links.extract_hrefs(df).orderBy("href_ix").collect()]
    assert got == ["/1", "/2&3", "/4", "/9", "/1", ""]


def test_hooks_are_transforms(spark):
    """Own steps go between the stages as DataFrame -> DataFrame functions."""
    shout = lambda df: df.withColumn("text", F.upper("text"))
    pages = spark.createDataFrame([("u", "<p>" + "hello world " * 10 + "</p>")], "url string, body string")
    out = content.page_texts(pages, Params()).transform(shout).transform(content.page_chunks, Params())
    assert out.first().chunks == [("HELLO WORLD " * 10).strip()]


@pytest.mark.parametrize("bad", [
    {"remove_delay": -1}, {"max_retry_attempts": 0}, {"max_retry_attempts": 11}, {"batch_size": 0},
    {"batch_size": 1001}, {"chunk_overlap": -1}, {"max_depth": -2},
])
def test_params(bad):
    with pytest.raises(ValueError):
        Params(**bad)


def test_running_splits_a_hot_key(spark):
    df = spark.range(20000).selectExpr("'h' AS run_id", "id * 86400000 AS seq", "1 AS one")
    out = running(df, ["run_id"], "seq", {"total": F.col("one")}, blocks=8)
    assert out.agg(F.max("total"), F.count("*")).first()[:] == (20000, 20000)
    scan = [line for line in out._jdf.queryExecution().toString().splitlines() if "Window" in line]
    assert any("_block" in line for line in scan)


def test_no_fetch_without_outcome(spark):
    rows = [(u, s, e, b, a) for u, (s, e, b, a) in enumerate([(None, None, "x", True), (None, None, None, None), (200, None, "word " * 40, None), (500, None, "", True), (None, "timeout", None, None), (200, None, "y" * 50, False)])]
    df = spark.createDataFrame(rows, "i int, status int, error string, body string, allowed boolean")
    got = {r.i: (r.outcome, r.reason) for r in fetchlog.classify(df).collect()}
    assert None not in {o for o, _ in got.values()} and len(got) == 6
    assert got[0] == got[1] == ("failed", "http_unknown") and got[4] == ("failed", "timeout") and got[5][0] == "ignored"


def test_two_publishers(spark, tmp_path):
    one, two = CorpusStore(spark, str(tmp_path)), CorpusStore(spark, str(tmp_path))
    two._manifest = lambda: Manifest(buckets=32)  # has looked before the other one published
    empty = one.read_chunks()
    state = lambda u: sync.upsert(one.read_state(), spark.createDataFrame([(u, "h", 1)], "url string, content_hash string, chunk_count int"), "s", F.timestamp_seconds(F.lit(1)))
    one.publish(state("a"), empty, session_id="first")
    with pytest.raises(PublishConflict):
        two.publish(state("b"), empty, session_id="second")
    assert [r.url for r in one.read_state().collect()] == ["a"] and not one.has_session("second")


def test_two_sources_of_one_session(spark, tmp_path):
    """Each has its own checkpoint, where batch ids begin at 0; nothing of the second is taken for known."""
    store = CorpusStore(spark, f"{tmp_path}/store")
    now = F.timestamp_seconds(F.lit(1706745600))
    schema = "url string, seq long, status int, error string, body string"
    for k in range(2):
        rows = [(f"https://e.com/{k}-{i}", i, 200, None, page([f"{k}{i}{w}" for w in WORDS])) for i in range(6)]
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/in{k}")
        for _ in range(2):  # a restart changes nothing
            stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in{k}")
            start_ingest(stream, store, PARAMS, "s", now, f"{tmp_path}/cp{k}").awaitTermination()
    assert store.read_state().count() == 12 and store.version() == 2


def test_two_alarm_queries_on_one_path(spark, tmp_path):
    schema = "host string, seq long, outcome string, reason string"
    for k in range(2):
        rows = [(None if k else "h", i, "failed", "timeout") for i in range(4)]
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/in{k}")
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in{k}")
        start_alarms(stream, str(tmp_path), Params(), ["host"], f"{tmp_path}/cp{k}").awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/alarms/*").collect()
    assert sorted((r.host or "", r.fails) for r in got) == [("", 1), ("", 2), ("", 3), ("", 4), ("h", 1), ("h", 2), ("h", 3), ("h", 4)]


def test_text_is_worked_out_once(spark):
    """A filter on what comes out of the text does not copy the text pipeline below itself."""
    pages = spark.createDataFrame([("u", "<p>x</p>")], "url string, body string")
    made = content.page_chunks(content.page_texts(pages, Params()), Params())
    times = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace")
    assert times(made.filter(F.col("chunk_count") > 0)) <= times(made)


def test_broken_xml_kinds(spark):
    """Text after the root, a second root and an undeclared prefix make a document broken: no dates, no children."""
    url = "<url><loc>https://e.com/a</loc><lastmod>2024-01-01</lastmod></url>"
    ns = 'xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"'
    good = [f"<urlset {ns}>{url}</urlset>", f'<?xml version="1.0"?>\n<!-- x -->\n<urlset>{url}</urlset>\n<!-- y -->\n',
            f'<urlset xmlns:i="u">{url.replace("</loc>", "</loc><i:image/>")}</urlset>']
    bad = [f"<urlset>{url}</urlset>more", f"<urlset>{url}</urlset><urlset>{url}</urlset>", f"<urlset>{url.replace('</loc>', '</loc><i:image/>')}</urlset>",
           f"<urlset>{url}"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(good + bad)], "i int, text string")
    rows = sitemap.entries(sitemap.parse(df)).collect()
    assert {r.i for r in rows} == set(range(7))
    assert {r.i for r in rows if r.lastmod is not None} == {0, 1, 2}


def test_sitemaps_are_parsed_once(spark):
    """Fifty roots of one host share an index: entries come per root, or once for the last root."""
    index = "<sitemapindex><sitemap><loc>https://e.com/m.xml</loc></sitemap></sitemapindex>"
    leaf = "<urlset>" + "".join(f"<url><loc>https://e.com/{i}</loc></url>" for i in range(20)) + "</urlset>"
    captured = spark.createDataFrame([("https://e.com/i.xml", 200, index), ("https://e.com/m.xml", 200, leaf)], "sitemap_url string, status int, text string")
    places = spark.range(50).selectExpr("id AS root_ix", "0 AS ord", "'https://e.com/i.xml' AS sitemap_url")
    every = sitemap.expand(places, captured)
    last = sitemap.expand(places, captured, last_root_only=True)
    assert every.count() == 1000 and last.count() == 20 and {r.root_ix for r in last.collect()} == {49}
    key = ["root_ix", "ord", "entry_ix"]
    pick = lambda rows: sorted(tuple(r) for r in sitemap.last_per_url(rows, *key).collect())
    assert pick(every) == pick(last)


def test_latest_capture(spark):
    rows = [("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y"), ("b", None, "n"), ("c", 5, "p"), ("c", 5, "q"), (None, 1, "u")]
    df = spark.createDataFrame(rows, "url string, seq int, body string")
    from webtide.sources.captures import latest

    assert sorted(((r.url or ""), r.seq, r.body) for r in latest(df, "seq").collect()) == [("", 1, "u"), ("a", 3, "z"), ("b", None, "n"), ("c", 5, "q")]


@pytest.mark.parametrize("few", [0, 1000])
def test_a_level_moves_only_the_links_that_leave_it(spark, few):
    """Edges, visited URLs and ends lie in buckets: whatever their size, the one shuffle of a level is over what it met."""
    scratch = Scratch(spark)
    rows = [(f"u{i}", f"u{(3 * i + k) % 200}", "root") for i in range(200) for k in range(3)]
    graph, _ = scratch.add_bucketed(spark.createDataFrame(rows, "src_url string, dst_url string, kind string").repartition(8, "src_url"), "edges", "src_url", 8)
    ends, _ = scratch.add_bucketed(spark.createDataFrame([(f"u{i}", "scraped") for i in range(200)], "url string, fin string"), "ends", "url", 8)
    seen = spark.createDataFrame([(f"u{i}", 0, "seed", "scraped") for i in range(20)], "url string, depth int, origin string, disposition string")
    visited, stats = scratch.add_bucketed(seen, "visited", "url", 8)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frontier = visited.filter("depth = 0").select(F.col("url").alias("src_url"))
        met = crawl.leaving(frontier, graph, stats["rows"], few)
        level = crawl._visit(crawl._next_level(met, visited, 1, Params()), ends)
        plan = level._jdf.queryExecution().executedPlan().toString()
        got = {r.url for r in level.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert plan.count("Exchange ") == 1 and "BroadcastExchange" not in plan
    assert ("In(src_url" in plan) == bool(few)
    assert got == {d for s, d, _ in rows if int(s[1:]) < 20} - {f"u{i}" for i in range(20)}
    # rows added later are read together with those before
    both, _ = scratch.add_bucketed(level, "visited", "url", 8)
    assert both.count() == 20 + len(got)
    assert {r.url for r in both.filter("depth = 1").collect()} == got
    scratch.forget("edges", "ends", "visited")


def _batch(spark, urls, text, n):
    state = spark.createDataFrame([(u, text, 1) for u in urls], "url string, content_hash string, chunk_count int")
    rows = sync.upsert(spark.createDataFrame([], sync.STATE_SCHEMA), state, f"s{n}", F.timestamp_seconds(F.lit(n)))
    chunks = [(u, 0, text, text, u, f"s{n}") for u in urls]
    return rows, spark.createDataFrame(chunks, "source string, chunk_ix int, text string, chunk_sha string, url string, session_id string")


def test_a_batch_reads_the_buckets_of_its_keys(spark, tmp_path):
    store = CorpusStore(spark, str(tmp_path), buckets=16)
    urls = [f"https://e.com/{i}" for i in range(300)]
    store.publish(*_batch(spark, urls, "old", 1))
    one = spark.createDataFrame([(urls[7],)], "u string")
    state, chunks = store.read_state(one), store.read_chunks(one)
    for df, kind in ((state, "state"), (chunks, "added")):
        places = {f.split(f"/{kind}/")[1].split("/")[1] for f in df.inputFiles()}
        assert len(places) == 1 and df.count() == 1
    assert len({f.split("/")[-2] for f in store.read_state().inputFiles()}) == 16
    # what a batch writes lies in the buckets of its keys as well
    store.publish(*_batch(spark, urls[7:8], "new", 2), whole_state=False)
    assert len(store._manifest().parts["state"]) == 16
    assert sorted(len(p) for p in store._manifest().parts["state"].values()) == [1] * 15 + [2]
    assert {r.content_hash for r in store.read_state(one).collect()} == {"new"}


def test_a_store_stays_as_large_as_its_content(spark, tmp_path):
    """Twenty batches on a few pages: parts, manifests and files do not add up, and every read is right."""
    store = CorpusStore(spark, str(tmp_path), buckets=2, most_parts=3, keep=1)
    want, files = {}, []
    gone = lambda u, t: spark.createDataFrame([(u, t)], "source string, chunk_sha string")
    for n in range(1, 21):
        url = f"u{n % 3}"
        state, added = _batch(spark, [url], f"t{n}", n)
        removed = gone(url, want[url]) if url in want else None
        forgotten = None
        if n % 7 == 0 and "u0" in want:
            forgotten = spark.createDataFrame([("u0",)], "url string")
            removed = gone("u0", want.pop("u0")) if url != "u0" else removed
        store.publish(state if url != "u0" or forgotten is None else state.limit(0), added, removed, session_id=f"b{n}", whole_state=False, forgotten=forgotten)
        want[url] = f"t{n}"
        if forgotten is not None and url == "u0":
            want_state = {u: t for u, t in want.items() if u != "u0"}
        else:
            want_state = dict(want)
        chunks = sorted((r.source, r.text) for r in store.read_chunks().collect())
        assert {c for c in chunks} >= set(want_state.items())
        assert {r.url: r.content_hash for r in store.read_state().collect()} == want_state
        if url == "u0" and forgotten is not None:
            want.pop("u0", None)
            store.publish(state.limit(0), added.limit(0), gone("u0", f"t{n}"), whole_state=False)
        files.append(sum(1 for f in tmp_path.rglob("*.parquet")))
        assert all(len(p) <= 3 for k in store._manifest().parts.values() for p in k.values())
    assert max(files[8:]) <= 2 * max(files[:8]) and len(list((tmp_path / "published").glob("*.json"))) == 2
    assert store.has_session("b20") and store.has_session("b1")


PLAIN = "  a <b and c> d &amp; e\n\n" + "kept   as it is <p> " * 12
PAGED = "\f".join(f"page {k} " + f"w{k} " * 40 for k in range(3))


def test_page_kind(spark):
    cases = [
        ("text/plain", "u.pdf", "plain"), (" Text/Plain ; charset=x", "u", "plain"), ("application/pdf", "u", "paged"),
        ("text/html; charset=utf-8", "u.pdf", "html"), (None, "u.PDF", "paged"), ("application/octet-stream", "u.pdf", "paged"),
        (None, "u.txt", "plain"), ("", "u", "html"), (None, None, "html"), ("image/png", "u.md", "plain"),
    ]
    rows = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, t string, u string, want string")
    got = rows.select("want", text.page_kind(F.col("t"), F.col("u")).alias("kind"), F.col("t"), F.col("u")).collect()
    assert [(r.t, r.u, r.kind) for r in got] == cases


def test_bodies_are_read_by_their_type(spark):
    """Plain text keeps what looks like tags, pages of a document are cut one by one, nothing crashes on nulls."""
    rows = [("h", "text/html", PLAIN), ("t", "text/plain", PLAIN), ("d", "application/pdf", PAGED), ("n", None, None), ("e", "text/plain", ""), ("d2.pdf", None, PAGED + "\f\f")]
    pages = spark.createDataFrame(rows, "url string, content_type string, body string")
    params = Params(chunk_size=100, chunk_overlap=20, min_chunk_length=1)
    texts = content.page_texts(pages, replace(params, ignore_display_none=True))
    by = {r.url: r for r in texts.collect()}
    assert by["t"].text == PLAIN and "<b" not in by["h"].text and by["d"].text == PAGED
    assert [u for u, r in by.items() if r.paged] == ["d", "d2.pdf"] and set(texts.columns) == {"url", "text", "paged"}
    made = {r.url: r for r in content.page_chunks(texts, params).collect()}
    each = [p[k:k + 100] for p in PAGED.split("\f") for k in range(0, max(len(p) - 20, 1), 80)]
    assert made["d"].chunks == each and made["d2.pdf"].chunks == each and made["e"].chunks == []
    assert not any("\f" in c for c in made["d"].chunks)


def test_types_reach_session_and_stream(spark, tmp_path):
    """Plain text comes unchanged through a whole session and through the stream."""
    base = "https://e.com"
    bodies = {base: ("text/html", page(WORDS, [f"{base}/t", f"{base}/d"])), f"{base}/t": ("text/plain", PLAIN), f"{base}/d": ("application/pdf", PAGED)}
    big = replace(PARAMS, chunk_size=4000)
    store = CorpusStore(spark, str(tmp_path / "batch"))
    one = web(spark, {u: (200, None, b) for u, (_, b) in bodies.items()}, store.read_state(), store.read_chunks())
    types = spark.createDataFrame([(u, t) for u, (t, _) in bodies.items()], "url string, content_type string")
    added = run_session(replace(one, captures=one.captures.join(types, "url")), big, "s1", F.timestamp_seconds(F.lit(1))).added
    texts = lambda rows: {u: [r.text for r in sorted(rows, key=lambda r: r.chunk_ix) if r.source == u] for u in bodies}
    want = texts(added.collect())
    assert want[f"{base}/t"] == [PLAIN] and want[f"{base}/d"] == PAGED.split("\f")
    assert "<p>" not in want[base][0]

    rows = [(u, k, 200, None, t, b) for k, (u, (t, b)) in enumerate(bodies.items())]
    frame = spark.createDataFrame(rows, "url string, seq bigint, status int, error string, content_type string, body string")
    frame.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(frame.schema).parquet(str(tmp_path / "in"))
    live = CorpusStore(spark, str(tmp_path / "live"))
    start_ingest(stream, live, big, "s1", F.timestamp_seconds(F.lit(1)), str(tmp_path / "cp")).awaitTermination()
    assert texts(live.read_chunks().collect()) == want


def test_rollup_is_closed_after_every_run(spark, tmp_path):
    """Appended and open windows together are the batch counts, each window once, also after a restart."""
    at = lambda name: str(tmp_path / name)
    lines = spark.range(400).select(
        F.timestamp_seconds(F.lit(1706745600) + F.col("id") * 97).alias("ts"),
        F.when(F.col("id") % 5 > 0, F.lit("info")).alias("level"),
        F.concat(F.lit("e"), (F.col("id") % 3).cast("string")).alias("event"),
        "id",
    )
    assert closed_rollup(spark, at("out"), at("cp")).count() == 0
    order = lambda rows: sorted(rows, key=repr)
    for run, (low, high) in enumerate([(0, 30), (30, 250), (250, 400)]):
        lines.filter(F.col("id").between(low, high - 1)).drop("id").write.mode("append").parquet(at("in"))
        stream = spark.readStream.schema(lines.drop("id").schema).parquet(at("in"))
        start_rollup(stream, "1 hour", "10 minutes", at("out"), at("cp")).awaitTermination()
        want = report.log_rollup(lines.filter(F.col("id") < high), "1 hour").collect()
        assert order(closed_rollup(spark, at("out"), at("cp")).collect()) == order(want)
        assert spark.read.parquet(at("out")).count() < len(want)
    still = open_windows(spark, at("cp")).count()
    # a batch that appended windows but did not record its end: they count once
    log = tmp_path / "cp" / "commits"
    last = max(int(n.name) for n in log.iterdir() if n.name.isdigit())
    (log / str(last)).rename(tmp_path / "commit")
    assert open_windows(spark, at("cp")).count() > still
    assert order(closed_rollup(spark, at("out"), at("cp")).collect()) == order(want)


def test_carry_follows_the_keys_of_a_batch(spark, tmp_path):
    """A batch writes the buckets of its keys, a batch that runs again the same ones, and what nobody can ask for goes."""
    base = tmp_path / "carry"
    carry = KeyedCarry(spark, str(base), "host string, open_fails bigint", ["host"], buckets=16)
    make = lambda rows: spark.createDataFrame(rows, "host string, open_fails bigint")
    want, before = {}, {}

    def step(n, changed):
        rows = make(list(changed.items()))
        touched = carry.buckets_of(rows.select("host"), n)
        found = carry.read(n, touched)
        before.setdefault(n, dict(want))
        assert all(before[n][r.host] == r.open_fails for r in found.collect())
        named = rows.select("host", F.col("open_fails").alias("_new"))
        same = found["host"].eqNullSafe(named["host"])
        kept = found.join(named, same, "left_anti").unionByName(rows).filter("open_fails > 0")
        carry.write(n, kept, touched)
        want.update(changed)
        for k in [k for k, v in want.items() if not v]:
            del want[k]
        assert {r.host: r.open_fails for r in carry.read(n + 1).collect()} == want
        return sorted(p.name for p in (base / f"part={n}").glob("bucket=*"))

    assert len(step(0, {f"h{i}": 1 for i in range(400)} | {None: 2})) == 16
    for n in range(1, 12):
        changed = {f"h{n % 3}": n + 1}
        wrote = step(n, changed)
        assert len(wrote) == 1 and step(n, changed) == wrote
    assert step(12, {f"h{i}": 0 for i in range(400)} | {None: 0}) == [] and want == {}
    step(13, {"a": 1})
    step(14, {"a": 2})
    assert sorted(p.name for p in base.iterdir() if not p.name.startswith(".")) == ["13.json", "14.json", "part=13", "part=14"]


def test_alarms_of_many_batches(spark, tmp_path):
    """Batches of few keys: the counts are those of one run over everything, and the carry stays as large as its keys."""
    rng = random.Random(9)
    rows = [(rng.choice([None, *(f"h{k}" for k in range(30))]), i, rng.choice(["ok", "failed", "failed"]), "timeout") for i in range(200)]
    schema = "host string, seq long, outcome string, reason string"
    for k in range(8):
        part = spark.createDataFrame(rows[25 * k:25 * k + 25], schema)
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        start_alarms(stream, str(tmp_path), Params(), ["host"], f"{tmp_path}/cp").awaitTermination()
    want, run = [], {}
    for host, seq, outcome, _ in rows:
        run[host] = run.get(host, 0) + 1 if outcome == "failed" else 0
        want += [(seq, run[host])] if outcome == "failed" else []
    got = spark.read.parquet(f"{tmp_path}/alarms/*").select("seq", "fails").collect()
    assert sorted(map(tuple, got)) == want
    carry = next((tmp_path / "carry").iterdir())
    assert sorted(p.name for p in carry.glob("*.json")) == ["6.json", "7.json"]
    assert len(list(carry.glob("part=*/bucket=*"))) <= 2 * 8


@pytest.mark.parametrize("obey", [True, False])
def test_fetch_plan(spark, obey):
    """Against planning page by page: a hot domain, a slow one, single ones, repeated and missing URLs."""
    rng = random.Random(4)
    addresses = [f"https://www.hot.com/{i}" for i in range(300)] + [f"https://slow.com/{i}" for i in range(9)] + [f"https://d{i}.com/" for i in range(40)]
    rows = [(u,) for u in addresses + addresses[:50] + [None, "no address"]]
    rng.shuffle(rows)
    given = {"slow.com": 7.5, "d1.com": 0.1, "d2.com": None}
    delays = spark.createDataFrame(list(given.items()), "domain string, crawl_delay double")
    params = Params(request_delay=0.3, obey_crawl_delay=obey, batch_size=7)
    plan = politeness.fetch_plan(spark.createDataFrame(rows, "url string"), delays, params)
    got = sorted(plan.collect(), key=lambda r: (r.batch_no, r.seq))

    host = lambda u: u.split("/")[2].removeprefix("www.") if "//" in u else ""
    want, seen = [], {}
    for u in sorted({u for (u,) in rows if u}):
        wait = max(0.3, (given.get(host(u)) or 0.0) if obey else 0.0)
        want.append((seen.get(host(u), 0) * wait, host(u), u, wait))
        seen[host(u)] = seen.get(host(u), 0) + 1
    want.sort()
    assert [(r.start_s, r.domain, r.url, r.delay_s, r.batch_no, r.seq) for r in got] == [
        (*w, k // 7 + 1, k % 7 + 1) for k, w in enumerate(want)
    ]
    times = sorted(politeness.batch_times(plan).collect())
    assert [t.pages for t in times] == [7] * (len(want) // 7) + [len(want) % 7] * (len(want) % 7 > 0)
    assert all(t.domains == len({r.domain for r in got if r.batch_no == t.batch_no}) for t in times)
    results = spark.createDataFrame([(u, "failed" if k % 3 else "ingested") for k, (_, _, u, _) in enumerate(want[:-5])], "url string, result string")
    last = max(politeness.progress(plan, results, "r").collect(), key=lambda r: r.batch_no)
    assert last.ingested + last.failed == len(want) - 5 and last.batch_no == times[-1].batch_no
    none = politeness.fetch_plan(spark.createDataFrame([], "url string"), delays, params)
    assert none.count() == 0
