"""Test inputs derived from the given tables, as one SQL text that Spark and DuckDB both run.

Every view is worked out row by row, or by joins and groupings on keys, from whole tables, so it grows with
them. `FIXTURES.md` lists the rules.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("pages", "documents", "events")
DAY = 86400
BASE_TS = 1705276800  # 2024-01-15T00:00:00Z
NOW_TS = 1706745600  # 2024-02-01T00:00:00Z
AGENT = "WebtideBot/1.0"


class DuckDialect:
    """DuckDB: tables are registered views."""

    def table(self, name: str) -> str:
        return name

    def sha(self, x: str) -> str:
        return f"sha256({x})"

    def epoch(self, x: str) -> str:
        return f"CAST(floor(epoch({x})) AS BIGINT)"

    def once(self, keep: str, columns: dict[str, str], relation: str) -> str:
        made = ", ".join(f"{x} AS {n}" for n, x in columns.items())
        return f"SELECT {keep}, {made} FROM {relation}"

    def each(self, n: str) -> str:
        return f"unnest(range(CAST({n} AS INT)))"


class SparkDialect:
    """Spark: tables are Parquet files of one folder."""

    def __init__(self, sf_dir: str) -> None:
        self.sf_dir = sf_dir

    def table(self, name: str) -> str:
        return f"parquet.`{self.sf_dir}/{name}.parquet`"

    def sha(self, x: str) -> str:
        return f"sha2({x}, 256)"

    def epoch(self, x: str) -> str:
        return f"timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {x})"

    def once(self, keep: str, columns: dict[str, str], relation: str) -> str:
        """Columns behind a one-row generator: not copied into every predicate above."""
        made = ", ".join(f"{x} AS {n}" for n, x in columns.items())
        names = ", ".join(columns)
        return f"SELECT {keep}, {names} FROM {relation} LATERAL VIEW inline(array(struct({made}))) AS {names}"

    def each(self, n: str) -> str:
        return f"explode(sequence(0, CAST({n} AS INT) - 1))"


def _text(i: str) -> str:
    return f"CAST({i} AS STRING)"


def _views(d) -> dict[str, str]:
    nl, crlf, quote = "chr(10)", "chr(13) || chr(10)", "chr(39)"
    line = lambda s, end=nl: f"'{s}' || {end}"
    i = _text("i")
    day = "lpad(" + _text("1 + i % 28") + ", 2, '0')"
    v: dict[str, str] = {}

    v["p0"] = d.once(
        "page_id AS i, url AS raw_url, html",
        {
            "cu": "split_part(url, '#', 1)",
            "proto": "split_part(url, '/', 1)",
            "auth": "split_part(split_part(split_part(url, '/', 3), '?', 1), '#', 1)",
            "lang": "split_part(split_part(url, '#', 1), '/', 4)",
        },
        d.table("pages"),
    )
    v["p"] = d.once(
        "i, raw_url, html, auth, proto, lang",
        {
            "dom": "CASE WHEN auth LIKE 'www.%' THEN substr(auth, 5) ELSE auth END",
            "url": f"proto || '//' || auth || '/' || lang || '/' || {i} "
            "|| substr(cu, CAST(length(proto) + 4 + length(auth) + length(lang) AS INT))",
        },
        "p0",
    )
    # every spelling of an address that the URL functions tell apart
    v["fx_urls"] = f"""
      SELECT i, 1 AS k, raw_url AS u FROM p UNION ALL
      SELECT i, 2, '  ' || raw_url || '/ ' FROM p UNION ALL
      SELECT i, 3, raw_url || '///' FROM p UNION ALL
      SELECT i, 4, raw_url || '#a/b' FROM p UNION ALL
      SELECT i, 5, 'www.' || auth || '/x' FROM p UNION ALL
      SELECT i, 6, upper(auth) FROM p UNION ALL
      SELECT i, 7, 'https://u:p@' || auth || ':80/' || {i} FROM p UNION ALL
      SELECT i, 8, 'http://' || auth || '/a b' FROM p UNION ALL
      SELECT i, 9, chr(160) || raw_url || '\u2028' || chr(28) FROM p UNION ALL
      SELECT i, 10, 'HTTP://WWW.' || auth || '?q=' || {i} FROM p UNION ALL
      SELECT i, 11, proto || '//' || auth || '/p;x/q;y=' || {i} || ';z?a=b;c' FROM p UNION ALL
      SELECT i, 12, 'mailto:a@' || auth FROM p UNION ALL
      SELECT i, 13, auth || '?x=' || {i} FROM p UNION ALL
      SELECT i, 14, 'localhost/' || {i} FROM p UNION ALL
      SELECT i, 15, '/' || lang || '/' || {i} || '?#' FROM p"""
    v["fx_seeds"] = f"""
      SELECT i AS setting,
             raw_url || ', ' || auth || '/' || lang || '/ ,,' || auth || ':8080/x,HTTP://' || auth || ','
             || proto || '//' || auth || '/a/#top, localhost ,' || auth || '?x=1,' || upper(auth)
             || ',www.' || auth || '/' || lang || '/,' AS raw
      FROM p"""
    v["doms"] = """
      SELECT dom, min(auth) AS auth, min(i) AS k, min_by(url, i) AS first_url,
             length(dom) % 5 AS cls
      FROM p GROUP BY dom"""
    v["fx_scope"] = """
      SELECT dom AS domain, 'root' AS kind, '/en' AS prefix FROM doms WHERE cls IN (0, 2) UNION ALL
      SELECT dom, 'root', '/' FROM doms WHERE cls IN (2, 3) UNION ALL
      SELECT dom, 'allowed', CAST(NULL AS STRING) FROM doms WHERE cls = 1"""
    # one prefix per page: numbers begin with other numbers
    v["fx_wide_scope"] = f"""
      SELECT dom AS domain, 'root' AS kind,
             '/' || lang || '/' || {i} || CASE WHEN i % 3 = 0 THEN '' ELSE '/only' END AS prefix
      FROM p"""

    sm = "'https://' || auth || '/sitemap-' || " + _text("k") + " || '.xml'"
    t0 = " || ".join([
        line("User-agent: *"), line("Disallow: /en/1"), line("Allow: /en"), line("Disallow: /fr"),
        line("Crawl-delay: 2"), nl, "'Sitemap: '", sm, nl])
    t1 = " || ".join([
        line("User-agent: WebtideBot"), line("User-agent: other"), line("Crawl-delay: 1.5"),
        line("Allow: /en/2"), line("Disallow: /en/2"), line("Disallow: /de/"), nl,
        line("User-agent: *"), line("Crawl-delay: 9"), line("Disallow: /"), line("# refresh: /en 3600")])
    t2 = " || ".join([
        line("# refresh: /en 3600"), line("#refresh:  /en/1   60"), line("# refresh: /en 7200"),
        line("# Refresh: /de 5"), line("User-agent: *"), nl, line("Disallow: /"),
        "'Sitemap: /sitemap-'", _text("k"), line(".xml"), "'  SITEMAP:index-'", _text("k"), line(".xml "),
        line("sitemap:")])
    t3 = " || ".join([
        line("User-agent: *"), line("Disallow: /fr"), nl, line("User-agent: *"), line("Disallow: /en"),
        line("User-agent: webtide"), line("Disallow:"), line("Crawl-delay: x"), line("Crawl-delay: 7")])
    t4 = " || ".join([
        line("User-agent: WEBTIDEBOT # c", crlf), line("Disallow: /%65n/3?", crlf),
        line("Disallow: *", crlf), line("  disallow : /es/%2F", crlf), line("# blank", crlf), line("   ", crlf),
        line("Crawl-delay: 0.25", crlf), line("User-agent: *", crlf), line("Request-rate: 1/5", crlf),
        line("Crawl-delay: 3", crlf), "'Sitemap: index-'", _text("k"), "'.xml'"])
    t5 = " || ".join([line("User-agent: nobody"), line("Disallow: /"), line("Allow: /en/"), "'User-agent: *'"])
    v["fx_robots"] = f"""
      SELECT dom AS domain, 'https' AS proto, CASE WHEN k % 7 = 6 THEN 404 ELSE 200 END AS status,
             CASE WHEN k % 6 = 0 THEN {t0} WHEN k % 6 = 1 THEN {t1} WHEN k % 6 = 2 THEN {t2}
                  WHEN k % 6 = 3 THEN {t3} WHEN k % 6 = 4 THEN {t4} ELSE {t5} END AS text
      FROM doms UNION ALL
      SELECT dom, 'http', CASE WHEN k % 5 = 4 THEN 404 ELSE 200 END,
             'User-agent: *' || {nl} || 'Disallow: /en/4' FROM doms"""

    lastmod = f"""CASE WHEN i % 5 = 0 THEN '2024-01-' || {day} || 'T12:00:00Z'
                       WHEN i % 5 = 1 THEN '2024-01-' || {day} || 'T12:00:00+0100'
                       WHEN i % 5 = 2 THEN '2024-01-' || {day} || 'T12:00:00+01:00'
                       WHEN i % 5 = 3 THEN ' 2024-1-' || {_text('1 + i % 28')} || ' '
                       ELSE '2024-01-' || {day} || 'T12:00:00.5Z' END"""
    freq = """CASE WHEN i % 8 = 0 THEN 'always' WHEN i % 8 = 1 THEN 'Hourly' WHEN i % 8 = 2 THEN 'daily'
                   WHEN i % 8 = 3 THEN 'weekly' WHEN i % 8 = 4 THEN 'MONTHLY' WHEN i % 8 = 5 THEN 'yearly'
                   WHEN i % 8 = 6 THEN 'never' ELSE '' END"""
    prio = f"CASE WHEN i % 13 = 0 THEN 'high' ELSE '0.' || {_text('i % 10')} END"
    v["pm"] = d.once(
        "i, url, auth, dom, proto",
        {
            "xurl": "replace(url, '&', '&amp;')",
            "lastmod": lastmod,
            "freq": freq,
            "prio": prio,
            "origin": "proto || '//' || auth",
        },
        "p",
    )
    entry = """'<url><loc> ' || xurl || chr(10) || '</loc><lastmod>' || lastmod || '</lastmod><changefreq>'
               || freq || '</changefreq><priority>' || prio || '</priority></url>'"""
    again = """CASE WHEN i % 4 = 0 THEN '<url><loc>' || xurl || '</loc><lastmod>2024-01-20</lastmod></url>'
                    ELSE '' END"""
    other = f"""'<url><loc>ftp://' || auth || '/f</loc></url><url><loc>' || origin || '/new/' || {i}
                || '</loc><priority>1</priority></url>'"""
    end = "CASE WHEN i % 11 = 0 THEN '<url><loc>' ELSE '</urlset>' END"
    head = """'<?xml version="1.0" encoding="UTF-8"?>' || chr(10)"""
    ns = 'xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"'
    sub = lambda name: f"'<sitemap><loc>' || origin || '/{name}-' || {i} || '.xml</loc></sitemap>'"
    index = lambda *names: (
        f"{head} || '<sitemapindex {ns}>' || " + " || ".join(sub(n) for n in names) + " || '</sitemapindex>'"
    )
    v["fx_sitemap"] = f"""
      SELECT origin || '/sitemap-' || {i} || '.xml' AS sitemap_url,
             CASE WHEN i % 19 = 0 THEN 404 ELSE 200 END AS status,
             {head} || '<urlset {ns}>' || {entry} || {again} || {other} || {end} AS text, i
      FROM pm UNION ALL
      SELECT origin || '/index-' || {i} || '.xml', 200, {index('sitemap', 'deep', 'missing')}, i FROM pm
      UNION ALL
      SELECT origin || '/deep-' || {i} || '.xml', 200, {index('index', 'sitemap')}, i FROM pm"""
    v["fx_sitemap_roots"] = f"""
      SELECT i AS root_ix, url AS root_url FROM p"""
    v["fx_declared"] = """
      SELECT root_ix, root_url FROM fx_sitemap_roots"""

    # --- captured web -------------------------------------------------------------------------------
    n = f"(SELECT count(*) FROM {d.table('pages')})"
    anchors = f"""'<a href="' || replace(t1.url, '&', '&amp;') || '#sec">one</a><A class="a>b" HREF='
      || {quote} || t2.url || {quote} || '>two</A><a href=../x' || a.si || '/./y>rel</a>'
      || '<a href="mailto:a@b.c">m</a><a href="/en/img/' || a.si || '.JPG">i</a>'
      || '<a href="/en/doc/' || a.si || '.pdf">p</a><a href="?page=' || a.sm || '">q</a><a name="n">no</a>'
      || '<a href="#top">f</a><a data-href="/en/no">no</a><!-- <a href="/en/hidden">h</a> -->'"""
    v["linked"] = f"""
      SELECT a.i, a.url, a.auth, a.dom, a.html, {anchors} AS anchors, t1.url AS u1, t2.url AS u2
      FROM (SELECT i, url, auth, dom, html, {i} AS si, {_text('i % 5')} AS sm,
                   (2 * i + 1) % {n} AS j1, (2 * i + 2) % {n} AS j2 FROM p) a
      JOIN (SELECT i, url FROM p) t1 ON t1.i = a.j1
      JOIN (SELECT i, url FROM p) t2 ON t2.i = a.j2"""
    hidden = "'<div style=\"Display : none;\">secret<div>deep</div> words</div>'"
    shown = "'<div style=\"color:red\">shown</div>'"
    v["fx_html"] = f"""
      SELECT i AS page_id, url, html AS plain,
             CASE WHEN i % 3 = 0 THEN replace(html, '</body>', {hidden} || '</body>')
                  WHEN i % 3 = 1 THEN replace(html, '</body>', {shown} || '</body>')
                  ELSE html END AS html,
             CASE WHEN i % 3 = 1 THEN replace(html, '</body>', {shown} || '</body>') ELSE html END AS expected
      FROM p"""
    status = "CASE WHEN i % 17 = 5 THEN 429 WHEN i % 23 = 7 THEN 404 ELSE 200 END"
    error = """CASE WHEN i % 37 = 9 THEN 'Read timed out' WHEN i % 41 = 11 THEN 'HTTP 429: Too Many Requests'
                    ELSE CAST(NULL AS STRING) END"""
    ctype = "CASE WHEN i % 3 = 0 THEN 'text/html; charset=utf-8' WHEN i % 3 = 1 THEN 'text/plain' WHEN i % 6 = 2 THEN ' Application/PDF;v=1' ELSE CAST(NULL AS STRING) END"
    modified = f"""CASE WHEN i % 6 = 0 THEN CAST(NULL AS STRING) WHEN i % 13 = 3 THEN 'garbage'
                        ELSE 'Mon, ' || {day} || ' Jan 2024 00:00:00 GMT' END"""
    v["fx_captures"] = f"""
      SELECT i, url, 'r' || {_text('i % 3')} AS run_id, CAST(floor(i / 50) AS BIGINT) + 1 AS batch_no, i AS seq,
             CASE WHEN i % 53 <> 7 THEN {status} END AS status, {ctype} AS content_type, {modified} AS last_modified, {error} AS error,
             CASE WHEN i % 29 = 13 THEN substr(html, 1, 60)
                  WHEN i % 31 = 17 THEN '<html><body>please solve this CAPTCHA ' || anchors || '</body></html>'
                  WHEN i % 6 = 2 THEN replace(replace(html, '<p', chr(12) || '<p'), '</body>', anchors || '</body>')
                  WHEN i % 3 = 0 THEN replace(html, '</body>', anchors || {hidden} || '</body>')
                  ELSE replace(html, '</body>', anchors || '</body>') END AS body
      FROM linked"""
    home = "CASE WHEN cls = 0 THEN 'https://' || auth || '/en' ELSE 'https://' || auth END"
    filler = "'Welcome to the first page of this site. It only says where its other pages can be found, in short.'"
    v["fx_homes"] = f"""
      SELECT k, dom, auth, cls, {home} AS url,
             '<html><body><p>' || {filler} || '</p><a href="' || replace(first_url, '&', '&amp;')
             || '">start</a></body></html>' AS body
      FROM doms WHERE cls IN (0, 2, 3)"""
    v["fx_web"] = """
      SELECT url, status, content_type, last_modified, error, body FROM fx_captures UNION ALL
      SELECT url, 200, 'text/html', CAST(NULL AS STRING), CAST(NULL AS STRING), body FROM fx_homes"""
    v["fx_links"] = "SELECT url, body FROM fx_captures"

    # --- state --------------------------------------------------------------------------------------
    last_seen = f"{BASE_TS} + (i % 10) * {DAY}"
    v["fx_pages_now"] = f"""
      SELECT i, url, {d.sha('html')} AS content_hash, CAST(floor(length(html) / 1000) AS INT) AS chunk_count
      FROM p"""
    v["fx_state"] = f"""
      SELECT url,
             CASE WHEN i % 7 = 0 THEN {d.sha("content_hash || 'old'")} ELSE content_hash END AS content_hash,
             CAST(CASE WHEN i % 11 = 0 THEN chunk_count + 1 ELSE chunk_count END AS INT) AS chunk_count,
             {last_seen} AS last_seen_s,
             CASE WHEN i % 4 = 3 THEN 's1' ELSE 's0' END AS session_id, CAST(0 AS INT) AS miss_count
      FROM fx_pages_now WHERE i % 10 <> 9 UNION ALL
      SELECT 'https://gone.example.com/' || {i}, {d.sha('url')}, CAST(2 AS INT), {last_seen},
             's0', CAST(i % 3 AS INT)
      FROM p WHERE i % 10 = 4"""
    v["fx_listed"] = f"""
      SELECT url AS loc, CASE WHEN i % 6 = 0 THEN CAST(NULL AS BIGINT)
                              ELSE {BASE_TS} + (i % 13 - 3) * {DAY} END AS lastmod_s FROM p"""
    v["fx_heads"] = f"""
      SELECT url, status, last_modified, error FROM fx_captures WHERE i % 19 <> 3"""

    # --- documents and events -----------------------------------------------------------------------
    v["docs"] = f"""
      SELECT doc_id, 'd' || {_text('doc_id')} AS source, text FROM {d.table('documents')}"""
    v["fx_old_cut"] = f"""
      SELECT doc_id, source, text, {d.each('ceil(length(text) / 192.0)')} AS k
      FROM docs WHERE length(text) > 0"""
    v["fx_chunks_old"] = f"""
      SELECT doc_id, source, CAST(k AS INT) AS chunk_ix, substr(text, k * 192 + 1, 256) AS text,
             {d.sha('substr(text, k * 192 + 1, 256)')} AS chunk_sha FROM fx_old_cut"""
    v["fx_new_text"] = """
      SELECT source, chunk_ix, CASE WHEN chunk_ix % 7 = 3 THEN text || '!' ELSE text END AS text
      FROM fx_chunks_old WHERE NOT (doc_id % 4 = 0 AND chunk_ix % 5 = 0) UNION ALL
      SELECT source, 100000 + chunk_ix, CASE WHEN doc_id % 2 = 0 THEN text ELSE text || '?' END
      FROM fx_chunks_old WHERE chunk_ix = 1"""
    v["fx_chunks_new"] = f"""
      SELECT source, chunk_ix, text, {d.sha('text')} AS chunk_sha FROM fx_new_text"""
    v["fx_doc_chunks"] = f"""
      SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN source || '.PDF' ELSE source || '.html' END AS source,
             CASE WHEN doc_id % 7 = 0 THEN 'a a  a' || repeat(' a', CAST(40 + doc_id % 9 AS INT))
                  WHEN doc_id % 7 = 1 THEN '(cid:' || {_text('doc_id')} || ')  (cid:7)' || text
                  WHEN doc_id % 7 = 2 THEN '(cid:1) ' || text
                  WHEN doc_id % 7 = 3 THEN repeat(' ', CAST(60 + doc_id % 9 AS INT))
                  WHEN doc_id % 7 = 4 THEN substr(text, 1, CAST(40 + doc_id % 20 AS INT)) ELSE text END AS text
      FROM docs"""
    v["fx_attempts"] = f"""
      SELECT 'https://e.example.com/' || {_text('CAST(floor(event_id / 3) AS BIGINT)')} AS url, event_id AS attempt_id,
             CAST(1 + event_id % 3 AS INT) AS attempt,
             CASE WHEN event_type IN ('view', 'click') THEN CAST(NULL AS STRING)
                  WHEN event_type = 'error' THEN 'HTTP 404: Not Found'
                  WHEN event_type = 'signup' THEN 'Connection reset' ELSE 'timeout' END AS error
      FROM {d.table('events')}"""
    v["fx_page_attempts"] = f"""
      SELECT url, CAST(1 AS INT) AS attempt, 'timeout' AS error, CAST(NULL AS STRING) AS body FROM p UNION ALL
      SELECT url, CAST(2 AS INT), CASE WHEN i % 3 = 0 THEN CAST(NULL AS STRING) WHEN i % 3 = 1 THEN 'HTTP 404'
                                       ELSE 'timeout' END,
             CASE WHEN i % 3 = 0 THEN html END FROM p UNION ALL
      SELECT url, CAST(3 AS INT), 'timeout', CAST(NULL AS STRING) FROM p"""
    v["fx_gone"] = f"""
      SELECT i, 'https://gone.example.com/' || {i} AS url FROM p WHERE i % 10 = 4"""
    v["fx_log"] = f"""
      SELECT event_id, ts,
             CASE WHEN event_type = 'error' THEN 'error' WHEN event_type = 'signup' THEN 'warning'
                  ELSE 'info' END AS level,
             CASE WHEN event_id % 50 = 7 THEN 'not json'
                  ELSE '{{"component": "webtide", "event": "' || event_type || '", "data": ' || props || '}}' END
               AS line
      FROM {d.table('events')}"""
    v["fx_fetches"] = f"""
      SELECT CASE WHEN user_id % 11 <> 5 THEN 'h' || {_text('user_id % 7')} END AS run_id,
             CASE WHEN user_id % 13 <> 4 THEN user_id % 3 END AS batch_no, event_id AS seq, event_id,
             user_id, ts,
             CASE WHEN event_type = 'view' THEN 'ok' WHEN event_type = 'signup' THEN 'ignored'
                  ELSE 'failed' END AS outcome,
             CASE WHEN event_type = 'error' THEN 'http_503' WHEN event_type = 'purchase' THEN '429_rate_limit'
                  WHEN event_type = 'click' THEN 'timeout' ELSE CAST(NULL AS STRING) END AS reason
      FROM {d.table('events')}"""
    v["fx_results"] = f"""
      SELECT CASE WHEN user_id % 9 <> 2 THEN 'run' || {_text('user_id % 4')} END AS run_id, CAST(floor(event_id / 50) AS BIGINT) AS batch_no,
             CASE WHEN event_type IN ('view', 'click') THEN 'ingested' WHEN event_type = 'error' THEN 'failed'
                  ELSE 'skipped' END AS result
      FROM {d.table('events')}"""
    return v


def with_views(dialect, body: str) -> str:
    """`body` with the views it needs in front, as one WITH statement."""
    views = _views(dialect)
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in views:
            if name not in needed and re.search(rf"(?:FROM|JOIN)\s+{name}\b", text):
                visit(views[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body
    ctes = ",\n".join(f"{n} AS ({views[n]})" for n in needed)
    lead = body.lstrip()
    if re.match(r"(?i)WITH RECURSIVE\b", lead):
        return f"WITH RECURSIVE {ctes},\n{lead[len('WITH RECURSIVE'):]}"
    if re.match(r"(?i)WITH\b", lead):
        return f"WITH {ctes},\n{lead[len('WITH'):]}"
    return f"WITH {ctes}\n{lead}"


def oracle(body: str) -> str:
    return with_views(DuckDialect(), body)


class Inputs:
    """Fixture views of one data folder as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.dialect = spark, SparkDialect(sf_dir.rstrip("/"))

    def sql(self, body: str) -> DataFrame:
        return self.spark.sql(with_views(self.dialect, body))

    def __getattr__(self, name: str) -> DataFrame:
        return self.sql(f"SELECT * FROM {name}")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dialect.sf_dir}/{name}.parquet")

    @cached_property
    def state(self) -> DataFrame:
        return self.sql("SELECT * FROM fx_state").select(
            "url", "content_hash", "chunk_count",
            F.timestamp_seconds("last_seen_s").alias("last_seen"), "session_id", "miss_count",
        )

    @cached_property
    def listed(self) -> DataFrame:
        return self.sql("SELECT * FROM fx_listed").select(
            "loc", F.timestamp_seconds("lastmod_s").alias("lastmod")
        )
