"""The whole session on the captured web, and the decision slice of it."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from webtide.checks.content import sql_chunk_list, sql_good, sql_page, sql_text
from webtide.checks.fetches import REASON
from webtide.checks.fixtures import AGENT, BASE_TS, DAY, NOW_TS
from webtide.checks.links import sql_walk
from webtide.checks.registry import check
from webtide.checks.robots import GATE, LINES, RULES, SITEMAPS, sql_robots_path
from webtide.checks.scalars import sql_domain, sql_http_epoch, sql_part
from webtide.checks.sitemaps import LAST, entries_cte
from webtide.functions.text import content_hash
from webtide.operators import content, sync
from webtide.params import Params
from webtide.plans.lineage import Scratch
from webtide.plans.session import Session, Web, run_session
from webtide.sources import seeds

PARAMS = Params(user_agent=AGENT, ingest_pdf=True, remove_delay=2)
NOW_SESSION = "s2"


def known_pages(x, captures=None):
    """Content of every good capture as the last session left it, with marks of change by page number."""
    captures = x.fx_captures if captures is None else captures
    good = captures.filter((F.col("status") == 200) & F.col("error").isNull()).select("i", "url", "content_type", "body")
    made = content.page_chunks(content.page_texts(good, PARAMS), PARAMS)
    return made.filter(F.col("i") % 10 != 9)


def known_state(x, pages=None):
    pages = known_pages(x) if pages is None else pages
    changed = F.when(
        F.col("i") % 7 == 0, content_hash(F.concat("content_hash", F.lit("old")))
    ).otherwise(F.col("content_hash"))
    seen = F.timestamp_seconds(F.lit(BASE_TS) + F.col("i") % 10 * DAY)
    rows = pages.select(
        "url",
        changed.alias("content_hash"),
        (F.col("chunk_count") + F.when(F.col("i") % 11 == 0, 1).otherwise(0)).alias("chunk_count"),
        seen.alias("last_seen"),
        F.lit("s0").alias("session_id"),
        F.lit(0).alias("miss_count"),
    )
    gone = x.fx_gone.select(
        "url",
        content_hash(F.col("url")).alias("content_hash"),
        F.lit(2).alias("chunk_count"),
        seen.alias("last_seen"),
        F.lit("s0").alias("session_id"),
        (F.col("i") % 3).cast("int").alias("miss_count"),
    )
    return rows.unionByName(gone)


def known_chunks(x, pages=None):
    pages = known_pages(x) if pages is None else pages
    rows = pages.select("i", "url", F.posexplode("chunks").alias("chunk_ix", "text"))
    edited = F.when(
        (F.col("i") % 7 == 0) & (F.col("chunk_ix") == 0), F.concat("text", F.lit("!"))
    ).otherwise(F.col("text"))
    gone = x.fx_gone.select(
        "url", F.posexplode(F.array(F.concat(F.lit("a "), "url"), F.concat(F.lit("b "), "url"))).alias("chunk_ix", "text")
    )
    both = rows.select("url", "chunk_ix", edited.alias("text")).unionByName(gone)
    return content.attach_metadata(both, "s0")


def web(x) -> Web:
    """The captured web as written tables, as a session finds it."""
    scratch = Scratch(x.spark)
    kept = lambda df, name: scratch.save(df, name)[0]
    # captures are joined from pages, and known pages cut into chunks, once for all that comes from them
    pages = kept(x.fx_captures.select("i", "url", "status", "content_type", "last_modified", "error", "body"), "captures")
    none = "CAST(NULL AS STRING)"
    homes = x.fx_homes.selectExpr(
        "url", "200 AS status", "'text/html' AS content_type", f"{none} AS last_modified", f"{none} AS error", "body"
    )
    known = kept(known_pages(x, pages), "known")
    return Web(
        seeds=kept(x.fx_homes.select("url"), "seeds"),
        scope=kept(x.fx_scope, "scope"),
        robots=kept(x.fx_robots, "robots"),
        sitemaps=kept(x.fx_sitemap.select("sitemap_url", "status", "text"), "sitemaps"),
        captures=pages.drop("i").unionByName(kept(homes, "homes")),
        heads=kept(x.fx_heads, "heads"),
        attempts=kept(x.fx_page_attempts, "attempts"),
        state=kept(known_state(x, known), "state"),
        chunks=kept(known_chunks(x, known), "chunks"),
    )


def session(x) -> Session:
    return run_session(web(x), PARAMS, NOW_SESSION, F.timestamp_seconds(F.lit(NOW_TS)), "1.5")


# --- SQL --------------------------------------------------------------------------------------------

_WEBOK = "webok AS (SELECT url, content_type, body FROM fx_web WHERE status = 200 AND error IS NULL)"
KNOWN = f"""kp AS (
  SELECT c.i, g.* FROM pagec g JOIN fx_captures c ON c.url = g.url WHERE c.i % 10 <> 9),
 kstate AS (
  SELECT url, CASE WHEN i % 7 = 0 THEN sha256(content_hash || 'old') ELSE content_hash END AS content_hash,
         CAST(chunk_count + CASE WHEN i % 11 = 0 THEN 1 ELSE 0 END AS INT) AS chunk_count,
         {BASE_TS} + (i % 10) * {DAY} AS last_seen_s, 's0' AS session_id, CAST(0 AS INT) AS miss_count FROM kp
  UNION ALL
  SELECT url, sha256(url), CAST(2 AS INT), {BASE_TS} + (i % 10) * {DAY}, 's0', CAST(i % 3 AS INT) FROM fx_gone),
 kchunks AS (
  SELECT url AS source, u.ix - 1 AS chunk_ix, CASE WHEN i % 7 = 0 AND u.ix = 1 THEN u.t || '!' ELSE u.t END AS text
  FROM (SELECT i, url, unnest(list_transform(chunks, lambda t, ix: {{'ix': ix, 't': t}})) AS u FROM kp)
  UNION ALL SELECT url, 0, 'a ' || url FROM fx_gone UNION ALL SELECT url, 1, 'b ' || url FROM fx_gone)"""

_DECIDE = """CASE WHEN s.url IS NULL THEN 'full'
    WHEN s.content_hash = n.content_hash AND s.chunk_count = n.chunk_count THEN 'skip' ELSE 'partial' END"""


@check(
    "ingest_decisions",
    f"""WITH {_WEBOK}, {sql_page('webok', 'body', ctype='content_type')}, {KNOWN}
        SELECT decision, count(*) AS urls, CAST(sum(chunk_count) AS BIGINT) AS chunks FROM (
          SELECT n.chunk_count, {_DECIDE} AS decision
          FROM (SELECT g.* FROM pagec g JOIN fx_captures c ON c.url = g.url) n LEFT JOIN kstate s ON s.url = n.url)
        GROUP BY decision""",
)
def ingest_decisions(x):
    good = x.fx_captures.filter((F.col("status") == 200) & F.col("error").isNull()).select("url", "content_type", "body")
    pages = content.page_chunks(content.page_texts(good, PARAMS), PARAMS)
    decided = sync.decide(pages.drop("chunks"), known_state(x))
    return decided.groupBy("decision").agg(
        F.count(F.lit(1)).alias("urls"), F.sum("chunk_count").alias("chunks")
    )


_HOST = sql_part("url", 2)
SESSION = f"""RECURSIVE {sql_walk(-1)}, {SITEMAPS}, {_WEBOK}, {sql_page('webok', 'body', ctype='content_type')}, {KNOWN},
 stops AS (
  SELECT r.url AS root_ix, [coalesce(d.line_no, 0)] AS ord, CASE WHEN d.sitemap IS NULL THEN base || '/sitemap.xml'
      WHEN d.sitemap LIKE 'http%' THEN d.sitemap WHEN d.sitemap LIKE '/%' THEN base || d.sitemap
      ELSE base || '/' || d.sitemap END AS sitemap_url
  FROM (SELECT url, regexp_replace(lower({_HOST}), '^www[.]', '') AS domain,
               {sql_part('url', 1)} || '://' || {_HOST} AS base FROM wseeds) r
  LEFT JOIN declared d ON d.domain = r.domain),
 okdocs AS (SELECT sitemap_url, text FROM fx_sitemap WHERE status = 200),
 kids AS (
  SELECT sitemap_url, unnest(list_transform(regexp_extract_all(text, '<sitemap><loc>([^<]*)</loc>', 1),
           lambda e, ix: {{'ix': ix, 'u': e}})) AS k FROM okdocs),
 tree(root_ix, sitemap_url, ord, depth) AS (
  SELECT root_ix, sitemap_url, ord, 0 FROM stops UNION
  SELECT t.root_ix, k.k.u, list_append(t.ord, k.k.ix - 1), depth + 1
  FROM tree t JOIN kids k ON k.sitemap_url = t.sitemap_url WHERE depth < 4),
 firsts AS (
  SELECT root_ix, sitemap_url, arg_min(ord, (depth, ord)) AS ord FROM tree GROUP BY root_ix, sitemap_url),
 gotten AS (SELECT root_ix, ord, o.text FROM firsts f JOIN okdocs o USING (sitemap_url)),
 {entries_cte('gotten', 'root_ix, ord')}, {LAST},
 cand AS (
  SELECT url, bool_or(cached) AS cached FROM (
    SELECT url, origin IN ('seed', 'link') AS cached FROM walk WHERE disposition = 'scraped'
    UNION ALL SELECT loc, false FROM lastper) GROUP BY url),
 smarked AS (
  SELECT c.url, c.cached, CASE
      WHEN l.lastmod_s >= 0 AND l.lastmod_s <= s.last_seen_s THEN 'lastmod_skip'
      WHEN s.url IS NULL THEN 'update'
      WHEN h.url IS NULL OR h.error IS NOT NULL OR h.status IS NULL OR h.status >= 400 THEN 'unchanged'
      WHEN h.last_modified IS NULL THEN 'update'
      WHEN {sql_http_epoch('h.last_modified')} > s.last_seen_s THEN 'update' ELSE 'unchanged' END AS disposition
  FROM cand c LEFT JOIN lastper l ON l.loc = c.url LEFT JOIN kstate s ON s.url = c.url
  LEFT JOIN fx_heads h ON h.url = c.url),
 cgate AS (
  SELECT q.url, coalesce(arg_min(r.allow, r.line_no), true) AS allowed
  FROM (SELECT url, {sql_domain(sql_part('url', 2))} AS domain, {sql_robots_path('url')} AS upath
        FROM smarked WHERE disposition = 'update') q
  LEFT JOIN rules r ON r.domain = q.domain AND starts_with(q.upath, r.rpath) GROUP BY q.url),
 met AS (
  SELECT m.url, m.cached, g.allowed, w.status, w.body,
         CASE WHEN w.url IS NULL THEN 'not captured' ELSE w.error END AS error
  FROM smarked m JOIN cgate g ON g.url = m.url LEFT JOIN fx_web w ON w.url = m.url WHERE m.disposition = 'update'),
 sfetched AS (
  SELECT url, CASE WHEN cached THEN 'ok' WHEN NOT allowed THEN 'ignored' WHEN reason IS NULL THEN 'ok'
                   ELSE 'failed' END AS outcome
  FROM (SELECT *, {REASON} AS reason FROM met)),
 spages AS (
  SELECT n.*, {_DECIDE} AS decision FROM pagec n JOIN sfetched f ON f.url = n.url AND f.outcome = 'ok'
  LEFT JOIN kstate s ON s.url = n.url),
 sfailed AS (
  SELECT url FROM sfetched WHERE outcome = 'failed' UNION SELECT url FROM walk WHERE disposition = 'failed'),
 tries AS (
  SELECT url, arg_min(CASE WHEN error IS NULL THEN 'recovered' ELSE 'dropped' END, attempt) FILTER (ends) AS result,
         min(attempt) FILTER (ends) AS stop
  FROM (SELECT *, error IS NULL OR error LIKE '%404%' AS ends FROM fx_page_attempts) GROUP BY url),
 tried AS (
  SELECT f.url, coalesce(t.result, 'still_failed') AS result, t.stop FROM sfailed f LEFT JOIN tries t ON t.url = f.url),
 backs AS (
  SELECT a.url, a.body FROM tried t JOIN fx_page_attempts a ON a.url = t.url AND a.attempt = t.stop
  WHERE t.result = 'recovered'),
 {sql_page('backs', 'body', name='back')},
 newc AS (
  SELECT url AS source, decision, u.ix - 1 AS chunk_ix, u.t AS text FROM (
    SELECT url, decision, unnest(list_transform(chunks, lambda t, ix: {{'ix': ix, 't': t}})) AS u FROM spages
    WHERE decision IN ('full', 'partial')
    UNION ALL SELECT url, 'recovered', unnest(list_transform(chunks, lambda t, ix: {{'ix': ix, 't': t}})) FROM backc)),
 addc AS (
  SELECT * FROM newc n WHERE decision <> 'partial'
    OR NOT EXISTS (SELECT 1 FROM kchunks k WHERE k.source = n.source AND k.text = n.text)),
 skeep AS (
  SELECT url FROM smarked UNION SELECT url FROM tried WHERE result IN ('recovered', 'still_failed')),
 sstale AS (
  SELECT url, CASE WHEN miss_count + 1 >= 2 THEN 'remove' ELSE 'miss' END AS action FROM kstate
  WHERE session_id <> '{NOW_SESSION}' AND url NOT IN (SELECT url FROM skeep)),
 remc AS (
  SELECT DISTINCT source, sha256(text) AS chunk_sha FROM kchunks k
  WHERE source IN (SELECT url FROM sstale WHERE action = 'remove')
     OR source IN (SELECT url FROM tried WHERE result = 'recovered')
     OR (source IN (SELECT url FROM spages WHERE decision = 'partial')
         AND NOT EXISTS (SELECT 1 FROM newc n WHERE n.decision = 'partial' AND n.source = k.source AND n.text = k.text))),
 acts AS (
  SELECT url, arg_max(action, rank) AS action, arg_max((h, n), rank) AS hn FROM (
    SELECT url, 'store' AS action, 'retried' AS h, 0 AS n, 4 AS rank FROM tried WHERE result = 'recovered' UNION ALL
    SELECT url, 'store', content_hash, chunk_count, 3 FROM spages WHERE decision IN ('full', 'partial') UNION ALL
    SELECT url, 'touch', NULL, NULL, 2 FROM spages WHERE decision = 'skip' UNION ALL
    SELECT url, 'touch', NULL, NULL, 1 FROM smarked WHERE disposition = 'lastmod_skip' UNION ALL
    SELECT url, action, NULL, NULL, 0 FROM sstale) GROUP BY url),
 nstate AS (
  SELECT coalesce(s.url, a.url) AS url, CASE WHEN a.action = 'store' THEN a.hn[1] ELSE s.content_hash END AS content_hash,
         CAST(CASE WHEN a.action = 'store' THEN a.hn[2] ELSE s.chunk_count END AS INT) AS chunk_count,
         CASE WHEN a.action IN ('store', 'touch') THEN {NOW_TS} ELSE s.last_seen_s END AS last_seen_s,
         CASE WHEN a.action IN ('store', 'touch') THEN '{NOW_SESSION}' ELSE s.session_id END AS session_id,
         CAST(CASE WHEN a.action IN ('store', 'touch') THEN 0 WHEN a.action = 'miss' THEN s.miss_count + 1
                   ELSE s.miss_count END AS INT) AS miss_count
  FROM kstate s FULL JOIN acts a ON a.url = s.url WHERE coalesce(a.action, '') <> 'remove')"""


@check(
    "d12_session_state",
    f"WITH {SESSION} SELECT url, content_hash, chunk_count, last_seen_s, session_id, miss_count FROM nstate",
)
def _(x):
    state = session(x).state
    return state.withColumn("last_seen_s", F.unix_seconds("last_seen")).drop("last_seen")


@check(
    "d12_session_added",
    f"WITH {SESSION} SELECT source, CAST(chunk_ix AS INT) AS chunk_ix, sha256(text) AS chunk_sha FROM addc",
)
def _(x):
    return session(x).added.select("source", "chunk_ix", "chunk_sha")


@check("d12_session_removed", f"WITH {SESSION} SELECT source, chunk_sha FROM remc")
def _(x):
    return session(x).removed


_KIND = "decision = 'full' OR url IN (SELECT source FROM addc WHERE decision = 'partial')"


@check(
    "d12_session_summary",
    f"""WITH {SESSION}, n AS (SELECT
          (SELECT count(*) FROM spages WHERE {_KIND}) AS ingested,
          (SELECT count(*) FROM spages WHERE NOT ({_KIND})) AS skipped,
          (SELECT count(*) FROM tried WHERE result = 'still_failed') AS failed,
          (SELECT count(*) FROM sstale WHERE action = 'remove') AS removed,
          (SELECT count(*) FROM tried WHERE result = 'recovered') AS recovered)
        SELECT *, concat_ws(', ', ingested || ' URLs ingested', CASE WHEN skipped > 0 THEN skipped || ' skipped (unchanged)' END,
          CASE WHEN failed > 0 THEN failed || ' failed' END, CASE WHEN removed > 0 THEN removed || ' stale removed' END,
          '1.5 min') AS message FROM n""",
)
def _(x):
    return session(x).summary


@check(
    "g6_early_exit",
    f"""WITH {LINES}, {RULES}, tested AS (SELECT i, 0 AS k, url AS u FROM p), {GATE},
          said AS (
            SELECT 'Error: no valid starting URLs in plugin settings.' AS message UNION ALL
            SELECT 'No pages scraped. ' || count(*) || ' failed (0.0 min).' FROM gate WHERE allowed UNION ALL
            SELECT 'All ' || count(*) || ' pages unchanged (0.0 min).' FROM fx_captures c JOIN gate g ON g.i = c.i
            WHERE allowed AND status = 200 AND error IS NULL)
        SELECT CAST(0 AS BIGINT) AS ingested, CAST(0 AS BIGINT) AS skipped, CAST(0 AS BIGINT) AS failed,
               CAST(0 AS BIGINT) AS removed, CAST(0 AS BIGINT) AS recovered, message FROM said""",
)
def _(x):
    """The three ways to stop early, each over all pages: no valid seed, nothing found, nothing to update."""
    now = F.timestamp_seconds(F.lit(NOW_TS))
    scratch = Scratch(x.spark)
    kept = lambda df, name: scratch.save(df, name)[0]
    every = kept(x.fx_captures.select("url", "status", "content_type", "last_modified", "error", "body"), "every")
    base = web(x)
    base.seeds = every.select("url")
    base.sitemaps = base.sitemaps.withColumn("status", F.lit(500))

    bad = seeds.seed_list(x.sql("SELECT i AS setting, 'localhost, ,not an address' AS raw FROM p"))
    no_seed = replace(base, seeds=bad.select("url"))
    broken = replace(base, captures=every.withColumn("error", F.lit("Read timed out")))
    # every page is known, and asking for its date fails
    known = every.select(
        "url", F.lit("h").alias("content_hash"), F.lit(1).alias("chunk_count"),
        F.timestamp_seconds(F.lit(BASE_TS)).alias("last_seen"), F.lit("s0").alias("session_id"), F.lit(0).alias("miss_count"),
    )
    heads = every.select("url", F.lit(503).alias("status"), F.lit(None).cast("string").alias("last_modified"), F.lit(None).cast("string").alias("error"))
    still = replace(base, captures=every, state=known, heads=heads, scope=base.scope.filter("kind = 'none'"))
    said = [run_session(w, PARAMS, NOW_SESSION, now).summary for w in (no_seed, broken, still)]
    return said[0].unionByName(said[1]).unionByName(said[2])


_HOOKED = "replace(html, '</title>', ' hooked</title>')"


@check(
    "x1_hooks",
    f"""WITH hooked AS (SELECT i, url, {sql_text(_HOOKED)} AS text FROM p),
          said AS (SELECT i, url, replace(text, 'hooked', 'THE HOOKED') AS text FROM hooked),
          cut AS (SELECT i, list_filter({sql_chunk_list('text', 1024, 256)}, lambda c: {sql_good('c', 'url', 50)}) AS chunks FROM said)
        SELECT i, array_to_string(list_filter(chunks, lambda c: contains(c, 'HOOKED')), chr(10)) AS kept FROM cut""",
)
def _(x):
    """Parser, document and chunk hooks are transforms between the stages."""
    parser = lambda df: df.withColumn("html", F.replace("html", F.lit("</title>"), F.lit(" hooked</title>")))
    document = lambda df: df.withColumn("text", F.replace("text", F.lit("hooked"), F.lit("THE HOOKED")))
    chunk = lambda df: df.withColumn("chunks", F.filter("chunks", lambda c: F.contains(c, F.lit("HOOKED"))))
    params = Params()
    pages = x.sql("SELECT i, url, html FROM p").transform(parser)
    texts = content.page_texts(pages, params, "html").transform(document)
    return content.page_chunks(texts, params).transform(chunk).select("i", F.array_join("chunks", "\n").alias("kept"))
