"""Sitemap operators over one set of documents per page."""

from __future__ import annotations

from pyspark.sql import functions as F

from webtide.checks.registry import check, sql_strip
from webtide.checks.robots import LINES, SITEMAPS, lines
from webtide.checks.scalars import sql_domain, sql_iso_epoch, sql_part, sql_path
from webtide.operators import robots as R
from webtide.operators import sitemap as M
from webtide.sources.seeds import pack_scope

_HOST = sql_part("root_url", 2)
_BASE = f"({sql_part('root_url', 1)} || '://' || {_HOST})"
PLACES = f"""places AS (
  SELECT r.root_ix, r.root_url, coalesce(d.line_no, 0) AS ord, CASE WHEN d.sitemap IS NULL THEN base || '/sitemap.xml'
      WHEN d.sitemap LIKE 'http%' THEN d.sitemap WHEN d.sitemap LIKE '/%' THEN base || d.sitemap
      ELSE base || '/' || d.sitemap END AS sitemap_url
  FROM (SELECT *, regexp_replace(lower({_HOST}), '^www[.]', '') AS domain, {_BASE} AS base FROM fx_sitemap_roots) r
  LEFT JOIN declared d ON d.domain = r.domain)"""


def declared(x):
    return R.sitemap_lines(lines(x))


@check("m1_sitemap_locations", f"WITH {LINES}, {SITEMAPS}, {PLACES} SELECT * FROM places")
def _(x):
    return M.locations(x.fx_sitemap_roots, declared(x))


def entries_cte(docs: str, key: str) -> str:
    """Entries of the documents of relation `docs`; `key` are its identifying columns."""
    kid = lambda t: f"regexp_extract(u.x, '(?s)<{t}>(.*?)</{t}>', 1)"
    return f"""whole AS (
      SELECT {key}, unnest(list_transform(regexp_extract_all(text, '(?s)<url>(.*?)</url>', 1),
               lambda e, ix: {{'ix': ix, 'x': e}})) AS u FROM {docs} WHERE text LIKE '%</urlset>'),
     broken AS (
      SELECT {key}, unnest(list_transform(regexp_extract_all(text, '<loc>\\s*(https?://[^<]+?)\\s*</loc>', 1),
               lambda e, ix: {{'ix': ix, 'x': e}})) AS u FROM {docs}
      WHERE text NOT LIKE '%</urlset>' AND text NOT LIKE '%</sitemapindex>'),
     ent AS (
      SELECT {key}, CAST(u.ix - 1 AS INT) AS entry_ix, replace({sql_strip(kid('loc'))}, '&amp;', '&') AS loc,
             coalesce({sql_iso_epoch(kid('lastmod'))}, -1) AS lastmod_s,
             CASE WHEN contains(u.x, '<changefreq>') THEN {kid('changefreq')} END AS changefreq,
             TRY_CAST({kid('priority')} AS DOUBLE) AS priority
      FROM whole WHERE {sql_strip(kid('loc'))} LIKE 'http%' UNION ALL
      SELECT {key}, CAST(u.ix - 1 AS INT), u.x, -1, NULL, NULL FROM broken)"""


def _out(rows, *keys):
    return rows.select(
        *keys,
        "entry_ix",
        "loc",
        F.coalesce(F.unix_seconds("lastmod"), F.lit(-1).cast("bigint")).alias("lastmod_s"),
        F.when(F.col("changefreq") != "", F.col("changefreq")).alias("changefreq"),
        F.coalesce("priority", F.lit(-1.0)).alias("priority"),
    )


def _sql_out(docs: str, key: str, more: str = "") -> str:
    return f"""WITH {more}{entries_cte(docs, key)} SELECT {key}, entry_ix, loc, lastmod_s,
      nullif(changefreq, '') AS changefreq, coalesce(priority, -1.0)::DOUBLE AS priority FROM ent"""


@check("m2_urlset_entries", _sql_out("fx_sitemap", "sitemap_url"))
def _(x):
    return _out(M.entries(M.parse(x.fx_sitemap.select("sitemap_url", "text"))), "sitemap_url")


@check("u12_namespace_prefixes", _sql_out("fx_sitemap", "sitemap_url"))
def _(x):
    prefixed = """SELECT sitemap_url, replace(replace(replace(replace(text, '<', '<s:'), '<s:/', '</s:'),
      '<s:?xml', '<?xml'), 'xmlns=', 'xmlns:s=') AS text FROM fx_sitemap"""
    whole = x.sql(prefixed)
    # the fallback for broken documents knows plain tags only, with and without namespaces
    plain = x.fx_sitemap.select("sitemap_url", "text")
    closed = F.col("text").rlike(r"</(s:)?(urlset|sitemapindex)>\z")
    docs = whole.filter(closed).unionByName(plain.filter(~closed))
    return _out(M.entries(M.parse(docs)), "sitemap_url")


@check(
    "m3_broken_sitemaps",
    _sql_out("torn", "sitemap_url", "torn AS (SELECT * FROM fx_sitemap WHERE NOT regexp_matches(text, '</(urlset|sitemapindex)>$')), "),
)
def _(x):
    docs = x.fx_sitemap.filter(~F.col("text").rlike(r"</(urlset|sitemapindex)>\z"))
    return _out(M.entries(M.parse(docs.select("sitemap_url", "text"))), "sitemap_url")


EXPAND = f"""tops AS (
  SELECT i AS root_ix, proto || '//' || auth || '/index-' || CAST(i AS STRING) || '.xml' AS sitemap_url FROM p),
 okdocs AS (SELECT sitemap_url, text FROM fx_sitemap WHERE status = 200),
 kids AS (
  SELECT sitemap_url, unnest(list_transform(regexp_extract_all(text, '<sitemap><loc>([^<]*)</loc>', 1),
           lambda e, ix: {{'ix': ix, 'u': e}})) AS k FROM okdocs),
 tree(root_ix, sitemap_url, ord, depth) AS (
  SELECT root_ix, sitemap_url, [0], 0 FROM tops UNION
  SELECT t.root_ix, k.k.u, list_append(t.ord, k.k.ix - 1), depth + 1
  FROM tree t JOIN kids k ON k.sitemap_url = t.sitemap_url WHERE depth < 4),
 firsts AS (
  SELECT root_ix, sitemap_url, arg_min(ord, (depth, ord)) AS ord FROM tree GROUP BY root_ix, sitemap_url),
 gotten AS (
  SELECT root_ix, array_to_string(ord, '.') AS place, ord, o.text FROM firsts f JOIN okdocs o USING (sitemap_url))"""


def expanded(x, last_root_only=False):
    tops = x.sql(
        "SELECT i AS root_ix, 0 AS ord, proto || '//' || auth || '/index-' || CAST(i AS STRING) || '.xml' AS sitemap_url FROM p"
    )
    return M.expand(tops, x.fx_sitemap, last_root_only)


@check("m4_sitemap_index", _sql_out("gotten", "root_ix, place", f"RECURSIVE {EXPAND}, "))
def _(x):
    rows = expanded(x).withColumn("place", F.array_join(F.transform("ord", lambda o: o.cast("string")), "."))
    return _out(rows, "root_ix", "place")


LAST = """lastper AS (
  SELECT loc, arg_max(lastmod_s, (root_ix, ord, entry_ix)) AS lastmod_s,
         arg_max(coalesce(priority, -1.0), (root_ix, ord, entry_ix)) AS priority FROM ent GROUP BY loc)"""


@check(
    "m5_last_entry",
    f"WITH RECURSIVE {EXPAND}, {entries_cte('gotten', 'root_ix, ord')}, {LAST} SELECT loc, lastmod_s, priority::DOUBLE AS priority FROM lastper",
)
def _(x):
    rows = M.last_per_url(expanded(x, last_root_only=True), "root_ix", "ord", "entry_ix")
    return rows.select(
        "loc",
        F.coalesce(F.unix_seconds("lastmod"), F.lit(-1).cast("bigint")).alias("lastmod_s"),
        F.coalesce("priority", F.lit(-1.0)).alias("priority"),
    )


MERGED = """crawled AS (SELECT url FROM fx_state),
 merged AS (
  SELECT coalesce(c.url, l.loc) AS url, c.url IS NOT NULL AS in_crawl, l.loc IS NOT NULL AS in_sitemap
  FROM (SELECT DISTINCT url FROM crawled) c FULL JOIN (SELECT DISTINCT loc FROM fx_listed) l ON l.loc = c.url)"""


@check("m6_merge_candidates", f"WITH {MERGED} SELECT url, in_crawl, in_sitemap FROM merged")
def _(x):
    return M.merge_candidates(x.state, x.fx_listed)


@check("m6_sitemap_only", "SELECT DISTINCT loc AS url, false AS in_crawl, true AS in_sitemap FROM fx_listed")
def _(x):
    return M.merge_candidates(x.state, x.fx_listed, only_sitemap=True)


@check(
    "m6_scoped_merge",
    f"""WITH {MERGED} SELECT url, in_crawl, in_sitemap FROM (
          SELECT *, {sql_domain(sql_part('url', 2))} AS domain, {sql_path('url')} AS path FROM merged) m
        WHERE in_crawl OR EXISTS (SELECT 1 FROM fx_scope s WHERE s.domain = m.domain
          AND CASE WHEN s.kind = 'root' THEN starts_with(m.path, s.prefix)
                   ELSE NOT EXISTS (SELECT 1 FROM fx_scope r WHERE r.domain = s.domain AND r.kind = 'root') END)""",
)
def _(x):
    return M.in_scope(M.merge_candidates(x.state, x.fx_listed), pack_scope(x.fx_scope))
