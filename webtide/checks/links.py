"""Link extraction, filters and the level-by-level walk over the captured web."""

from __future__ import annotations

from pyspark.sql import functions as F

from webtide.checks.fixtures import AGENT
from webtide.checks.registry import check
from webtide.checks.robots import LINES, RULES, lines, sql_robots_path
from webtide.checks.scalars import sql_domain, sql_part, sql_path, sql_resolve
from webtide.operators import crawl as C
from webtide.operators import links as L
from webtide.operators import robots as R
from webtide.params import SKIP_EXTENSIONS, Params
from webtide.plans.lineage import Scratch
from webtide.sources.seeds import pack_scope

PARAMS = Params(user_agent=AGENT, ingest_pdf=True)

_OPAQUE = "(?is)<!--.*?-->|<script[^>]*>.*?</script[^>]*>|<style[^>]*>.*?</style[^>]*>"


def sql_drop_opaque(x: str) -> str:
    return f"regexp_replace({x}, '{_OPAQUE}', ' ', 'g')"


_ATTR = r"""(?:"[^"]*"|''[^'']*''|[^\s"''>][^\s>]*)"""
_HREF = (
    r"""(?is)<a(?:[\s/]+[^\s=>/"'']+(?:\s*=\s*""" + _ATTR + r""")?)*?[\s/]+href\s*=\s*(""" + _ATTR + ")"
)


def hrefs_cte(source: str = "fx_links", name: str = "hrefs") -> str:
    return f"""{name}_q AS (
      SELECT url, unnest(list_transform(regexp_extract_all({sql_drop_opaque('body')}, '{_HREF}', 1),
               lambda q, ix: {{'ix': ix, 'q': q}})) AS a FROM {source}),
     {name} AS (
      SELECT url AS src_url, CAST(a.ix - 1 AS INT) AS href_ix,
             replace(CASE WHEN left(a.q, 1) IN ('"', '''') THEN a.q[2:-2] ELSE a.q END, '&amp;', '&') AS href
      FROM {name}_q)"""


HREFS = hrefs_cte()
CUT = f"""cutf AS (
  SELECT src_url, href_ix, split_part(href, '#', 1) AS href FROM hrefs WHERE split_part(href, '#', 1) <> '')"""
RES = f"""resl AS (
  SELECT src_url, href_ix, href, {sql_resolve('src_url', 'href')} AS dst_url FROM cutf),
 res AS (
  SELECT *, {sql_domain(sql_part('dst_url', 2))} AS dst_domain, {sql_path('dst_url')} AS dst_path,
         {sql_part('dst_url', 4)} AS dst_query FROM resl)"""
SCOPE = """sc AS (
  SELECT domain, CASE WHEN bool_or(kind = 'root') THEN 'root' ELSE 'allowed' END AS kind,
         array_agg(DISTINCT prefix) FILTER (kind = 'root') AS prefixes FROM fx_scope GROUP BY domain)"""
CLS = f"""cls AS (SELECT res.*, sc.kind, sc.prefixes FROM res JOIN sc ON sc.domain = res.dst_domain)"""
PATHS = """inpath AS (
  SELECT * FROM cls WHERE kind <> 'root' OR len(list_filter(prefixes, lambda p: starts_with(dst_path, p))) > 0)"""
_EXT = "(" + "|".join(e.replace(".", "[.]") for e in SKIP_EXTENSIONS.split(",")) + ")$"
EXTS = f"""noext AS (SELECT * FROM inpath WHERE NOT regexp_matches(lower(dst_url), '{_EXT}'))"""
VALID = """valid AS (
  SELECT src_url, href_ix, dst_url, CASE WHEN lower(dst_url) LIKE '%.pdf' THEN 'pdf' ELSE kind END AS kind
  FROM noext)"""
CHAIN = ", ".join([HREFS, CUT, RES, SCOPE, CLS, PATHS, EXTS, VALID])


def hrefs(x):
    return L.extract_hrefs(x.fx_links)


def packed(x):
    return pack_scope(x.fx_scope)


def classified(x):
    return hrefs(x).transform(L.cut_fragments).transform(L.resolve).transform(L.classify, packed(x))


@check("l1_extract_hrefs", f"WITH {HREFS} SELECT src_url, href_ix, href FROM hrefs")
def _(x):
    return hrefs(x)


@check("l2_cut_fragments", f"WITH {HREFS}, {CUT} SELECT * FROM cutf")
def _(x):
    return hrefs(x).transform(L.cut_fragments)


_COLS = ["src_url", "href_ix", "dst_url", "kind"]
_SEL = "SELECT src_url, href_ix, dst_url, kind FROM"
_UPTO = ", ".join([HREFS, CUT, RES, SCOPE, CLS])


@check("l3_domain_class", f"WITH {_UPTO} {_SEL} cls")
def _(x):
    return classified(x).select(*_COLS)


@check("l4_path_scope", f"WITH {_UPTO}, {PATHS} {_SEL} inpath")
def _(x):
    return classified(x).transform(L.in_path_scope, packed(x)).select(*_COLS)


@check(
    "l4_wide_scope",
    f"""WITH {HREFS}, {CUT}, {RES} SELECT src_url, href_ix, dst_url, 'root' AS kind FROM res
        WHERE EXISTS (SELECT 1 FROM fx_wide_scope s WHERE s.domain = res.dst_domain AND starts_with(res.dst_path, s.prefix))""",
)
def _(x):
    """As many prefixes as there are pages."""
    scope = pack_scope(x.fx_wide_scope).saved(Scratch(x.spark))
    found = hrefs(x).transform(L.cut_fragments).transform(L.resolve).transform(L.classify, scope)
    return found.transform(L.in_path_scope, scope).select(*_COLS)


@check("l5_query_filter", f"WITH {_UPTO} {_SEL} cls WHERE dst_query = ''")
def _(x):
    return classified(x).transform(L.without_query, True).select(*_COLS)


@check("l6_extension_filter", f"WITH {_UPTO}, inpath AS (SELECT * FROM cls), {EXTS} {_SEL} noext")
def _(x):
    return classified(x).transform(L.without_extensions, SKIP_EXTENSIONS).select(*_COLS)


@check(
    "l7_pdf_routing",
    f"""WITH {_UPTO} SELECT src_url, href_ix, dst_url,
          CASE WHEN lower(dst_url) LIKE '%.pdf' THEN 'pdf' ELSE kind END AS kind FROM cls""",
)
def _(x):
    return classified(x).transform(L.route_pdfs, True).select(*_COLS)


@check("l8_valid_links", f"WITH {CHAIN} SELECT * FROM valid")
def _(x):
    return L.valid_links(hrefs(x), packed(x), PARAMS)


@check(
    "l9_unvisited",
    f"WITH {CHAIN} SELECT DISTINCT dst_url AS url FROM valid WHERE dst_url NOT IN (SELECT url FROM fx_state)",
)
def _(x):
    links = L.valid_links(hrefs(x), packed(x), PARAMS).select(F.col("dst_url").alias("url"))
    return L.unvisited(links, x.state)


# --- the walk ---------------------------------------------------------------------------------------

_GOOD = """good AS (SELECT url, body FROM fx_web WHERE status = 200 AND error IS NULL)"""
WEB_CHAIN = ", ".join(
    [_GOOD, hrefs_cte("good"), CUT, RES, SCOPE, CLS, PATHS, EXTS, VALID]
)


def sql_walk(max_depth: int, seeds: str = "SELECT url FROM fx_homes") -> str:
    bound = "" if max_depth == -1 else f" AND (e.kind <> 'root' OR r.depth + 1 <= {max_depth})"
    return f"""{LINES}, {RULES}, {WEB_CHAIN},
     edges AS (SELECT DISTINCT src_url, dst_url, kind FROM valid),
     wseeds AS ({seeds}),
     tovisit AS (SELECT url FROM wseeds UNION SELECT dst_url FROM edges WHERE kind = 'root'),
     wgate AS (
      SELECT q.url, coalesce(arg_min(r.allow, r.line_no), true) AS allowed
      FROM (SELECT url, {sql_domain(sql_part('url', 2))} AS domain, {sql_robots_path('url')} AS upath FROM tovisit) q
      LEFT JOIN rules r ON r.domain = q.domain AND starts_with(q.upath, r.rpath) GROUP BY q.url),
     ends AS (
      SELECT g.url, CASE WHEN NOT g.allowed THEN 'blocked' WHEN w.url IS NULL OR w.error IS NOT NULL THEN 'failed'
                         WHEN w.status = 200 THEN 'scraped' ELSE 'http_error' END AS fin
      FROM wgate g LEFT JOIN fx_web w USING (url)),
     reach(url, depth, origin) AS (
      SELECT DISTINCT url, 0, 'seed' FROM wseeds
      UNION
      SELECT e.dst_url, r.depth + 1, CASE e.kind WHEN 'root' THEN 'link' ELSE e.kind END
      FROM reach r JOIN ends d ON d.url = r.url AND d.fin = 'scraped' JOIN edges e ON e.src_url = r.url
      WHERE r.origin IN ('seed', 'link') AND r.depth < 40{bound}),
     walk AS (
      SELECT w.url, w.depth, w.origin, CASE WHEN w.origin IN ('pdf', 'allowed') THEN 'scraped' ELSE d.fin END AS disposition
      FROM (SELECT url, min(depth) AS depth, arg_min(origin, depth * 10 +
              CASE origin WHEN 'seed' THEN 0 WHEN 'link' THEN 1 WHEN 'pdf' THEN 2 ELSE 3 END) AS origin
            FROM reach GROUP BY url) w LEFT JOIN ends d ON d.url = w.url)"""


def walk(x, **changes):
    params = Params(user_agent=AGENT, ingest_pdf=True, **changes)
    rules = R.rule_tables(lines(x), AGENT)
    return C.crawl(x.fx_homes.select("url"), x.fx_web, packed(x), rules, params)


@check("l10_crawl", f"WITH RECURSIVE {sql_walk(-1)} SELECT url, depth, origin, disposition FROM walk")
def _(x):
    return walk(x)


@check("l11_depth_limit", f"WITH RECURSIVE {sql_walk(2)} SELECT url, depth, origin, disposition FROM walk")
def _(x):
    return walk(x, max_depth=2)


@check(
    "l12_single_pages",
    f"WITH RECURSIVE {sql_walk(3)} SELECT url, depth, origin FROM walk WHERE origin IN ('allowed', 'pdf')",
)
def _(x):
    found = walk(x, max_depth=3)
    return found.filter(F.col("origin").isin("allowed", "pdf")).select("url", "depth", "origin")


@check(
    "l13_page_limit",
    f"""WITH RECURSIVE {sql_walk(-1)}
        SELECT url, depth, origin, disposition FROM walk ORDER BY depth, url LIMIT 200""",
)
def _(x):
    return walk(x, max_pages=200)
