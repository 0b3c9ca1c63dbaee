"""robots.txt operators over one file per domain and all page addresses."""

from __future__ import annotations

from pyspark.sql import functions as F

from webtide.checks.fixtures import AGENT
from webtide.checks.registry import SPACE, check, sql_strip
from webtide.checks.scalars import sql_domain, sql_part
from webtide.operators import robots as R
from webtide.sources.robots_files import pick_robots

# CTE texts, reused by other oracles
FILES = """files AS (
  SELECT domain, arg_min(text, CASE proto WHEN 'https' THEN 0 ELSE 1 END) AS text
  FROM fx_robots WHERE status = 200 GROUP BY domain)"""
LINES = f"""{FILES}, cut AS (
  SELECT domain, string_split(replace(text, chr(13) || chr(10), chr(10)), chr(10)) AS parts FROM files),
 lines AS (
  SELECT domain, CAST(u.ix - 1 AS INT) AS line_no, u.raw AS raw, {sql_strip('u.raw')} AS line
  FROM (SELECT domain, unnest(list_transform(parts, lambda s, ix: {{'ix': ix, 'raw': s}})) AS u,
               len(parts) AS n, parts FROM cut)
  WHERE NOT (u.ix = n AND u.raw = ''))"""
_VALUE = sql_strip("substr(line, position(':' in line) + 1)")

DELAYS = f"""sig AS (
  SELECT domain, line_no, line, lower(line) LIKE 'user-agent:%' AS is_ua, lower({_VALUE}) AS val
  FROM lines WHERE line <> '' AND line NOT LIKE '#%'),
 blk AS (
  SELECT *, sum(CASE WHEN is_ua AND NOT prev THEN 1 ELSE 0 END)
              OVER (PARTITION BY domain ORDER BY line_no) AS block
  FROM (SELECT *, coalesce(lag(is_ua) OVER (PARTITION BY domain ORDER BY line_no), false) AS prev FROM sig)),
 blkf AS (
  SELECT domain, block, bool_or(val = '*') AS wild, bool_or(contains('{AGENT.lower()}', val)) AS named
  FROM blk WHERE is_ua GROUP BY domain, block),
 dl AS (
  SELECT b.domain, b.line_no, f.wild, f.named AND NOT f.wild AS own, TRY_CAST(b.val AS DOUBLE) AS v
  FROM blk b JOIN blkf f USING (domain, block)
  WHERE lower(b.line) LIKE 'crawl-delay:%' AND TRY_CAST(b.val AS DOUBLE) IS NOT NULL),
 delays AS (
  SELECT domain, coalesce(arg_max(v, line_no) FILTER (own), arg_max(v, line_no) FILTER (wild)) AS crawl_delay
  FROM dl GROUP BY domain)"""

SITEMAPS = f"""declared AS (
  SELECT domain, line_no, {_VALUE} AS sitemap FROM lines
  WHERE lower(line) LIKE 'sitemap:%' AND {_VALUE} <> '')"""

_HINT = rf"^#{SPACE}*refresh:{SPACE}*([^\s]+){SPACE}+([0-9]+)"
HINTS = f"""hints AS (
  SELECT domain, regexp_extract(line, '{_HINT}', 1) AS prefix,
         arg_max(CAST(regexp_extract(line, '{_HINT}', 2) AS BIGINT), line_no) AS interval_s
  FROM lines WHERE regexp_matches(line, '{_HINT}') GROUP BY ALL)"""

RULES = f"""bare AS (
  SELECT domain, line_no, raw, {sql_strip("split_part(raw, '#', 1)")} AS t FROM lines),
 nv AS (
  SELECT domain, line_no, raw,
         CASE WHEN contains(t, ':') THEN lower({sql_strip("split_part(t, ':', 1)")}) ELSE '' END AS name,
         url_decode({sql_strip("substr(t, position(':' in t) + 1)")}) AS val FROM bare),
 kinds AS (
  SELECT *, CASE WHEN raw = '' THEN 'B' WHEN name = 'user-agent' THEN 'U'
                 WHEN name IN ('allow', 'disallow', 'crawl-delay', 'request-rate') THEN 'R' END AS kind FROM nv),
 rent AS (
  SELECT *, sum(CASE WHEN kind = 'B' OR (kind = 'U' AND prev <> 'U') THEN 1 ELSE 0 END)
              OVER (PARTITION BY domain ORDER BY line_no) AS entry
  FROM (SELECT *, coalesce(lag(kind) OVER (PARTITION BY domain ORDER BY line_no), 'B') AS prev
        FROM kinds WHERE kind IS NOT NULL)),
 entry_flags AS (
  SELECT domain, entry, coalesce(bool_or(val = '*') FILTER (kind = 'U'), false) AS dflt,
         bool_or(contains('{AGENT.split('/')[0].lower()}', lower(val))) FILTER (kind = 'U') AS named,
         count(*) FILTER (kind = 'R') AS n_rules FROM rent GROUP BY domain, entry),
 chosen AS (
  SELECT domain, arg_min(entry, (CASE WHEN dflt THEN 1000000 ELSE 0 END) + entry) AS entry
  FROM entry_flags WHERE n_rules > 0 AND (dflt OR coalesce(named, false)) GROUP BY domain),
 rules AS (
  SELECT e.domain, e.line_no, e.name = 'allow' OR e.val = '' AS allow,
         regexp_replace(regexp_replace(e.val, '#$', ''), '^([^?#]*)[?]$', '\\1') AS rpath
  FROM rent e JOIN chosen c USING (domain, entry) WHERE e.name IN ('allow', 'disallow'))"""


def sql_robots_path(u: str) -> str:
    d = f"url_decode({u})"
    path, query, frag = (sql_part(d, k) for k in (3, 4, 5))
    return (
        f"coalesce(nullif({path} || CASE WHEN {query} <> '' THEN '?' || {query} ELSE '' END || "
        f"CASE WHEN {frag} <> '' THEN '#' || {frag} ELSE '' END, ''), '/')"
    )


def lines(x):
    return R.directive_lines(pick_robots(x.fx_robots))


@check("s4_robots_source", f"WITH {FILES} SELECT domain, text FROM files")
def _(x):
    return pick_robots(x.fx_robots)


@check("r1_directive_lines", f"WITH {LINES} SELECT domain, line_no, line FROM lines")
def _(x):
    return lines(x).select("domain", "line_no", "line")


@check("r2_crawl_delay", f"WITH {LINES}, {DELAYS} SELECT domain, crawl_delay FROM delays WHERE crawl_delay IS NOT NULL")
def _(x):
    return R.crawl_delays(lines(x), AGENT).filter("crawl_delay IS NOT NULL")


@check("r3_sitemap_directives", f"WITH {LINES}, {SITEMAPS} SELECT domain, line_no, sitemap FROM declared")
def _(x):
    return R.sitemap_lines(lines(x))


@check("r4_refresh_hints", f"WITH {LINES}, {HINTS} SELECT domain, prefix, interval_s FROM hints")
def _(x):
    return R.refresh_hints(lines(x))


GATE = f"""gate AS (
  SELECT q.i, q.k, coalesce(arg_min(r.allow, r.line_no), true) AS allowed
  FROM (SELECT i, k, u, {sql_domain(sql_part('u', 2))} AS domain, {sql_robots_path('u')} AS upath FROM tested) q
  LEFT JOIN rules r ON r.domain = q.domain AND starts_with(q.upath, r.rpath)
  GROUP BY q.i, q.k)"""
_TESTED = """tested AS (
  SELECT i, 0 AS k, url AS u FROM p UNION ALL
  SELECT i, k, u FROM fx_urls WHERE u LIKE 'http%' UNION ALL
  SELECT i, 20, proto || '//' || auth || '/en/%31' || CAST(i AS STRING) || '?' FROM p)"""


@check("r5_robots_gate", f"WITH {LINES}, {RULES}, {_TESTED}, {GATE} SELECT i, k, allowed FROM gate")
def _(x):
    tested = x.sql(f"WITH {_TESTED} SELECT i, k, u AS url FROM tested")
    return R.gate(tested, R.rule_tables(lines(x), AGENT)).select("i", "k", "allowed")


@check(
    "r6_effective_delay",
    f"""WITH {LINES}, {DELAYS} SELECT dom AS domain, greatest(0.5, coalesce(crawl_delay, 0.5))::DOUBLE AS delay_s
        FROM doms LEFT JOIN delays ON domain = dom""",
)
def _(x):
    domains = x.doms.select(F.col("dom").alias("domain"))
    return R.effective_delays(domains, R.crawl_delays(lines(x), AGENT), 0.5)


REFRESH = f"""refreshed AS (
  SELECT q.i, q.url, arg_max(h.interval_s, length(h.prefix)) AS refresh_s
  FROM (SELECT i, url, {sql_domain(sql_part('url', 2))} AS domain, {sql_part('url', 3)} AS upath FROM p) q
  LEFT JOIN hints h ON h.domain = q.domain AND starts_with(q.upath, h.prefix)
  GROUP BY q.i, q.url)"""


@check(
    "r7_refresh_interval",
    f"WITH {LINES}, {HINTS}, {REFRESH} SELECT i, coalesce(refresh_s, -1) AS refresh_s FROM refreshed",
)
def _(x):
    marked = R.refresh_intervals(x.sql("SELECT i, url FROM p"), R.refresh_hints(lines(x)))
    return marked.select("i", F.coalesce("refresh_s", F.lit(-1).cast("bigint")).alias("refresh_s"))
