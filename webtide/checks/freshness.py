"""Freshness tests over all page addresses."""

from __future__ import annotations

from pyspark.sql import functions as F

from webtide.checks.fixtures import NOW_TS
from webtide.checks.registry import check
from webtide.checks.robots import HINTS, LINES, REFRESH, lines
from webtide.checks.scalars import SQL_FREQ, sql_http_epoch
from webtide.operators import freshness as W
from webtide.operators import robots as R

_CAND = """cand AS (
  SELECT url FROM p UNION ALL SELECT 'https://new.example.com/' || CAST(i AS STRING) FROM p)"""


def candidates(x):
    return x.sql(f"WITH {_CAND} SELECT url FROM cand")


LASTMOD = """marked AS (
  SELECT c.url, CASE WHEN l.lastmod_s <= s.last_seen_s THEN 'lastmod_skip' ELSE 'continue' END AS disposition
  FROM cand c LEFT JOIN fx_listed l ON l.loc = c.url LEFT JOIN fx_state s ON s.url = c.url)"""


@check("f1_lastmod_filter", f"WITH {_CAND}, {LASTMOD} SELECT url, disposition FROM marked")
def _(x):
    return W.lastmod_filter(candidates(x), x.listed, x.state)


HEAD = f"""headed AS (
  SELECT c.url, CASE
      WHEN s.url IS NULL THEN 'update'
      WHEN h.url IS NULL OR h.error IS NOT NULL OR h.status IS NULL OR h.status >= 400 THEN 'unchanged'
      WHEN h.last_modified IS NULL THEN 'update'
      WHEN {sql_http_epoch('h.last_modified')} > s.last_seen_s THEN 'update'
      ELSE 'unchanged' END AS disposition
  FROM cand c LEFT JOIN fx_state s ON s.url = c.url LEFT JOIN fx_heads h ON h.url = c.url)"""


@check("f2_head_filter", f"WITH {_CAND}, {HEAD} SELECT url, disposition FROM headed")
def _(x):
    return W.head_filter(candidates(x), x.fx_heads, x.state)


@check(
    "f3_split_unchanged",
    f"""WITH {_CAND}, {HEAD} SELECT url, 'to_update' AS side FROM headed WHERE disposition = 'update'
        UNION ALL SELECT url, 'unchanged' FROM headed WHERE disposition <> 'update'""",
)
def _(x):
    update, unchanged = W.split_unchanged(W.head_filter(candidates(x), x.fx_heads, x.state))
    return update.withColumn("side", F.lit("to_update")).unionByName(
        unchanged.withColumn("side", F.lit("unchanged"))
    )


@check(
    "f3_meeting",
    f"""WITH {_CAND}, {LASTMOD}, {HEAD} SELECT m.url, CASE WHEN m.disposition = 'lastmod_skip' THEN m.disposition
          ELSE h.disposition END AS disposition, s.content_hash AS known_hash, s.chunk_count AS known_count
        FROM marked m JOIN headed h ON h.url = m.url LEFT JOIN fx_state s ON s.url = m.url""",
)
def _(x):
    """Both tests and what decisions compare, in one meeting with the state."""
    return W.meet(candidates(x), x.listed, x.fx_heads, x.state)


@check(
    "f4_recrawl_due",
    f"""WITH {LINES}, {HINTS}, {REFRESH} SELECT s.url, coalesce(w.wait_s, -1) AS wait_s,
          coalesce(s.last_seen_s + w.wait_s <= {NOW_TS}, false) AS due
        FROM fx_state s JOIN (
          SELECT r.url, coalesce(r.refresh_s, CAST({SQL_FREQ.format('m.freq')} AS BIGINT)) AS wait_s
          FROM refreshed r JOIN pm m USING (url)) w ON w.url = s.url""",
)
def _(x):
    known = x.state.join(x.sql("SELECT url, freq AS changefreq FROM pm"), "url")
    hinted = R.refresh_intervals(known, R.refresh_hints(lines(x)))
    due = W.recrawl_due(hinted, F.timestamp_seconds(F.lit(NOW_TS)))
    return due.select("url", F.coalesce("wait_s", F.lit(-1).cast("bigint")).alias("wait_s"), "due")
