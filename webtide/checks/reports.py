"""Counts and summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from webtide.checks.fixtures import DuckDialect
from webtide.checks.freshness import _CAND, HEAD, candidates
from webtide.checks.registry import check
from webtide.checks.sitemaps import MERGED
from webtide.operators import freshness as W
from webtide.operators import report as G
from webtide.operators import sitemap as M
from webtide.sources import logs


@check(
    "g1_discovery_counts",
    f"""WITH {MERGED} SELECT count(*) FILTER (in_sitemap) AS sitemap_urls, count(*) FILTER (NOT in_sitemap) AS bfs_only,
          count(*) AS total, (SELECT count(DISTINCT url) FROM fx_captures WHERE error IS NOT NULL) AS failed FROM merged""",
)
def _(x):
    failed = x.fx_captures.filter(F.col("error").isNotNull())
    return G.discovery_counts(M.merge_candidates(x.state, x.fx_listed), failed)


@check(
    "g2_freshness_counts",
    f"WITH {_CAND}, {HEAD} SELECT disposition, count(*) AS urls FROM headed GROUP BY disposition",
)
def _(x):
    return G.disposition_counts(W.head_filter(candidates(x), x.fx_heads, x.state))


@check(
    "g3_batch_progress",
    """WITH b AS (SELECT run_id, batch_no, count(*) FILTER (result = 'ingested') AS i,
         count(*) FILTER (result = 'skipped') AS s, count(*) FILTER (result = 'failed') AS f
       FROM fx_results GROUP BY run_id, batch_no)
       SELECT run_id, batch_no, CAST(sum(i) OVER w AS BIGINT) AS ingested, CAST(sum(s) OVER w AS BIGINT) AS skipped,
         CAST(sum(f) OVER w AS BIGINT) AS failed FROM b WINDOW w AS (PARTITION BY run_id ORDER BY batch_no)""",
)
def _(x):
    return G.batch_progress(x.fx_results)


_PARSED = """parsed AS (SELECT ts, level, json_extract_string(line, '$.event') AS event
  FROM (SELECT * FROM fx_log WHERE json_valid(line)))"""


@check("g4_log_rollup", f"WITH {_PARSED} SELECT level, event, count(*) AS lines FROM parsed GROUP BY ALL")
def _(x):
    return G.log_rollup(logs.parse_log(x.fx_log))


@check(
    "g4_log_windows",
    f"""WITH {_PARSED} SELECT level, event, {DuckDialect().epoch("time_bucket(INTERVAL '1 hour', ts)")} AS window_s,
          count(*) AS lines FROM parsed GROUP BY ALL""",
)
def _(x):
    rows = G.log_rollup(logs.parse_log(x.fx_log), "1 hour")
    epoch = F.unix_seconds(F.col("window_start").cast("timestamp"))
    return rows.select("level", "event", epoch.alias("window_s"), "lines")


@check(
    "g5_summary_text",
    """SELECT url, concat_ws(', ', n || ' URLs ingested', CASE WHEN s > 0 THEN s || ' skipped (unchanged)' END,
         CASE WHEN f > 0 THEN f || ' failed' END, CASE WHEN r > 0 THEN r || ' stale removed' END, '0.5 min') AS summary
       FROM (SELECT url, chunk_count AS n, chunk_count % 2 AS s, miss_count AS f, miss_count % 2 AS r FROM fx_state)""",
)
def _(x):
    n, miss = F.col("chunk_count"), F.col("miss_count")
    return x.state.select(
        "url", G.summary_text(n, n % 2, miss, miss % 2, F.lit("0.5")).alias("summary")
    )
