"""Fetch outcomes, failure runs, batches and retries."""

from __future__ import annotations

from pyspark.sql import functions as F

from webtide.checks.fixtures import AGENT
from webtide.checks.registry import check
from webtide.checks.robots import DELAYS, GATE, LINES, RULES, lines
from webtide.checks.scalars import SQL_EMPTY, sql_domain, sql_part
from webtide.operators import fetchlog as L
from webtide.operators import robots as R
from webtide.params import Params
from webtide.plans import politeness
from webtide.plans.lineage import Scratch

_TESTED = "tested AS (SELECT i, 0 AS k, url AS u FROM p)"
_LIMITED = "(contains(lower(error), '429') OR contains(lower(error), 'too many'))"
REASON = f"""CASE WHEN NOT allowed THEN NULL
    WHEN error IS NOT NULL AND {_LIMITED} THEN '429_rate_limit'
    WHEN error IS NOT NULL THEN left(error, 200) WHEN status = 429 THEN '429_rate_limit'
    WHEN status = 200 AND {SQL_EMPTY} THEN 'empty_content' WHEN status = 200 THEN NULL
    ELSE 'http_' || coalesce(CAST(status AS STRING), 'unknown') END"""


@check(
    "c1_fetch_outcome",
    f"""WITH {LINES}, {RULES}, {_TESTED}, {GATE} SELECT i,
          CASE WHEN NOT allowed THEN 'ignored' WHEN reason IS NULL THEN 'ok' ELSE 'failed' END AS outcome, reason
        FROM (SELECT c.i, g.allowed, {REASON} AS reason FROM fx_captures c JOIN gate g ON g.i = c.i)""",
)
def _(x):
    gated = R.gate(x.fx_captures, R.rule_tables(lines(x), AGENT))
    return L.classify(gated).select("i", "outcome", "reason")


_RUNS = """grp AS (
  SELECT *, sum(CASE WHEN outcome = 'ok' THEN 1 ELSE 0 END) OVER w AS g FROM fx_fetches
  WINDOW w AS (PARTITION BY run_id, batch_no ORDER BY seq)),
 fl AS (
  SELECT *, CAST(sum(CASE WHEN outcome = 'failed' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS fails FROM grp
  WINDOW w AS (PARTITION BY run_id, batch_no, g ORDER BY seq))"""


@check(
    "c2_backoff_runs",
    f"""WITH {_RUNS} SELECT run_id, batch_no, seq, fails,
          CASE WHEN outcome = 'failed' AND reason NOT LIKE 'http_%'
               THEN least(10.0 * pow(2.0, least(fails - 1, 60)), 120.0) ELSE 0.0 END::DOUBLE AS wait_s,
          outcome = 'failed' AND fails >= 3 AS alarm FROM fl""",
)
def _(x):
    marked = L.backoff(x.fx_fetches, Params())
    return marked.select("run_id", "batch_no", "seq", "fails", "wait_s", "alarm")


@check(
    "c3_batches",
    """SELECT url, CAST(floor((n - 1) / 50) AS BIGINT) + 1 AS batch_no, (n - 1) % 50 + 1 AS seq
       FROM (SELECT url, row_number() OVER (ORDER BY url) AS n FROM p)""",
)
def _(x):
    return L.number_batches(x.sql("SELECT url FROM p"), 50)


@check(
    "c4_retry_rounds",
    """WITH a AS (SELECT *, error IS NULL OR regexp_matches(lower(error),
           '404|not found|403|forbidden|400|bad request|not supported') AS ends FROM fx_attempts)
       SELECT url, coalesce(arg_min(CASE WHEN error IS NULL THEN 'recovered' ELSE 'dropped' END, attempt) FILTER (ends),
                            'still_failed') AS result,
              coalesce(min(attempt) FILTER (ends), max(attempt)) AS attempts
       FROM a GROUP BY url""",
)
def _(x):
    return L.retry_rounds(x.fx_attempts, 3)


# a batch size that gives many batches at every scale
POLITE = Params(user_agent=AGENT, request_delay=0.75, batch_size=16)
PLAN = f"""{LINES}, {DELAYS}, {RULES}, {_TESTED}, {GATE},
 due AS (
  SELECT url, {sql_domain(sql_part('url', 2))} AS domain FROM (
    SELECT DISTINCT url FROM p JOIN gate g ON g.i = p.i AND g.allowed)),
 timed AS (
  SELECT url, d.domain, greatest(0.75, coalesce(crawl_delay, 0.75))::DOUBLE AS delay_s,
         row_number() OVER (PARTITION BY d.domain ORDER BY url) - 1 AS before
  FROM due d LEFT JOIN delays USING (domain)),
 plan AS (
  SELECT url, domain, delay_s, start_s, CAST(floor((n - 1) / 16) AS BIGINT) + 1 AS batch_no, (n - 1) % 16 + 1 AS seq
  FROM (SELECT *, row_number() OVER (ORDER BY start_s, domain, url) AS n
        FROM (SELECT *, before * delay_s AS start_s FROM timed)))"""


def fetch_plan(x):
    due = R.gate(x.sql("SELECT url FROM p"), R.rule_tables(lines(x), AGENT)).filter("allowed")
    return politeness.fetch_plan(due, R.crawl_delays(lines(x), AGENT), POLITE)


@check("c3_fetch_plan", f"WITH {PLAN} SELECT url, domain, delay_s, start_s, batch_no, seq FROM plan")
def _(x):
    return fetch_plan(x)


@check(
    "c3_batch_times",
    f"""WITH {PLAN} SELECT batch_no, count(*) AS pages, count(DISTINCT domain) AS domains, min(start_s) AS from_s,
          max(start_s + delay_s) AS until_s FROM plan GROUP BY batch_no""",
)
def _(x):
    return politeness.batch_times(fetch_plan(x))


@check(
    "g3_planned_progress",
    f"""WITH {PLAN}, got AS (
          SELECT url, CASE WHEN {REASON.replace('NOT allowed', 'false')} IS NULL THEN 'ingested' ELSE 'failed' END AS result FROM fx_captures),
        b AS (SELECT batch_no, count(*) FILTER (result = 'ingested') AS i, count(*) FILTER (result = 'failed') AS f
              FROM plan LEFT JOIN got USING (url) GROUP BY batch_no)
        SELECT 'r' AS run_id, batch_no, CAST(sum(i) OVER w AS BIGINT) AS ingested, CAST(0 AS BIGINT) AS skipped,
          CAST(sum(f) OVER w AS BIGINT) AS failed FROM b WINDOW w AS (ORDER BY batch_no)""",
)
def _(x):
    judged = L.classify(x.fx_captures.withColumn("allowed", F.lit(True)))
    result = F.when(F.col("outcome") == "ok", F.lit("ingested")).otherwise(F.lit("failed"))
    plan, _ = Scratch(x.spark).save(fetch_plan(x), "plan")
    return politeness.progress(plan, judged.select("url", result.alias("result")), "r")
