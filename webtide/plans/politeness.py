"""When which page is fetched: one page of a domain per delay, domains side by side, in batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webtide.functions import urls
from webtide.operators import fetchlog, report, robots
from webtide.params import Params
from webtide.plans.order import running


def fetch_plan(candidates: DataFrame, delays: DataFrame, params: Params) -> DataFrame:
    """(url, domain, delay_s, start_s, batch_no, seq) of every candidate URL, each once.

    The n-th page of a domain, by URL, starts n - 1 delays after the first; the delay is the larger of `request_delay` and,
    if obeyed, the site's own (`delays`: domain, crawl_delay). Batches of `batch_size` follow the starts, so a batch
    takes pages of all domains that are due, and a large domain does not hold up the others. Pages are counted in blocks
    by position: a domain with a third of all pages is many tasks. Without a URL there is nothing to fetch.
    """
    wanted = candidates.select("url").filter(F.col("url").isNotNull()).distinct()
    keyed = wanted.withColumn("domain", urls.normalize_domain(urls.netloc(F.col("url"))))
    counted = running(keyed, ["domain"], "url", {"_n": F.lit(1)})
    timed = robots.effective_delays(counted, delays, params.request_delay, params.obey_crawl_delay)
    # a product, not a sum of delays: exact whatever the blocks are
    started = timed.withColumn("start_s", (F.col("_n") - 1) * F.col("delay_s")).drop("_n")
    numbered = fetchlog.number_batches(started, params.batch_size, "start_s", "domain", "url")
    return numbered.select("url", "domain", "delay_s", "start_s", "batch_no", "seq")


def batch_times(plan: DataFrame) -> DataFrame:
    """(batch_no, pages, domains, from_s, until_s): first start and last end of a wait in each batch.

    Pages of a domain are counted in each task first, so no batch or domain is gathered.
    """
    per_domain = plan.groupBy("batch_no", "domain").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("start_s").alias("first"),
        F.max(F.col("start_s") + F.col("delay_s")).alias("last"),
    )
    return per_domain.groupBy("batch_no").agg(
        F.sum("n").alias("pages"),
        F.count(F.lit(1)).alias("domains"),
        F.min("first").alias("from_s"),
        F.max("last").alias("until_s"),
    )


def progress(plan: DataFrame, results: DataFrame, run_id: str) -> DataFrame:
    """Totals of `results` (url, result) up to and including each batch of the plan; pages without result count nowhere."""
    done = plan.select("url", "batch_no").join(results.select("url", "result"), "url", "left")
    return report.batch_progress(done.withColumn("run_id", F.lit(run_id)))
