"""Counts and the run summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webtide.plans.order import running


def discovery_counts(merged: DataFrame, failed: DataFrame) -> DataFrame:
    """One row: sitemap_urls, bfs_only, total, failed."""
    found = merged.select(F.col("in_sitemap"), F.lit(False).alias("failed"))
    lost = failed.select("url").distinct().select(
        F.lit(None).cast("boolean").alias("in_sitemap"), F.lit(True).alias("failed")
    )
    return found.unionByName(lost).agg(
        F.count_if("in_sitemap").alias("sitemap_urls"),
        F.count_if(~F.col("in_sitemap")).alias("bfs_only"),
        F.count_if(~F.col("failed")).alias("total"),
        F.count_if("failed").alias("failed"),
    )


def disposition_counts(marked: DataFrame, column: str = "disposition") -> DataFrame:
    return marked.groupBy(column).agg(F.count(F.lit(1)).alias("urls"))


def batch_progress(results: DataFrame) -> DataFrame:
    """(run_id, batch_no, ingested, skipped, failed): totals up to and including each batch.

    `results` has run_id, batch_no and result.
    """
    names = ("ingested", "skipped", "failed")
    per_batch = results.groupBy("run_id", "batch_no").agg(
        *[F.count_if(F.col("result") == n).alias(f"n_{n}") for n in names]
    )
    return running(per_batch, ["run_id"], "batch_no", {n: F.col(f"n_{n}") for n in names}).select(
        "run_id", "batch_no", *[F.col(n).cast("bigint").alias(n) for n in names]
    )


def log_rollup(log: DataFrame, window: str | None = None) -> DataFrame:
    """Log lines per level and event, and per time window if one is given."""
    if window is None:
        return log.groupBy("level", "event").agg(F.count(F.lit(1)).alias("lines"))
    return (
        log.groupBy("level", "event", F.window("ts", window).alias("w"))
        .agg(F.count(F.lit(1)).alias("lines"))
        .select("level", "event", F.col("w.start").alias("window_start"), "lines")
    )


def summary_text(
    ingested: Column, skipped: Column, failed: Column, removed: Column, minutes: Column
) -> Column:
    """'3 URLs ingested, 2 skipped (unchanged), ...': zero parts are left out, but for the first."""
    part = lambda n, words: F.when(n > 0, F.concat(n.cast("string"), F.lit(words)))
    return F.concat_ws(
        ", ",
        F.concat(ingested.cast("string"), F.lit(" URLs ingested")),
        part(skipped, " skipped (unchanged)"),
        part(failed, " failed"),
        part(removed, " stale removed"),
        F.concat(minutes.cast("string"), F.lit(" min")),
    )
