"""Fetch outcomes: classes, failure runs, batches and retry rounds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webtide.functions.outcome import is_permanent
from webtide.functions.text import is_empty_content
from webtide.params import Params
from webtide.plans.order import running, with_global_index


def outcome(body: str = "body") -> Column:
    """ok, ignored, or failed with a reason; needs allowed, error, status and the body.

    Never NULL: without a status the reason is http_unknown, and without a verdict of the gate a page is allowed.
    """
    message = F.lower("error")
    limited = F.contains(message, F.lit("429")) | F.contains(message, F.lit("too many"))
    status = F.col("status")
    reason = (
        F.when(~_allowed(), F.lit("ignored"))
        .when(F.col("error").isNotNull() & limited, F.lit("429_rate_limit"))
        .when(F.col("error").isNotNull(), F.substring("error", 1, 200))
        .when(status == 429, F.lit("429_rate_limit"))
        .when((status == 200) & is_empty_content(F.col(body)), F.lit("empty_content"))
        .when(status == 200, F.lit("ok"))
        .otherwise(F.concat(F.lit("http_"), F.coalesce(status.cast("string"), F.lit("unknown"))))
    )
    return reason


def _allowed() -> Column:
    return F.coalesce(F.col("allowed"), F.lit(True))


def classify(fetches: DataFrame) -> DataFrame:
    """Adds outcome ('ok', 'ignored', 'failed') and reason (NULL unless failed)."""
    rows = fetches.withColumn("_r", outcome())
    failed = ~F.col("_r").isin("ok", "ignored") | F.col("error").isNotNull() & _allowed()
    return (
        rows.withColumn("outcome", F.when(failed, F.lit("failed")).otherwise(F.col("_r")))
        .withColumn("reason", F.when(failed, F.col("_r")))
        .drop("_r")
    )


def backoff(fetches: DataFrame, params: Params, blocks: int | None = None) -> DataFrame:
    """Adds fails (length of the failure run), wait_s and alarm, per run and batch in order of seq.

    The run length is the number of failures so far less the number there was at the last success, so two
    running values do, and no batch has to fit into one task.
    """
    if not params.adaptive_backoff:
        return fetches.withColumns(
            {"fails": F.lit(0).cast("bigint"), "wait_s": F.lit(0.0), "alarm": F.lit(False)}
        )
    failed = F.col("outcome") == "failed"
    rows = running(
        fetches,
        ["run_id", "batch_no"],
        "seq",
        {"_failed": failed.cast("bigint")},
        {"_at_ok": ("_failed", F.col("outcome") == "ok")},
        blocks,
    ).withColumn("fails", (F.col("_failed") - F.col("_at_ok")).cast("bigint"))
    return rows.select("*", *waits(params)).drop("_failed", "_at_ok")


def waits(params: Params) -> tuple[Column, Column]:
    """wait_s and alarm from outcome, reason and fails; plain HTTP errors count but do not wait."""
    failed = F.col("outcome") == "failed"
    slow_down = failed & ~F.coalesce(F.startswith("reason", F.lit("http_")), F.lit(False))
    # beyond 60 doublings any wait is at its maximum
    grown = F.lit(float(params.backoff_initial_seconds)) * F.pow(
        F.lit(2.0), F.least(F.col("fails") - 1, F.lit(60))
    )
    wait = F.when(slow_down, F.least(grown, F.lit(float(params.backoff_max_seconds)))).otherwise(0.0)
    return wait.alias("wait_s"), (failed & (F.col("fails") >= params.backoff_threshold)).alias("alarm")


def number_batches(candidates: DataFrame, batch_size: int, *order: str) -> DataFrame:
    """Adds batch_no (from 1) and seq (from 1 in the batch): consecutive slices of the list, ordered by URL if not told."""
    ix = F.col("ix") - 1
    return (
        with_global_index(candidates, list(order) or ["url"])
        .withColumn("batch_no", F.floor(ix / F.lit(batch_size)) + 1)
        .withColumn("seq", ix % batch_size + 1)
        .drop("ix")
    )


def retry_rounds(attempts: DataFrame, max_attempts: int) -> DataFrame:
    """(url, result, attempts): recovered, dropped (permanent error) or still_failed.

    The first success or permanent error among the allowed attempts decides.
    """
    allowed = attempts.filter(F.col("attempt").between(1, max_attempts))
    ends = F.col("error").isNull() | is_permanent(F.col("error"))
    result = F.when(F.col("error").isNull(), F.lit("recovered")).otherwise(F.lit("dropped"))
    return (
        allowed.groupBy("url")
        .agg(
            F.min_by(F.when(ends, result), F.when(ends, F.col("attempt"))).alias("r"),
            F.min(F.when(ends, F.col("attempt"))).alias("stop"),
            F.max("attempt").alias("last"),
        )
        .select(
            "url",
            F.coalesce("r", F.lit("still_failed")).alias("result"),
            F.coalesce("stop", "last").alias("attempts"),
        )
    )
