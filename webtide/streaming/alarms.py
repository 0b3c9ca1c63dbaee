"""Failure alarms over a stream of fetch outcomes.

Between micro-batches only one number per key is carried: the length of the failure run that is still open. It lies in
buckets by key, and a batch reads and writes those of its keys.
Inside a micro-batch the running totals of the batch job do the counting, in blocks, so a host that causes a
third of all fetches is not counted by a single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from webtide.operators.fetchlog import waits
from webtide.params import Params
from webtide.plans.order import match, running
from webtide.streaming.batches import start_batches
from webtide.streaming.carry import KeyedCarry


def count_batch(batch: DataFrame, carried: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds `fails`, counting on from the carried run until the first success of the batch."""
    ok = F.col("outcome") == "ok"
    rows = running(
        batch,
        keys,
        "seq",
        {"_failed": (F.col("outcome") == "failed").cast("bigint"), "_oks": ok.cast("bigint")},
        {"_at_ok": ("_failed", ok)},
    )
    rows = match(rows, carried, keys, "left")
    before = F.when(F.col("_oks") == 0, F.coalesce("open_fails", F.lit(0))).otherwise(F.lit(0))
    return rows.withColumn(
        "fails", (F.col("_failed") - F.col("_at_ok") + before).cast("bigint")
    ).drop("_failed", "_oks", "_at_ok", "open_fails")


def next_carry(counted: DataFrame, carried: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, open_fails) after the batch, of runs that are open; keys it did not touch keep their number."""
    ends = counted.groupBy(*keys).agg(F.max_by("fails", "seq").alias("_end"))
    after = match(carried, ends, keys, "full").select(*keys, F.coalesce("_end", "open_fails").alias("open_fails"))
    return after.filter(F.col("open_fails") > 0)


def start_alarms(
    stream: DataFrame, path: str, params: Params, keys: Sequence[str], checkpoint: str
) -> StreamingQuery:
    """Write failed rows with fails, wait_s and alarm under `path`/alarms, one folder per query and micro-batch.

    The query's id is kept in its checkpoint: a batch that runs again replaces its own folder, and a query with
    another checkpoint neither reads nor overwrites anything of this one's.
    """
    spark = SparkSession.getActiveSession()
    schema = ", ".join([f"{k} {stream.schema[k].dataType.simpleString()}" for k in keys])

    def each(batch: DataFrame, query_id: str, batch_id: int) -> None:
        carry = KeyedCarry(spark, f"{path}/carry/{query_id}", f"{schema}, open_fails bigint", keys)
        touched = carry.buckets_of(batch, batch_id)
        carried = carry.read(batch_id, touched)
        counted = count_batch(batch, carried, keys).persist()
        try:
            failed = counted.filter(F.col("outcome") == "failed")
            alarms = f"{path}/alarms/{query_id}-{batch_id}"
            failed.select("*", *waits(params)).write.mode("overwrite").parquet(alarms)
            carry.write(batch_id, next_carry(counted, carried, keys), touched)
        finally:
            counted.unpersist()

    return start_batches(stream, each, checkpoint)
