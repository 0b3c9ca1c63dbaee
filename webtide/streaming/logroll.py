"""Windowed counts over a stream of log lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from webtide.operators.report import log_rollup
from webtide.plans.lineage import names_in
from webtide.plans.order import match

_SCHEMA = "level string, event string, window_start timestamp, lines bigint"


def start_rollup(
    parsed: DataFrame, window: str, late: str, path: str, checkpoint: str
) -> StreamingQuery:
    """Append the count of every window once no line for it is expected any more."""
    rolled = log_rollup(parsed.withWatermark("ts", late), window)
    return (
        rolled.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _committed(spark: SparkSession, folder: str) -> bool:
    return any(n.isdigit() for n in names_in(spark, folder))


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(level, event, window_start, lines) of windows that still wait for lines, as the last finished batch left them."""
    if not _committed(spark, f"{checkpoint}/commits"):
        return spark.createDataFrame([], _SCHEMA)
    state = spark.read.format("statestore").load(checkpoint)
    return state.select(
        "key.level", "key.event", F.col("key.window.start").alias("window_start"), F.col("value.count").alias("lines")
    )


def closed_rollup(spark: SparkSession, path: str, checkpoint: str) -> DataFrame:
    """The counts at the end of the input: windows that are appended and those still open, each once.

    To be called while the query is stopped. Nothing is written: the query goes on from its checkpoint when more lines
    arrive, and a window that was open here is appended later, with those lines. If a batch was appended but its end
    not recorded, its windows are in both places: the appended ones count. Lines beyond the watermark are in neither.
    """
    still = open_windows(spark, checkpoint)
    if not _committed(spark, f"{path}/_spark_metadata"):
        return still
    done = spark.read.schema(_SCHEMA).parquet(path)
    return done.unionByName(match(still, done, ["level", "event", "window_start"], "left_anti"))
