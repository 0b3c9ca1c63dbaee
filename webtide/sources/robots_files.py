"""Captured robots.txt files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pick_robots(captured: DataFrame) -> DataFrame:
    """(domain, text): the https copy if it came with status 200, else the http copy."""
    rank = F.when(F.col("proto") == "https", 0).when(F.col("proto") == "http", 1)
    return (
        captured.filter((F.col("status") == 200) & rank.isNotNull())
        .groupBy("domain")
        .agg(F.min_by("text", rank).alias("text"))
    )
