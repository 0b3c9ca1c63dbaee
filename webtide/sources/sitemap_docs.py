"""Captured sitemap documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fetched_sitemaps(locations: DataFrame, captured: DataFrame) -> DataFrame:
    """Text of every wanted sitemap that was captured with status 200."""
    ok = captured.filter((F.col("status") == 200) & (F.length("text") > 0)).select(
        "sitemap_url", "text"
    )
    return locations.join(ok, "sitemap_url")
