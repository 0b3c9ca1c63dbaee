"""Captured pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def content_type(df: DataFrame) -> DataFrame:
    """Header value up to the first ';', neither trimmed nor lower-cased; text/html when missing."""
    header = F.coalesce(F.col("content_type"), F.lit("text/html"))
    return df.withColumn("content_type", F.split_part(header, F.lit(";"), F.lit(1)))


def typed(captures: DataFrame) -> DataFrame:
    """With a content_type: NULL where captures do not say."""
    if "content_type" in captures.columns:
        return captures
    return captures.withColumn("content_type", F.lit(None).cast("string"))


def latest(captures: DataFrame, *order: str) -> DataFrame:
    """Last capture per URL. Which one that is comes from narrow rows; bodies are joined to it, never sorted in groups.

    Of captures alike in URL and order one is taken, the greatest by its other columns.
    """
    at = F.struct(*order)
    counted = captures.groupBy("url", at.alias("_at")).agg(F.count(F.lit(1)).alias("_n"))
    last = counted.groupBy(F.col("url").alias("_url")).agg(F.max(F.struct("_at", "_n")).alias("_last"))
    same = F.col("url").eqNullSafe(F.col("_url")) & at.eqNullSafe(F.col("_last._at"))
    found = captures.join(last, same).withColumn("_n", F.col("_last._n")).drop("_url", "_last")
    rest = [c for c in captures.columns if c != "url"]
    # only ties, which are rare, are grouped with their bodies
    tied = found.filter(F.col("_n") > 1).groupBy("url").agg(F.max(F.struct(*rest)).alias("_one"))
    return found.filter(F.col("_n") == 1).drop("_n").unionByName(tied.select("url", "_one.*"))


def contents(candidates: DataFrame, captures: DataFrame) -> DataFrame:
    """Captured response for each candidate URL; `captured` is false where there is none."""
    found = content_type(captures).withColumn("captured", F.lit(True))
    return candidates.join(found, "url", "left").withColumn(
        "captured", F.coalesce("captured", F.lit(False))
    )
