"""Cheap tests that spare known, unchanged URLs a fetch. Only narrow columns are read here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webtide.functions import dates


def _seen(state: DataFrame) -> DataFrame:
    return state.select("url", "last_seen")


def lastmod_filter(candidates: DataFrame, listed: DataFrame, state: DataFrame) -> DataFrame:
    """Adds disposition 'lastmod_skip' for known URLs whose sitemap date is not after last_seen, else 'continue'."""
    met = candidates.join(
        listed.select(F.col("loc").alias("url"), "lastmod"), "url", "left"
    ).join(_seen(state), "url", "left")
    return met.withColumn(
        "disposition", F.when(_listed_as_old(), F.lit("lastmod_skip")).otherwise(F.lit("continue"))
    ).drop("lastmod", "last_seen")


def _listed_as_old() -> Column:
    return F.col("lastmod") <= F.col("last_seen")


def head_filter(candidates: DataFrame, heads: DataFrame, state: DataFrame) -> DataFrame:
    """Adds disposition 'update' or 'unchanged' from the captured headers.

    New URLs are updated, failing known ones left alone; a date decides where there is one, and without a
    header the page is fetched.
    """
    met = candidates.join(_seen(state), "url", "left").join(_answers(heads), "url", "left")
    return met.withColumn("disposition", _head_rule()).drop("last_seen", *_ANSWER)


_ANSWER = ("_answered", "status", "last_modified", "error")


def _answers(heads: DataFrame) -> DataFrame:
    return heads.select("url", F.lit(True).alias("_answered"), *_ANSWER[1:])


def meet(candidates: DataFrame, listed: DataFrame, heads: DataFrame, state: DataFrame) -> DataFrame:
    """Adds disposition (lastmod_skip, unchanged or update), known_hash and known_count.

    All rules that ask what is known, with one scan of the state: the sitemap's date first, then the header, and what
    `sync.decision` compares later goes along. All four tables meet on `url`, so candidates are shuffled once.
    """
    known = state.select(
        "url", "last_seen", F.col("content_hash").alias("known_hash"), F.col("chunk_count").alias("known_count")
    )
    dates_of = listed.select(F.col("loc").alias("url"), "lastmod")
    met = candidates.join(dates_of, "url", "left").join(_answers(heads), "url", "left").join(known, "url", "left")
    rule = F.when(_listed_as_old(), F.lit("lastmod_skip")).otherwise(_head_rule())
    return met.withColumn("disposition", rule).drop("lastmod", "last_seen", *_ANSWER)


def _head_rule() -> Column:
    newer = dates.parse_http_date(F.col("last_modified")) > F.col("last_seen")
    failing = (
        F.col("_answered").isNull()
        | F.col("error").isNotNull()
        | F.col("status").isNull()
        | (F.col("status") >= 400)
    )
    has_date = F.coalesce(F.col("last_modified"), F.lit("")) != ""
    update, unchanged = F.lit("update"), F.lit("unchanged")
    return (
        F.when(F.col("last_seen").isNull(), update)
        .when(failing, unchanged)
        .when(~has_date, update)
        .when(F.coalesce(newer, F.lit(False)), update)
        .otherwise(unchanged)
    )


def split_unchanged(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    return (
        marked.filter(F.col("disposition") == "update").select("url"),
        marked.filter(F.col("disposition") == "unchanged").select("url"),
    )


def recrawl_due(known: DataFrame, as_of: Column) -> DataFrame:
    """Adds due: last_seen plus the site's hint, or else the sitemap frequency, is over; NULL hints are never due.

    `known` has last_seen, refresh_s and changefreq.
    """
    wait = F.coalesce(F.col("refresh_s"), dates.changefreq_seconds(F.col("changefreq")).cast("bigint"))
    return known.withColumn("wait_s", wait).withColumn(
        "due",
        F.coalesce(F.unix_seconds("last_seen") + F.col("wait_s") <= F.unix_seconds(as_of), F.lit(False)),
    )
