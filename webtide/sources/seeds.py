"""Seed lists and crawl scope out of settings text."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webtide.functions import urls
from webtide.functions.text import strip
from webtide.plans.lineage import Scratch


def seed_list(settings: DataFrame, key: str = "setting", raw: str = "raw") -> DataFrame:
    """Comma-separated seeds -> one row (key, seed_ix, url) per valid item, in order, repeats kept."""
    items = settings.select(key, F.posexplode(F.split(raw, ",")).alias("seed_ix", "item"))
    valid = items.filter((strip(F.col("item")) != "") & urls.validate_url(F.col("item")))
    return valid.select(
        key, "seed_ix", urls.with_protocol(urls.clean_url(F.col("item"))).alias("url")
    )


def extra_domains(settings: DataFrame, raw: str = "raw") -> DataFrame:
    """Comma-separated further hosts -> (domain)."""
    items = settings.select(F.explode(F.split(raw, ",")).alias("item"))
    valid = items.filter((strip(F.col("item")) != "") & urls.validate_url(F.col("item")))
    return valid.select(
        urls.normalize_domain(urls.with_protocol(F.col("item"))).alias("domain")
    ).distinct()


def scope(seeds: DataFrame, extras: DataFrame | None = None) -> DataFrame:
    """(domain, kind, prefix): root domains with their path prefixes, allowed domains with a NULL prefix."""
    path = urls.path(F.col("url"))
    roots = seeds.select(
        urls.normalize_domain(urls.netloc(F.col("url"))).alias("domain"),
        F.lit("root").alias("kind"),
        F.when(path == "", F.lit("/")).otherwise(path).alias("prefix"),
    ).distinct()
    if extras is None:
        return roots
    return roots.unionByName(
        extras.select(
            "domain", F.lit("allowed").alias("kind"), F.lit(None).cast("string").alias("prefix")
        ).distinct()
    )


@dataclass(frozen=True)
class Scope:
    """A job's scope in two tables; none of them holds the prefixes of a domain in one row.

    domains(domain, kind, lengths): one row per domain; `lengths` are the distinct lengths of its prefixes, which are
    bounded by its longest path, however many prefixes there are. prefixes(domain, prefix): the cover.
    """

    domains: DataFrame
    prefixes: DataFrame

    def saved(self, scratch: Scratch) -> Scope:
        """Both tables written, so that their size is known and decides how they are joined."""
        return Scope(
            scratch.save(self.domains, "scope-domains")[0], scratch.save(self.prefixes, "scope-prefixes")[0]
        )


def prefix_cover(scope_rows: DataFrame) -> DataFrame:
    """(domain, prefix): root prefixes that begin with no other one of their domain.

    A prefix looks up its own beginnings, of the lengths that its domain has, by equality: none is compared with all
    others. A path begins with at most one prefix of the cover, and with one exactly if it does with one of all.
    """
    is_root = (F.col("kind") == "root") & F.col("prefix").isNotNull()
    roots = scope_rows.filter(is_root).select("domain", "prefix").distinct()
    shorter = F.filter("lengths", lambda n: n < F.length("prefix"))
    starts = roots.join(_lengths(roots), "domain").select(
        "domain", "prefix", F.explode(shorter).alias("n")
    )
    told = starts.select("domain", F.col("prefix").alias("covered"), F.left("prefix", "n").alias("prefix"))
    covered = told.join(roots, ["domain", "prefix"], "left_semi")
    return roots.join(covered.select("domain", F.col("covered").alias("prefix")), ["domain", "prefix"], "left_anti")


def _lengths(prefixes: DataFrame) -> DataFrame:
    return prefixes.groupBy("domain").agg(F.sort_array(F.collect_set(F.length("prefix"))).alias("lengths"))


def pack_scope(scope_rows: DataFrame) -> Scope:
    """Domains, where root wins over allowed, and the cover of their prefixes."""
    cover = prefix_cover(scope_rows)
    kind = F.when(F.bool_or(F.col("kind") == "root"), F.lit("root")).otherwise(F.lit("allowed"))
    domains = scope_rows.groupBy("domain").agg(kind.alias("kind")).join(_lengths(cover), "domain", "left")
    none = F.array().cast("array<int>")
    return Scope(domains.withColumn("lengths", F.coalesce("lengths", none)), cover)
