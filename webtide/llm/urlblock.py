"""URL filter with redirect equivalence: decisions on one address hold for all addresses that lead to the same page.

Addresses are nodes; redirects and canonical links are edges. A rule decides an address by itself. An address
without a rule follows its component: allowed if a member is allowed by a rule, else blocked if one is blocked,
else allowed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webtide.functions import urls
from webtide.llm.components import components
from webtide.plans.lineage import Scratch

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPLIT = r"(?s)\A.*?://([^/?#]*)([^?#]*)"
_LINK = r"(?is)<link\b(?=[^>]*\brel\s*=\s*[\"']?canonical\b)[^>]*?\bhref\s*=\s*[\"']?([^\"'\s>]+)"
_REFRESH = r"(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b)[^>]*?\burl\s*=\s*[\"']?([^\"'\s>]+)"


def host(url: Column) -> Column:
    """After the first '://' up to '/', '?', '#' or the end, A-Z lowered; empty without '://' or for null."""
    return F.translate(F.coalesce(F.regexp_extract(url, _SPLIT, 1), F.lit("")), _UPPER, _LOWER)


def path(url: Column) -> Column:
    """What follows the host, up to '?', '#' or the end."""
    return F.coalesce(F.regexp_extract(url, _SPLIT, 2), F.lit(""))


def plain(url: Column) -> Column:
    """Where sites redirect spellings of one address to: https, lower-case host, no fragment, no utm_ parameters,
    no slash at the end of a path. Null without '://'."""
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.startswith("utm_")), "&")
    end = F.when(kept == "", F.lit("")).otherwise(F.concat(F.lit("?"), kept))
    web = F.regexp_replace(F.lower(F.substring_index(url, "://", 1)), r"\Ahttp\z", "https")
    short = F.regexp_replace(path(url), r"/+\z", "")
    return F.when(F.contains(url, F.lit("://")), F.concat(web, F.lit("://"), host(url), short, end))


def page_edges(pages: DataFrame) -> DataFrame:
    """(a, b) of every page (url, html): to its plain form, its canonical link and its refresh target, resolved."""
    rows = pages.select(
        "url",
        plain(F.col("url")).alias("same"),
        *[F.nullif(F.regexp_extract("html", p, 1), F.lit("")).alias(n) for n, p in (("link", _LINK), ("refresh", _REFRESH))],
    )
    ends = rows.select("url", F.explode(F.array("same", "link", "refresh")).alias("to")).filter(F.col("to").isNotNull())
    return ends.select(F.col("url").alias("a"), urls.resolve(F.col("url"), F.col("to")).alias("b"))


def apply_rules(nodes: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, host, path, rule, action) of distinct urls. rules: host, path, action (allow or block).

    A rule fits its host and all subdomains if the url's path starts with the rule's. The longest wins, at equal
    length allow. Every url meets its host's suffixes in an equality join, so large rule lists need no scan.
    """
    parts = nodes.select("url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    at = parts.withColumn("suffix", F.explode(suffixes))
    law = rules.select(
        F.col("host").alias("suffix"), F.col("path").alias("start"), "action", F.concat("host", "path").alias("rule")
    )
    fits = at.join(law, "suffix").filter((F.col("host") != "") & F.startswith("path", F.col("start")))
    best = fits.groupBy("url").agg(
        F.max_by(
            F.struct("rule", "action"), F.struct(F.length("rule"), (F.col("action") == "allow").cast("int"), "rule")
        ).alias("best")
    )
    return parts.join(best, "url", "left").select("url", "host", "path", "best.rule", "best.action")


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] | DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of `pages` (page_id, url, html; others are ignored).

    `edges` (two columns of urls) adds known redirects to what the pages tell. Null urls have no aliases and no
    rule: they are allowed. Repeated rows are judged alike; an empty table gives no rows. An action holds for all
    spellings of it in a component whether or not that address is among the pages.
    """
    spark = pages.sparkSession
    scratch = Scratch(spark)
    law = rules if isinstance(rules, DataFrame) else spark.createDataFrame(list(rules), "host string, path string, action string")
    known = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    linked = page_edges(known.filter(F.col("url").isNotNull()))
    if edges is not None:
        linked = linked.unionByName(edges.toDF("a", "b"))
    targets = linked.select(F.col("b").alias("a"), plain(F.col("b")).alias("b"))
    linked = linked.unionByName(targets).distinct()
    linked, _ = scratch.save(linked.filter(F.col("a").isNotNull() & F.col("b").isNotNull()), "edges")
    group, _ = scratch.save(components(linked, scratch), "groups")
    nodes = known.select("url").unionByName(group.select(F.col("node").alias("url"))).filter(F.col("url").isNotNull()).distinct()
    decided, _ = scratch.save(apply_rules(nodes, law), "decided")
    # an address without aliases is its own group
    joined = decided.join(group.withColumnsRenamed({"node": "url"}), "url", "left")
    named = joined.withColumn("component", F.coalesce("component", "url"))
    acts = (
        named.filter(F.col("action").isNotNull())
        .groupBy("component")
        .agg(F.max((F.col("action") == "allow").cast("int")).alias("allowed"))
    )
    # written, so that the join with a very large group can be split
    acts, _ = scratch.save(acts, "acts")
    method = F.when(F.col("allowed") == 0, F.lit("block")).otherwise(F.lit("allow"))
    verdicts = named.join(acts, "component", "left").select(
        "url", "host", "path", "rule", F.coalesce("action", method).alias("verdict")
    )
    judged = known.select("page_id", "url").join(verdicts, "url", "left")
    return judged.select(
        "page_id",
        F.coalesce("host", F.lit("")).alias("host"),
        F.coalesce("path", F.lit("")).alias("path"),
        "rule",
        F.coalesce("verdict", F.lit("allow")).alias("verdict"),
    )
