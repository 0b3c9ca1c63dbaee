"""Sitemaps: where they are, what they list, and how several lists become one."""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webtide.functions import dates, urls
from webtide.functions.text import SPACE, strip
from webtide.operators.links import in_path_scope
from webtide.plans.lineage import Scratch
from webtide.plans.once import computed
from webtide.sources.seeds import Scope
from webtide.sources.sitemap_docs import fetched_sitemaps

_XML = (
    "url array<struct<loc:string,lastmod:string,changefreq:string,priority:string>>,"
    "sitemap array<struct<loc:string>>,"
    "_broken string"
)
_XML_OPTIONS = {
    "ignoreNamespace": "true",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_broken",
}
# Fixed value: what is taken from a document that is no XML.
_LOC = rf"<loc>{SPACE}*(https?://[^<]+?){SPACE}*</loc>"
_ROOT = r"\A\ufeff?\s*(?:<!DOCTYPE[^>]*>\s*)?<([A-Za-z_][\w.:-]*)"
#: So many levels look for their own sitemaps among the captured ones.
SOUGHT = 8
_NUMBER = r"\A[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\z"


def locations(roots: DataFrame, declared: DataFrame) -> DataFrame:
    """(root_ix, root_url, ord, sitemap_url): declared sitemaps of each root, else the usual place."""
    host = urls.netloc(F.col("root_url"))
    keyed = roots.select(
        "root_ix",
        "root_url",
        F.regexp_replace(F.lower(host), r"\Awww\.", "").alias("domain"),
        F.concat(urls.scheme(F.col("root_url")), F.lit("://"), host).alias("base"),
    )
    joined = keyed.join(declared, "domain", "left")
    place = (
        F.when(F.col("sitemap").isNull(), F.concat("base", F.lit("/sitemap.xml")))
        .when(F.startswith("sitemap", F.lit("http")), F.col("sitemap"))
        .when(F.startswith("sitemap", F.lit("/")), F.concat("base", "sitemap"))
        .otherwise(F.concat("base", F.lit("/"), "sitemap"))
    )
    return joined.select(
        "root_ix", "root_url", F.coalesce("line_no", F.lit(0)).alias("ord"), place.alias("sitemap_url")
    )


def _well_formed(text: Column) -> Column:
    """What the reader lets pass and XML does not: text around the root, a second root, an undeclared prefix."""
    bare = F.regexp_replace(text, r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>|<\?.*?\?>", "")
    root = F.regexp_extract(bare, _ROOT, 1)
    whole = bare.rlike(rf"(?s){_ROOT}[^>]*(?<=/)>\s*\z") | bare.rlike(rf"(?s){_ROOT}[\s>].*</\1\s*>\s*\z")
    once = F.regexp_count(bare, F.concat(F.lit("</"), root, F.lit(r"\s*>"))) <= 1
    used = F.array_distinct(F.regexp_extract_all(bare, F.lit(r"<([A-Za-z_][\w.-]*):"), F.lit(1)))
    declared = F.regexp_extract_all(bare, F.lit(r"xmlns:([\w.-]+)\s*="), F.lit(1))
    return whole & once & (F.size(F.array_except(used, F.array_append(declared, "xml"))) == 0)


def parse(docs: DataFrame) -> DataFrame:
    """Adds `entries` and `children` arrays to rows with `text`; broken XML falls back to its <loc> parts."""
    keep = [c for c in docs.columns if c != "text"]
    xml = docs.select(*keep, "text", F.from_xml("text", _XML, _XML_OPTIONS).alias("x"))
    broken = F.col("x._broken").isNotNull() | F.col("x").isNull() | ~_well_formed(F.col("text"))
    none = F.lit(None).cast("string")
    fallback = F.transform(
        F.regexp_extract_all("text", F.lit(_LOC), F.lit(1)),
        lambda u: F.struct(
            u.alias("loc"), none.alias("lastmod"), none.alias("changefreq"), none.alias("priority")
        ),
    )
    return xml.select(
        *keep,
        F.when(broken, fallback).otherwise(F.col("x.url")).alias("entries"),
        F.when(~broken, F.col("x.sitemap.loc")).alias("children"),
    )


def entries(parsed: DataFrame) -> DataFrame:
    """One row per listed URL: loc, lastmod, changefreq, priority, and its place `entry_ix`."""
    keep = [c for c in parsed.columns if c not in ("entries", "children")]
    rows = parsed.select(*keep, F.posexplode("entries").alias("entry_ix", "e"))
    number = strip(F.col("e.priority"))
    return rows.select(
        *keep,
        "entry_ix",
        strip(F.col("e.loc")).alias("loc"),
        dates.parse_iso(F.col("e.lastmod")).alias("lastmod"),
        strip(F.col("e.changefreq")).alias("changefreq"),
        F.when(number.rlike(_NUMBER), number.try_cast("double")).alias("priority"),
    ).filter(F.startswith("loc", F.lit("http")))


def expand(places: DataFrame, captured: DataFrame, last_root_only: bool = False) -> DataFrame:
    """Entries of all sitemaps reachable from `places`, each sitemap once per root.

    Every document that is reached is parsed once, however many roots list it, at the first level that names it; from
    level `SOUGHT` on, which scans the captures for the last time, so is every one that is left. The walk moves only the
    names of sitemaps and sub-sitemaps, and entries come in at its end. `ord` is the path of positions that led to
    an entry, so it sorts as nested lists do. A sitemap listed at several depths is read at the least one.
    With `last_root_only` a sitemap's entries come once, for the last root that reaches it: enough where the
    last entry of a URL wins.
    """
    scratch = Scratch(places.sparkSession)
    seen_key = ["root_ix", "sitemap_url"]
    level = _first(places.select("root_ix", F.array(F.col("ord").cast("int")).alias("ord"), "sitemap_url"))
    levels: list[str] = []
    parsed: list[str] = []
    for depth in count():
        levels.append(f"level-{depth}")
        frontier, stats = scratch.save(level, levels[-1])
        reached = scratch.read(frontier, *levels)
        if not stats["rows"]:
            break
        if depth <= SOUGHT:
            names = (frontier if depth < SOUGHT else captured).select("sitemap_url").distinct()
            if parsed:
                asked = scratch.read(frontier, *levels[:-1]).select("sitemap_url")
                names = names.join(asked, "sitemap_url", "left_anti")
            parsed.append(f"docs-{depth}")
            made, _ = scratch.save(parse(fetched_sitemaps(names, captured)), parsed[-1])
            docs = scratch.read(made, *parsed)
            children = docs.select("sitemap_url", F.posexplode("children").alias("pos", "child"))
            graph = children.withColumn("child", strip(F.col("child"))).filter(F.col("child") != "")
        below = frontier.join(graph, "sitemap_url").select(
            "root_ix", F.concat("ord", F.array("pos")).alias("ord"), F.col("child").alias("sitemap_url")
        )
        level = _first(below).join(reached.select(*seen_key), seen_key, "left_anti")
    if not parsed:
        docs = parse(captured.limit(0).select("sitemap_url", "text"))
    if last_root_only:
        last = F.max(F.struct("root_ix", "ord")).alias("last")
        reached = reached.groupBy("sitemap_url").agg(last).select("sitemap_url", "last.*")
    return entries(reached.join(docs, "sitemap_url"))


def _first(rows: DataFrame) -> DataFrame:
    return rows.groupBy("root_ix", "sitemap_url").agg(F.min("ord").alias("ord"))


def last_per_url(rows: DataFrame, *order: str) -> DataFrame:
    """(loc, lastmod, changefreq, priority): the last entry wins."""
    value = F.struct("lastmod", "changefreq", "priority")
    return (
        rows.groupBy("loc")
        .agg(F.max_by(value, F.struct(*order)).alias("v"))
        .select("loc", "v.*")
    )


def merge_candidates(crawled: DataFrame, listed: DataFrame, only_sitemap: bool = False) -> DataFrame:
    """(url, in_crawl, in_sitemap): union of crawled and listed URLs, each once."""
    maps = listed.select(
        F.col("loc").alias("url"), F.lit(False).alias("c"), F.lit(True).alias("s")
    )
    if only_sitemap:
        both = maps
    else:
        both = maps.unionByName(crawled.select("url", F.lit(True).alias("c"), F.lit(False).alias("s")))
    return both.groupBy("url").agg(
        F.bool_or("c").alias("in_crawl"), F.bool_or("s").alias("in_sitemap")
    )


def in_scope(merged: DataFrame, scope: Scope) -> DataFrame:
    """Listed URLs outside the scope's domains, or outside a root domain's prefixes, go; crawled ones have passed it."""
    url = F.col("url")
    keyed = computed(merged, {"dst_domain": urls.normalize_domain(urls.netloc(url)), "dst_path": urls.path(url)})
    domains = scope.domains.withColumnRenamed("domain", "dst_domain")
    known = keyed.join(domains, "dst_domain", "left").filter(F.col("in_crawl") | F.col("kind").isNotNull())
    free = F.when(F.col("in_crawl"), F.lit("crawled")).otherwise(F.col("kind"))
    return in_path_scope(known.withColumn("kind", free), scope).select(*merged.columns)
