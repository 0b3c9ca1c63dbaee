"""Links: from page bodies to scoped, filtered edges. No step depends on crawl depth."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webtide.functions import urls
from webtide.functions.text import drop_opaque, unescape
from webtide.params import Params
from webtide.plans.once import computed
from webtide.sources.seeds import Scope

# An <a ...> tag up to its href; attribute values are skipped as wholes, so a '>' in quotes does no harm.
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+)"""
_HREF = (
    r"(?is)<a(?=[\s/])(?:[\s/]++(?!href[\s=])[^\s=>/\"']++(?:\s*+=\s*+" + _VALUE + r")?+)*+"
    r"[\s/]++href\s*+=\s*+(" + _VALUE + r")"
)


def extract_hrefs(pages: DataFrame, body: str = "body") -> DataFrame:
    """(src_url, href_ix, href): href of every anchor element, in document order, repeats kept."""
    quoted = F.regexp_extract_all(drop_opaque(F.col(body)), F.lit(_HREF), F.lit(1))
    rows = pages.select(F.col("url").alias("src_url"), F.posexplode(quoted).alias("href_ix", "q"))
    first = F.substring("q", 1, 1)
    bare = F.when(first.isin('"', "'"), F.substr("q", F.lit(2), F.length("q") - 2)).otherwise(F.col("q"))
    return computed(rows, {"href": unescape(bare)}).drop("q")


def cut_fragments(links: DataFrame) -> DataFrame:
    """Cut at the first '#'; what is empty then is no link. Blanks stay."""
    return links.withColumn("href", F.split_part("href", F.lit("#"), F.lit(1))).filter(
        F.col("href") != ""
    )


def resolve(links: DataFrame) -> DataFrame:
    """Adds dst_url, dst_domain, dst_path and dst_query, each worked out once."""
    page, href = F.col("src_url"), F.col("href")
    # an address is cut up once: what refers to a column of a step below does not repeat it
    cut = computed(links, {"_page": urls.pieces(page), "_link": urls.pieces(href)})
    dst_url = urls.resolve_parts(page, urls.named(F.col("_page")), href, urls.named(F.col("_link")))
    full = computed(cut, {"dst_url": dst_url}).drop("_page", "_link")
    dst = urls.named(F.col("_dst"))
    return computed(
        computed(full, {"_dst": urls.pieces(F.col("dst_url"))}),
        {
            "dst_domain": urls.normalize_domain(dst["host"]),
            "dst_path": F.regexp_replace(dst["path"], r";[^/]*\z", ""),
            "dst_query": dst["query"],
        },
    ).drop("_dst")


def classify(links: DataFrame, scope: Scope) -> DataFrame:
    """Adds kind (root or allowed) and the lengths of the domain's prefixes; other domains drop out."""
    return links.join(scope.domains.withColumnRenamed("domain", "dst_domain"), "dst_domain")


def in_path_scope(links: DataFrame, scope: Scope) -> DataFrame:
    """Root links must begin with one of their domain's prefixes, letter by letter; a domain without any is free.

    A path's beginnings, of the lengths that the domain's prefixes have, meet the cover by equality. At most one of them
    is in it, so no link comes out twice. Free links look up their whole path, which spreads them over all tasks.
    """
    free = (F.col("kind") != "root") | (F.size("lengths") == 0)
    cut = F.filter("lengths", lambda n: n <= F.length("dst_path"))
    begins = F.transform(cut, lambda n: F.left("dst_path", n))
    probed = links.withColumn("_begin", F.explode(F.when(free, F.array("dst_path")).otherwise(begins)))
    cover = scope.prefixes.select(
        F.col("domain").alias("dst_domain"), F.col("prefix").alias("_begin"), F.lit(True).alias("_fits")
    )
    met = probed.join(cover, ["dst_domain", "_begin"], "left")
    return met.filter(free | F.col("_fits")).drop("_begin", "_fits", "lengths")


def without_query(links: DataFrame, skip: bool) -> DataFrame:
    return links.filter(F.col("dst_query") == "") if skip else links


def _ends_with_any(low: Column, endings: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.endswith(low, F.lit(e)) for e in endings], F.lit(False))


def extension_items(skip_extensions: str) -> list[str]:
    items = [e.strip() for e in skip_extensions.split(",") if e.strip()]
    return [e if e.startswith(".") else f".{e}" for e in items]


def without_extensions(links: DataFrame, skip_extensions: str) -> DataFrame:
    """Drop addresses that end, query included, with one of the endings."""
    return links.filter(~_ends_with_any(F.lower("dst_url"), extension_items(skip_extensions)))


def route_pdfs(links: DataFrame, ingest_pdf: bool) -> DataFrame:
    """PDF links are never followed: they become kind 'pdf', or drop out."""
    is_pdf = F.endswith(F.lower("dst_url"), F.lit(".pdf"))
    if not ingest_pdf:
        return links.filter(~is_pdf)
    return links.withColumn("kind", F.when(is_pdf, F.lit("pdf")).otherwise(F.col("kind")))


def valid_links(hrefs: DataFrame, scope: Scope, params: Params) -> DataFrame:
    """(src_url, href_ix, dst_url, kind): the whole filter chain."""
    return (
        hrefs.transform(cut_fragments)
        .transform(resolve)
        .transform(classify, scope)
        .transform(in_path_scope, scope)
        .transform(without_query, params.skip_get_params)
        .transform(without_extensions, params.skip_extensions)
        .transform(route_pdfs, params.ingest_pdf)
        .select("src_url", "href_ix", "dst_url", "kind")
    )


def edges(links: DataFrame) -> DataFrame:
    """(src_url, dst_url, kind), each once."""
    return links.select("src_url", "dst_url", "kind").distinct()


def unvisited(candidates: DataFrame, visited: DataFrame) -> DataFrame:
    """Each URL once, and only those not visited; exact text decides."""
    return candidates.select("url").distinct().join(visited.select("url"), "url", "left_anti")
