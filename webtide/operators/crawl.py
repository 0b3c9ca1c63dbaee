"""Breadth-first walk over the captured link graph, one level per round."""

from __future__ import annotations

from collections import defaultdict
from contextlib import contextmanager
from itertools import count

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webtide.operators import links as L
from webtide.operators import robots as R
from webtide.params import Params
from webtide.plans.lineage import Scratch
from webtide.plans.order import with_global_index
from webtide.sources.seeds import Scope

# Order in which one URL's roles rank when it is met more than once in a level.
_ORIGIN_RANK = {"seed": 0, "link": 1, "pdf": 2, "allowed": 3}
# Origins of pages that are taken as they are, and whose links nobody follows.
_TAKEN = ("pdf", "allowed")
#: So many pages of a level at most are looked up in the edges by name.
FEW = 1000
#: A walk is held by the driver while it has so many URLs, and the pages of a level so many links, at most.
HELD = 50_000
_WALKED = "url string, depth int, origin string, disposition string"


def page_states(captures: DataFrame) -> DataFrame:
    """(url, fetch): how a visit to each captured URL ends; bodies are not touched."""
    fetch = (
        F.when(F.col("error").isNotNull(), F.lit("failed"))
        .when(F.col("status") == 200, F.lit("scraped"))
        .otherwise(F.lit("http_error"))
    )
    return captures.select("url", fetch.alias("fetch"))


def visit_ends(
    targets: DataFrame, captures: DataFrame, rules: DataFrame, params: Params
) -> DataFrame:
    """(url, fin): blocked by robots, or how the captured visit ended; never captured means failed."""
    gated = R.gate(targets, rules, params.follow_robots_txt)
    met = gated.join(page_states(captures), "url", "left")
    fin = F.when(~F.col("allowed"), F.lit("blocked")).otherwise(F.coalesce("fetch", F.lit("failed")))
    return met.select("url", fin.alias("fin"))


def crawl(
    seeds: DataFrame, captures: DataFrame, scope: Scope, rules: DataFrame, params: Params
) -> DataFrame:
    """(url, depth, origin, disposition) of every URL the walk visits.

    disposition: scraped, blocked, http_error, failed. Links, and how a visit would end, do not depend on
    depth, so both are worked out once for the whole corpus. Edges are written in buckets by source, ends in as many
    buckets by URL. Small levels only look up names in these two tables (`held_levels`); from the first large one on,
    levels are written tables.
    """
    spark = seeds.sparkSession
    scratch, buckets = Scratch(spark), int(spark.conf.get("spark.sql.shuffle.partitions"))
    # written, so that their size is known and decides between broadcast and shuffle
    scope = scope.saved(scratch)
    rules, _ = scratch.save(rules, "rules")
    starts, _ = scratch.save(seeds.select("url").distinct(), "starts")
    graph, targets = None, starts
    if not params.only_sitemap:
        good = captures.filter((F.col("status") == 200) & F.col("error").isNull())
        links = L.valid_links(L.extract_hrefs(good), scope, params)
        # by source alone: what is left to do for single edges then moves nothing
        dealt = L.edges(links.repartition(buckets, "src_url"))
        graph, _ = scratch.add_bucketed(dealt, "edges", "src_url", buckets)
        linked = graph.filter(F.col("kind") == "root").select(F.col("dst_url").alias("url"))
        targets = starts.unionByName(linked).distinct()
    ends, _ = scratch.add_bucketed(visit_ends(targets, captures, rules, params), "ends", "url", buckets)

    with _buckets_kept(spark, buckets):
        rows, left = held_levels(starts, graph, ends, params)
        if left is None:
            walked, _ = scratch.save(_walked(spark, rows).coalesce(1), "walked")
        else:
            walked = _written_levels(scratch, buckets, starts, graph, ends, params, rows, left)
    scratch.forget("edges", "ends", "visited")
    return walked


def held_levels(
    starts: DataFrame, graph: DataFrame | None, ends: DataFrame, params: Params, most: int | None = None
) -> tuple[list[tuple], list[str] | None]:
    """(rows, left): what the walk visits, level by level, while the driver can hold it (`most`, or else HELD).

    A level is two look-ups by name, of links and of ends, and writes nothing. `left` is None if the walk is over, else
    those pages of the last level in `rows` whose links are still to be followed; without rows it has not begun.
    """
    most = HELD if most is None else most
    met = starts.limit(most + 1).collect()
    if len(met) > most:
        return [], []
    level, seen, rows = {r.url: "seed" for r in met}, set(), []
    for depth in count():
        if params.max_pages != -1:
            first = sorted(level, key=lambda u: (u is not None, (u or "").encode()))
            level = {u: level[u] for u in first[: params.max_pages - len(rows)]}
        fins = defaultdict(list)
        asked = [u for u, origin in level.items() if origin not in _TAKEN]
        for r in _named(ends, "url", asked).collect() if asked else ():
            fins[r.url].append(r.fin)
        new = [
            (u, depth, origin, fin)
            for u, origin in level.items()
            for fin in (["scraped"] if origin in _TAKEN else fins.get(u, ["failed"]))
        ]
        rows += new
        seen.update(level)
        left = sorted({u for u, _, origin, fin in new if fin == "scraped" and origin not in _TAKEN})
        full = params.max_pages != -1 and len(rows) >= params.max_pages
        if graph is None or not left or full:
            return rows, None
        links = _named(graph, "src_url", left).select("dst_url", "kind").limit(most + 1).collect()
        if len(links) > most or len(rows) + len({r.dst_url for r in links} - seen) > most:
            return rows, left
        # only root children are bound by depth
        deep = params.max_depth != -1 and depth + 1 > params.max_depth
        level = {}
        for r in links:
            origin = "link" if r.kind == "root" else r.kind
            if r.dst_url in seen or (deep and origin == "link"):
                continue
            level[r.dst_url] = min(origin, level.get(r.dst_url, origin), key=_ORIGIN_RANK.get)


def _named(table: DataFrame, key: str, names: list[str]) -> DataFrame:
    """Rows of a bucketed table whose key is one of `names`; NULL is no name."""
    if len(names) > FEW:
        wanted = table.sparkSession.createDataFrame([(n,) for n in names], f"{key} string")
        return table.join(wanted, key, "left_semi")
    return table.filter(F.col(key).isin([n for n in names if n is not None]))


def _walked(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, _WALKED)


def _written_levels(
    scratch: Scratch,
    buckets: int,
    starts: DataFrame,
    graph: DataFrame | None,
    ends: DataFrame,
    params: Params,
    rows: list[tuple],
    left: list[str],
) -> DataFrame:
    """The walk from where `held_levels` left it, of any size.

    Visited URLs are written in buckets as the ends are: a level shuffles the links that leave its pages, once, and
    nothing else. The plan of a level never contains the levels before it.
    """
    spark, total, start = scratch.spark, len(rows), 0
    level = starts.select("url", F.lit(0).alias("depth"), F.lit("seed").alias("origin"))
    if rows:
        start = rows[-1][1] + 1
        visited, _ = scratch.add_bucketed(_walked(spark, rows).repartition(buckets, "url"), "visited", "url", buckets)
        frontier = spark.createDataFrame([(u,) for u in left], "src_url string")
        level = _next_level(leaving(frontier, graph, len(left)), visited, start, params)
    for depth in count(start):
        if params.max_pages != -1:
            level = _first_pages(level, params.max_pages - total)
        visited, stats = scratch.add_bucketed(
            _visit(level, ends),
            "visited",
            "url",
            buckets,
            F.count(F.lit(1)).alias("rows"),
            F.count_if(_expanded()).alias("open"),
        )
        total += stats["rows"]
        full = params.max_pages != -1 and total >= params.max_pages
        if graph is None or not stats["open"] or full:
            break
        frontier = visited.filter((F.col("depth") == depth) & _expanded()).select(F.col("url").alias("src_url"))
        level = _next_level(leaving(frontier, graph, stats["open"]), visited, depth + 1, params)
    return scratch.read(visited, "visited")


@contextmanager
def _buckets_kept(spark: SparkSession, buckets: int):
    """What is shuffled for a bucketed table stays in as many partitions, so that each task writes one bucket.

    A bounded look-up asks all buckets at once.
    """
    wanted = {
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.limit.initialNumPartitions": str(buckets),
    }
    before = {name: spark.conf.get(name) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def _expanded():
    """Pages whose links are followed."""
    return (F.col("disposition") == "scraped") & F.col("origin").isin("seed", "link")


def _visit(level: DataFrame, ends: DataFrame) -> DataFrame:
    """PDF and single pages are taken as they are, others end as robots and the capture say."""
    taken = F.col("origin").isin(*_TAKEN)
    disposition = F.when(taken, F.lit("scraped")).otherwise(F.coalesce("fin", F.lit("failed")))
    # bucket by bucket at every size
    return level.join(ends.hint("merge"), "url", "left").select(
        "url", "depth", "origin", disposition.alias("disposition")
    )


def leaving(frontier: DataFrame, graph: DataFrame, rows: int, few: int = FEW) -> DataFrame:
    """Edges that leave the frontier's pages (src_url), of which there are `rows`.

    Up to `few` of them become part of the scan's filter: it reads only their buckets, and there only the ranges where
    they can be. More meet the edges bucket by bucket.
    """
    if rows > few:
        return graph.join(frontier, "src_url", "left_semi")
    return graph.filter(F.col("src_url").isin([r.src_url for r in frontier.collect()]))


def _next_level(met: DataFrame, visited: DataFrame, depth: int, params: Params) -> DataFrame:
    origin = F.when(F.col("kind") == "root", F.lit("link")).otherwise(F.col("kind"))
    met = met.select(F.col("dst_url").alias("url"), origin.alias("origin"))
    if params.max_depth != -1 and depth > params.max_depth:
        # only root children are bound by depth
        met = met.filter(F.col("origin") != "link")
    # a page that a third of all links point to is one row per task before the shuffle
    fresh = met.groupBy("url").agg(F.min_by("origin", _rank()).alias("origin"))
    return fresh.join(visited.select("url").hint("merge"), "url", "left_anti").select(
        "url", F.lit(depth).alias("depth"), "origin"
    )


def _rank():
    order = F.create_map(*[F.lit(x) for kv in _ORIGIN_RANK.items() for x in kv])
    return F.element_at(order, F.col("origin"))


def _first_pages(level: DataFrame, room: int) -> DataFrame:
    """The first `room` URLs of a level; numbering is spread over range partitions."""
    return with_global_index(level, ["url"]).filter(F.col("ix") <= room).drop("ix")
