"""One whole session as a table job: discover, prune, ingest, retry, clean up, report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webtide.operators import content, crawl, fetchlog, freshness, report, robots, sitemap, sync
from webtide.params import Params
from webtide.plans.lineage import Scratch
from webtide.sources.captures import typed
from webtide.sources.robots_files import pick_robots
from webtide.sources.seeds import pack_scope


# Texts of sessions that stop early; the others are in `_nothing_found` and `run_session`.
NO_SEEDS = "Error: no valid starting URLs in plugin settings."


@dataclass
class Web:
    """The captured web and what is known from before.

    seeds(url), scope(domain, kind, prefix), robots(domain, proto, status, text), sitemaps(sitemap_url,
    status, text), captures(url, status, error, body and, if known, content_type; one row per URL, see `captures.latest`), heads(url, status, last_modified, error),
    attempts(url, attempt, error, body and, if known, content_type), state and chunks as `CorpusStore` keeps them.
    """

    seeds: DataFrame
    scope: DataFrame
    robots: DataFrame
    sitemaps: DataFrame
    captures: DataFrame
    heads: DataFrame
    attempts: DataFrame
    state: DataFrame
    chunks: DataFrame


@dataclass
class Session:
    """What a session leaves behind: new state, chunks added, keys of chunks removed, one summary row."""

    state: DataFrame
    added: DataFrame
    removed: DataFrame
    summary: DataFrame


def discover(web: Web, params: Params, rules: DataFrame, lines: DataFrame, scratch: Scratch):
    """(candidates, walked, listed): crawled and listed URLs, merged; `cached` marks pages the walk has read."""
    scope = pack_scope(web.scope)
    if params.only_sitemap:
        walked = web.seeds.limit(0).selectExpr("url", "0 AS depth", "'' AS origin", "'' AS disposition")
    else:
        walked = crawl.crawl(web.seeds, web.captures, scope, rules, params)
    if params.use_sitemap:
        # where two roots list one page, the later root wins: in seed order if known, else by URL
        rank = F.max("seed_ix" if "seed_ix" in web.seeds.columns else "url")
        roots = web.seeds.groupBy(F.col("url").alias("root_url")).agg(rank.alias("root_ix"))
        places = sitemap.locations(roots, robots.sitemap_lines(lines))
        rows = sitemap.expand(places, web.sitemaps, last_root_only=True)
        listed, _ = scratch.save(sitemap.last_per_url(rows, "root_ix", "ord", "entry_ix"), "listed")
    else:
        listed = web.seeds.limit(0).selectExpr("url AS loc", "CAST(NULL AS TIMESTAMP) AS lastmod")
    scraped = walked.filter(F.col("disposition") == "scraped")
    merged = sitemap.merge_candidates(scraped, listed, params.only_sitemap)
    if params.scope_sitemap:
        merged = sitemap.in_scope(merged, scope)
    read = scraped.filter(F.col("origin").isin("seed", "link") & F.lit(params.cache_content))
    cached = read.select("url", F.lit(True).alias("cached"))
    candidates = merged.join(cached, "url", "left").withColumn("cached", F.coalesce("cached", F.lit(False)))
    return candidates, walked, listed


def mark(candidates: DataFrame, listed: DataFrame, web: Web, rules: DataFrame, params: Params) -> DataFrame:
    """Adds disposition (lastmod_skip, unchanged or update), what is known of a page, and allowed. Bodies are not touched."""
    marked = freshness.meet(candidates, listed, web.heads, web.state)
    return robots.gate(marked, rules, params.follow_robots_txt)


def fetch(wanted: DataFrame, captures: DataFrame) -> DataFrame:
    """Outcome and body for every captured page to update. Pages the walk has read are taken as they are.

    An inner join, so that few wanted pages can be broadcast or filter the captures before bodies move.
    """
    got = typed(captures).select("url", "status", "error", "content_type", "body")
    judged = fetchlog.classify(wanted.join(got, "url"))
    return judged.select(
        "url",
        F.when(F.col("cached"), F.lit("ok")).otherwise(F.col("outcome")).alias("outcome"),
        F.when(~F.col("cached"), F.col("reason")).alias("reason"),
        "known_hash",
        "known_count",
        "content_type",
        "body",
    )


def not_captured(wanted: DataFrame, captures: DataFrame) -> DataFrame:
    """Outcome of pages to update that have no capture."""
    lost = wanted.join(captures.select("url"), "url", "left_anti")
    return lost.select(
        "url",
        F.when(F.col("allowed"), F.lit("failed")).otherwise(F.lit("ignored")).alias("outcome"),
        F.when(F.col("allowed"), F.lit("not captured")).alias("reason"),
    )


def ingest(fetched: DataFrame, params: Params) -> DataFrame:
    """Every fetched page with outcome and, where it is ok, hash, count and decision; chunks only if needed.

    One pass: bodies are shuffled by `url` once, when they meet the candidates; cutting text moves nothing, and
    pages carry what the state knows of them. Bodies and unchanged chunks are never written.
    """
    good = F.col("outcome") == "ok"
    texts = content.page_texts(fetched.withColumn("body", F.when(good, F.col("body"))), params)
    chunked = content.page_chunks(texts, params).withColumn("decision", F.when(good, sync.decision()))
    wanted = F.col("decision").isin("full", "partial")
    return chunked.withColumn("chunks", F.when(wanted, F.col("chunks"))).drop("known_hash", "known_count")


def retry(failed: DataFrame, web: Web, params: Params) -> DataFrame:
    """(url, result, attempts) of every failed URL; one without attempts has still failed."""
    if not params.retry_failed_urls:
        return failed.select("url", F.lit("still_failed").alias("result"), F.lit(0).alias("attempts"))
    rounds = fetchlog.retry_rounds(web.attempts, params.max_retry_attempts)
    return failed.join(rounds, "url", "left").select(
        "url", F.coalesce("result", F.lit("still_failed")).alias("result"), "attempts"
    )


def run_session(
    web: Web, params: Params, session_id: str, now: Column, minutes: str = "0.0"
) -> Session:
    """All stages in order. The tables other stages read again are written once in the shared folder."""
    if web.seeds.isEmpty():
        message = web.seeds.sparkSession.range(1).select(F.lit(NO_SEEDS).alias("message"))
        return _stop_early(web, message, web.state)
    scratch = Scratch(web.seeds.sparkSession)
    lines = robots.directive_lines(pick_robots(web.robots))
    rules, _ = scratch.save(robots.rule_tables(lines, params.user_agent), "rules")
    candidates, walked, listed = discover(web, params, rules, lines, scratch)

    is_ = lambda d: F.count_if(F.col("disposition") == d)
    marked, found = scratch.save(
        mark(candidates, listed, web, rules, params),
        "marked",
        F.count(F.lit(1)).alias("all"),
        is_("update").alias("update"),
        is_("unchanged").alias("unchanged"),
    )
    walk_failed = walked.filter(F.col("disposition") == "failed").select("url").distinct()
    touched = marked.filter(F.col("disposition") == "lastmod_skip").select("url")

    if not found["all"]:
        return _stop_early(web, _nothing_found(walk_failed, minutes), web.state)
    if not found["update"]:
        text = F.lit(f"All {found['unchanged']} pages unchanged ({minutes} min).")
        one = marked.agg(F.count(F.lit(1)).alias("n")).select(text.alias("message"))
        return _stop_early(web, one, sync.touch(web.state, touched, session_id, now))

    wanted = marked.filter(F.col("disposition") == "update").select(
        "url", "cached", "allowed", "known_hash", "known_count"
    )
    tested, _ = scratch.save(ingest(fetch(wanted, web.captures), params), "pages")
    pages = tested.filter(F.col("outcome") == "ok")
    lost = not_captured(wanted, web.captures)
    failed = (
        tested.select("url", "outcome")
        .unionByName(lost.select("url", "outcome"))
        .filter(F.col("outcome") == "failed")
        .select("url")
        .unionByName(walk_failed)
        .distinct()
    )
    tried, _ = scratch.save(retry(failed, web, params), "tried")
    recovered = tried.filter(F.col("result") == "recovered")
    still = tried.filter(F.col("result") == "still_failed").select("url")

    # chunks
    with_decision = lambda *d: pages.filter(F.col("decision").isin(*d))
    partial = with_decision("partial")
    old = web.chunks.join(partial.select(F.col("url").alias("source")), "source", "left_semi")
    new = content.chunk_rows(partial, session_id)
    changes, _ = scratch.save(sync.chunk_changes(old, new), "changes")
    back = _recovered_pages(recovered, web, params)
    added = (
        content.chunk_rows(with_decision("full"), session_id)
        .unionByName(sync.coming(new, changes))
        .unionByName(content.chunk_rows(back, session_id))
    )

    keep = sync.keep_set(marked, recovered, still)
    sites = web.seeds.select(sync.site(F.col("url")).alias("domain")) if params.stale_in_sites else None
    missing = sync.stale_urls(web.state, session_id, keep, sites)
    stale, _ = scratch.save(sync.stale_actions(missing, params.remove_delay), "stale")
    gone = stale.filter(F.col("action") == "remove").select(F.col("url").alias("source"))
    dropped_sources = gone.unionByName(recovered.select(F.col("url").alias("source"))).distinct()
    key = ["source", "chunk_sha"]
    removed = (
        sync.going(changes)
        .unionByName(web.chunks.join(dropped_sources, "source", "left_semi").select(*key))
        .distinct()
    )

    # state
    actions = _one_per_url(
        (4, recovered.withColumns(
            {"action": F.lit("store"), "content_hash": F.lit(sync.RETRIED), "chunk_count": F.lit(0)}
        )),
        (3, with_decision("full", "partial").withColumn("action", F.lit("store"))),
        (2, sync.no_content(with_decision("skip"), "touch")),
        (1, sync.no_content(touched, "touch")),
        (0, stale.withColumns(
            {"content_hash": F.lit(None).cast("string"), "chunk_count": F.lit(None).cast("int")}
        )),
    )
    state = sync.transition(web.state, actions, session_id, now)
    summary = _summary(pages, changes, tried, stale, minutes)
    return Session(state, added, removed, summary)


def _one_per_url(*ranked: tuple[int, DataFrame]) -> DataFrame:
    """Where a URL has two roles, the higher rank acts."""
    out = None
    for rank, rows in ranked:
        part = rows.select(
            "url", "action", "content_hash", F.col("chunk_count").cast("int").alias("chunk_count"),
            F.lit(rank).alias("rank"),
        )
        out = part if out is None else out.unionByName(part)
    value = F.struct("action", "content_hash", "chunk_count")
    return out.groupBy("url").agg(F.max_by(value, "rank").alias("v")).select("url", "v.*")


def _recovered_pages(recovered: DataFrame, web: Web, params: Params) -> DataFrame:
    """Content of the attempt that brought each page in."""
    success = typed(web.attempts).select("url", F.col("attempt").alias("attempts"), "content_type", "body")
    got = recovered.join(success, ["url", "attempts"]).select("url", "content_type", "body")
    return content.page_chunks(content.page_texts(got, params), params)


def _summary(
    pages: DataFrame, changes: DataFrame, tried: DataFrame, stale: DataFrame, minutes: str
) -> DataFrame:
    """One row of counts and text. A partial update that adds no chunk counts as skipped."""
    changed = changes.filter("n_old = 0").select(F.col("source").alias("url")).distinct().withColumn("_new", F.lit(True))
    done = pages.select("url", "decision").join(changed, "url", "left")
    kind = F.when(
        (F.col("decision") == "full") | F.col("_new").isNotNull(), F.lit("ingested")
    ).otherwise(F.lit("skipped"))
    events = (
        done.select(kind.alias("kind"))
        .unionByName(tried.select(F.col("result").alias("kind")))
        .unionByName(stale.select(F.col("action").alias("kind")))
    )
    n = lambda name: F.count_if(F.col("kind") == name)
    counts = events.agg(
        n("ingested").alias("ingested"),
        n("skipped").alias("skipped"),
        n("still_failed").alias("failed"),
        n("remove").alias("removed"),
        n("recovered").alias("recovered"),
    )
    text = report.summary_text(
        F.col("ingested"), F.col("skipped"), F.col("failed"), F.col("removed"), F.lit(minutes)
    )
    return counts.withColumn("message", text)


def _nothing_found(failed: DataFrame, minutes: str) -> DataFrame:
    n = failed.agg(F.count(F.lit(1)).alias("n"))
    some = F.concat(
        F.lit("No pages scraped. "), F.col("n").cast("string"), F.lit(f" failed ({minutes} min).")
    )
    return n.select(
        F.when(F.col("n") > 0, some).otherwise(F.lit(f"No pages scraped ({minutes} min).")).alias("message")
    )


def _stop_early(web: Web, message: DataFrame, state: DataFrame) -> Session:
    """Neither retries nor cleanup: chunks stay, only what the tests touched is new."""
    nothing = web.chunks.limit(0)
    zero = {c: F.lit(0).cast("bigint") for c in ("ingested", "skipped", "failed", "removed", "recovered")}
    summary = message.select(*[v.alias(k) for k, v in zero.items()], "message")
    return Session(state, nothing, nothing.select("source", "chunk_sha"), summary)
