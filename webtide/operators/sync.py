"""Keeping page state and chunks in step with what was found."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webtide.functions import urls
from webtide.plans.once import computed

RETRIED = "retried"  # stands for the hash of a page that a retry brought in

STATE_SCHEMA = (
    "url string, content_hash string, chunk_count int, last_seen timestamp, "
    "session_id string, miss_count int"
)


def lookup(keys: DataFrame, state: DataFrame) -> DataFrame:
    """State row of each URL, or NULLs."""
    return keys.select("url").join(state, "url", "left")


def decide(pages: DataFrame, state: DataFrame) -> DataFrame:
    """Adds decision: full (unknown URL), skip (same hash and chunk count) or partial."""
    known = state.select("url", F.col("content_hash").alias("known_hash"), F.col("chunk_count").alias("known_count"))
    met = pages.join(known, "url", "left")
    return met.withColumn("decision", decision()).drop("known_hash", "known_count")


def decision() -> Column:
    """The rule of `decide` where a page carries what the state knows of it: known_hash and known_count."""
    same = (F.col("known_hash") == F.col("content_hash")) & (F.col("known_count") == F.col("chunk_count"))
    return (
        F.when(F.col("known_hash").isNull(), F.lit("full"))
        .when(same, F.lit("skip"))
        .otherwise(F.lit("partial"))
    )


_CHUNK_KEY = ["source", "chunk_sha"]


def chunks_to_delete(old: DataFrame, new: DataFrame) -> DataFrame:
    """Stored chunks whose text is not in the new version of their source; every copy goes.

    The key holds the text's hash, so one big source spreads over all tasks, and a text stored very often is
    split by the adaptive skew join, which can split the left side of an anti join.
    """
    return old.join(new.select(*_CHUNK_KEY), _CHUNK_KEY, "left_anti")


def chunks_to_add(old: DataFrame, new: DataFrame) -> DataFrame:
    """New chunks whose text is not stored for their source; repeats are kept."""
    return new.join(old.select(*_CHUNK_KEY), _CHUNK_KEY, "left_anti")


def chunk_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """(source, chunk_sha, n_old, n_new): texts that one version of a source has and the other has not, with their copies.

    One aggregation over the keys of both sides answers what goes and what comes. Tasks count before the shuffle, so
    a text stored very often is a few rows by then, and no text moves.
    """
    side = lambda df, is_new: df.select(*_CHUNK_KEY, F.lit(is_new).alias("_new"))
    both = side(old, False).unionByName(side(new, True)).groupBy(*_CHUNK_KEY)
    counted = both.agg(F.count_if(~F.col("_new")).alias("n_old"), F.count_if("_new").alias("n_new"))
    return counted.filter((F.col("n_old") == 0) | (F.col("n_new") == 0))


def coming(new: DataFrame, changes: DataFrame) -> DataFrame:
    """Rows of `new` that `chunk_changes` calls new, every copy; with few changes no row of `new` is shuffled."""
    wanted = changes.filter("n_old = 0").select(F.col("source").alias("_source"), F.col("chunk_sha").alias("_sha"))
    same = F.col("source").eqNullSafe(F.col("_source")) & F.col("chunk_sha").eqNullSafe(F.col("_sha"))
    return new.join(wanted, same, "left_semi")


def going(changes: DataFrame) -> DataFrame:
    """Keys of stored chunks that `chunk_changes` found in no new version, each once."""
    return changes.filter("n_new = 0").select(*_CHUNK_KEY)


def apply_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Stored chunks after the difference: old ones still wanted plus genuinely new ones."""
    kept = old.join(new.select(*_CHUNK_KEY), _CHUNK_KEY, "left_semi")
    return kept.unionByName(chunks_to_add(old, new))


def upsert(state: DataFrame, pages: DataFrame, session_id: str, now: Column) -> DataFrame:
    """Hash, count, time and session of ingested pages; miss_count restarts."""
    return transition(state, pages.withColumn("action", F.lit("store")), session_id, now)


def touch(state: DataFrame, keys: DataFrame, session_id: str, now: Column) -> DataFrame:
    """Time and session only; unknown URLs stay unknown."""
    return transition(state, no_content(keys, "touch"), session_id, now)


def delete(state: DataFrame, keys: DataFrame) -> DataFrame:
    return state.join(keys.select("url"), "url", "left_anti")


def count_miss(state: DataFrame, keys: DataFrame, session_id: str, now: Column) -> DataFrame:
    """One more miss for the given URLs; nothing else changes."""
    return transition(state, no_content(keys, "miss"), session_id, now)


def no_content(keys: DataFrame, action: str) -> DataFrame:
    return keys.select(
        "url",
        F.lit(None).cast("string").alias("content_hash"),
        F.lit(None).cast("int").alias("chunk_count"),
        F.lit(action).alias("action"),
    )


def transition(state: DataFrame, actions: DataFrame, session_id: str, now: Column) -> DataFrame:
    """New state from one action per URL: store, touch, miss or remove. One full join on url."""
    a = actions.select(
        "url",
        F.col("action"),
        F.col("content_hash").alias("_hash"),
        F.col("chunk_count").alias("_count"),
        F.lit(True).alias("_acted"),
    )
    joined = state.withColumn("_known", F.lit(True)).join(a, "url", "full")
    action = F.coalesce("action", F.lit("keep"))
    stores, seen = action == "store", action.isin("store", "touch")
    gone = (action == "remove") | (F.col("_known").isNull() & ~stores)
    return joined.filter(~gone).select(
        "url",
        F.when(stores, F.col("_hash")).otherwise(F.col("content_hash")).alias("content_hash"),
        F.when(stores, F.col("_count")).otherwise(F.col("chunk_count")).cast("int").alias("chunk_count"),
        F.when(seen, now).otherwise(F.col("last_seen")).alias("last_seen"),
        F.when(seen, F.lit(session_id)).otherwise(F.col("session_id")).alias("session_id"),
        F.when(seen, F.lit(0))
        .when(action == "miss", F.col("miss_count") + 1)
        .otherwise(F.col("miss_count"))
        .cast("int")
        .alias("miss_count"),
    )


def keep_set(*url_tables: DataFrame) -> DataFrame:
    """Every URL this session met in any role, once."""
    out = url_tables[0].select("url")
    for t in url_tables[1:]:
        out = out.unionByName(t.select("url"))
    return out.distinct()


def site(url: Column) -> Column:
    """The domain that a URL belongs to, as scopes name it."""
    return urls.normalize_domain(urls.netloc(url))


def stale_urls(state: DataFrame, session_id: str, keep: DataFrame, sites: DataFrame | None = None) -> DataFrame:
    """State rows of other sessions that are not in the keep set: of all sites, or of those in `sites` (domain) only.

    Without the sites, a session over some of them counts a miss for every page of the others. A URL without a
    domain belongs to none.
    """
    others = state.filter(F.col("session_id") != session_id)
    if sites is not None:
        named = sites.select(F.col("domain").alias("_site")).filter(F.col("_site") != "").distinct()
        others = computed(others, {"_site": site(F.col("url"))}).join(named, "_site", "left_semi").select(*state.columns)
    return others.join(keep.select("url"), "url", "left_anti")


def stale_actions(stale: DataFrame, remove_delay: int) -> DataFrame:
    """(url, action): remove at once without a delay, else when the next miss reaches it."""
    due = F.lit(remove_delay == 0) | (F.col("miss_count") + 1 >= remove_delay)
    return stale.select("url", F.when(due, F.lit("remove")).otherwise(F.lit("miss")).alias("action"))


def without_sources(chunks: DataFrame, sources: DataFrame) -> DataFrame:
    """Chunks left after the given sources were deleted."""
    return chunks.join(named_sources(sources), "source", "left_anti")


def deleted_counts(chunks: DataFrame, sources: DataFrame) -> DataFrame:
    """(source, deleted): number of chunks a deletion takes away; blank names delete nothing.

    Chunks are counted before the join, so a source with very many of them is a few rows when it is shuffled.
    """
    per_source = chunks.groupBy("source").agg(F.count(F.lit(1)).alias("deleted"))
    return (
        named_sources(sources)
        .join(per_source, "source", "left")
        .select("source", F.coalesce("deleted", F.lit(0)).cast("bigint").alias("deleted"))
    )


def named_sources(sources: DataFrame) -> DataFrame:
    return sources.select("source").filter(F.col("source") != "").distinct()


def duplicate_report(pages: DataFrame) -> DataFrame:
    """(content_hash, copies, first_url) of every text held by more than one URL."""
    return (
        pages.groupBy("content_hash")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("url").alias("first_url"))
        .filter(F.col("copies") > 1)
    )
