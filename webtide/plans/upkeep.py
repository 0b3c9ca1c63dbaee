"""Jobs on a published corpus: delete whole sources, and close a session that arrived as a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webtide.operators import sync
from webtide.params import Params
from webtide.plans.lineage import Scratch
from webtide.sources.store import CorpusStore


def delete_sources(store: CorpusStore, sources: DataFrame, session_id: str = "") -> DataFrame:
    """(source, deleted) for the named sources; their chunks and state rows go in one published version.

    Only the buckets of these sources are read, and only what changes is written. Blank names delete nothing; unknown ones count 0.
    """
    scratch = Scratch(store.spark)
    named, _ = scratch.save(sync.named_sources(sources), "named")
    chunks = store.read_chunks(named)
    counts, _ = scratch.save(sync.deleted_counts(chunks, named), "deleted")
    store.publish(
        store.spark.createDataFrame([], sync.STATE_SCHEMA),
        chunks.limit(0),
        chunks.select("source", "chunk_sha").distinct(),
        session_id=session_id,
        whole_state=False,
        forgotten=named.select(F.col("source").alias("url")),
    )
    return counts


def complete_session(
    store: CorpusStore, session_id: str, params: Params, now: Column, sites: DataFrame | None = None
) -> DataFrame:
    """(url, action) of pages that no micro-batch of the session has met: a miss, or removal when it is due.

    With `sites` (domain) only pages of these are looked at.

    To be called once all sources of a streamed session have been read; a second call changes nothing. State and
    chunks of removed pages go in one published version.
    """
    scratch = Scratch(store.spark)
    state = store.read_state()
    key = f"{session_id}/complete"
    if store.has_session(key):
        return state.select("url", F.lit("miss").alias("action")).limit(0)
    # what the batches met carries the session's id already
    missing = sync.stale_urls(state, session_id, state.limit(0), sites)
    actions, _ = scratch.save(sync.stale_actions(missing, params.remove_delay), "actions")
    gone = actions.filter(F.col("action") == "remove").select(F.col("url").alias("source"))
    missed = sync.no_content(actions.filter(F.col("action") == "miss"), "miss")
    chunks = store.read_chunks(gone)
    store.publish(
        sync.transition(state.join(missed.select("url"), "url", "left_semi"), missed, session_id, now),
        chunks.limit(0),
        chunks.select("source", "chunk_sha").distinct(),
        session_id=key,
        whole_state=False,
        forgotten=gone.select(F.col("source").alias("url")),
    )
    return actions
