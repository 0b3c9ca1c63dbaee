"""Ingest of captures as they arrive: each micro-batch is one partial session."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from webtide.operators import content, fetchlog, sync
from webtide.params import Params
from webtide.plans.lineage import Scratch
from webtide.sources.captures import latest, typed
from webtide.sources.store import CorpusStore
from webtide.streaming.batches import start_batches


def ingest_batch(
    captures: DataFrame, store: CorpusStore, params: Params, session_id: str, now: Column, batch_key: str
) -> None:
    """Decide, store and publish one batch; a batch that is already published does nothing.

    Only pages of the batch are compared with what is known. Nothing is ever retired here: a partial session
    cannot tell what has vanished.
    """
    if store.has_session(batch_key):
        return
    last = latest(typed(captures), "seq").withColumn("allowed", F.lit(True))
    good = fetchlog.classify(last).filter(F.col("outcome") == "ok").select("url", "content_type", "body")
    chunked = content.page_chunks(content.page_texts(good, params), params)
    # the text work is done once; everything below reads its result
    scratch = Scratch(captures.sparkSession)
    made, _ = scratch.save(chunked, "made")
    # only the buckets of the batch's pages are read
    known, _ = scratch.save(store.read_state(made.select("url")), "known")
    pages = sync.decide(made, known)

    partial = pages.filter(F.col("decision") == "partial")
    new = content.chunk_rows(partial, session_id)
    old = store.read_chunks(partial.select(F.col("url").alias("source")))
    changes, _ = scratch.save(sync.chunk_changes(old, new), "changes")
    whole = content.chunk_rows(pages.filter(F.col("decision") == "full"), session_id)
    stored = pages.filter(F.col("decision") != "skip").withColumn("action", F.lit("store"))
    touched = sync.no_content(pages.filter(F.col("decision") == "skip"), "touch")
    actions = stored.select("url", "content_hash", "chunk_count", "action").unionByName(touched)
    store.publish(
        sync.transition(known, actions, session_id, now),
        whole.unionByName(sync.coming(new, changes)),
        sync.going(changes),
        session_id=batch_key,
        whole_state=False,
    )


def start_ingest(
    stream: DataFrame, store: CorpusStore, params: Params, session_id: str, now: Column, checkpoint: str
) -> StreamingQuery:
    """Run over all captures that are there, then stop; call again for what arrives later.

    Several sources may feed one session, each with its own checkpoint: a batch is known by its query's id too.
    """

    def each(batch: DataFrame, query_id: str, batch_id: int) -> None:
        ingest_batch(batch, store, params, session_id, now, f"{session_id}/{query_id}/{batch_id}")

    return start_batches(stream, each, checkpoint)
