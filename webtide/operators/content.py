"""From page bodies to filtered chunks. A page stays one row until its chunks are wanted as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webtide.functions import text as T
from webtide.params import Params
from webtide.plans.once import computed


def page_texts(pages: DataFrame, params: Params, body: str = "body") -> DataFrame:
    """Adds text, what a reader of the page sees, and paged, whether form feeds part its pages.

    `content_type`, where there is such a column, and `url` say what a body is: only HTML loses its tags, plain text and
    the text of paged documents stay as they are. The body and its type go.
    """
    given = lambda name: F.col(name) if name in pages.columns else F.lit(None).cast("string")
    kind, is_html = T.page_kind(given("content_type"), given("url")), F.col("_kind") == "html"
    typed = computed(pages, {"_kind": kind})
    if params.ignore_display_none:
        shown = F.when(is_html, T.strip_hidden(F.col(body))).otherwise(F.col(body))
    else:
        shown = F.col(body)
    rest = typed.withColumn("_shown", shown).drop("text", "paged", "content_type", body)
    text = F.when(is_html, T.html_to_text(F.col("_shown"))).otherwise(F.col("_shown"))
    return computed(rest, {"text": text, "paged": F.col("_kind") == "paged"}).drop("_shown", "_kind")


def page_chunks(pages: DataFrame, params: Params, source: str = "url") -> DataFrame:
    """Replaces text by chunks (filtered, in order), content_hash and chunk_count; nothing is shuffled.

    No chunk crosses a page of a paged document: one that `paged` says is one, or the address where there is no such column.
    """
    size, overlap = params.chunk_size, params.chunk_overlap
    known = "paged" in pages.columns
    paged = F.col("paged") if known else T.page_kind(F.lit(None).cast("string"), F.col(source)) == "paged"
    cut = F.when(paged, T.paged_chunks(F.col("text"), size, overlap)).otherwise(T.chunks(F.col("text"), size, overlap))
    kept = F.filter(
        cut, lambda c: T.is_good_chunk(c, F.col(source), params.min_chunk_length)
    )
    return (
        computed(pages, {"chunks": kept})
        .drop("text", "paged")
        .withColumn("content_hash", T.content_hash(F.array_join("chunks", "\n")))
        .withColumn("chunk_count", F.size("chunks"))
    )


def chunk_rows(pages: DataFrame, session_id: str) -> DataFrame:
    """(source, chunk_ix, text, chunk_sha, url, session_id) from pages with url and chunks."""
    rows = pages.select("url", F.posexplode("chunks").alias("chunk_ix", "text"))
    return attach_metadata(rows, session_id)


def attach_metadata(rows: DataFrame, session_id: str, source: str = "url") -> DataFrame:
    """Every chunk knows its source, its URL and the session that stored it."""
    return rows.select(
        F.col(source).alias("source"),
        "chunk_ix",
        "text",
        T.content_hash(F.col("text")).alias("chunk_sha"),
        "url",
        F.lit(session_id).alias("session_id"),
    )


def filter_chunks(chunks: DataFrame, min_length: int) -> DataFrame:
    return chunks.filter(T.is_good_chunk(F.col("text"), F.col("source"), min_length))
