"""Content operators over all pages and all documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from webtide.checks.links import sql_drop_opaque
from webtide.checks.registry import SPACE, check, sql_strip
from webtide.functions import text as T
from webtide.operators import content as O
from webtide.params import Params

PARAMS = Params()


def sql_text(html: str) -> str:
    tag = r"""<[/!?a-zA-Z](?:"[^"]*"|''[^'']*''|[^''">])*>"""
    out = f"regexp_replace({sql_drop_opaque(html)}, '{tag}', ' ', 'g')"
    # the named characters that occur in the given pages; HTML's other names are tested in test_text.py
    for name, char in (("&nbsp;", " "), ("&middot;", "\u00b7"), ("&copy;", "\u00a9"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "''"), ("&amp;", "&")):
        out = f"replace({out}, '{name}', '{char}')"
    return sql_strip(f"regexp_replace({out}, '{SPACE}+', ' ', 'g')")


def sql_chunk_list(text: str, size: int, overlap: int) -> str:
    step = size - overlap
    n = (
        f"CASE WHEN length({text}) = 0 THEN 0 "
        f"ELSE greatest(1, CAST(ceil((length({text}) - {overlap}) / {step}.0) AS BIGINT)) END"
    )
    return f"list_transform(range({n}), lambda k: substr({text}, k * {step} + 1, {size}))"


def sql_good(chunk: str, source: str, min_len: int) -> str:
    s = sql_strip(f"replace({chunk}, ' ', '')")
    cid = rf"\(cid:\p{{Nd}}+\){SPACE}*\(cid:\p{{Nd}}+\)"
    return (
        f"(length({chunk}) >= {min_len} AND NOT (lower({source}) LIKE '%.pdf' AND "
        f"(({s} <> '' AND replace({s}, left({s}, 1), '') = '') OR regexp_matches({chunk}, '{cid}'))))"
    )


def sql_kind(ctype: str, url: str) -> str:
    name = f"lower({sql_strip(f'split_part({ctype}, {chr(39)};{chr(39)}, 1)')})"
    return f"""CASE WHEN {name} = 'application/pdf' THEN 'paged' WHEN {name} IN ('text/plain', 'text/markdown') THEN 'plain'
      WHEN {name} IN ('text/html', 'application/xhtml+xml') THEN 'html' WHEN lower({url}) LIKE '%.pdf' THEN 'paged'
      WHEN lower({url}) LIKE '%.txt' OR lower({url}) LIKE '%.md' THEN 'plain' ELSE 'html' END"""


def sql_paged_chunks(text: str, size: int, overlap: int) -> str:
    return f"flatten(list_transform(string_split({text}, chr(12)), lambda t: {sql_chunk_list('t', size, overlap)}))"


def sql_page(relation: str, body: str, size: int = 1024, overlap: int = 256, min_len: int = 50, url: str = "url", keep: str = "url", name: str = "page", ctype: str = "CAST(NULL AS STRING)") -> str:
    """CTEs ending in `<name>c`: url, kept chunks, hash and count of every page of `relation`."""
    return f"""{name}kind AS (SELECT {keep}, {body} AS body, {sql_kind(ctype, url)} AS kind FROM {relation}),
     {name}text AS (SELECT {keep}, kind, CASE WHEN kind = 'html' THEN {sql_text('body')} ELSE body END AS text FROM {name}kind),
     {name}k AS (
      SELECT {keep}, list_filter(CASE WHEN kind = 'paged' THEN {sql_paged_chunks('text', size, overlap)}
               ELSE {sql_chunk_list('text', size, overlap)} END, lambda c: {sql_good('c', url, min_len)}) AS chunks FROM {name}text),
     {name}c AS (
      SELECT *, sha256(array_to_string(chunks, chr(10))) AS content_hash, CAST(len(chunks) AS INT) AS chunk_count
      FROM {name}k)"""


@check("h1_strip_hidden", "SELECT page_id, expected AS html FROM fx_html")
def _(x):
    return x.fx_html.select("page_id", T.strip_hidden(F.col("html")).alias("html"))


@check("h2_html_to_text", f"SELECT page_id, {sql_text('html')} AS text FROM fx_html")
def _(x):
    return x.fx_html.select("page_id", T.html_to_text(F.col("html")).alias("text"))


@check(
    "h2_routed_text",
    f"""WITH {sql_page('fx_captures', 'body', keep='i, url', ctype='content_type')}
        SELECT i, kind, sha256(text) AS text_sha FROM pagetext""",
)
def _(x):
    """Pages, plain texts and paged documents, each read as its type or address says."""
    captures = x.fx_captures.withColumn("kind", T.page_kind(F.col("content_type"), F.col("url")))
    return O.page_texts(captures, PARAMS).select("i", "kind", F.sha2("text", 256).alias("text_sha"))


@check(
    "h6_routed_chunks",
    f"""WITH {sql_page('fx_captures', 'body', keep='i, url', ctype='content_type')}
        SELECT i, content_hash, chunk_count FROM pagec""",
)
def _(x):
    made = O.page_chunks(O.page_texts(x.fx_captures, PARAMS), PARAMS)
    return made.select("i", "content_hash", "chunk_count")


@check(
    "h3_chunks",
    f"""SELECT doc_id, CAST(u.ix - 1 AS INT) AS chunk_ix, u.c AS chunk FROM (
          SELECT doc_id, unnest(list_transform({sql_chunk_list('text', 1024, 256)},
                   lambda c, ix: {{'ix': ix, 'c': c}})) AS u FROM docs)""",
)
def _(x):
    return x.docs.select(
        "doc_id", F.posexplode(T.chunks(F.col("text"), 1024, 256)).alias("chunk_ix", "chunk")
    )


@check(
    "h4_chunk_filter",
    f"SELECT doc_id, source, text FROM fx_doc_chunks WHERE {sql_good('text', 'source', 50)}",
)
def _(x):
    return O.filter_chunks(x.fx_doc_chunks, 50)


@check(
    "h5_chunk_metadata",
    """SELECT source, chunk_ix, text, sha256(text) AS chunk_sha, source AS url, 's9' AS session_id
       FROM fx_chunks_new""",
)
def _(x):
    rows = x.fx_chunks_new.select(F.col("source").alias("url"), "chunk_ix", "text")
    return O.attach_metadata(rows, "s9")


_DOCK = f"""dock AS (
  SELECT doc_id, list_filter({sql_paged_chunks('text', 512, 128)},
           lambda c: {sql_good('c', "source || '.pdf'", 50)}) AS kept FROM docs)"""


@check(
    "h6_page_text",
    f"""WITH {_DOCK} SELECT doc_id, sha256(array_to_string(kept, chr(10))) AS content_hash,
          CAST(len(kept) AS INT) AS chunk_count, length(array_to_string(kept, chr(10))) AS n_chars FROM dock""",
)
def _(x):
    params = Params(chunk_size=512, chunk_overlap=128)
    docs = x.docs.withColumn("source", F.concat("source", F.lit(".pdf")))
    made = O.page_chunks(docs, params, source="source")
    return made.select(
        "doc_id",
        "content_hash",
        "chunk_count",
        F.length(F.array_join("chunks", "\n")).cast("bigint").alias("n_chars"),
    )
