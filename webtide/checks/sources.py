"""Sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from webtide.checks.fixtures import BASE_TS
from webtide.checks.registry import check, sql_strip
from webtide.checks.scalars import sql_clean, sql_domain, sql_part, sql_path, sql_protocol, sql_valid
from webtide.operators import report, sync
from webtide.plans.lineage import Scratch
from webtide.sources import captures, logs, seeds
from webtide.sources.sitemap_docs import fetched_sitemaps
from webtide.sources.store import CorpusStore

_CLEAN = sql_protocol(f"({sql_clean('item')})")
SEEDS = f"""items AS (
  SELECT setting, u.ix AS ix, u.item AS item FROM (
    SELECT i AS setting, unnest(list_transform(string_split(raw, ','), lambda s, ix: {{'ix': ix, 'item': s}})) AS u
    FROM (SELECT setting AS i, raw FROM fx_seeds))),
 seeds AS (
  SELECT setting, CAST(ix - 1 AS INT) AS seed_ix, {_CLEAN} AS url FROM items
  WHERE {sql_strip('item')} <> '' AND {sql_valid('item')})"""


@check("s1_seed_list", f"WITH {SEEDS} SELECT setting, seed_ix, url FROM seeds")
def _(x):
    return seeds.seed_list(x.fx_seeds)


@check(
    "s2_scope",
    f"""WITH {SEEDS} SELECT DISTINCT {sql_domain(sql_part('url', 2))} AS domain, 'root' AS kind,
          CASE WHEN {sql_path('url')} = '' THEN '/' ELSE {sql_path('url')} END AS prefix FROM seeds
        UNION ALL SELECT DISTINCT {sql_domain(sql_protocol('item'))}, 'allowed', NULL
        FROM items WHERE {sql_strip('item')} <> '' AND {sql_valid('item')}""",
)
def _(x):
    return seeds.scope(seeds.seed_list(x.fx_seeds), seeds.extra_domains(x.fx_seeds))


@check(
    "s2_prefix_cover",
    """SELECT DISTINCT domain, prefix FROM fx_wide_scope a WHERE NOT EXISTS (
         SELECT 1 FROM fx_wide_scope b WHERE b.domain = a.domain AND length(b.prefix) < length(a.prefix)
           AND starts_with(a.prefix, b.prefix))""",
)
def _(x):
    return seeds.prefix_cover(x.fx_wide_scope)


@check(
    "s3_captured_pages",
    """SELECT c.url, x.url IS NOT NULL AS captured,
         CASE WHEN x.url IS NOT NULL THEN split_part(coalesce(x.content_type, 'text/html'), ';', 1) END AS content_type,
         sha256(x.body) AS body_sha
       FROM (SELECT url FROM fx_state) c LEFT JOIN fx_captures x ON x.url = c.url""",
)
def _(x):
    found = captures.contents(x.state.select("url"), x.fx_captures)
    return found.select("url", "captured", "content_type", F.sha2("body", 256).alias("body_sha"))


@check(
    "s3_latest_capture",
    """SELECT 'u' || CAST(user_id AS STRING) AS url, max(event_id) AS seq, arg_max(event_type, event_id) AS kind
       FROM events GROUP BY user_id""",
)
def _(x):
    log = x.table("events").select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("url"),
        F.col("event_id").alias("seq"),
        F.col("event_type").alias("kind"),
    )
    return captures.latest(log, "seq")


@check(
    "s5_sitemap_source",
    """SELECT i AS root, 'https://' || auth || '/sitemap-' || CAST(i AS STRING) || '.xml' AS sitemap_url,
         sha256(s.text) AS sha FROM p JOIN (SELECT sitemap_url, text FROM fx_sitemap WHERE status = 200) s
       ON s.sitemap_url = 'https://' || auth || '/sitemap-' || CAST(i AS STRING) || '.xml'""",
)
def _(x):
    wanted = x.sql(
        "SELECT i AS root, 'https://' || auth || '/sitemap-' || CAST(i AS STRING) || '.xml' AS sitemap_url FROM p"
    )
    found = fetched_sitemaps(wanted, x.fx_sitemap)
    return found.select("root", "sitemap_url", F.sha2("text", 256).alias("sha"))


@check(
    "s6_state_table",
    """SELECT url, content_hash, chunk_count, last_seen_s, session_id, miss_count FROM fx_state""",
)
def _(x):
    store = CorpusStore(x.spark, f"{Scratch(x.spark).base}/store")
    nothing = x.fx_chunks_old.filter("false").select(
        "source", "chunk_ix", "text", "chunk_sha", F.col("source").alias("url"), F.lit("s0").alias("session_id")
    )
    store.publish(x.state, nothing)
    back = store.read_state()
    return back.withColumn("last_seen_s", F.unix_seconds("last_seen")).drop("last_seen")


def _stored(df):
    return df.withColumn("url", F.col("source")).withColumn("session_id", F.lit("s0"))


@check(
    "s7_chunk_store",
    """SELECT source, chunk_ix, chunk_sha FROM fx_chunks_old o
       WHERE EXISTS (SELECT 1 FROM fx_chunks_new n WHERE n.source = o.source AND n.chunk_sha = o.chunk_sha)
       UNION ALL SELECT source, chunk_ix, chunk_sha FROM fx_chunks_new n
       WHERE NOT EXISTS (SELECT 1 FROM fx_chunks_old o WHERE n.source = o.source AND n.chunk_sha = o.chunk_sha)""",
)
def _(x):
    store = CorpusStore(x.spark, f"{Scratch(x.spark).base}/store")
    old, new = _stored(x.fx_chunks_old), _stored(x.fx_chunks_new)
    store.publish(x.state, old)
    store.publish(x.state, sync.chunks_to_add(old, new), sync.chunks_to_delete(old, new))
    return store.read_chunks().select("source", "chunk_ix", "chunk_sha")


_LOG = """SELECT event_id, json_extract_string(line, '$.component') AS component,
  json_extract_string(line, '$.event') AS event, CAST(json_extract_string(line, '$.data.k') AS STRING) AS k
  FROM (SELECT * FROM fx_log WHERE json_valid(line))"""


@check("s8_log_source", _LOG)
def _(x):
    parsed = logs.parse_log(x.fx_log)
    return parsed.select("event_id", "component", "event", F.try_element_at("data", F.lit("k")).alias("k"))


@check(
    "s9_run_summary",
    """SELECT run_id, concat_ws(', ', i || ' URLs ingested', CASE WHEN s > 0 THEN s || ' skipped (unchanged)' END,
         CASE WHEN f > 0 THEN f || ' failed' END, CASE WHEN r > 0 THEN r || ' stale removed' END, '4.2 min') AS summary
       FROM (SELECT run_id, count(*) FILTER (result = 'ingested') AS i, count(*) FILTER (result = 'skipped') AS s,
               count(*) FILTER (result = 'failed') AS f, 0 AS r FROM fx_results GROUP BY run_id)""",
)
def _(x):
    counts = x.fx_results.groupBy("run_id").agg(
        *[F.count_if(F.col("result") == n).alias(n) for n in ("ingested", "skipped", "failed")]
    )
    text = report.summary_text(
        F.col("ingested"), F.col("skipped"), F.col("failed"), F.lit(0), F.lit("4.2")
    )
    return counts.select("run_id", text.alias("summary"))
