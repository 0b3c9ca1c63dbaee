"""Decisions, chunk differences and state transitions."""

from __future__ import annotations

from pyspark.sql import functions as F

from webtide.checks.fixtures import NOW_TS
from webtide.checks.registry import check
from webtide.checks.scalars import sql_domain, sql_part
from webtide.operators import sync as S
from webtide.plans.lineage import Scratch
from webtide.plans.upkeep import delete_sources
from webtide.sources.store import CorpusStore


def now():
    return F.timestamp_seconds(F.lit(NOW_TS))


def out(state):
    return state.select(
        "url", "content_hash", "chunk_count", F.unix_seconds("last_seen").alias("last_seen_s"),
        "session_id", "miss_count",
    )


COLS = "url, content_hash, chunk_count, last_seen_s, session_id, miss_count"
DECIDED = """decided AS (
  SELECT n.url, n.content_hash, n.chunk_count, CASE WHEN s.url IS NULL THEN 'full'
      WHEN s.content_hash = n.content_hash AND s.chunk_count = n.chunk_count THEN 'skip' ELSE 'partial' END AS decision
  FROM fx_pages_now n LEFT JOIN fx_state s ON s.url = n.url)"""


def pages_now(x):
    return x.fx_pages_now.select("url", "content_hash", "chunk_count")


@check("d1_decision", f"WITH {DECIDED} SELECT url, content_hash, chunk_count, decision FROM decided")
def _(x):
    return S.decide(pages_now(x), x.state)


_IN = "EXISTS (SELECT 1 FROM {} z WHERE z.source = y.source AND z.chunk_sha = y.chunk_sha)"


@check(
    "d2_chunks_to_delete",
    f"SELECT source, chunk_ix, chunk_sha FROM fx_chunks_old y WHERE NOT {_IN.format('fx_chunks_new')}",
)
def _(x):
    return S.chunks_to_delete(x.fx_chunks_old, x.fx_chunks_new).select("source", "chunk_ix", "chunk_sha")


@check(
    "d2_chunks_to_add",
    f"SELECT source, chunk_ix, chunk_sha FROM fx_chunks_new y WHERE NOT {_IN.format('fx_chunks_old')}",
)
def _(x):
    return S.chunks_to_add(x.fx_chunks_old, x.fx_chunks_new).select("source", "chunk_ix", "chunk_sha")


@check(
    "d2_chunk_changes",
    """SELECT source, chunk_sha, CAST(sum(1 - v) AS BIGINT) AS n_old, CAST(sum(v) AS BIGINT) AS n_new FROM (
         SELECT source, chunk_sha, 0 AS v FROM fx_chunks_old UNION ALL SELECT source, chunk_sha, 1 FROM fx_chunks_new)
       GROUP BY ALL HAVING min(v) = max(v)""",
)
def _(x):
    return S.chunk_changes(x.fx_chunks_old, x.fx_chunks_new)


@check(
    "d2_changed_rows",
    f"""SELECT source, chunk_sha, chunk_ix FROM fx_chunks_new y WHERE NOT {_IN.format('fx_chunks_old')} UNION ALL
        SELECT DISTINCT source, chunk_sha, CAST(-1 AS INT) FROM fx_chunks_old y WHERE NOT {_IN.format('fx_chunks_new')}""",
)
def _(x):
    """What a session makes of the changes: rows that come, and the keys that go with place -1."""
    changes, _ = Scratch(x.spark).save(S.chunk_changes(x.fx_chunks_old, x.fx_chunks_new), "changes")
    coming = S.coming(x.fx_chunks_new, changes).select("source", "chunk_sha", F.col("chunk_ix").cast("int").alias("chunk_ix"))
    return coming.unionByName(S.going(changes).withColumn("chunk_ix", F.lit(-1)))


@check(
    "d2_chunk_diff_result",
    f"""SELECT source, chunk_ix, text FROM fx_chunks_old y WHERE {_IN.format('fx_chunks_new')} UNION ALL
        SELECT source, chunk_ix, text FROM fx_chunks_new y WHERE NOT {_IN.format('fx_chunks_old')}""",
)
def _(x):
    old, new = (d.select("source", "chunk_ix", "text", "chunk_sha") for d in (x.fx_chunks_old, x.fx_chunks_new))
    return S.apply_diff(old, new).select("source", "chunk_ix", "text")


@check(
    "d3_state_upsert",
    f"""SELECT coalesce(n.url, s.url) AS url, coalesce(n.content_hash, s.content_hash) AS content_hash,
          coalesce(n.chunk_count, s.chunk_count) AS chunk_count,
          CASE WHEN n.url IS NULL THEN s.last_seen_s ELSE {NOW_TS} END AS last_seen_s,
          CASE WHEN n.url IS NULL THEN s.session_id ELSE 's2' END AS session_id,
          CASE WHEN n.url IS NULL THEN s.miss_count ELSE 0 END AS miss_count
        FROM fx_state s FULL JOIN fx_pages_now n ON n.url = s.url""",
)
def _(x):
    return out(S.upsert(x.state, pages_now(x), "s2", now()))


@check(
    "d4_state_touch",
    f"""SELECT s.url, content_hash, chunk_count, CASE WHEN n.loc IS NULL THEN last_seen_s ELSE {NOW_TS} END AS last_seen_s,
          CASE WHEN n.loc IS NULL THEN session_id ELSE 's2' END AS session_id,
          CASE WHEN n.loc IS NULL THEN miss_count ELSE 0 END AS miss_count
        FROM fx_state s LEFT JOIN fx_listed n ON n.loc = s.url""",
)
def _(x):
    return out(S.touch(x.state, x.fx_listed.select(F.col("loc").alias("url")), "s2", now()))


@check(
    "d5_state_lookup",
    """SELECT l.loc AS url, s.content_hash, s.session_id FROM fx_listed l LEFT JOIN fx_state s ON s.url = l.loc""",
)
def _(x):
    found = S.lookup(x.fx_listed.select(F.col("loc").alias("url")), x.state)
    return found.select("url", "content_hash", "session_id")


@check("d6_state_delete", f"SELECT {COLS} FROM fx_state WHERE url NOT IN (SELECT loc FROM fx_listed)")
def _(x):
    return out(S.delete(x.state, x.fx_listed.select(F.col("loc").alias("url"))))


@check(
    "d7_miss_count",
    """SELECT url, content_hash, chunk_count, last_seen_s, session_id,
         CAST(CASE WHEN url IN (SELECT loc FROM fx_listed) THEN miss_count ELSE miss_count + 1 END AS INT) AS miss_count
       FROM fx_state""",
)
def _(x):
    missing = x.state.join(x.fx_listed, F.col("url") == F.col("loc"), "left_anti")
    return out(S.count_miss(x.state, missing, "s2", now()))


_STALE = """keep AS (SELECT loc AS url FROM fx_listed), stale AS (
  SELECT url, miss_count FROM fx_state WHERE session_id <> 's1' AND url NOT IN (SELECT url FROM keep))"""


def stale(x):
    return S.stale_urls(x.state, "s1", x.fx_listed.select(F.col("loc").alias("url")))


@check("d8_stale_urls", f"WITH {_STALE} SELECT url FROM stale")
def _(x):
    return stale(x).select("url")


@check(
    "d9_stale_cleanup",
    f"""WITH {_STALE} SELECT url, d.delay,
          CASE WHEN d.delay = 0 OR miss_count + 1 >= d.delay THEN 'remove' ELSE 'miss' END AS action
        FROM stale, (SELECT unnest([0, 1, 2, 3]) AS delay) d""",
)
def _(x):
    rows = stale(x)
    parts = [S.stale_actions(rows, d).withColumn("delay", F.lit(d)) for d in (0, 1, 2, 3)]
    out_rows = parts[0]
    for p in parts[1:]:
        out_rows = out_rows.unionByName(p)
    return out_rows


# pages that no sitemap dates are missing; those of other sites than the scope's are not looked at
_SITE_STALE = f"""stale AS (
  SELECT url, miss_count FROM fx_state WHERE session_id <> 's1'
    AND url NOT IN (SELECT loc FROM fx_listed WHERE lastmod_s IS NOT NULL)
    AND {sql_domain(sql_part('url', 2))} IN (SELECT domain FROM fx_scope))"""


def stale_in_sites(x):
    keep = x.fx_listed.filter("lastmod_s IS NOT NULL").select(F.col("loc").alias("url"))
    return S.stale_urls(x.state, "s1", keep, x.fx_scope)


@check("d8_stale_in_sites", f"WITH {_SITE_STALE} SELECT url FROM stale")
def _(x):
    return stale_in_sites(x).select("url")


@check(
    "d9_cleanup_in_sites",
    f"""WITH {_SITE_STALE}, acted AS (SELECT url, CASE WHEN miss_count + 1 >= 2 THEN 'remove' ELSE 'miss' END AS action FROM stale)
        SELECT s.url, s.session_id, CAST(s.miss_count + CASE WHEN a.action = 'miss' THEN 1 ELSE 0 END AS INT) AS miss_count
        FROM fx_state s LEFT JOIN acted a ON a.url = s.url WHERE coalesce(a.action, '') <> 'remove'""",
)
def _(x):
    """The state after the cleanup: pages of sites that the session did not visit are left as they were."""
    acted = S.stale_actions(stale_in_sites(x), 2).withColumns(
        {"content_hash": F.lit(None).cast("string"), "chunk_count": F.lit(None).cast("int")}
    )
    return S.transition(x.state, acted, "s2", now()).select("url", "session_id", "miss_count")


_SRC = """SELECT CASE WHEN doc_id % 5 = 0 THEN '' ELSE 'd' || CAST(doc_id * 2 AS STRING) END AS source FROM documents"""


def _sources(x):
    return x.table("documents").select(
        F.when(F.col("doc_id") % 5 == 0, F.lit(""))
        .otherwise(F.concat(F.lit("d"), (F.col("doc_id") * 2).cast("string")))
        .alias("source")
    )


@check(
    "d10_delete_counts",
    f"""SELECT n.source, count(o.source) AS deleted FROM (SELECT DISTINCT source FROM ({_SRC}) WHERE source <> '') n
        LEFT JOIN fx_chunks_old o ON o.source = n.source GROUP BY n.source""",
)
def _(x):
    return S.deleted_counts(x.fx_chunks_old, _sources(x))


@check(
    "d10_delete_by_source",
    f"SELECT source, chunk_ix, chunk_sha FROM fx_chunks_old WHERE source NOT IN ({_SRC})",
)
def _(x):
    return S.without_sources(x.fx_chunks_old, _sources(x)).select("source", "chunk_ix", "chunk_sha")


@check(
    "d10_delete_job",
    f"""WITH gone AS ({_SRC} UNION ALL SELECT loc FROM fx_listed)
        SELECT 'state' AS kind, url AS name, CAST(1 AS BIGINT) AS n FROM fx_state WHERE url NOT IN (FROM gone) UNION ALL
        SELECT 'chunks', source, count(*) FROM fx_chunks_old WHERE source NOT IN (FROM gone) GROUP BY source""",
)
def _(x):
    """What a store still holds after the job."""
    store = CorpusStore(x.spark, f"{Scratch(x.spark).base}/store")
    old = x.fx_chunks_old.withColumns({"url": F.col("source"), "session_id": F.lit("s")})
    store.publish(x.state, old)
    delete_sources(store, _sources(x).unionByName(x.fx_listed.select(F.col("loc").alias("source"))))
    count = F.count(F.lit(1)).alias("n")
    left = store.read_chunks().groupBy(F.lit("chunks").alias("kind"), F.col("source").alias("name")).agg(count)
    return left.unionByName(store.read_state().select(F.lit("state").alias("kind"), F.col("url").alias("name"), F.lit(1).cast("bigint").alias("n")))


@check(
    "d11_keep_set",
    "SELECT url FROM fx_state UNION SELECT loc FROM fx_listed UNION SELECT url FROM fx_attempts",
)
def _(x):
    return S.keep_set(x.state, x.fx_listed.select(F.col("loc").alias("url")), x.fx_attempts)


@check(
    "d13_duplicate_report",
    """SELECT sha256(text) AS content_hash, count(*) AS copies, min(source) AS first_url FROM docs
       GROUP BY ALL HAVING count(*) > 1""",
)
def _(x):
    return S.duplicate_report(
        x.docs.select(F.col("source").alias("url"), F.sha2("text", 256).alias("content_hash"))
    )
