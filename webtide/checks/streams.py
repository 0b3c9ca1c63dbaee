"""Streams over the same inputs; each must end where the batch job ends."""

from __future__ import annotations

from pyspark.sql import functions as F

from webtide.checks.content import sql_page
from webtide.checks.fetches import _RUNS
from webtide.checks.fixtures import NOW_TS, DuckDialect
from webtide.checks.registry import check
from webtide.checks.reports import _PARSED
from webtide.checks.scalars import SQL_EMPTY
from webtide.checks.session import _DECIDE, KNOWN, NOW_SESSION, PARAMS, known_chunks, known_state
from webtide.params import Params
from webtide.plans.lineage import Scratch
from webtide.plans.upkeep import complete_session
from webtide.sources import logs
from webtide.sources.store import CorpusStore
from webtide.streaming.alarms import start_alarms
from webtide.streaming.ingest import start_ingest
from webtide.streaming.logroll import closed_rollup, start_rollup

_PARTS = 4


def arriving(x, df, order: str, base: str):
    """`df` as a stream of files that arrive in `_PARTS` steps, by `order`."""
    df, _ = Scratch(x.spark).save(df, "arriving")
    # four equal ranges of the order values, appended one after the other
    top = df.agg(F.max(order).alias("top")).first().top
    part = F.floor(F.col(order) * _PARTS / F.lit(top + 1))
    for k in range(_PARTS):
        df.filter(part == k).repartition(_PARTS).write.mode("append").parquet(f"{base}/in")
    return (
        x.spark.readStream.schema(df.schema).option("maxFilesPerTrigger", _PARTS).parquet(f"{base}/in")
    )


_NEWC = f"""okcap AS (
  SELECT url, body FROM fx_captures WHERE status = 200 AND error IS NULL AND NOT {SQL_EMPTY})"""


_INGESTED = f"""WITH webok AS (SELECT url, content_type, body FROM fx_captures WHERE status = 200 AND error IS NULL),
        {_NEWC}, {sql_page('webok', 'body', ctype='content_type')}, {KNOWN},
        done AS (SELECT n.*, {_DECIDE} AS decision FROM pagec n JOIN okcap USING (url) LEFT JOIN kstate s ON s.url = n.url)
        SELECT coalesce(s.url, d.url) AS url,
          CASE WHEN d.decision IN ('full', 'partial') THEN d.content_hash ELSE s.content_hash END AS content_hash,
          CASE WHEN d.decision IN ('full', 'partial') THEN d.chunk_count ELSE s.chunk_count END AS chunk_count,
          CASE WHEN d.url IS NULL THEN s.last_seen_s ELSE {NOW_TS} END AS last_seen_s,
          CASE WHEN d.url IS NULL THEN s.session_id ELSE '{NOW_SESSION}' END AS session_id,
          CASE WHEN d.url IS NULL THEN s.miss_count ELSE 0 END AS miss_count
        FROM kstate s FULL JOIN done d ON d.url = s.url"""


@check("st1_stream_ingest", _INGESTED)
def _(x):
    return _state(ingested(x))


def _state(store: CorpusStore):
    return store.read_state().withColumn("last_seen_s", F.unix_seconds("last_seen")).drop("last_seen")


@check(
    "st1_complete_session",
    f"""SELECT url, content_hash, chunk_count, last_seen_s, session_id,
          CAST(CASE WHEN session_id = '{NOW_SESSION}' THEN miss_count ELSE miss_count + 1 END AS INT) AS miss_count
        FROM ({_INGESTED}) WHERE session_id = '{NOW_SESSION}' OR miss_count + 1 < {PARAMS.remove_delay}""",
)
def _(x):
    """The streamed session is declared complete: what it has not met is missing or removed."""
    store = ingested(x)
    complete_session(store, NOW_SESSION, PARAMS, F.timestamp_seconds(F.lit(NOW_TS)))
    return _state(store)


def ingested(x) -> CorpusStore:
    base = Scratch(x.spark).base
    store = CorpusStore(x.spark, f"{base}/store")
    store.publish(known_state(x), known_chunks(x), session_id="s0")
    captures = x.fx_captures.select("url", "seq", "status", "error", "content_type", "body")
    now = F.timestamp_seconds(F.lit(NOW_TS))
    stream = arriving(x, captures, "seq", base)
    start_ingest(stream, store, PARAMS, NOW_SESSION, now, f"{base}/cp").awaitTermination()
    return store


@check(
    "st1_stream_chunks",
    f"""WITH webok AS (SELECT url, content_type, body FROM fx_captures WHERE status = 200 AND error IS NULL),
        {_NEWC}, {sql_page('webok', 'body', ctype='content_type')}, {KNOWN},
        now_c AS (SELECT url AS source, unnest(chunks) AS text FROM pagec JOIN okcap USING (url))
        SELECT source, sha256(text) AS chunk_sha, count(*) AS copies FROM (
          SELECT source, text FROM now_c UNION ALL
          SELECT source, text FROM kchunks WHERE source NOT IN (SELECT url FROM okcap)) GROUP BY ALL""",
)
def _(x):
    return ingested(x).read_chunks().groupBy("source", "chunk_sha").agg(F.count(F.lit(1)).alias("copies"))


@check(
    "st2_stream_alarms",
    f"""WITH {_RUNS} SELECT run_id, batch_no, seq, fails,
          CASE WHEN reason NOT LIKE 'http_%' THEN least(10.0 * pow(2.0, least(fails - 1, 60)), 120.0)
               ELSE 0.0 END::DOUBLE AS wait_s, fails >= 3 AS alarm
        FROM fl WHERE outcome = 'failed'""",
)
def _(x):
    base = Scratch(x.spark).base
    fetches = x.fx_fetches.select("run_id", "batch_no", "seq", "outcome", "reason")
    stream = arriving(x, fetches, "seq", base)
    start_alarms(stream, base, Params(), ["run_id", "batch_no"], f"{base}/cp").awaitTermination()
    out = x.spark.read.parquet(f"{base}/alarms/*")
    return out.select("run_id", "batch_no", "seq", "fails", "wait_s", "alarm")


_HOUR = DuckDialect().epoch("time_bucket(INTERVAL '1 hour', ts)")


@check(
    "st3_stream_rollup",
    f"""WITH {_PARSED} SELECT level, event, {_HOUR} AS window_s, count(*) AS lines FROM parsed
        WHERE {_HOUR} + 3600 <= (SELECT epoch(max(ts)) - 600 FROM parsed) GROUP BY ALL""",
)
def _(x):
    base = rolled_up(x)
    rolled = x.spark.read.parquet(f"{base}/out")
    return rolled.select("level", "event", F.unix_seconds("window_start").alias("window_s"), "lines")


@check(
    "st3_closed_rollup",
    f"WITH {_PARSED} SELECT level, event, {_HOUR} AS window_s, count(*) AS lines FROM parsed GROUP BY ALL",
)
def _(x):
    """All lines, those of windows still open at the end included."""
    base = rolled_up(x)
    rolled = closed_rollup(x.spark, f"{base}/out", f"{base}/cp")
    return rolled.select("level", "event", F.unix_seconds("window_start").alias("window_s"), "lines")


def rolled_up(x) -> str:
    base = Scratch(x.spark).base
    lines = x.fx_log.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "level", "line")
    lines.write.parquet(f"{base}/in")
    stream = x.spark.readStream.schema(lines.schema).parquet(f"{base}/in")
    start_rollup(logs.parse_log(stream), "1 hour", "10 minutes", f"{base}/out", f"{base}/cp").awaitTermination()
    return base
