"""The registered queries of this subpackage: thin, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webtide.llm import mixing, turns_sql
from webtide.llm.mixing import Mix

_SPARK: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register the decorated function as query `name`, with its SQL if there is one."""

    def add(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)

        _SPARK[name] = run
        if sql is not None:
            _SQL[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_SPARK)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


@query("op1_token_output")
def _(spark, sf_dir):
    import public_tokenizers

    from webtide.llm import tokens
    from webtide.plans.lineage import Scratch

    path = f"{Scratch(spark).base}/tokens"
    tokens.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return tokens.digests(tokens.read_tokens(spark, path))


@query("op5_simhash")
def _(spark, sf_dir):
    from webtide.llm import simhash

    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


SHARDS = 40


@query("op2_sharding")
def _(spark, sf_dir):
    from webtide.llm import sharding
    from webtide.plans.lineage import Scratch

    docs = table(spark, sf_dir, "documents")
    path = f"{Scratch(spark).base}/shards"
    sharding.write_shards(docs, path, SHARDS)
    return sharding.digests(sharding.read_shards(spark, path, docs)).select(
        "*", F.lit("rows").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    )


MIX = Mix(
    weights={
        "domain": {"web": 4, "books": 3, "forum": 2, "news": 3},
        "lang": {"en": 5, "de": 2, "fr": 2, "es": 2},
    }
)
#: The tables' sources are numbered; their domains go by the number.
_DOMAIN_NAMES = ("web", "books", "forum", "news")


def domain_of(source: Column) -> Column:
    number = F.try_to_number(F.regexp_extract(source, r"([0-9]+)$", 1), F.lit("999999999")).cast("int")
    return F.get(F.array(*map(F.lit, _DOMAIN_NAMES)), number % len(_DOMAIN_NAMES))


_DOMAIN_SQL = "(['web', 'books', 'forum', 'news'])[1 + CAST(nullif(regexp_extract(source, '([0-9]+)$', 1), '') AS INT) % 4]"


@query("op3_mixing", mixing.sql(_DOMAIN_SQL, MIX))
def _(spark, sf_dir):
    chosen = mixing.choose(table(spark, sf_dir, "documents"), domain_of(F.col("source")), MIX)
    return chosen.select("_doc.doc_id", "_mix.*")


URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


@query("op4_url_filter")
def _(spark, sf_dir):
    from webtide.llm import urlblock

    return urlblock.judge(table(spark, sf_dir, "pages"), URL_RULES)


@query("op7_pii")
def _(spark, sf_dir):
    from webtide.llm import pii

    return pii.digest(pii.find(table(spark, sf_dir, "documents")))


@query("op9_merkle")
def _(spark, sf_dir):
    from webtide.llm import merkle

    return merkle.compare(table(spark, sf_dir, "documents"))


@query("op8_decontamination")
def _(spark, sf_dir):
    from webtide.llm import decontam

    return decontam.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op10_langid")
def _(spark, sf_dir):
    from webtide.llm import langid

    docs = table(spark, sf_dir, "documents")
    found = langid.predict(docs, langid.learn(docs))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query("op6_line_dedup")
def _(spark, sf_dir):
    from webtide.llm import linedup

    found = linedup.deletions(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", F.size("deleted").alias("n_deleted"), "deleted", "runs")


@query("op12_whitening")
def _(spark, sf_dir):
    from webtide.llm import whitening

    return whitening.components_of(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


@query("op13_substring_dedup")
def _(spark, sf_dir):
    from webtide.llm import substrings

    done = substrings.without_copies(table(spark, sf_dir, "documents"))
    gone = F.aggregate("removed", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return done.select("doc_id", "n_words", gone.alias("n_removed"), F.sha2("text", 256).alias("kept_sha256"), "removed")


@query("op11_turn_repair", turns_sql.SQL)
def _(spark, sf_dir):
    from webtide.llm import turns
    from webtide.plans.order import match

    given = table(spark, sf_dir, "conversations")
    audits, repaired = turns.repair(turns_sql.damaged(given))
    every = given.select("conv_id").distinct()
    met = match(match(every, audits, ["conv_id"], "left"), turns.digests(repaired), ["conv_id"], "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return met.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
