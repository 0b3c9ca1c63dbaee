"""The corpus pipeline: whole documents in, token ids out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
one's documents. All but the last keep the columns of `documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webtide.llm import decontam, langid, mixing, queries, simhash, tokens
from webtide.plans.lineage import Scratch

#: Language, duplicates and mixture cannot be put into SQL: a trained model, hashes and components come before.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no known language, or in no one language, go. The model is learned from labelled ones."""
    return langid.accepted(docs, langid.learn(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the document with the smallest doc_id stays."""
    return simhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap a benchmark item go."""
    return decontam.clean(docs, queries.table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many tokens of each domain, language and source as the weights ask for; some documents more than once."""
    return mixing.mixed(docs, queries.domain_of(F.col("source")), queries.MIX)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the shared folder, and per document what they hold: doc_id, start, n_tokens, ids_crc32."""
    path = f"{Scratch(spark).base}/tokens"
    tokens.write_tokens(docs, path, public_tokenizers.path("byte_bpe_50k.json"))
    return tokens.digests(tokens.read_tokens(spark, path))


STAGES = [
    ("language ID", identify_language),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("mixing to target weights", mix_sources),
    ("token-ID output", write_token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what each leaves is written in the shared folder."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    scratch = Scratch(spark)
    docs = queries.table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES[:-1]):
        docs, _ = scratch.save(stage(spark, docs, sf_dir), f"stage{i}")
    return STAGES[-1][1](spark, docs, sf_dir)
