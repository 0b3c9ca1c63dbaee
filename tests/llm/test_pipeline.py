"""Each stage over what the one before left, against plain versions; the entry without this subpackage."""

import shutil
import subprocess
import sys
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers

import corpus_pipeline
from test_decontam import overlap
from test_simhash import groups, plain
from webtide.llm import langid, mixing, queries

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    left = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(i)))
        columns, docs = docs.columns, spark.read.parquet(str(tmp_path / str(i)))
        left.append(docs.collect())
        if i < 4:
            assert docs.columns == columns

    start = spark.read.parquet(f"{SF}/documents.parquet")
    found = langid.predict(start, langid.learn(start)).collect()
    ids = lambda rows: sorted(r.doc_id for r in rows)
    assert ids(left[0]) == sorted(r.doc_id for r in found if r.lang_pred != "und" and r.score >= 0.35)
    assert len(left[0]) == start.count()  # none of these is to be rejected

    rows = sorted(left[0], key=lambda r: r.doc_id)
    assert ids(left[1]) == sorted({rows[g].doc_id for g in groups([plain(r.text) for r in rows])})

    items = [r.text for r in queries.table(spark, SF, "benchmark").collect()]
    low = [" ".join(t.lower().split()) for t in items]
    dirty = {r.doc_id for r in left[1] if any(t in " ".join(r.text.lower().split()) for t in low)}
    assert not dirty & set(ids(left[2]))
    for r in left[1]:
        if r.doc_id not in set(ids(left[2])):
            assert any(overlap(r.text, t) for t in items)

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/2/*.parquet'")
    want = con.execute(mixing.sql(queries._DOMAIN_SQL, queries.MIX)).fetchall()
    assert Counter(ids(left[3])) == Counter({r[0]: r[5] for r in want})

    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text for r in left[3]}
    at = 0
    for r in sorted(left[4], key=lambda r: r.start):
        ids_ = np.array([*model.encode(texts[r.doc_id], add_special_tokens=False).ids, 2], "<u4").tobytes()
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids_) // 4, zlib.crc32(ids_))
        at += r.n_tokens
    assert len(left[4]) == len(left[3])


def test_entry_without_llm(tmp_path):
    """The rest of the library imports and registers its queries when this subpackage is gone."""
    root = Path(__file__).resolve().parents[2]
    shutil.copytree(root / "webtide", tmp_path / "webtide", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 90 and not any(k.startswith('op') for k in q) and 'pipeline' not in q"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})


def test_all_registered():
    names = set(queries.queries())
    assert {n.split("_")[0] for n in names} == {f"op{i}" for i in range(1, 14)}
    assert set(queries.oracle_sql()) <= names


def test_empty_and_odd_rows(spark):
    """No documents at all, and documents with nulls, repeated rows and a very long text, pass all stages."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    none = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        none = stage(spark, none, SF)
        assert none.count() == 0
    odd = [(None, "the of and this with", None, None, None), (-1, None, "en", "src1", 0), (-2, "", None, "src1", 0), (-3, "the of " * 30000, "en", "odd", 1)]
    odd += [(-4, "and this is the same text as that one", "en", "src2", 1)] * 2
    rows = docs.limit(80).unionByName(spark.createDataFrame(odd, docs.schema))
    for _, stage in corpus_pipeline.STAGES[:4]:
        rows = spark.createDataFrame(stage(spark, rows, SF).collect(), docs.schema)
        ids = Counter(r.doc_id for r in rows.collect())
        assert not ids.keys() & {-1, -2}
    assert ids[-4] <= 2 and corpus_pipeline.STAGES[4][1](spark, rows, SF).count() == sum(ids.values())
