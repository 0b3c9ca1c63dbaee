"""Mixtures against SQL over the same table, budgets against repeated filling, and odd rows."""

import duckdb
import pytest
from pyspark.sql import functions as F

from webtide.llm import mixing, queries
from webtide.llm.mixing import Mix

DOCS = "/root/testdata/sf0.001/documents.parquet"


@pytest.mark.parametrize("share,most", [(0, 50_000), (600, 50_000), (600, 0), (2500, 50_000), (9000, 0)])
def test_sql(spark, monkeypatch, share, most):
    monkeypatch.setattr(mixing, "_BROADCAST", most)  # both ways to meet the plan
    mix = Mix(share=share, epochs=3, weights={"domain": {"web": 7, "books": 0, "news": 1}, "lang": {"en": 1, "de": 9}})
    chosen = mixing.choose(spark.read.parquet(DOCS), queries.domain_of(F.col("source")), mix)
    got = sorted(tuple(r) for r in chosen.select("_doc.doc_id", "_mix.*").collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{DOCS}'")
    assert got == sorted(con.execute(mixing.sql(queries._DOMAIN_SQL, mix)).fetchall())


def fill(budget, nodes):
    """Water-filling by rounds: (weight, supply) -> exact shares."""
    got, open_ = [0.0] * len(nodes), [i for i, (w, s) in enumerate(nodes) if w > 0]
    left = float(budget)
    while open_ and left > 1e-9:
        total = sum(nodes[i][0] for i in open_)
        over = [i for i in open_ if got[i] + left * nodes[i][0] / total >= nodes[i][1]]
        if not over:
            for i in open_:
                got[i] += left * nodes[i][0] / total
            break
        for i in over:
            left -= nodes[i][1] - got[i]
            got[i] = nodes[i][1]
        open_ = [i for i in open_ if i not in over]
    return got


def test_shortages_stay_with_siblings(spark):
    """web/en cannot use its part: web's other languages get it, and books only what web cannot use at all."""
    leaves = [("web", "en", "a", 10), ("web", "de", "b", 1000), ("books", "en", "c", 1000), ("books", "de", "d", 1000)]
    mix = Mix(share=300, epochs=1, weights={"domain": {"web": 1, "books": 1}})
    df = spark.createDataFrame(leaves, "domain string, lang string, source string, tokens long")
    got = {(r.domain, r.lang): r.budget for r in mixing.budgets(df, mix).collect()}
    budget = 3010 * 300 // 1000
    assert got[("web", "en")] == 10 and got[("web", "de")] in (budget // 2 - 10, budget // 2 - 11)
    assert abs(got[("books", "en")] - budget / 4) <= 1


def test_budgets_against_rounds(spark):
    import random

    r = random.Random(3)
    rows = [("d", f"l{i}", "s", r.randint(0, 500)) for i in range(12)]
    weights = {f"l{i}": r.randint(0, 9) for i in range(12)}
    for share in (50, 400, 900):
        mix = Mix(share=share, epochs=1, weights={"lang": weights})
        df = spark.createDataFrame(rows, "domain string, lang string, source string, tokens long")
        got = {x.lang: x.budget for x in mixing.budgets(df, mix).collect()}
        total = sum(x[3] for x in rows)
        want = fill(min(total * share // 1000, total), [(weights[x[1]], x[3]) for x in rows])
        assert all(abs(got[x[1]] - w) <= 1 for x, w in zip(rows, want))


def test_odd_rows(spark):
    rows = [(1, None, None, None), (None, "a b", "en", "s"), (2, "", "en", "s"), (3, "x " * 5000, None, "s"), (4, "same", "en", "s"), (4, "same", "en", "s")]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, lang string, source string, copies int")
    out = mixing.mixed(docs, F.col("source"), Mix(share=2000, epochs=2))
    assert out.columns == docs.columns
    assert out.filter("doc_id = 4").count() == 4 and out.filter("doc_id = 3").count() == 2
    assert mixing.mixed(docs.limit(0), F.col("source"), Mix()).count() == 0
    assert mixing.mixed(docs, F.col("source"), Mix(share=0)).count() == 0


def test_plan_grows_with_the_levels_not_with_their_power(spark):
    """Budgets read each level's nodes once: a plan that doubles with each level fills the driver's memory."""
    leaves = spark.createDataFrame([("web", "en", "a", 10), ("web", "de", "b", 0)], "domain string, lang string, source string, tokens long")
    mix = Mix(share=300, weights={"lang": {"en": 2, "de": 0}})
    plan = mixing.budgets(leaves, mix)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") <= 2 + 1 + len(mixing.LEVELS)  # the leaves, all tokens, and each level's nodes
    assert [r.budget for r in mixing.budgets(leaves, mix).orderBy("source").collect()] == [3, 0]
