"""Mixing sources to target weights: budgets down a domain - language - source tree, then prefixes of seeded epochs.

A node's budget is divided among its children by weight. No child gets more than its supply (its tokens times
`epochs`); what it cannot use goes to its siblings by weight, and only what no sibling can use comes back to the
parent's siblings, because a parent's supply is that of its children. A leaf's documents follow each other in a seeded
order, one order per epoch; the leaf's stream of epochs is taken until the budget is used up.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import chain

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webtide.plans.lineage import Scratch

LEVELS = ("domain", "lang", "source")
NONE = "none"
#: Most leaves whose plan (some 100 bytes each) is broadcast.
_BROADCAST = 50_000


@dataclass(frozen=True)
class Mix:
    """share: budget as parts of 1000 of all tokens. Weights are integers, `other` where a name has none."""

    share: int = 600
    epochs: int = 4
    seed: int = 7
    weights: dict[str, dict[str, int]] = field(default_factory=dict)
    other: int = 1

    def __post_init__(self) -> None:
        if self.share < 0 or self.epochs < 1 or self.other < 0 or any(w < 0 for v in self.weights.values() for w in v.values()):
            raise ValueError("need share >= 0, epochs >= 1, weights >= 0")


def words(text: Column) -> Column:
    """Default token count: words between white space; none in a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def _weight(level: str, mix: Mix) -> Column:
    table = mix.weights.get(level, {})
    if not table:
        return F.lit(mix.other).cast("bigint")
    known = F.create_map(*[F.lit(x) for x in chain.from_iterable(table.items())])
    return F.coalesce(F.try_element_at(known, F.col(level)), F.lit(mix.other)).cast("bigint")


def divide(children: DataFrame, parent: list[str], child: str) -> DataFrame:
    """Adds `budget` to children (parent keys, child, supply, weight, total): total divided by weight within supplies.

    Siblings in order of supply / weight: each is full if its supply is at most its part of what the full ones
    before it leave. The others share the rest, rounded down. All in integers; weight 0 gets nothing.
    """
    # siblings without weight stay in the same pass and count for nothing: apart from it, each level would double the plan
    live = F.col("weight") > 0
    weight, supply = (F.when(live, F.col(c)).otherwise(0) for c in ("weight", "supply"))
    order = [F.when(live, F.col("supply") / F.col("weight")), F.col(child)]
    siblings = Window.partitionBy(*parent)
    before = siblings.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    others = F.sum(weight).over(siblings) - F.coalesce(F.sum(weight).over(before), F.lit(0))
    rest = F.col("total") - F.coalesce(F.sum(supply).over(before), F.lit(0))
    full = live & (F.col("supply") * others <= rest * F.col("weight"))
    marked = children.filter(F.col("weight").isNotNull()).withColumn("full", full)
    marked = marked.withColumns(
        {
            "left": F.col("total") - F.sum(F.when(F.col("full"), F.col("supply")).otherwise(0)).over(siblings),
            "over": F.sum(F.when(F.col("full"), 0).otherwise(weight)).over(siblings),
        }
    )
    part = F.when(F.col("full"), F.col("supply")).when(live, F.expr("left * weight div over")).otherwise(0)
    return marked.withColumn("budget", part.cast("bigint")).drop("full", "left", "over")


def budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """(domain, lang, source, tokens, budget) from leaves (domain, lang, source, tokens), one row per leaf."""
    whole = leaves.withColumns(
        {"supply": F.col("tokens") * mix.epochs, "total": F.expr(f"{mix.share} * sum(tokens) OVER () div 1000")}
    )
    parent: list[str] = []
    known = whole.select("total").distinct()
    for level in LEVELS:
        keys = [*parent, level]
        nodes = whole.groupBy(*keys).agg(F.sum("supply").alias("supply"))
        nodes = nodes.crossJoin(F.broadcast(known)) if not parent else nodes.join(known, parent)
        known = divide(nodes.withColumn("weight", _weight(level, mix)), parent, level)
        known = known.select(*keys, F.col("budget").alias("total"))
        parent = keys
    return leaves.join(known.withColumnRenamed("total", "budget"), list(LEVELS))


def _counted(plan: DataFrame, rows: int) -> DataFrame:
    """One row per leaf: broadcast up to a size that has been counted, beyond it joined as Spark sees fit."""
    return F.broadcast(plan) if rows <= _BROADCAST else plan


def choose(docs: DataFrame, domain: Column, mix: Mix, tokens: Column | None = None) -> DataFrame:
    """`docs` with domain (null: "none"), tokens and copies, as columns of `_mix`; rows without copies are gone.

    docs: doc_id, text, lang, source and others. Whole epochs count for every document of a leaf; of the last one
    those count that begin before the budget ends, in the order of md5(seed:epoch:doc_id), then doc_id and tokens.
    Null labels are a label of their own, "none". Documents without tokens cost nothing. Repeated rows are
    taken one by one. An empty table gives no rows.

    One pass over the texts writes leaf, block and tokens per document; sums by leaf and by block (of 4,096 in each
    epoch's order) are combined within tasks. A second pass meets one row per leaf: documents in blocks before the
    one where the budget ends are in, those after it out; only that block's are sorted.
    """
    scratch = Scratch(docs.sparkSession)
    label = lambda c: F.coalesce(c.cast("string"), F.lit(NONE))
    leaf = F.struct(
        label(domain).alias("domain"),
        label(F.col("lang")).alias("lang"),
        label(F.col("source")).alias("source"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (words(F.col("text")) if tokens is None else tokens).cast("bigint").alias("tokens"),
    )
    narrow, _ = scratch.save(docs.select(leaf.alias("l")).select("l.*"), "leaves")
    # one row per leaf, written because every level reads it
    sums, _ = scratch.save(narrow.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens")), "sums")
    plan = budgets(sums, mix).select(
        *LEVELS,
        F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(F.lit(0)).alias("whole"),
        F.when(F.col("tokens") > 0, F.expr("budget % tokens")).otherwise(F.lit(0)).alias("rest"),
    )
    plan, size = scratch.save(plan, "plan")
    leaves = size["rows"]

    turn = F.md5(F.concat_ws(":", F.lit(mix.seed), F.col("whole"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    ordered = narrow.join(_counted(plan.filter(F.col("rest") > 0), leaves), list(LEVELS)).withColumn(
        "block", F.substring(turn, 1, 3)
    )
    blocks = ordered.groupBy(*LEVELS, "block").agg(F.sum("tokens").alias("n"), F.max("rest").alias("rest"))
    upto = Window.partitionBy(*LEVELS).orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    # one block per leaf, 4,096 rows per leaf in the window
    end = (
        blocks.withColumn("sum", F.sum("n").over(upto))
        .filter((F.col("sum") >= F.col("rest")) & (F.col("sum") - F.col("n") < F.col("rest")))
        .select(*LEVELS, F.col("block").alias("last"), (F.col("sum") - F.col("n")).alias("before"))
    )
    ends, _ = scratch.save(plan.join(end, list(LEVELS), "left"), "ends")

    names = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_doc"), leaf.alias("l")).select("_doc", "l.*")
    met = rows.join(_counted(ends, leaves), list(LEVELS)).withColumn("turn", turn)
    met = met.withColumn("block", F.substring("turn", 1, 3))
    inside = F.when(F.col("rest") == 0, F.lit("out")).when(F.col("block") < F.col("last"), F.lit("in")).when(
        F.col("block") == F.col("last"), F.lit("edge")
    ).otherwise(F.lit("out"))
    met = met.withColumn("where", inside)
    row = Window.partitionBy(*LEVELS).orderBy("turn", "doc_id", "tokens").rowsBetween(Window.unboundedPreceding, -1)
    # dealt out anew, so that only these rows need their leaf together and the join above can be split
    last = met.filter(F.col("where") == "edge").repartition(*LEVELS, "block")
    edge = last.withColumn(
        "taken", (F.col("before") + F.coalesce(F.sum("tokens").over(row), F.lit(0)) < F.col("rest")).cast("int")
    )
    clear = met.filter(F.col("where") != "edge").withColumn("taken", (F.col("where") == "in").cast("int"))
    chosen = edge.unionByName(clear).withColumn("copies", F.col("whole") + F.col("taken"))
    about = F.struct(*LEVELS, "tokens", "copies").alias("_mix")
    return chosen.filter(F.col("copies") > 0).select("_doc", about)


def mixed(docs: DataFrame, domain: Column, mix: Mix) -> DataFrame:
    """The mixture itself: each chosen row of `docs` as often as its epochs ask for, in all its columns."""
    chosen = choose(docs, domain, mix)
    again = F.explode(F.sequence(F.lit(1), F.col("_mix.copies").cast("int")))
    return chosen.select("_doc", again.alias("_copy")).select("_doc.*")


def sql(domain: str, mix: Mix) -> str:
    """The same choice in DuckDB SQL over `documents`: doc_id, domain, lang, source, tokens, copies."""

    def weight(level: str) -> str:
        cases = "".join(f" WHEN '{k}' THEN {v}" for k, v in mix.weights.get(level, {}).items())
        return f"CASE {level}{cases} ELSE {mix.other} END" if cases else str(mix.other)

    steps, above = [], []
    for level in LEVELS:
        keys = ", ".join([*above, level])
        total = f"JOIN b_{above[-1]} USING ({', '.join(above)})" if above else "CROSS JOIN (SELECT SUM(tokens) * " + str(mix.share) + " // 1000 AS total FROM leaves)"
        part = f"PARTITION BY {', '.join(above)} " if above else ""
        order = f"ORDER BY supply / weight, {level}"
        steps.append(f"""n_{level} AS (SELECT {keys}, SUM(tokens) * {mix.epochs} AS supply, {weight(level)} AS weight
          FROM leaves GROUP BY {keys}),
        w_{level} AS (SELECT *, supply * SUM(weight) OVER ({part}{order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
            <= (total - COALESCE(SUM(supply) OVER ({part}{order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * weight AS is_full
          FROM n_{level} {total} WHERE weight > 0),
        x_{level} AS (SELECT *, total - SUM(CASE WHEN is_full THEN supply ELSE 0 END) OVER ({part}) AS rest,
            SUM(CASE WHEN is_full THEN 0 ELSE weight END) OVER ({part}) AS others FROM w_{level}),
        b_{level} AS (SELECT {keys}, CASE WHEN is_full THEN supply ELSE rest * weight // others END AS total FROM x_{level}
          UNION ALL SELECT {keys}, 0 FROM n_{level} WHERE weight <= 0)""")
        above.append(level)
    keys = ", ".join(LEVELS)
    return f"""WITH d AS (SELECT doc_id, COALESCE({domain}, '{NONE}') AS domain, COALESCE(lang, '{NONE}') AS lang,
          COALESCE(source, '{NONE}') AS source,
          len(regexp_extract_all(COALESCE(text, ''), '[^\\x20\\x09-\\x0D]+')) AS tokens FROM documents),
        leaves AS (SELECT {keys}, SUM(tokens) AS tokens FROM d GROUP BY {keys}),
        {', '.join(steps)},
        plan AS (SELECT {keys}, CASE WHEN tokens > 0 THEN total // tokens ELSE 0 END AS whole,
          CASE WHEN tokens > 0 THEN total % tokens ELSE 0 END AS rest FROM leaves JOIN b_source USING ({keys})),
        o AS (SELECT *, COALESCE(SUM(tokens) OVER (PARTITION BY {keys}
            ORDER BY md5(concat_ws(':', '{mix.seed}', CAST(whole AS VARCHAR), COALESCE(CAST(doc_id AS VARCHAR), ''))), doc_id, tokens
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d JOIN plan USING ({keys}))
        SELECT doc_id, {keys}, CAST(tokens AS BIGINT) AS tokens,
          CAST(whole + CASE WHEN before < rest THEN 1 ELSE 0 END AS BIGINT) AS copies
        FROM o WHERE whole + CASE WHEN before < rest THEN 1 ELSE 0 END > 0"""
