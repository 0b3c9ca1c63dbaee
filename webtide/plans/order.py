"""Numbering and running totals that never put a whole group into one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webtide.plans.lineage import Scratch


def with_global_index(df: DataFrame, order: Sequence[str], name: str = "ix") -> DataFrame:
    """Number all rows 1, 2, 3, ... by `order` (which must be unique).

    Rows are range-partitioned and written once, so the partition bounds are the same for both uses:
    counting (one row per partition) and numbering inside a partition.
    """
    ranged = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    fixed, _ = Scratch(df.sparkSession).save(ranged, "ranged")
    sizes = fixed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select(
        "_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before")
    )
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return (
        # one row per partition, so the broadcast cannot grow with the data
        fixed.join(F.broadcast(before), "_part")
        .withColumn(name, inside + F.col("_before"))
        .drop("_part", "_before")
    )


def match(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on keys where NULL equals NULL, so that no row is lost to a missing key."""
    theirs = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    joined = left.join(theirs, same, how)
    if how == "full":
        joined = joined.withColumns({k: F.coalesce(k, f"_right_{k}") for k in keys})
    return joined.drop(*[f"_right_{k}" for k in keys])


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    sums: dict[str, Column] | None = None,
    maxima: dict[str, tuple[str, Column]] | None = None,
    blocks: int | None = None,
) -> DataFrame:
    """Running totals per key, in two levels. NULL is a key like any other; rows with a NULL `order` come first.

    Rows are range-partitioned by key and `order` and written once; a key's part of one partition is a block, so
    a hot key is cut by the number of its rows, whatever its `order` values are. Totals run inside a block, and what
    came before it is carried in from one row per block. `maxima` maps a new column to (running sum, condition): the
    largest value of that sum so far among rows where the condition holds, 0 if there is none. `blocks` sets the
    number of partitions.
    """
    sums, maxima = sums or {}, maxima or {}
    block = [*keys, "_block"]
    by = [*keys, order]
    ranged = df.repartitionByRange(blocks, *by) if blocks else df.repartitionByRange(*by)
    rows, _ = Scratch(df.sparkSession).save(ranged.withColumn("_block", F.spark_partition_id()), "blocks")
    w = Window.partitionBy(*block).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumns({f"_l_{n}": F.sum(c).over(w) for n, c in sums.items()})
    for n, (total, cond) in maxima.items():
        local = local.withColumn(f"_l_{n}", F.max(F.when(cond, F.col(f"_l_{total}"))).over(w))

    # sums only grow, so a block's last one is its largest
    per_block = local.groupBy(*block).agg(
        *[F.max(f"_l_{n}").alias(f"_t_{n}") for n in (*sums, *maxima)],
    )
    past = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_block.withColumns(
        {f"_c_{n}": F.coalesce(F.sum(f"_t_{n}").over(past), F.lit(0)) for n in sums}
    )
    for n, (total, _) in maxima.items():
        carry = carry.withColumn(
            f"_c_{n}", F.max(F.col(f"_t_{n}") + F.col(f"_c_{total}")).over(past)
        )
    carry = carry.select(*block, *[f"_c_{n}" for n in (*sums, *maxima)])

    out = match(local, carry, block)
    done = {n: F.col(f"_l_{n}") + F.col(f"_c_{n}") for n in sums}
    for n, (total, _) in maxima.items():
        here = F.col(f"_l_{n}") + F.col(f"_c_{total}")
        done[n] = F.coalesce(F.greatest(here, F.col(f"_c_{n}")), F.lit(0))
    return out.withColumns(done).drop(
        "_block", *[f"_l_{n}" for n in done], *[f"_c_{n}" for n in done]
    )
