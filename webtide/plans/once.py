"""Columns that are worked out once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add costly columns that later filters and joins use.

    As plain projections the optimizer would copy them into every predicate it pushes down; as the output
    of a one-row generator they are worked out once and referred to from then on.
    """
    fields = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select("*", F.inline(F.array(fields)))
