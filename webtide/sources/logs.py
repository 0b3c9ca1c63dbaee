"""Structured log lines: one JSON object per line."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LINE_SCHEMA = "component string, event string, data map<string,string>"


def parse_log(lines: DataFrame, column: str = "line") -> DataFrame:
    """Adds component, event and data; lines that are no JSON objects are left out."""
    parsed = F.from_json(F.col(column), LINE_SCHEMA)
    keep = [c for c in lines.columns if c != column]
    return (
        lines.select(*keep, parsed.alias("p"))
        .filter(F.col("p.event").isNotNull())
        .select(*keep, "p.*")
    )
