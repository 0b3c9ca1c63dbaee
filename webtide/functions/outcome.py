"""Classes of fetch errors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Message parts that make an error final.
PERMANENT = ("404", "not found", "403", "forbidden", "400", "bad request", "not supported")


def is_permanent(error: Column) -> Column:
    """True when the message names an error that trying again cannot cure."""
    return F.lower(error).rlike("|".join(PERMANENT))
