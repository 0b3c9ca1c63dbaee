"""All registered queries: a Spark side and, where SQL can say it, a DuckDB side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from webtide.checks.fixtures import Inputs, oracle

_SPARK: dict[str, Callable[[Inputs], DataFrame]] = {}
_SQL: dict[str, str] = {}

# Whole RFC 3986 split and the blanks that stripping removes, for RE2
SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def sql_strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^{SPACE}+', ''), '{SPACE}+$', '')"


def check(name: str, sql: str | None = None):
    """Register the decorated function as query `name`, with its oracle if there is one."""

    def add(fn: Callable[[Inputs], DataFrame]):
        if name in _SPARK:
            raise ValueError(f"query {name} is registered twice")
        _SPARK[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn

    return add


def _load() -> None:
    from webtide.checks import (  # noqa: F401
        content,
        fetches,
        freshness,
        links,
        reports,
        robots,
        scalars,
        session,
        sitemaps,
        sources,
        streams,
        sync,
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()

    def bind(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(Inputs(spark, sf_dir))

        return run

    return {name: bind(fn) for name, fn in _SPARK.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {name: oracle(sql) for name, sql in _SQL.items()}
