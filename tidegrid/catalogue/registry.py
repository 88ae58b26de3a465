"""All registered queries by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidegrid.catalogue import operators, reports, sources, streams, upkept
from tidegrid.session import own_root, without_zone

Query = Callable[[SparkSession, str], DataFrame]

_ALL: dict[str, tuple[Query, str | None]] = {**operators.QUERIES, **reports.QUERIES, **streams.QUERIES, **sources.QUERIES, **upkept.QUERIES}


def _plain(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        own_root(spark)
        return without_zone(query(spark, sf_dir))

    return run


def queries() -> dict[str, Query]:
    return {name: _plain(query) for name, (query, _) in _ALL.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _ALL.items() if sql}
