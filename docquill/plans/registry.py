"""All registered queries and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import catalog_docs, catalog_eval, catalog_log, catalog_search
from . import oracle_docs, oracle_eval, oracle_log, oracle_search

Query = Callable[[SparkSession, str], DataFrame]


def _in_utc(query: Query) -> Query:
    """Hours and dates are those of UTC, whatever the session was started with."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    parts = [catalog_log.QUERIES, catalog_docs.QUERIES, catalog_search.QUERIES, catalog_eval.QUERIES]
    return {name: _in_utc(q) for part in parts for name, q in part.items()}


def oracle_sql() -> dict[str, str]:
    return {**oracle_log.SQL, **oracle_docs.SQL, **oracle_search.SQL, **oracle_eval.SQL}
