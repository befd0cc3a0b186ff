"""Registry of named queries: ``name -> op(Tables) -> DataFrame`` plus the
DuckDB oracle text for each one that SQL can state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillroll.session import sized_session
from tillroll.sources.bind import Tables
from tillroll.sources.driver import DRIVER_SCHEMAS, table_path

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(t: Tables) -> DataFrame`` under ``name``."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def runner(name: str) -> Callable[[SparkSession, str], DataFrame]:
    fn = QUERIES[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        sized = sized_session(spark, [table_path(sf_dir, table) for table in DRIVER_SCHEMAS])
        return fn(Tables(sized, sf_dir))

    run.__name__ = name
    return run


def load_all() -> None:
    """Import every module that registers queries."""
    from tillroll.operators import (advanced, customer, extras, generate, journeys,  # noqa: F401
                                    marketing, operations, product, quality, sales, samples, series)
    from tillroll.plans import incremental, jobs, statistics, tablefns, views  # noqa: F401
    from tillroll.streaming import ledger, windows  # noqa: F401
