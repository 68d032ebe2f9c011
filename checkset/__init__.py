"""Queries over the test tables, each beside the SQL that must give the same rows.

The tables stand in for the feed's own inputs (events for queue events and data
files, orders and customers for state rows, line items for listings and jobs).
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register the decorated function under its name, with its SQL if it has one."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load_all() -> None:
    """Import every module that registers queries."""
    from checkset import catalog, events, feeds, messages, scalars, scans, state, status, streams  # noqa: F401
