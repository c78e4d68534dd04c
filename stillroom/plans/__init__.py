"""The catalogue of registered queries, each with the SQL text its result must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Plan = Callable[[SparkSession, str], DataFrame]

PLANS: dict[str, Plan] = {}
SQL: dict[str, str] = {}


def plan(sql: str | None) -> Callable[[Plan], Plan]:
    """Register a function under its name; ``sql`` is the equivalent text for a SQL engine."""

    def register(function: Plan) -> Plan:
        PLANS[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql.strip()
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def load_all() -> None:
    """Import every module that registers queries."""
    from stillroom.plans import external, further, geography, history, listing, loads, maintenance, publishing, streams, versioned  # noqa: F401
