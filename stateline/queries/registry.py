"""The registry, and the pieces the query modules share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFunction = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFunction] = {}
SQL: dict[str, str] = {}

SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
NATIONS = {f"NATION_{i}": i for i in range(25)}


def query(sql: str | None = None) -> Callable[[QueryFunction], QueryFunction]:
    """Registers a query under its function name."""

    def add(function: QueryFunction) -> QueryFunction:
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def sql_total(value: str) -> str:
    return f"cast(sum(cast({value} as decimal(28, 2))) as double)"


def sql_mean(value: str) -> str:
    return f"({sql_total(value)} / cast(nullif(count({value}), 0) as double))"


def sql_season(day: str) -> str:
    return (
        f"case when month({day}) <= 3 then 'winter' when month({day}) <= 6 then 'spring' "
        f"when month({day}) <= 9 then 'summer' else 'autumn' end"
    )


def sql_case(key: str, pairs: dict, default: str = "null") -> str:
    def text(value) -> str:
        return f"'{value}'" if isinstance(value, str) else str(value)

    branches = " ".join(f"when {key} = {text(k)} then {text(v)}" for k, v in pairs.items())
    return f"case {branches} else {default} end"
