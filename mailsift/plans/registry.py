"""Named queries over the given tables, each beside the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with its check where SQL can state one."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if oracle is not None:
            ORACLES[function.__name__] = oracle
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r6(value: Column | str) -> Column:
    """Six decimals by the same arithmetic on every engine."""
    value = F.col(value) if isinstance(value, str) else value
    return F.floor(value * F.lit(1e6) + F.lit(0.5)) / F.lit(1e6)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: r6(c) for c in columns})


def s6(expression: str) -> str:
    """``r6`` in SQL."""
    return f"floor(({expression}) * 1e6 + 0.5e0) / 1e6"
