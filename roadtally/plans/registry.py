"""Named queries over the driver tables, each with the SQL that must agree with it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Doubles are compared at this many decimal places.
PLACES = 6


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name; without SQL only its rows are checked."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame) -> DataFrame:
    return df.select(
        *[F.round(c, PLACES).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )
