"""Raw text rows to typed rows."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from roadtally.functions.columns import require_columns, snake_columns
from roadtally.functions.parsing import (
    NUMBER_PATTERN,
    as_number,
    null_tokens,
    parse_date,
    plain_number,
    to_number,
)
from roadtally.operators.quantiles import exact_quantiles
from roadtally.schemas import COUNT_TYPES, OPTIONAL_COUNTS, REGION_COLUMNS, REQUIRED_COUNTS
from roadtally.session import broadcast_if_small

# Name parts of columns that stay text.
TEXT_NAME_PARTS = ("road_name", "junction", "location", "name", "code", "region")


def clean_counts(raw: DataFrame) -> DataFrame:
    """Typed counts with the month keys; rows lacking a required value are dropped.

    Parsing alone turns a null token into NULL, so only columns that stay text are searched
    for tokens.  That keeps the generated code small enough to be compiled.
    """
    df = require_columns(snake_columns(raw), REQUIRED_COUNTS)
    typed = {"count_date": parse_date("count_date")}
    for name, to in COUNT_TYPES.items():
        if name in df.columns:
            typed[name] = to_number(df, name, to)
        elif name in OPTIONAL_COUNTS:
            typed[name] = F.lit(None).cast(to)
    parsed = null_tokens(df, leave=list(typed)).withColumns(typed)
    return month_keys(parsed.dropna(subset=list(REQUIRED_COUNTS)), "count_date")


def month_keys(df: DataFrame, date_col: str) -> DataFrame:
    return df.withColumns(
        {"p_year": F.year(date_col), "p_month": F.date_format(date_col, "MM")}
    )


def inferable(columns: list[str]) -> list[str]:
    barred = re.compile("|".join(TEXT_NAME_PARTS))
    return [c for c in columns if not barred.search(c)]


def numeric_ratios(df: DataFrame, sample_rows: int | None = None) -> DataFrame:
    """One row: per column the share of its non-NULL values that look like numbers.

    All columns are measured in one aggregate, over every row unless a sample of about
    ``sample_rows`` is asked for; a row's own values tell whether it is in the sample.
    """
    rows = df
    if sample_rows is not None and (n := df.count()) > sample_rows:
        rows = df.where(F.pmod(F.xxhash64(*df.columns), F.lit(1 << 30)) < int((1 << 30) * sample_rows / n))
    return rows.agg(
        *[
            F.avg(plain_number(c).rlike(NUMBER_PATTERN).cast("double")).alias(c)
            for c in inferable(df.columns)
        ]
    )


def numeric_columns(
    df: DataFrame, at_least: float = 0.8, sample_rows: int | None = None
) -> list[str]:
    ratios = numeric_ratios(df, sample_rows).first().asDict()
    return [c for c, r in ratios.items() if r is not None and r >= at_least]


def clean_any(
    raw: DataFrame, region: str, at_least: float = 0.8, sample_rows: int | None = None
) -> DataFrame:
    """Clean a file of unknown layout: names, null tokens, numbers by content, region.

    Text columns that are mostly numbers become doubles.
    """
    named = snake_columns(raw)
    numeric = numeric_columns(null_tokens(named, fold_case=True), at_least, sample_rows)
    typed = {c: as_number(plain_number(c)) for c in numeric}
    rows = null_tokens(named, fold_case=True, leave=numeric).withColumns(typed)
    return rows.withColumn("region", F.lit(region))


def tag_region(df: DataFrame, region: str) -> DataFrame:
    """Name the region unless the rows already do."""
    return df if "region" in df.columns else df.withColumn("region", F.lit(region))


def region_extract(raw: DataFrame, region: str, first_year: int) -> DataFrame:
    """One region's recent rows of the national file, in the columns that are used."""
    df = snake_columns(raw).withColumnRenamed("local_authority_name", "local_authority")
    rows = df.where(
        (F.col("region_name") == region) & (to_number(df, "year", "int") >= first_year)
    )
    return rows.select(*[c for c in REGION_COLUMNS if c in df.columns])


# The rules below are specified by the report, not by code.


def drop_negative(df: DataFrame, value: str) -> DataFrame:
    return df.where(F.col(value) >= 0)


def cap_by_key(df: DataFrame, key: str, value: str, q: float = 0.995) -> DataFrame:
    """Cap each value at its key's exact quantile, of a null key too; a null value stays null."""
    caps = exact_quantiles(df, key, value, q, "cap").withColumnRenamed(key, "_key")
    capped = df.join(broadcast_if_small(caps), df[key].eqNullSafe(F.col("_key")), "left").drop("_key")
    return capped.withColumn(value, F.when(F.col(value).isNotNull(), F.least(value, "cap"))).drop("cap")


def latest_per_key(df: DataFrame, keys: list[str], newest_first: list) -> DataFrame:
    """Keep the newest row per key.

    The rank filter is also applied before the shuffle, so a hot key sends one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*newest_first)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def range_violations(df: DataFrame, rules: dict[str, tuple[float, float]]) -> DataFrame:
    """One row: how many values of each column lie outside its range."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[
            F.count_if(~F.col(c).between(low, high)).alias(f"bad_{c}")
            for c, (low, high) in rules.items()
        ],
    )


def within_ranges(df: DataFrame, rules: dict[str, tuple[float, float]]) -> DataFrame:
    for c, (low, high) in rules.items():
        df = df.where(F.col(c).between(low, high))
    return df
