"""Hotspot flags by quantile and the rates made of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from roadtally.operators.quantiles import exact_quantiles
from roadtally.session import broadcast_if_small

DEFAULT_QUANTILE = 0.60

# The calendar columns of the time profile.
PROFILE_COLUMNS = ("hour_of_day", "day_of_week", "is_weekend", "month")


def thresholds(
    preds: DataFrame, key: str, value: str, q: float, exact: bool = False
) -> DataFrame:
    """The ``q`` quantile of ``value`` per key.

    Partial quantile sketches are merged, so no task holds all rows of a key as a window would.
    The sketch is exact up to some thousands of rows per key and within 1/10,000 of the rank
    beyond; ``exact`` takes a second pass instead.
    """
    if exact:
        return exact_quantiles(preds, key, value, q, "hotspot_threshold")
    return preds.groupBy(key).agg(F.percentile_approx(value, q).alias("hotspot_threshold"))


def with_threshold(
    preds: DataFrame, key: str, value: str, q: float, exact: bool = False
) -> DataFrame:
    """Put the key's threshold on each row; a null key has its own."""
    limits = thresholds(preds, key, value, q, exact).withColumnRenamed(key, "_key")
    joined = preds.join(broadcast_if_small(limits), preds[key].eqNullSafe(F.col("_key")), "left")
    return joined.drop("_key")


def flag_hotspots(preds: DataFrame, q: float = DEFAULT_QUANTILE) -> DataFrame:
    """Per hour, flag the links whose prediction reaches the hour's quantile."""
    rows = with_threshold(preds, "ts_hour", "y_pred", q)
    hit = F.coalesce(F.col("y_pred") >= F.col("hotspot_threshold"), F.lit(False))
    return rows.withColumn("is_hotspot", hit.cast("int"))


def _rate() -> Column:
    return F.avg("is_hotspot").alias("hotspot_rate")


def _mean(value: str, name: str) -> Column:
    return F.avg(value).alias(name)


def _rows() -> Column:
    return F.count(F.lit(1)).alias("n_rows")


def point_rates(flags: DataFrame) -> DataFrame:
    return flags.groupBy("count_point_id", "latitude", "longitude").agg(
        _rate(), _mean("y_pred", "avg_pred"), _mean("y_true", "avg_true"), _rows()
    )


def time_profile(flags: DataFrame) -> DataFrame:
    keys = [c for c in PROFILE_COLUMNS if c in flags.columns]
    return flags.groupBy(*keys).agg(
        _mean("y_true", "avg_true"), _mean("y_pred", "avg_pred"), _rate(), _rows()
    )


def edge_rates(flags: DataFrame) -> DataFrame:
    return flags.groupBy("from_node", "to_node").agg(_rate(), _mean("y_pred", "avg_pred"), _rows())


def map_kpis(rates: DataFrame, threshold: float) -> DataFrame:
    """One row: edges at or above the map's threshold, and the highest rate."""
    return rates.agg(
        F.count_if(F.col("hotspot_rate") >= threshold).alias("n_hot"),
        F.max("hotspot_rate").alias("max_rate"),
    )


def segment_hotspots(
    preds: DataFrame, segment: str, q: float = 0.90, rate_above: float = 0.20
) -> DataFrame:
    """Segments often above their own quantile; specified by the report."""
    rows = with_threshold(preds, segment, "y_pred", q, exact=True)
    flags = rows.withColumn("is_hotspot", (F.col("y_pred") > F.col("hotspot_threshold")).cast("int"))
    return flags.groupBy(segment).agg(_rate(), _rows()).withColumn(
        "is_segment_hotspot", F.col("hotspot_rate") > rate_above
    )
