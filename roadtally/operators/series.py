"""Series of hourly values: calendar, row lags, rolling statistics, targets, event joins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.sql.window import Window, WindowSpec

from roadtally.functions.columns import series_and_volume
from roadtally.functions.parsing import severity_score
from roadtally.operators.cleaning import tag_region
from roadtally.session import broadcast_if_small, cut_and_measure, scratch_path

LAGS = (1, 2, 24)
ROLL_ROWS = 24


def hourly_totals(df: DataFrame, series: str, ts: str, value: str, places: int = 2) -> DataFrame:
    """One row per series and hour; a series then has at most one row per hour of the span."""
    return df.groupBy(series, F.date_trunc("hour", ts).alias("ts_hour")).agg(
        F.round(F.sum(value), places).alias("volume")
    )


def calendar(df: DataFrame, ts: str = "ts_hour") -> DataFrame:
    day = F.dayofweek(ts)
    return df.withColumns(
        {
            "hour_of_day": F.hour(ts),
            "day_of_week": day,
            "is_weekend": day.isin(1, 7).cast("int"),
            "month": F.month(ts),
            "year": F.year(ts),
        }
    )


def _row_features(
    window: WindowSpec, value: str, lags: Sequence[int], roll: int, horizon: int
) -> dict[str, Column]:
    before = window.rowsBetween(-roll, -1)
    columns = {f"lag_{n}h": F.lag(value, n).over(window) for n in lags}
    columns[f"roll_mean_{roll}h"] = F.avg(value).over(before)
    columns[f"roll_std_{roll}h"] = F.stddev_samp(value).over(before)
    columns[f"y_t_plus_{horizon}h"] = F.lead(value, horizon).over(window)
    return columns


def sequence_features(
    df: DataFrame,
    series: str,
    order: Sequence[str],
    value: str,
    *,
    lags: Sequence[int] = LAGS,
    roll: int = ROLL_ROWS,
    horizon: int = 1,
    split_above: int | None = 1_000_000,
) -> DataFrame:
    """Lags, rolling statistics and the target, counted in rows of each series.

    ``order`` starts with the timestamp and must order a series totally.  Rows are one shuffle
    and one sort away from their features.  Series of more than ``split_above`` rows are numbered
    through a range sort and cut into blocks of so many rows (at least as many as a frame
    reaches); a block also gets the few rows of its neighbours that its frames reach, so tasks
    grow in number with the rows and no row is compared with the cuts of its series.
    ``split_above=None`` says the caller knows every series to
    be short.
    """
    whole = Window.partitionBy(series).orderBy(*order)
    plain = _row_features(whole, value, lags, roll, horizon)
    if split_above is None:
        return df.withColumns(plain)
    long_ones, seen = cut_and_measure(
        df.groupBy(F.col(series).alias("_hot")).count().where(F.col("count") > split_above),
        most=F.max("count"),
    )
    if seen["most"] is None:
        return df.withColumns(plain)
    is_hot = F.col(series).eqNullSafe(F.col("_hot"))
    hot = broadcast_if_small(long_ones.select("_hot"), stored=True)
    short = df.join(hot, is_hot, "left_anti").withColumns(plain)
    placed = _placed(df.join(hot, is_hot, "left_semi"), [series, *order])
    rows = max(split_above, horizon, roll, *lags)
    back, at = max([*lags, roll]), F.col("_place") % rows
    own = F.floor(F.col("_place") / rows)
    # A row is sent to the block before or after its own where a frame of that block reaches it.
    blocks = F.array_compact(
        F.array(own, F.when(at >= rows - back, own + 1), F.when(at < horizon, own - 1))
    )
    sent = placed.withColumns({"_own": own, "_block": F.explode(blocks)})
    inside = Window.partitionBy(series, "_block").orderBy("_place")
    cut = sent.withColumns(_row_features(inside, value, lags, roll, horizon)).where("_own = _block")
    kept = [*df.columns, *plain]
    return short.select(*kept).unionByName(cut.select(*kept))


def _placed(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows with ``_place``, their number from 0 in the order of ``order``, stored.

    Rows are ranged over the tasks and sorted there; the rows of the tasks before are added to a
    row's place in its own task, so only the counts of the tasks are ever ordered as a whole.
    """
    path = scratch_path(df.sparkSession, "placed")
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    stored = df.sparkSession.read.schema(StructType([*df.schema.fields, StructField("_at", LongType())])).parquet(path)
    # The upper bits of such an id are the number of the task, the lower ones count its rows.
    task = F.shiftright("_at", 33)
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    sizes = stored.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("n"))
    shifts = sizes.select("_task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_shift"))
    in_task = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    found = stored.join(broadcast_if_small(shifts), task == F.col("_task"))
    return found.withColumn("_place", F.col("_shift") + in_task).drop("_at", "_task", "_shift")


def clock_lags(
    df: DataFrame, series: str, ts: str, value: str, hours: Sequence[int] = LAGS
) -> DataFrame:
    """Values exactly so many hours back, unlike the row lags; needs one row per series and hour.

    All offsets are answered by one self-join: each row is sent to the hours it is a lag of.
    """
    sent = df.select(
        series,
        F.col(value).alias("_past"),
        F.explode(F.array(*[F.lit(h) for h in hours])).alias("_back"),
        ts,
    ).withColumn(ts, F.col(ts) + F.make_interval(hours="_back"))
    past = sent.groupBy(series, ts).agg(
        *[F.max(F.when(F.col("_back") == h, F.col("_past"))).alias(f"clock_lag_{h}h") for h in hours]
    )
    return df.join(past, [series, ts], "left")


def hourly_event_counts(feed: DataFrame, ts: str, name: str = "tfl_disruptions_hour") -> DataFrame:
    return (
        feed.where(F.col(ts).isNotNull())
        .groupBy(F.date_trunc("hour", ts).alias("ts_hour"))
        .agg(F.count(F.lit(1)).alias(name))
    )


def hourly_severity(feed: DataFrame, hour: str, severity: str) -> DataFrame:
    return feed.groupBy(F.col(hour).alias("ts_hour")).agg(
        F.avg(severity_score(severity)).alias("avg_severity")
    )


def attach_hourly(df: DataFrame, hourly: DataFrame, fill: float | int = 0) -> DataFrame:
    """Left join one row per hour."""
    added = [c for c in hourly.columns if c != "ts_hour"]
    joined = df.join(broadcast_if_small(hourly), "ts_hour", "left")
    return joined.fillna({c: fill for c in added})


def with_features_and_target(df: DataFrame, horizon: int = 1) -> DataFrame:
    return df.where(F.col("lag_1h").isNotNull() & F.col(f"y_t_plus_{horizon}h").isNotNull())


def gold_features(
    df: DataFrame,
    region: str,
    *,
    tie_break: Sequence[str] = (),
    horizon: int = 1,
    hourly: Sequence[DataFrame] = (),
    split_above: int | None = 1_000_000,
) -> DataFrame:
    """The feature table of step two, from rows that have a series, ``ts_hour`` and a volume."""
    series, volume = series_and_volume(df)
    rows = sequence_features(
        df, series, ["ts_hour", *tie_break], volume, horizon=horizon, split_above=split_above
    )
    rows = with_features_and_target(calendar(rows), horizon)
    return tag_region(reduce(attach_hourly, hourly, rows), region)
