"""Series features and hourly event joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadtally.operators import series as ops
from roadtally.plans import stand_ins
from roadtally.plans.registry import query, rounded, table
from roadtally.plans.stand_ins import SERIES

CALENDAR = """hour(ts_hour)::INT AS hour_of_day, (dayofweek(ts_hour) + 1)::INT AS day_of_week,
       (dayofweek(ts_hour) IN (0, 6))::INT AS is_weekend, month(ts_hour)::INT AS month,
       year(ts_hour)::INT AS year"""

COUNTS = """counts AS (
  SELECT date_trunc('hour', ts) AS ts_hour, count(*) AS tfl_disruptions_hour
  FROM events WHERE event_type = 'error' GROUP BY 1)"""

SEVERITY = """severity AS (
  SELECT date_trunc('hour', ts) AS ts_hour, avg(CASE event_type WHEN 'error' THEN 3.0::DOUBLE
    WHEN 'purchase' THEN 2.0 WHEN 'signup' THEN 1.0 WHEN 'view' THEN 1.0 ELSE 0.0 END)
    AS avg_severity
  FROM events GROUP BY 1)"""


def _features(value: str, order: str, series: str) -> str:
    w = f"OVER (PARTITION BY {series} ORDER BY {order})"
    frame = f"OVER (PARTITION BY {series} ORDER BY {order} ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING)"
    return f"""lag({value}, 1) {w} AS lag_1h, lag({value}, 2) {w} AS lag_2h,
         lag({value}, 24) {w} AS lag_24h,
         round(avg({value}) {frame}, 6) AS roll_mean_24h,
         round(stddev_samp({value}) {frame}, 6) AS roll_std_24h,
         lead({value}, 1) {w} AS y_t_plus_1h"""


@query(f"WITH {SERIES} SELECT * FROM series")
def hourly_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stand_ins.series(spark, sf_dir)


@query(f"WITH {SERIES} SELECT segment_id, ts_hour, {CALENDAR} FROM series")
def calendar_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.calendar(stand_ins.series(spark, sf_dir).drop("volume"))


def _user_features(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    return ops.sequence_features(events, "user_id", ["ts", "event_id"], "value", **options)


@query(
    f"""SELECT event_id, user_id, lag_1h, lag_2h, lag_24h FROM (
  SELECT event_id, user_id, {_features('value', 'ts, event_id', 'user_id')} FROM events)"""
)
def lag_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _user_features(spark, sf_dir).select(
        "event_id", "user_id", "lag_1h", "lag_2h", "lag_24h"
    )


@query(
    f"""SELECT event_id, user_id, roll_mean_24h, roll_std_24h FROM (
  SELECT event_id, user_id, {_features('value', 'ts, event_id', 'user_id')} FROM events)"""
)
def rolling_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _user_features(spark, sf_dir)
    return rounded(rows.select("event_id", "user_id", "roll_mean_24h", "roll_std_24h"))


@query(
    f"""WITH {SERIES}
SELECT segment_id, ts_hour,
       lead(volume, 3) OVER (PARTITION BY segment_id ORDER BY ts_hour) AS y_t_plus_3h
FROM series"""
)
def lead_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ops.sequence_features(
        stand_ins.series(spark, sf_dir),
        "segment_id",
        ["ts_hour"],
        "volume",
        horizon=3,
        split_above=None,
    )
    return rows.select("segment_id", "ts_hour", "y_t_plus_3h")


@query(
    f"""SELECT event_id, event_type, {_features('value', 'ts, event_id', 'event_type')}
FROM events"""
)
def hot_series_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few series with a large share of the rows each, cut into blocks of so many rows."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "ts", "value")
    rows = ops.sequence_features(
        events, "event_type", ["ts", "event_id"], "value", split_above=100
    )
    return rounded(rows.drop("ts", "value"))


@query(
    f"""WITH {SERIES}
SELECT s.segment_id, s.ts_hour, s.volume, a.volume AS clock_lag_1h, b.volume AS clock_lag_2h,
       c.volume AS clock_lag_24h
FROM series s
LEFT JOIN series a ON a.segment_id = s.segment_id AND a.ts_hour = s.ts_hour - INTERVAL 1 HOUR
LEFT JOIN series b ON b.segment_id = s.segment_id AND b.ts_hour = s.ts_hour - INTERVAL 2 HOUR
LEFT JOIN series c ON c.segment_id = s.segment_id AND c.ts_hour = s.ts_hour - INTERVAL 24 HOUR"""
)
def clock_lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.clock_lags(stand_ins.series(spark, sf_dir), "segment_id", "ts_hour", "volume")


@query(
    f"""WITH {SERIES}, {COUNTS}
SELECT segment_id, ts_hour, volume, coalesce(tfl_disruptions_hour, 0) AS tfl_disruptions_hour
FROM series LEFT JOIN counts USING (ts_hour)"""
)
def hourly_event_count_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    hourly = ops.hourly_event_counts(stand_ins.error_feed(spark, sf_dir), "ts")
    return ops.attach_hourly(stand_ins.series(spark, sf_dir), hourly)


@query(
    f"""WITH {SERIES}, {SEVERITY}
SELECT segment_id, ts_hour, volume, round(coalesce(avg_severity, 0.0), 6) AS avg_severity
FROM series LEFT JOIN severity USING (ts_hour)"""
)
def hourly_severity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = stand_ins.severity_feed(spark, sf_dir)
    hourly = ops.hourly_severity(feed, "timestamp_hour", "severity")
    return rounded(ops.attach_hourly(stand_ins.series(spark, sf_dir), hourly, 0.0))


@query(
    f"""WITH {SERIES}, {COUNTS}, {SEVERITY},
features AS (
  SELECT segment_id, ts_hour, volume, {_features('volume', 'ts_hour', 'segment_id')}
  FROM series)
SELECT f.*, {CALENDAR}, coalesce(tfl_disruptions_hour, 0) AS tfl_disruptions_hour,
       round(coalesce(avg_severity, 0.0), 6) AS avg_severity, 'London' AS region
FROM features f LEFT JOIN counts USING (ts_hour) LEFT JOIN severity USING (ts_hour)
WHERE lag_1h IS NOT NULL AND y_t_plus_1h IS NOT NULL"""
)
def gold_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    feeds = [
        ops.hourly_event_counts(stand_ins.error_feed(spark, sf_dir), "ts"),
        ops.hourly_severity(stand_ins.severity_feed(spark, sf_dir), "timestamp_hour", "severity"),
    ]
    rows = ops.gold_features(
        stand_ins.series(spark, sf_dir), "London", hourly=feeds, split_above=None
    )
    return rounded(rows)
