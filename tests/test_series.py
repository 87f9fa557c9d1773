"""Series features against plain Python."""

from __future__ import annotations

import datetime as dt
import random
import statistics

import pytest

from roadtally.operators import series as ops

START = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def gappy(spark):
    """Two long series with gaps and one repeated hour, one of two rows and one of one."""
    rng = random.Random(7)
    rows = []
    for sid, n in ((1, 90), (2, 60), (3, 2), (4, 1)):
        hours = sorted(rng.sample(range(200), n))
        if n > 10:
            hours[5] = hours[4]
        rows += [(sid, START + dt.timedelta(hours=h), k, float(rng.randint(0, 99))) for k, h in enumerate(hours)]
    rows += [(None, START + dt.timedelta(hours=h), h, float(h)) for h in range(40)]
    return rows, spark.createDataFrame(rows, "sid int, ts timestamp, tie int, v double")


def brute(rows, horizon):
    expected = {}
    for sid in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == sid), key=lambda r: (r[1], r[2]))
        vs = [r[3] for r in mine]
        for i, r in enumerate(mine):
            past = vs[max(0, i - 24) : i]
            expected[(sid, r[1], r[2])] = (
                vs[i - 1] if i >= 1 else None,
                vs[i - 2] if i >= 2 else None,
                vs[i - 24] if i >= 24 else None,
                sum(past) / len(past) if past else None,
                statistics.stdev(past) if len(past) > 1 else None,
                vs[i + horizon] if i + horizon < len(vs) else None,
            )
    return expected


@pytest.mark.parametrize(
    "options",
    [
        {"split_above": None},
        {"split_above": 1_000},
        {"split_above": 10},
        {"split_above": 3},
        {"split_above": 70},
    ],
)
@pytest.mark.parametrize("horizon", [1, 3])
def test_row_features_with_and_without_cuts(gappy, options, horizon):
    rows, df = gappy
    out = ops.sequence_features(df, "sid", ["ts", "tie"], "v", horizon=horizon, **options)
    expected = brute(rows, horizon)
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        want = expected[(r.sid, r.ts, r.tie)]
        have = (r.lag_1h, r.lag_2h, r.lag_24h, r.roll_mean_24h, r.roll_std_24h, r[f"y_t_plus_{horizon}h"])
        for a, b in zip(have, want):
            assert (a is None) == (b is None)
            assert a is None or a == pytest.approx(b, abs=1e-9)


def test_plain_plan_has_one_shuffle(gappy):
    out = ops.sequence_features(gappy[1], "sid", ["ts", "tie"], "v", split_above=None)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_clock_lags_differ_from_row_lags(spark):
    rows = [("a", START + dt.timedelta(hours=h), float(h)) for h in (0, 1, 3, 24, 25)]
    df = spark.createDataFrame(rows, "sid string, ts timestamp, v double")
    got = {r.ts: r for r in ops.clock_lags(df, "sid", "ts", "v").collect()}
    at = lambda h: got[START + dt.timedelta(hours=h)]
    assert at(3).clock_lag_1h is None and at(3).clock_lag_2h == 1.0
    assert at(24).clock_lag_24h == 0.0 and at(25).clock_lag_24h == 1.0
    assert len(got) == len(rows)


def test_hourly_joins_fill(spark):
    df = spark.createDataFrame([(START,), (START + dt.timedelta(hours=1),)], "ts_hour timestamp")
    feed = spark.createDataFrame(
        [(START + dt.timedelta(minutes=m), s) for m, s in ((5, "Severe"), (50, "x"))] + [(None, "Minor")],
        "ts timestamp, severity string",
    )
    counts = ops.attach_hourly(df, ops.hourly_event_counts(feed, "ts")).orderBy("ts_hour").collect()
    assert [r.tfl_disruptions_hour for r in counts] == [2, 0]
    by_hour = feed.selectExpr("date_trunc('hour', ts) as h", "severity")
    scores = ops.attach_hourly(df, ops.hourly_severity(by_hour, "h", "severity"), 0.0)
    assert [r.avg_severity for r in scores.orderBy("ts_hour").collect()] == [1.5, 0.0]


def test_gold_features_drops_ends(spark):
    rows = [(1, START + dt.timedelta(hours=h), float(h)) for h in range(5)] + [(2, START, 1.0)]
    df = spark.createDataFrame(rows, "count_point_id long, ts_hour timestamp, all_motor_vehicles double")
    out = ops.gold_features(df, "London", horizon=2)
    assert [(r.ts_hour.hour, r.y_t_plus_2h) for r in out.orderBy("ts_hour").collect()] == [(1, 3.0), (2, 4.0)]
    monday = out.first()
    assert (monday.day_of_week, monday.is_weekend, monday.region) == (2, 0, "London")


@pytest.mark.parametrize("split_above", [5, 20, 42])
def test_rows_without_a_time_when_a_series_is_cut(spark, split_above):
    start = dt.datetime(2024, 1, 1)
    rows = [("a", None, k, float(k)) for k in range(3)]
    rows += [("a", start + dt.timedelta(minutes=k), k, float(k * k)) for k in range(40)]
    rows += [(None, start, k, 1.0 + k) for k in range(50)] + [("b", None, 0, 2.0), ("b", start, 1, 3.0)]
    df = spark.createDataFrame(rows, "sid string, ts timestamp, tie int, v double")
    plain = ops.sequence_features(df, "sid", ["ts", "tie"], "v", split_above=None).collect()
    cut = ops.sequence_features(df, "sid", ["ts", "tie"], "v", split_above=split_above).collect()

    def shown(rows):
        return sorted(str([round(x, 9) if isinstance(x, float) else x for x in r]) for r in rows)

    assert shown(cut) == shown(plain)


def test_a_series_of_one_timestamp_is_cut_without_comparing_rows_with_cuts(spark):
    rows = [("a", START, k, float(k % 7)) for k in range(3_000)]
    df = spark.createDataFrame(rows, "sid string, ts timestamp, tie int, v double").repartition(3)
    out = ops.sequence_features(df, "sid", ["ts", "tie"], "v", split_above=40)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert "_cuts" not in plan and any("_block" in line for line in windows)
    got = {r.tie: r for r in out.collect()}
    assert len(got) == len(rows)
    assert all(got[k].lag_24h == (rows[k - 24][3] if k >= 24 else None) for k in got)
    assert all(got[k].y_t_plus_1h == (rows[k + 1][3] if k + 1 < len(rows) else None) for k in got)
