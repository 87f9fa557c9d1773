"""Cleaning and parsing on small inline rows."""

from __future__ import annotations

import datetime as dt

import pytest

from roadtally.functions import parsing
from roadtally.functions.columns import (
    FROM_NAMES,
    TO_NAMES,
    listed_features,
    event_time_column,
    resolve_column,
    series_and_volume,
    snake_columns,
    snake_name,
    typed_features,
)
from roadtally.operators import cleaning


def values(df, column):
    return [r[column] for r in df.collect()]


@pytest.fixture
def dirty(spark):
    texts = ["NULL", "null", " NA ", "N/A", "NaN", " ", "", "1,234.5", "-3", "abc", None, " none "]
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")


def test_exact_tokens_keep_other_spellings(dirty):
    assert values(parsing.null_tokens(dirty).orderBy("id"), "t") == [
        None, None, " NA ", "N/A", None, None, None, "1,234.5", "-3", "abc", None, " none ",
    ]


def test_folded_tokens_keep_nan(dirty):
    assert values(parsing.null_tokens(dirty, fold_case=True).orderBy("id"), "t") == [
        None, None, None, None, "NaN", None, None, "1,234.5", "-3", "abc", None, None,
    ]


def test_numbers_never_throw(spark):
    texts = ["7", "7.0", " 7.9 ", "-3", "abc", "", None, "1e3", "12345678901234567", "99999999999999999999"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    whole = values(df.select("id", parsing.to_number(df, "t", "bigint").alias("n")).orderBy("id"), "n")
    assert whole == [7, 7, 7, -3, None, None, None, 1000, 12345678901234567, None]
    real = values(df.select("id", parsing.to_number(df, "t").alias("n")).orderBy("id"), "n")
    assert real[:5] == [7.0, 7.0, 7.9, -3.0, None]


def test_hour_timestamps(spark):
    rows = [
        ("2020-06-26", "7"), ("21/05/2004", "7.0"), ("31/02/2004", "3"), (None, "1"),
        ("2020-06-26", "23"), ("2020-06-26", "24"), ("2020-06-26", "x"), ("21/05/2004", "0"),
        ("2004-05-21 00:00:00", "5"), (" 2004-05-21", "6"), ("21/05/2004 10:00", "7"),
    ]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, d string, h string")
    got = values(df.select("id", parsing.hour_timestamp(df, "d", "h").alias("t")).orderBy("id"), "t")
    assert got == [
        dt.datetime(2020, 6, 26, 7), dt.datetime(2004, 5, 21, 7), None, None,
        dt.datetime(2020, 6, 26, 23), None, None, dt.datetime(2004, 5, 21, 0),
        dt.datetime(2004, 5, 21, 5), dt.datetime(2004, 5, 21, 6), dt.datetime(2004, 5, 21, 7),
    ]


def test_event_times(spark):
    texts = ["2024-01-02T03:04:05", "02/01/2024 03:04", "02/01/2024 03:04:05", "2024-01-02 03:04:05", "soon", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    got = values(df.select("id", parsing.parse_event_time("t").alias("t")).orderBy("id"), "t")
    full, minute = dt.datetime(2024, 1, 2, 3, 4, 5), dt.datetime(2024, 1, 2, 3, 4)
    assert got == [full, minute, full, full, None, None]


def test_severity(spark):
    words = ["Severe", "Serious", "Moderate", "Minor", "Other", None]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "id int, w string")
    got = values(df.select("id", parsing.severity_score("w").alias("s")).orderBy("id"), "s")
    assert got == [3.0, 2.0, 1.0, 1.0, 0.0, 0.0]


def test_clip_counts_missing_as_zero_first(spark):
    df = spark.createDataFrame([(-1.0,), (0.5,), (2.0,), (None,)], "r double")
    got = values(df.select(parsing.clip(df.r, 0.1, 1.0).alias("r")), "r")
    assert got == [0.1, 0.5, 1.0, 0.1]


def test_names():
    assert snake_name("Link Length (km)/A-B") == "link_length_km_a_b"
    assert snake_name("All__HGVs") == "all_hgvs"


def test_colliding_names_are_refused(spark):
    with pytest.raises(ValueError, match="a_b"):
        snake_columns(spark.createDataFrame([(1, 2)], "`a-b` int, `A B` int"))


def test_column_resolution_has_no_substring_match():
    columns = ["all_motor_vehicles", "Start Junction Road Name", "end_junction_road_name"]
    assert resolve_column(columns, FROM_NAMES) == "Start Junction Road Name"
    assert resolve_column(columns, TO_NAMES) == "end_junction_road_name"
    with pytest.raises(ValueError):
        resolve_column(["all_motor_vehicles"], ("to",))
    with pytest.raises(ValueError):
        resolve_column(columns, FROM_NAMES, explicit="nope")


def test_role_columns(spark):
    df = spark.createDataFrame([], "count_point_id long, segment_id long, all_motor_vehicles double")
    assert series_and_volume(df) == ("segment_id", "all_motor_vehicles")
    feed = spark.createDataFrame([], "candidate_id int, last_seen_date string")
    with pytest.raises(ValueError):
        event_time_column(feed)
    assert event_time_column(feed, "last_seen_date") == "last_seen_date"


def test_feature_choice(spark):
    df = spark.createDataFrame(
        [], "ts_hour timestamp, y double, region string, lag_1h double, month int, all_hgvs double, z float"
    )
    assert typed_features(df, "y", "ts_hour") == ["lag_1h", "month", "all_hgvs", "z"]
    assert listed_features(df) == ["month", "all_hgvs", "lag_1h"]
    with pytest.raises(ValueError):
        typed_features(df.select("ts_hour", "y", "month"), "y", "ts_hour")


def test_clean_counts_drops_and_types(spark):
    raw = spark.createDataFrame(
        [
            ("1", "2020-06-26", "7.0", "A1", "A2", "100", "1.5", "NULL"),
            ("2", "21/05/2004", "8", "A1", " null ", "100", "1.5", "3"),
            ("3", "31/02/2004", "8", "A1", "A2", "100", "1.5", "3"),
            ("4", "21/05/2004", "8", "A1", "A2", "NaN", "1.5", "3"),
        ],
        "count_point_id string, count_date string, hour string, start_junction_road_name string, "
        "end_junction_road_name string, all_motor_vehicles string, link_length_km string, `all_HGVs` string",
    )
    (row,) = cleaning.clean_counts(raw).collect()
    assert (row.count_point_id, row.hour, row.p_year, row.p_month) == (1, 7, 2020, "06")
    assert row.all_hgvs is None and row.latitude is None
    with pytest.raises(ValueError, match="hour"):
        cleaning.clean_counts(raw.drop("hour"))


def test_numbers_by_content_ignore_missing_values(spark):
    rows = [(str(i), "NULL" if i % 2 else "1,234", "x" if i % 3 == 0 else "5", "9") for i in range(12)]
    raw = spark.createDataFrame(rows, "id string, half string, mixed string, `road name` string")
    clean = cleaning.clean_any(raw, "London")
    types = dict(clean.dtypes)
    assert types["id"] == types["half"] == "double"
    assert types["mixed"] == types["road_name"] == "string"
    assert clean.where("half = 1234").count() == 6
    assert set(values(clean, "region")) == {"London"}
    assert cleaning.numeric_columns(parsing.null_tokens(snake_columns(raw), True), sample_rows=6)


def test_region_tag_keeps_an_existing_one(spark):
    df = spark.createDataFrame([("Leeds",)], "region string")
    assert values(cleaning.tag_region(df, "London"), "region") == ["Leeds"]


def test_region_extract_keeps_known_columns(spark):
    raw = spark.createDataFrame(
        [("London", "2019", "X", "5"), ("London", "2018", "X", "5"), ("Wales", "2020", "X", "5")],
        "region_name string, year string, local_authority_name string, `all_HGVs` string",
    )
    out = cleaning.region_extract(raw, "London", 2019)
    assert out.columns == ["year", "region_name", "local_authority", "all_hgvs"]
    assert out.count() == 1


def test_report_rules(spark):
    df = spark.createDataFrame([(1, h, v) for h, v in enumerate([-1.0, 1.0, 2.0, 900.0])], "k int, h int, v double")
    assert cleaning.drop_negative(df, "v").count() == 3
    assert max(values(cleaning.cap_by_key(df, "k", "v", 0.5), "v")) == 1.0
    assert cleaning.range_violations(df, {"v": (0, 100), "h": (0, 2)}).first().asDict() == {
        "n_rows": 4, "bad_v": 2, "bad_h": 1,
    }
    assert cleaning.within_ranges(df, {"v": (0, 100)}).count() == 2
    twice = df.unionAll(df.selectExpr("k", "h", "v + 1"))
    latest = cleaning.latest_per_key(twice, ["k", "h"], [twice.v.desc()])
    assert sorted(values(latest, "v")) == [0.0, 2.0, 3.0, 901.0]
