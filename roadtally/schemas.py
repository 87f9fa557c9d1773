"""Column layouts of the layers, stated once; schemas are DDL text as readers take it."""

from __future__ import annotations

# Columns a raw count file must have, and those it may have.
REQUIRED_COUNTS = (
    "count_date",
    "hour",
    "count_point_id",
    "start_junction_road_name",
    "end_junction_road_name",
    "all_motor_vehicles",
    "link_length_km",
)
COUNT_TYPES = {
    "hour": "int",
    "count_point_id": "bigint",
    "link_length_km": "double",
    "latitude": "double",
    "longitude": "double",
    "all_motor_vehicles": "double",
    "all_hgvs": "double",
}
OPTIONAL_COUNTS = ("latitude", "longitude", "all_hgvs")

# Columns kept from the national file for one region.
REGION_COLUMNS = (
    "year",
    "count_date",
    "hour",
    "region_name",
    "local_authority",
    "road_name",
    "latitude",
    "longitude",
    "all_hgvs",
    "all_motor_vehicles",
)

# Model inputs, used when present.
MODEL_FEATURES = (
    "hour_of_day",
    "day_of_week",
    "is_weekend",
    "month",
    "year",
    "all_motor_vehicles",
    "all_hgvs",
    "lag_1h",
    "lag_2h",
    "lag_24h",
    "roll_mean_24h",
    "roll_std_24h",
    "tfl_disruptions_hour",
    "link_length_km",
)

# Columns that are never model inputs when features are chosen by type.
NON_FEATURES = (
    "count_date",
    "region_name",
    "region_ons_code",
    "region",
    "start_junction_road_name",
    "end_junction_road_name",
)

DISRUPTION_JSON = (
    "id string, category string, subCategory string, severity string, statusSeverity string, "
    "severityDescription string, statusSeverityDescription string, location string, "
    "comments string, corridorIds array<string>, roadDisruptionLines array<string>, "
    "startDateTime string, endDateTime string"
)

NODES = ("node_id string, lon double, lat double, n_rows bigint")
EDGES = ("src string, dst string, length_km double, n_rows bigint")
EDGE_RATES = (
    "from_node string, to_node string, hotspot_rate double, avg_pred double, n_rows bigint"
)
ROUTE_EDGES = (
    "from_node string, to_node string, route string, step int, src string, dst string, "
    "length_km double, hotspot_rate double, weight_km double, penalty_km double"
)
FOLD_METRICS = (
    "fold int, model string, train_end timestamp, test_end timestamp, train_rows bigint, "
    "test_rows bigint, rmse double, mae double, r2 double, geh_pct_lt5 double"
)
