"""Column names: normalising, resolving, requiring, choosing."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame

from roadtally.schemas import MODEL_FEATURES, NON_FEATURES

# Candidate names by role, in order of preference.
FROM_NAMES = ("from_node", "start_junction_road_name", "start_junction", "from", "src", "u", "source")
TO_NAMES = ("to_node", "end_junction_road_name", "end_junction", "to", "dst", "v", "target")
LON_NAMES = ("lon", "longitude", "lng", "x")
LAT_NAMES = ("lat", "latitude", "y")
LENGTH_NAMES = ("length_km", "link_length_km", "len_km", "distance_km")
RATE_NAMES = ("hotspot_rate", "rate", "risk", "congestion_rate")
NODE_NAMES = ("node", "node_id", "id", "name")
ROUTE_NAMES = ("route", "route_type", "strategy")
EVENT_TIME_NAMES = (
    "timestamp",
    "datetime",
    "date_time",
    "start_time",
    "start_datetime",
    "created",
    "publish_date",
    "last_modified",
    "time",
)
SERIES_NAMES = ("segment_id", "count_point_id")
VOLUME_NAMES = ("volume", "all_motor_vehicles")

# The numeric types a feature may have.
NUMERIC_TYPES = {"tinyint", "smallint", "int", "bigint", "float", "double"}


def snake_name(name: str) -> str:
    bare = re.sub("[\ufeff()]", "", name.strip())
    return re.sub(r"[-/ _]+", "_", bare).lower()


def snake_columns(df: DataFrame) -> DataFrame:
    names = [snake_name(c) for c in df.columns]
    clashes = sorted(n for n, times in Counter(names).items() if times > 1)
    if clashes:
        raise ValueError(f"columns collide after renaming: {clashes}")
    return df.toDF(*names)


def require_columns(df: DataFrame, needed: Iterable[str]) -> DataFrame:
    missing = [c for c in needed if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")
    return df


def _plain(name: str) -> str:
    return re.sub(r"[^0-9a-z]", "", name.lower())


def resolve_column(
    columns: Sequence[str], candidates: Sequence[str], explicit: str | None = None
) -> str:
    """The first candidate that is a column, by exact and then by normalised name.

    There is no substring match: ``to`` must not find ``all_motor_vehicles``.
    """
    if explicit is not None:
        if explicit not in columns:
            raise ValueError(f"no column {explicit!r} in {list(columns)}")
        return explicit
    exact = next((c for c in candidates if c in columns), None)
    if exact is not None:
        return exact
    by_plain = {_plain(c): c for c in reversed(columns)}
    found = next((by_plain[_plain(c)] for c in candidates if _plain(c) in by_plain), None)
    if found is None:
        raise ValueError(f"none of {list(candidates)} in {list(columns)}")
    return found


def event_time_column(df: DataFrame, explicit: str | None = None) -> str:
    """The time column of an event feed, by one of its known names; others have to be named."""
    return resolve_column(df.columns, EVENT_TIME_NAMES, explicit)


def series_and_volume(df: DataFrame) -> tuple[str, str]:
    return resolve_column(df.columns, SERIES_NAMES), resolve_column(df.columns, VOLUME_NAMES)


def typed_features(df: DataFrame, label: str, time_col: str, at_least: int = 3) -> list[str]:
    """Every numeric column but the label, the time and the named non-features."""
    barred = {label, time_col, *NON_FEATURES}
    chosen = [c for c, t in df.dtypes if t in NUMERIC_TYPES and c not in barred]
    if len(chosen) < at_least:
        raise ValueError(f"only {len(chosen)} numeric features: {chosen}")
    return chosen


def listed_features(df: DataFrame, wanted: Sequence[str] = MODEL_FEATURES) -> list[str]:
    chosen = [c for c in wanted if c in df.columns]
    if not chosen:
        raise ValueError(f"none of the features {list(wanted)} in {df.columns}")
    return chosen
