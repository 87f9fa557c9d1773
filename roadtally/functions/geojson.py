"""GeoJSON features as structs and as text; ``to_json`` leaves out absent properties."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def position(lon: str, lat: str) -> Column:
    return F.array(F.col(lon).cast("double"), F.col(lat).cast("double"))


def line_feature(coordinates: Column, properties: Sequence[Column | str]) -> Column:
    return F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.lit("LineString").alias("type"), coordinates.alias("coordinates")).alias(
            "geometry"
        ),
        F.struct(*properties).alias("properties"),
    )


def feature_text(feature: Column) -> Column:
    return F.to_json(feature)
