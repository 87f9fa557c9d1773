"""Road graph as two tables: nodes and edges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from roadtally.functions.columns import (
    FROM_NAMES,
    LAT_NAMES,
    LENGTH_NAMES,
    LON_NAMES,
    RATE_NAMES,
    TO_NAMES,
    resolve_column,
)
from roadtally.functions.parsing import clip, to_number
from roadtally.operators.quantiles import weighted_medians

# Penalty strength and the shortest link kept.
ALPHA = 2.0
MIN_LENGTH_KM = 0.001


def clean_links(
    df: DataFrame,
    *,
    columns: dict[str, str] | None = None,
    min_length_km: float = MIN_LENGTH_KM,
    drop_missing_coords: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per usable link observation: ``src, dst, lon, lat, length_km``.

    ``columns`` names the source column of a role where the usual names do not apply; columns of
    ``keep`` come out as they are.
    """
    given = columns or {}
    roles = {
        "src": FROM_NAMES,
        "dst": TO_NAMES,
        "lon": LON_NAMES,
        "lat": LAT_NAMES,
        "length_km": LENGTH_NAMES,
    }
    found = {r: resolve_column(df.columns, names, given.get(r)) for r, names in roles.items()}
    links = df.select(
        *[F.trim(F.col(found[r]).cast("string")).alias(r) for r in ("src", "dst")],
        *[to_number(df, found[r]).alias(r) for r in ("lon", "lat", "length_km")],
        *keep,
    ).where((F.col("src") != "") & (F.col("dst") != "") & (F.col("length_km") >= min_length_km))
    return links.dropna(subset=["lon", "lat"]) if drop_missing_coords else links


def edge_table(links: DataFrame, flag: Column | None = None, **more: Column) -> DataFrame:
    """One row per edge; ``flag`` is 0 or 1 where a link was judged, and its mean ``hotspot_rate``.

    With ``flag``, links are grouped once for both, and the rates need no join of their own. Aggregates
    of ``more`` come out under their names.
    """
    rate = [] if flag is None else [F.avg(flag).alias("hotspot_rate")]
    return links.groupBy("src", "dst").agg(
        F.avg("length_km").alias("length_km"), F.count(F.lit(1)).alias("n_rows"), *rate,
        *[c.alias(name) for name, c in more.items()],
    )


def endpoints(links: DataFrame) -> DataFrame:
    """Both ends of every link as rows, from a single scan.

    Each end gets the position of the counting point, so a node lies amid its links.
    """
    return links.select(F.explode(F.array("src", "dst")).alias("node_id"), "lon", "lat")


def node_table(links: DataFrame, how: str = "mean") -> DataFrame:
    """Position and row count per node.

    For the median, rows are first counted per node and distinct coordinate, which happens map-side;
    :func:`weighted_medians` takes the counts and orders few coordinates of a node in any task.
    """
    ends = endpoints(links)
    if how == "mean":
        return ends.groupBy("node_id").agg(
            F.avg("lon").alias("lon"), F.avg("lat").alias("lat"), F.count(F.lit(1)).alias("n_rows")
        )
    if how != "median":
        raise ValueError(f"how must be mean or median, not {how!r}")
    places = ends.groupBy("node_id", "lon", "lat").agg(F.count(F.lit(1)).alias("n"))
    medians = weighted_medians(places, "node_id", ["lon", "lat"], "n")
    return medians.withColumnRenamed("n", "n_rows")


def undirected(edges: DataFrame) -> DataFrame:
    """Both directions of every edge with equal values.

    Where the two directions disagree, the row with the larger ``src`` holds for both.
    """
    values = [c for c in edges.columns if c not in ("src", "dst")]
    pairs = edges.groupBy(
        F.least("src", "dst").alias("low"), F.greatest("src", "dst").alias("high")
    ).agg(F.max_by(F.struct(*values), "src").alias("v"))
    ways = F.array_distinct(
        F.array(
            F.struct(F.col("low").alias("src"), F.col("high").alias("dst")),
            F.struct(F.col("high").alias("src"), F.col("low").alias("dst")),
        )
    )
    return pairs.select(F.explode(ways).alias("way"), "v").select("way.*", "v.*")


def weight_edges(
    edges: DataFrame,
    rates: DataFrame | None,
    alpha: float = ALPHA,
    clip_min: float = 0.0,
    clip_max: float = 1.0,
) -> DataFrame:
    """Lengthen each edge by its hotspot rate; an edge without a rate keeps its length.

    Without ``rates`` the edges carry their ``hotspot_rate`` themselves.
    """
    if alpha < 0:
        raise ValueError("alpha must not be negative: weights could drop below zero")
    if rates is None:
        own = clip(to_number(edges, "hotspot_rate"), clip_min, clip_max)
        return _lengthened(edges.withColumn("hotspot_rate", own), alpha)
    src = resolve_column(rates.columns, ("src", *FROM_NAMES))
    dst = resolve_column(rates.columns, ("dst", *TO_NAMES))
    rate = to_number(rates, resolve_column(rates.columns, RATE_NAMES))
    clipped = rates.select(
        F.col(src).alias("src"),
        F.col(dst).alias("dst"),
        clip(rate, clip_min, clip_max).alias("hotspot_rate"),
    )
    return _lengthened(edges.join(clipped, ["src", "dst"], "left"), alpha)


def _lengthened(joined: DataFrame, alpha: float) -> DataFrame:
    joined = joined.fillna({"hotspot_rate": 0.0})
    weight = F.col("length_km") * (F.lit(1.0) + F.lit(float(alpha)) * F.col("hotspot_rate"))
    return joined.withColumns({"weight_km": weight, "penalty_km": weight - F.col("length_km")})


def graph_nodes(edges: DataFrame) -> DataFrame:
    """The distinct node ids an edge table mentions."""
    return edges.select(F.explode(F.array("src", "dst")).alias("node_id")).distinct()


def graph_counts(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row with the number of nodes and of edges."""
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    marks = nodes.select(one.alias("n"), none.alias("e")).unionAll(edges.select(none, one))
    return marks.agg(
        F.coalesce(F.sum("n"), none).alias("nodes"), F.coalesce(F.sum("e"), none).alias("edges")
    )
