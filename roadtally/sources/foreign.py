"""Tables of other makers: columns found by their known names, typed, with conflicts reported."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from roadtally.functions.columns import LAT_NAMES, LENGTH_NAMES, LON_NAMES, NODE_NAMES, RATE_NAMES, ROUTE_NAMES, resolve_column
from roadtally.functions.parsing import as_number

# Names of the columns of each layout, in order of preference.
PAIR_FROM, PAIR_TO = ("from_node", "from"), ("to_node", "to")
SRC_NAMES, DST_NAMES = ("src", "from_node", "from", "u"), ("dst", "to_node", "to", "v")
STEP_SRC, STEP_DST = ("src", "u", "source"), ("dst", "v", "target")
WEIGHT_NAMES, PENALTY_NAMES = ("weight_km",), ("penalty_km",)

# Layout: column, its possible names, whether it is a number, whether it must be there.
LAYOUTS = {
    "nodes": [("node_id", NODE_NAMES, False, True), ("lon", LON_NAMES, True, True), ("lat", LAT_NAMES, True, True)],
    "links": [("src", SRC_NAMES, False, True), ("dst", DST_NAMES, False, True), ("length_km", LENGTH_NAMES, True, False)],
    "rates": [("from_node", SRC_NAMES[1:], False, True), ("to_node", DST_NAMES[1:], False, True), ("hotspot_rate", RATE_NAMES, True, True)],
    "routes": [
        ("from_node", PAIR_FROM, False, True),
        ("to_node", PAIR_TO, False, True),
        ("route", ROUTE_NAMES, False, True),
        ("src", STEP_SRC, False, True),
        ("dst", STEP_DST, False, True),
        ("length_km", LENGTH_NAMES, True, False),
        ("weight_km", WEIGHT_NAMES, True, False),
        ("hotspot_rate", RATE_NAMES, True, False),
        ("penalty_km", PENALTY_NAMES, True, False),
    ],
}


def resolved_names(columns: list[str], layout: str) -> dict[str, str | None]:
    """The column of the table behind each column of the layout, None for one that may be absent.

    Raises an error that names every missing column and every column two roles would share.
    """
    found: dict[str, str | None] = {}
    missing = []
    for role, names, _, needed in LAYOUTS[layout]:
        try:
            found[role] = resolve_column(columns, names)
        except ValueError:
            found[role] = None
            if needed:
                missing.append(f"{role} (one of {list(names)})")
    if missing:
        raise ValueError(f"{layout}: no column for {', '.join(missing)}; have {columns}")
    chosen = [c for c in found.values() if c is not None]
    shared = sorted({c for c in chosen if chosen.count(c) > 1})
    if shared:
        raise ValueError(f"{layout}: columns {shared} would serve several roles of {found}")
    return found


def resolved(df: DataFrame, layout: str, *kept: str) -> DataFrame:
    """``df`` in the named layout, with the columns ``kept`` as they are and ``conflicts``.

    Ids become text and numbers doubles; an absent optional column is NULL. ``conflicts`` lists the
    columns whose value is there but is no number; such a value is NULL and its row stays.
    """
    found = resolved_names([c for c in df.columns if c not in kept], layout)
    columns, unread = [], []
    for role, _, numeric, _ in LAYOUTS[layout]:
        name = found[role]
        raw = F.lit(None).cast("string") if name is None else F.col(f"`{name}`").cast("string")
        value = as_number(raw, "double") if numeric else raw
        columns.append(value.alias(role))
        if numeric and name is not None:
            unread.append(F.when(raw.isNotNull() & (F.trim(raw) != "") & value.isNull(), F.lit(role)))
    conflicts = F.array_compact(F.array(*unread)) if unread else F.array().cast("array<string>")
    return df.select(*columns, *kept, conflicts.alias("conflicts"))
