"""Short forked routes are walked in rows of their own, longer ones spliced; both by one rule."""

from __future__ import annotations

from test_trails import LAYOUT, trails, walk

from roadtally.operators import layers, trails as splicing

STOPS = ["s", "a", "b", "c", "t"]
EIGHTS = [e for h, n in zip(STOPS, STOPS[1:]) for e in [(h, h + "x"), (h + "x", h + "y"), (h + "y", h + "x"), (h + "x", h), (h, n)]]
ROUTES = {
    "eights": EIGHTS,
    "short": [("s", "u"), ("u", "s"), ("s", "t")],
    "astray": [("s", "u"), ("s", "v"), ("u", "s"), ("v", "s")],
    "lost": [("s", None), ("s", "t")],
}


def test_short_and_long_routes_at_once(spark, monkeypatch):
    monkeypatch.setattr(splicing, "ROW_EDGES", 10)
    got = trails(spark, ROUTES)
    assert {name: got[name] for name in ("eights", "short", "astray")} == {
        name: walk(ROUTES[name], "s", "t") for name in ("eights", "short", "astray")
    }
    assert got["lost"][0] == "s"


def test_short_routes_take_no_rounds(spark, monkeypatch):
    """No route is spliced, and rows of a route without a name are no error."""
    monkeypatch.setattr(splicing, "_spliced", None)
    rows = [("s", "t", name, *e, i) for name, edges in ROUTES.items() for i, e in enumerate(edges)]
    rows += [("s", "t", None, "s", "u", 1), ("s", "t", None, "s", "t", 2)]
    steps = layers.order_steps(spark.createDataFrame(rows, LAYOUT), "n").collect()
    assert [r.node for r in sorted((r for r in steps if r.route == "eights"), key=lambda r: r.step)] == walk(EIGHTS, "s", "t")
