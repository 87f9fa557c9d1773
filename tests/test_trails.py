"""Trails of routes with forks, loops within loops, and rows in the order of their files."""

from __future__ import annotations

import random

from roadtally.operators import layers, trails as splicing

LAYOUT = "from_node string, to_node string, route string, src string, dst string, n int"


def walk(edges: list[tuple[str, str]], start: str, end: str) -> list[str]:
    """The same rule edge by edge; rows in order where it does not reach the end."""
    left = list(dict.fromkeys(edges))
    seq = [start]
    while seq[-1] != end:
        step = next((e for e in left if e[0] == seq[-1]), None)
        if step is None:
            return [edges[0][0], *[d for _, d in edges]]
        left.remove(step)
        seq.append(step[1])
    return seq


def trails(spark, routes: dict[str, list[tuple[str, str]]]) -> dict[str, list[str]]:
    rows = [("s", "t", name, *e, i) for name, edges in routes.items() for i, e in enumerate(edges)]
    random.Random(1).shuffle(rows)
    found: dict[str, dict[int, str]] = {}
    for r in layers.order_steps(spark.createDataFrame(rows, LAYOUT), "n").collect():
        assert r.step not in found.setdefault(r.route, {})
        found[r.route][r.step] = r.node
    return {name: [steps[i] for i in range(len(steps))] for name, steps in found.items()}


def test_random_forked_routes(spark, monkeypatch):
    """Many small multigraphs at once, all spliced, against the walk edge by edge."""
    monkeypatch.setattr(splicing, "WALKED_EDGES", 0)
    rng = random.Random(7)
    routes = {}
    for i in range(40):
        names = ["s", "t", *"abcde"[: rng.randint(1, 5)]]
        routes[f"r{i}"] = [(rng.choice(names), rng.choice(names)) for _ in range(rng.randint(1, 9))]
    got = trails(spark, routes)
    assert got == {name: walk(edges, "s", "t") for name, edges in routes.items()}


def test_loops_take_few_jobs(spark):
    """A line of 15 figure eights, each with a loop within its loop: a bounded number of jobs an edge."""
    stops = ["s", *[f"m{i}" for i in range(14)], "t"]
    edges = []
    for here, there in zip(stops, stops[1:]):
        edges += [(here, f"{here}x"), (f"{here}x", f"{here}y"), (f"{here}y", f"{here}x"), (f"{here}x", here), (here, there)]
    tracker = spark.sparkContext.statusTracker()
    group = "trail jobs"
    spark.sparkContext.setJobGroup(group, group)
    try:
        got = trails(spark, {"r": edges})
        jobs = len(tracker.getJobIdsForGroup(group))
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert got["r"] == walk(edges, "s", "t") and len(got["r"]) == 76
    assert jobs < 4 * len(edges)  # 266 measured


def test_loops_at_the_start_rings_and_nulls(spark, monkeypatch):
    monkeypatch.setattr(splicing, "WALKED_EDGES", 0)
    routes = {
        "loop": [("s", "s"), ("s", "t"), ("s", "u")],
        "ring": [("a", "b"), ("b", "a"), ("s", "c"), ("s", "d"), ("c", "s"), ("d", "t")],
        "away": [("a", "b"), ("b", "a"), ("a", "c")],
    }
    got = trails(spark, routes | {"null": [("s", None), ("s", "t")]})
    assert {name: got[name] for name in routes} == {name: walk(edges, "s", "t") for name, edges in routes.items()}
    assert got["null"][0] == "s"
