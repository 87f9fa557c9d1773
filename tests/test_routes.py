"""Paths and routes: the golden pair, a brute-force search, geometry rules, rebuilt order."""

from __future__ import annotations

import heapq
import json
import random

import pytest

from roadtally.operators import graph, layers, paths, routes
from roadtally.plans import queries_routes, stand_ins

RATE = 0.5217391304347826
GOLDEN = [
    ("A407", "A5", 2.1, 0.0),
    ("A5", "A41", 0.4, 0.0),
    ("A41", "LA Boundary", 1.5, RATE),
    ("LA Boundary", "A221", 2.6, 0.0),
    ("A221", "A206", 3.4, 0.0),
    ("A206", "Bugsby's Way", 0.9, 0.0),
    ("A407", "A406", 2.1, 0.0),
    ("A406", "A504", 1.3652173913043475, 0.0),
    ("A504", "LA Boundary", 0.8, 0.0),
]


@pytest.fixture(scope="module")
def golden(spark):
    rows = spark.createDataFrame(GOLDEN, "src string, dst string, length_km double, hotspot_rate double")
    edges = graph.weight_edges(rows.drop("hotspot_rate"), rows.where("hotspot_rate > 0"))
    pairs, found = routes.find_routes(edges, ["A407"], ["Bugsby's Way"])
    return edges, pairs, found


def test_golden_edges(golden):
    edge = golden[0].where("src = 'A41'").first()
    assert edge.weight_km == pytest.approx(3.065217391304348)
    assert edge.penalty_km == pytest.approx(1.565217391304348)


def test_golden_paths(golden):
    text = {r.route: r.path for r in routes.path_text(golden[2]).collect()}
    assert text == {
        "shortest_distance": "A407 -> A5 -> A41 -> LA Boundary -> A221 -> A206 -> Bugsby's Way",
        "avoid_hotspots": "A407 -> A406 -> A504 -> LA Boundary -> A221 -> A206 -> Bugsby's Way",
    }


def test_golden_comparison(golden):
    row = routes.compare_routes(golden[1], golden[2]).first()
    assert row.reachable and not row.same_path
    assert row.short_len_km == pytest.approx(10.9)
    assert row.short_weight_km == pytest.approx(12.465217391304348)
    assert row.avoid_len_km == row.avoid_weight_km == pytest.approx(11.165217391304347)
    assert (row.short_hot_edges, row.avoid_hot_edges, row.delta_hot_edges) == (1, 0, 1)
    assert row.short_hot_share_pct == pytest.approx(100 / 6)
    assert row.short_avg_hotspot == pytest.approx(RATE / 6) and row.short_max_hotspot == RATE
    assert row.delta_len_km == pytest.approx(0.265217391304347)
    assert row.delta_weight_km == pytest.approx(-1.3)
    assert (row.explain_removed_edges, row.explain_removed_risky_edges) == (3, 1)
    assert row.explain_reason == routes.BYPASSED
    assert row.explain_removed_risky_top5 == "A41->LA Boundary (risk=0.522, penalty=1.565)"


def test_high_threshold_still_counts_penalty_as_risk(golden):
    row = routes.compare_routes(golden[1], golden[2], hot_above=0.9).first()
    assert (row.short_hot_edges, row.explain_removed_risky_edges) == (0, 1)


def dijkstra(edges, source, cost):
    out = {}
    for e in edges:
        out.setdefault(e["src"], []).append((e["dst"], e[cost]))
    best, heap = {}, [(0.0, source)]
    while heap:
        d, n = heapq.heappop(heap)
        if n in best:
            continue
        best[n] = d
        for m, c in out.get(n, []):
            heapq.heappush(heap, (d + c, m))
    return best


@pytest.fixture(scope="module")
def random_graph(spark):
    rng = random.Random(3)
    rows = []
    for a in range(40):
        for b in rng.sample(range(46), 3):
            rows.append({"src": f"n{a}", "dst": f"n{b}", "length_km": rng.randint(0, 40) / 8, "w": 0.0})
    for r in rows:
        r["weight_km"] = r["length_km"] * (1 + 2 * rng.choice([0, 0, 0.25, 0.5, 1]))
    rows = [dict(r) for r in {(r["src"], r["dst"]): r for r in rows}.values()]
    df = spark.createDataFrame(
        [(r["src"], r["dst"], r["length_km"], r["weight_km"]) for r in rows],
        "src string, dst string, length_km double, weight_km double",
    )
    return rows, df


def test_paths_match_a_plain_search(spark, random_graph):
    rows, df = random_graph
    sources = spark.createDataFrame([("n0",), ("n7",)], "source string")
    tree = paths.shortest_paths(df, sources)
    got = {(r.source, r.metric, r.node): r.dist for r in tree.collect()}
    want = {
        (s, m, n): d
        for s in ("n0", "n7")
        for m, c in paths.ROUTE_COSTS.items()
        for n, d in dijkstra(rows, s, c).items()
    }
    assert got == want
    targets = tree.select("source", tree.node.alias("target")).distinct()
    cost = {(r["src"], r["dst"]): r for r in rows}
    lengths, at = {}, {}
    steps = sorted(paths.path_steps(tree, targets).collect(), key=lambda r: r.step)
    for r in steps:
        key = (r.source, r.metric, r.target)
        assert r.step == at.get(key, (0, r.source))[0] + 1 and r.src == at.get(key, (0, r.source))[1]
        at[key] = (r.step, r.dst)
        lengths[key] = lengths.get(key, 0.0) + cost[r.src, r.dst][paths.ROUTE_COSTS[r.metric]]
    assert all(end[1] == key[2] for key, end in at.items())
    assert {k: v for k, v in want.items() if k[2] != k[0]} == lengths


@pytest.mark.parametrize(
    "bounds",
    [
        {"BROADCAST_ROWS": 0},
        {"BROADCAST_ROWS": 0, "MERGE_ROWS": 0},
        {"MERGE_ROWS": 0},
        {"MERGE_ROWS": 0, "MAX_PARTS": 3},
        {"MERGE_ROWS": 30, "BROADCAST_ROWS": 25},
    ],
)
def test_search_beyond_the_size_bounds(spark, random_graph, monkeypatch, bounds):
    """Shuffle joins, a state left in place, and a switch between the ways give one result."""
    rows, df = random_graph
    for name, value in bounds.items():
        monkeypatch.setattr(paths, name, value)
    if bounds.get("BROADCAST_ROWS") == 0:
        monkeypatch.setattr(paths, "fits", lambda *a: False)
        monkeypatch.setattr(paths, "broadcast_if_small", lambda d, *a, **k: d)
    sources = spark.createDataFrame([("n0",)], "source string")
    tree = paths.shortest_paths(df, sources)
    got = tree.collect()
    for metric, cost in paths.ROUTE_COSTS.items():
        assert {r.node: r.dist for r in got if r.metric == metric} == dijkstra(rows, "n0", cost)
    ends = tree.select("source", tree.node.alias("target")).distinct()
    assert paths.path_steps(tree, ends).count() == sum(r.hops for r in got)


def test_invariants(random_graph):
    edges = random_graph[1].selectExpr("*", "0.0 as hotspot_rate", "weight_km - length_km as penalty_km")
    pairs, found = routes.find_routes(edges, ["n0"])
    rows = routes.compare_routes(pairs, found).collect()
    assert len(rows) == graph.graph_nodes(edges).count() - 1
    for r in rows:
        if not r.reachable:
            assert r.short_len_km is None and r.same_path is None and r.explain_reason is None
            continue
        assert r.short_len_km <= r.avoid_len_km + 1e-9
        assert r.avoid_weight_km <= r.short_weight_km + 1e-9
        if r.same_path:
            assert r.explain_reason == routes.SAME_PATH and r.delta_len_km == 0


def test_ties_prefer_fewer_hops_then_smaller_ids(spark):
    rows = [("s", "b", 1.0), ("b", "t", 1.0), ("s", "a", 1.0), ("a", "t", 1.0), ("s", "u", 2.0), ("a", "u", 1.0), ("t", "t", 0.0)]
    df = spark.createDataFrame(rows, "src string, dst string, length_km double")
    sources = spark.createDataFrame([("s",)], "source string")
    tree = paths.shortest_paths(df, sources, {"d": "length_km"})
    assert {r.node: (r.dist, r.hops, r.pred) for r in tree.collect()} == {
        "s": (0.0, 0, None), "a": (1.0, 1, "s"), "b": (1.0, 1, "s"), "t": (2.0, 2, "a"), "u": (2.0, 1, "s"),
    }


def test_bad_input_is_refused(spark, golden):
    edges = golden[0]
    with pytest.raises(ValueError, match="not in the graph"):
        routes.find_routes(edges, ["nowhere"], ["A5"])
    with pytest.raises(ValueError, match="not in the graph"):
        routes.find_routes(edges, ["A5"], ["nowhere"])
    with pytest.raises(ValueError, match="negative or missing"):
        routes.find_routes(edges.selectExpr("src", "dst", "-length_km as length_km", "weight_km"), ["A5"])
    with pytest.raises(ValueError, match="alpha"):
        graph.weight_edges(edges.select("src", "dst", "length_km"), edges, alpha=-1)


def test_path_to_itself_has_no_edges(golden):
    pairs, found = routes.find_routes(golden[0], ["A5"], ["A5"])
    row = routes.compare_routes(pairs, found).first()
    assert found.count() == 0
    assert row.reachable and row.same_path and row.short_len_km == 0.0 and row.short_n_edges == 0


def test_target_limit_and_counts(golden):
    pairs, _ = routes.find_routes(golden[0], ["LA Boundary"], max_targets=4)
    assert sorted(r.to_node for r in pairs.collect()) == ["A206", "A221", "A406", "A407"]
    assert routes.route_counts(pairs).first().asDict() == {"targets_attempted": 4, "targets_reached": 2}


def test_changed_edges(golden):
    ends = lambda df: sorted((r.src, r.dst) for r in df.collect())
    assert ends(routes.removed_edges(golden[2])) == [("A407", "A5"), ("A41", "LA Boundary"), ("A5", "A41")]
    assert ends(routes.added_edges(golden[2])) == [("A406", "A504"), ("A407", "A406"), ("A504", "LA Boundary")]
    assert ends(routes.hot_edges(golden[2])) == [("A41", "LA Boundary")]


def test_missing_edge_values_fall_back(spark):
    steps = spark.createDataFrame([("a", "b"), ("b", "c")], "src string, dst string")
    edges = spark.createDataFrame([("a", "b", 2.0, None), ("b", "c", 3.0, 0.0)], "src string, dst string, length_km double, weight_km double")
    rows = {r.src: r for r in routes.with_edge_values(steps, edges).collect()}
    assert (rows["a"].weight_km, rows["a"].penalty_km) == (2.0, 0.0)
    assert (rows["b"].weight_km, rows["b"].penalty_km) == (0.0, -3.0)


# ---- graph tables ------------------------------------------------------------------------


@pytest.fixture
def links(spark):
    rows = [
        (" a ", "b", 1.0, 10.0, "2"), ("a", "b", 3.0, 20.0, "4"), ("b", "a", 5.0, 30.0, "6"),
        ("a", "a", 0.0, 0.0, "1"), (None, "b", 0.0, 0.0, "1"), (" ", "b", 0.0, 0.0, "1"),
        ("a", "c", None, None, "0.0005"), ("a", "c", None, None, "x"), ("c", "a", None, 1.0, "7"),
    ]
    raw = spark.createDataFrame(rows, "from_node string, to_node string, lon double, lat double, length_km string")
    return graph.clean_links(raw)


def test_link_cleaning(links):
    assert sorted((r.src, r.dst, r.length_km) for r in links.collect()) == [
        ("a", "a", 1.0), ("a", "b", 2.0), ("a", "b", 4.0), ("b", "a", 6.0), ("c", "a", 7.0),
    ]


def test_graph_tables(links):
    edges = {(r.src, r.dst): (r.length_km, r.n_rows) for r in graph.edge_table(links).collect()}
    assert edges[("a", "b")] == (3.0, 2)
    mean = {r.node_id: r for r in graph.node_table(links).collect()}
    median = {r.node_id: r for r in graph.node_table(links, "median").collect()}
    assert mean["b"].lon == 3.0 and mean["b"].n_rows == 3
    assert median["b"].lat == 20.0 and median["a"].lon == 1.0 and median["a"].n_rows == 6
    assert median["c"].lon is None and median["c"].lat == 1.0
    assert graph.graph_counts(graph.graph_nodes(graph.edge_table(links)), graph.edge_table(links)).first().asDict() == {"nodes": 3, "edges": 4}


def test_undirected_keeps_the_larger_source(links):
    both = {(r.src, r.dst): r.length_km for r in graph.undirected(graph.edge_table(links)).collect()}
    assert both == {("a", "b"): 6.0, ("b", "a"): 6.0, ("a", "a"): 1.0, ("a", "c"): 7.0, ("c", "a"): 7.0}


# ---- geometry ----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def nodes(spark):
    """All golden nodes on a line but ``A5``, which has no position."""
    names = ["A407", "A41", "LA Boundary", "A221", "A206", "Bugsby's Way", "A406", "A504"]
    rows = [(n, float(i), 51.0) for i, n in enumerate(names)] + [("A5", None, 51.0)]
    return spark.createDataFrame(rows, "node_id string, lon double, lat double")


def test_strict_and_lenient_route_lines(golden, nodes):
    strict = layers.run_features(layers.route_lines(golden[2], nodes))
    assert [r.route for r in strict.collect()] == ["avoid_hotspots"]
    layer = {r.route: r for r in layers.route_layer(golden[2], nodes).collect()}
    short = layer["shortest_distance"]
    assert short.placed and len(short.coordinates) == 6 and short.n_edges == 6
    assert short.route_id == "A407__Bugsby's Way__shortest_distance"
    assert short.hotspot_max == RATE and short.length_km == pytest.approx(10.9)
    no_end = nodes.where("node_id <> 'A407'")
    assert not any(r.placed for r in layers.route_layer(golden[2], no_end).collect())


def test_rebuilt_layer_equals_the_stepped_one(golden, nodes):
    shuffled = golden[2].selectExpr("*", "xxhash64(src) as line_no").drop("step")
    again = {r.route: r for r in layers.route_layer_from_rows(shuffled, nodes, "line_no").collect()}
    for r in layers.route_layer(golden[2], nodes).collect():
        assert again[r.route].coordinates == r.coordinates
        assert again[r.route].n_edges == r.n_edges


@pytest.mark.parametrize(
    "edges, want",
    [
        ("s>a a>t", "s a t"),
        ("a>t s>a", "s a t"),
        ("s>a a>s s>b b>t", "s a s b t"),
        ("s>a a>b b>a", "s a b a"),
        ("x>y y>z", "x y z"),
        ("s>a s>t a>b", "s a t b"),
        ("s>a s>a a>t a>c", "s a t"),
        ("s>a a>a a>t", "s a a t"),
    ],
)
def test_step_order_from_edge_rows(spark, edges, want):
    """Chains, loops, forks; rows that form no way to the end keep their order."""
    rows = [("s", "t", "r", *e.split(">"), i) for i, e in enumerate(edges.split())]
    df = spark.createDataFrame(rows, "from_node string, to_node string, route string, src string, dst string, n int")
    got = layers.order_steps(df, "n").orderBy("step").collect()
    assert " ".join(r.node for r in got) == want
    assert [r.step for r in got] == list(range(len(got)))


def test_hotspot_layer(spark, nodes):
    rates = spark.createDataFrame(
        [("A407", "A41", 0.4, 9.0, 3), ("A407", "A5", 0.9, 9.0, 3), ("A41", "A407", 0.1, 9.0, 3), ("A41", "A206", 0.4, None, 2)],
        "from_node string, to_node string, hotspot_rate double, avg_pred double, n_rows long",
    )
    edges = spark.createDataFrame(
        [("A407", "A41", 1.0, 7), ("A407", "A5", 1.0, 7)], "src string, dst string, length_km double, n_rows long"
    )
    lines = layers.hotspot_lines(rates, edges, nodes, min_rate=0.4)
    assert layers.layer_counts(lines).first().asDict() == {"n_features": 1, "n_dropped": 2}
    (text,) = [r.t for r in layers.hotspot_features(lines).selectExpr("to_json(feature) as t").collect()]
    assert json.loads(text) == {
        "type": "Feature",
        "geometry": {"type": "LineString", "coordinates": [[0.0, 51.0], [1.0, 51.0]]},
        "properties": {
            "from_node": "A407", "to_node": "A41", "hotspot_rate": 0.4, "avg_pred": 9.0,
            "n_scored": 3, "n_rows": 7, "length_km": 1.0,
        },
    }


def test_map_choices(golden, nodes):
    layer = layers.route_layer(golden[2], nodes)
    assert [(r.kind, r.value) for r in layers.route_options(layer).collect()] == [
        ("destination", "Bugsby's Way"), ("route", "avoid_hotspots"), ("route", "shortest_distance"),
    ]
    assert layers.select_routes(layer, "Bugsby's Way").count() == 2
    assert layers.select_routes(layer, "Bugsby's Way", "avoid_hotspots").count() == 1
    assert layers.first_route(layer).first().length_km == pytest.approx(11.165217391304347)


def test_the_registered_comparison_is_whole(spark, tmp_path):
    rows = [(0, 1, 9.0), (1, 2, 9.0), (5, 6, 9.0)]  # junctions 5 and 6 are not reached from 0
    table = spark.createDataFrame(rows, "l_partkey long, l_suppkey long, l_quantity double")
    table.selectExpr(
        "*", "0.01 as l_tax", "0.02 as l_discount", "'O' as l_linestatus", "'R' as l_returnflag",
        "1.0D as l_extendedprice",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    found = queries_routes.route_comparison(spark, str(tmp_path))
    assert "explain_removed_risky_top5" in found.columns
    assert {r.to_node: (r.reachable, r.short_n_edges) for r in found.collect()} == {
        "N1": (True, 1), "N2": (True, 2), "N5": (False, None), "N6": (False, None),
    }


def test_links_and_flags_are_grouped_in_one_pass(spark, tmp_path):
    """No join, one shuffle, and the edges of the table of links joined with the table of rates."""
    sf_dir = str(tmp_path)
    spark.range(400).selectExpr(
        "nullif(id % 13, 12) AS l_partkey", "nullif(id % 7, 6) AS l_suppkey", "nullif(id % 5, 4) + 0.5D AS l_quantity",
        "id * 1.0D AS l_extendedprice", "if(id % 3 = 0, 0.10D, 0.05D) AS l_discount", "if(id % 4 = 0, 0.08D, 0.02D) AS l_tax",
        "nullif(if(id % 11 < 6, 'R', 'N'), if(id % 17 = 0, 'N', 'x')) AS l_returnflag",
        "CASE WHEN id % 19 = 0 THEN NULL WHEN id % 8 < 5 THEN 'O' ELSE 'F' END AS l_linestatus",
    ).write.parquet(f"{sf_dir}/lineitem.parquet")
    rows = stand_ins.weighted(spark, sf_dir)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.split("Initial Plan")[-1].count("Exchange") == 1
    joined = graph.weight_edges(graph.edge_table(stand_ins.links(spark, sf_dir)), stand_ins.rates(spark, sf_dir))
    assert rows.schema == joined.schema and rows.count() == joined.count() > 50
    assert rows.exceptAll(joined).isEmpty() and joined.exceptAll(rows).isEmpty()


def test_nodes_of_a_search_come_from_one_scan(spark):
    edges = spark.createDataFrame(
        [("a", "b", 1.0), ("b", "b", 1.0), ("c", "b", 1.0), ("d", "d", 1.0), ("b", "e", 2.0)], "src string, dst string, km double"
    )
    nodes = paths.entered_nodes(edges)
    assert {tuple(r) for r in nodes.collect()} == {("a", False), ("b", True), ("c", False), ("d", False), ("e", True)}
    starts, costs = spark.createDataFrame([("a",)], "source string"), {"km": "km"}
    found = paths.shortest_paths(edges, starts, costs, nodes=nodes)
    assert {r["node"]: r["dist"] for r in found.collect()} == {"a": 0.0, "b": 1.0, "e": 3.0}
    kept = paths.enterable_arcs(edges, starts, nodes=nodes)
    assert {(r["src"], r["dst"]) for r in kept.collect()} == {("a", "b"), ("b", "e")}
    with pytest.raises(ValueError):
        paths.shortest_paths(edges, starts.replace("a", "z"), costs, nodes=nodes)
    assert paths.all_targets(edges, ["a"], nodes=nodes).count() == 4
