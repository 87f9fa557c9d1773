"""Sinks and sources, and the whole run on a small region."""

from __future__ import annotations

import glob
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from roadtally.operators import layers
from roadtally.plans.batch import Settings, build_layers
from roadtally.session import broadcast_if_small, fits, scratch_path, shared_folder
from roadtally.sources import readers, sinks


def joined_text(path):
    return "".join(open(p).read() for p in sorted(glob.glob(f"{path}/part-*")))


def test_csv_scans_skip_marker_files(spark, tmp_path):
    base = tmp_path / "raw" / "region=London" / "year=2020"
    base.mkdir(parents=True)
    (base / "part-0.csv").write_text('a,b\n1,"x ""y"", z"\n')
    (base / "_notes.csv").write_text("a,b\nno,no\n")
    for scan in (readers.csv_strings, readers.csv_quoted):
        (row,) = scan(spark, str(tmp_path / "raw")).collect()
        assert row.a == "1" and len(row) == 2
    assert readers.csv_quoted(spark, str(tmp_path / "raw")).first().b == 'x "y", z'


def test_parquet_scan_ignores_other_files(spark, tmp_path):
    path = str(tmp_path / "layer")
    spark.range(5).write.parquet(path)
    (tmp_path / "layer" / "notes.csv").write_text("x\n")
    assert readers.parquet_files(spark, path).count() == 5
    (tmp_path / "layer" / "broken.parquet").write_text("no")
    tolerant = readers.parquet_files(spark, path, recursive=False, skip_corrupt=True, schema="id long")
    assert sorted(r.id for r in tolerant.collect()) == [0, 1, 2, 3, 4]


def test_month_rewrite_keeps_other_months(spark, tmp_path):
    path = str(tmp_path / "silver")
    df = spark.range(10).selectExpr("id", "2020 as p_year", "lpad(id % 2 + 1, 2, '0') as p_month")
    sinks.write_months(df, path)
    sinks.write_months(df.where("p_month = '02'").limit(1), path)
    assert spark.read.parquet(path).count() == 6


def test_region_modes(spark, tmp_path):
    path = str(tmp_path / "gold")
    df = spark.range(4).withColumn("region", F.lit("A"))
    sinks.write_region(df, path)
    sinks.write_region(df.withColumn("region", F.lit("B")), path)
    sinks.write_region(df, path, mode="append", coalesce=1)
    assert spark.read.parquet(path).groupBy("region").count().orderBy("region").collect() == [("A", 8), ("B", 4)]
    with pytest.raises(ValueError, match="mode"):
        sinks.write_region(df, path, mode="ignore")


def test_single_file_where_it_is_asked_for(spark, tmp_path):
    df = spark.range(100).repartition(4)
    sinks.write_csv(df, str(tmp_path / "one"), single_file=True)
    sinks.write_csv(df, str(tmp_path / "many"))
    assert len(list((tmp_path / "one").glob("part-*"))) == 1
    assert len(list((tmp_path / "many").glob("part-*"))) == 4


def test_latest_run_and_export_preference(spark, tmp_path):
    root = str(tmp_path)
    df = spark.range(3)
    for n, stamp in enumerate(("20260101T000000Z", "20260102T000000Z")):
        sinks.write_run(df.limit(n + 1), f"{root}/route_analysis", "London", stamp)
    assert readers.latest_routes(spark, root, "London").count() == 2
    df.write.parquet(f"{root}/exports/route_edges")
    assert readers.latest_routes(spark, root, "London").count() == 3
    with pytest.raises(FileNotFoundError):
        readers.first_readable(spark, [f"{root}/nothing"])


def test_feature_collection_is_one_valid_document(spark, tmp_path):
    lines = spark.range(50).selectExpr(
        "'a' as from_node", "concat('n', id) as to_node", "0.5 as hotspot_rate",
        "0.0 as src_lon", "1.0 as src_lat", "2.0 as dst_lon", "3.0 as dst_lat", "id % 5 > 0 as placed",
    )
    features = layers.hotspot_features(lines)
    for name, limit, want in (("all", None, 40), ("some", 7, 7), ("none", 0, 0)):
        sinks.write_collection(features, f"{tmp_path}/{name}", ["from_node", "to_node"], limit)
        document = json.loads(joined_text(f"{tmp_path}/{name}"))
        assert document["type"] == "FeatureCollection" and len(document["features"]) == want
    assert document["features"] == []


def test_metadata_and_scores(spark, tmp_path):
    counts = spark.createDataFrame([(3, 4)], "nodes long, edges long")
    sinks.write_metadata(counts, f"{tmp_path}/meta", region="London", directed=True)
    assert json.loads(joined_text(f"{tmp_path}/meta")) == {"region": "London", "directed": True, "nodes": 3, "edges": 4}
    scores = spark.createDataFrame([(827, 101831, 193.395, 125.676, 0.968435)], "score_rows long, train_rows long, rmse double, mae double, r2 double")
    sinks.write_scores(scores, f"{tmp_path}/eval", 0.8)
    assert joined_text(f"{tmp_path}/eval").splitlines() == [
        "Scoring window rows: 827", "Train rows: 101831", "RMSE: 193.395", "MAE : 125.676",
        "R2  : 0.968435", "Hotspot quantile (per hour): 0.8",
    ]


def test_disruptions(spark, tmp_path):
    records = [
        {"id": "1", "severity": "", "statusSeverity": "Severe", "corridorIds": [], "roadDisruptionLines": ["x", "y"],
         "startDateTime": "2024-01-01T10:20:30Z", "endDateTime": "never"},
        {"id": "2", "severity": "Minor", "corridorIds": ["q"]},
    ]
    (tmp_path / "feed.json").write_text(json.dumps(records, indent=1))
    flat = readers.flatten_disruptions(readers.disruption_feed(spark, str(tmp_path / "feed.json"), one_per_line=False))
    one, two = flat.orderBy("disruption_id").collect()
    assert (one.severity, one.corridor_ids, one.timestamp_hour.hour, one.end_datetime) == ("Severe", "x,y", 10, None)
    assert (two.severity, two.corridor_ids, two.start_datetime) == ("Minor", "q", None)


def test_size_checks(spark):
    df = spark.range(11)
    assert fits(df, 11) and not fits(df, 10)
    plan = lambda d: d._jdf.queryExecution().analyzed().toString()
    for stored in (True, False):
        assert "broadcast" in plan(df.join(broadcast_if_small(df, 11, stored), "id"))
        assert "broadcast" not in plan(df.join(broadcast_if_small(df, 10, stored), "id"))


class FakeSession:
    """A session on a cluster, with or without a shared folder."""

    def __init__(self, folder):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = self
        self.master = "yarn"
        self.folder = None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_a_cluster_needs_its_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(FakeSession(None))
    named = FakeSession("hdfs:///shared")
    assert shared_folder(named) == named.folder == "hdfs:///shared"


def test_scratch_paths_differ(spark):
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_whole_run(spark, tmp_path):
    rng = random.Random(1)
    junctions = [("J0", "J1"), ("J1", "J2"), ("J0", "J2"), ("J2", "J3"), ("J3", "J0")]
    rows = []
    for point in range(10):
        a, b = junctions[point % 5]
        for day in range(1, 21):
            for hour in range(7, 19):
                rows.append(
                    f"{point},{'%02d/03/2020' % day if point % 2 else '2020-03-%02d' % day},{hour},{a},{b},"
                    f"{rng.randint(50, 900) + 500 * (point == 0)},{0.5 + point % 5},{51 + point / 50},{-0.1 * point},{rng.randint(0, 9)}"
                )
    header = "count_point_id,count_date,hour,start_junction_road_name,end_junction_road_name,all_motor_vehicles,link_length_km,latitude,longitude,all_HGVs"
    raw = tmp_path / "raw" / "year=2020"
    raw.mkdir(parents=True)
    (raw / "counts.csv").write_text("\n".join([header, *rows]))
    (tmp_path / "feed.json").write_text('{"id": "1", "startDateTime": "2020-03-02T10:20:30Z"}\n')
    root = str(tmp_path / "lake")
    build_layers(
        spark,
        Settings(
            raw=str(tmp_path / "raw"), root=root, region="London", run_utc="20260101T000000Z",
            sources=["J0"], event_feed=str(tmp_path / "feed.json"), test_days=1, score_days=5,
            trees=3, fold_trees=3, with_boosting=True, hot_above=0.0, save_model=True,
        ),
    )
    gold = spark.read.parquet(f"{root}/gold/features")
    assert gold.count() == 10 * (20 * 12 - 2)
    assert gold.where("tfl_disruptions_hour = 1").count() == 10
    assert spark.read.option("header", True).csv(f"{root}/gold/walkforward_metrics").count() == 6
    summary = spark.read.parquet(f"{root}/gold/route_summary")
    assert {r.to_node for r in summary.where("reachable").collect()} == {"J1", "J2", "J3"}
    for layer, n in (("routes", 6), ("hotspots", 5)):
        assert len(json.loads(joined_text(f"{root}/map/{layer}"))["features"]) == n
    assert json.loads(joined_text(f"{root}/gold/run_metadata"))["targets_reached"] == 3
    assert json.loads(joined_text(f"{root}/gold/graph_metadata"))["edges"] == 5


def test_runs_that_broke_off_are_passed_over(spark, tmp_path):
    path = str(tmp_path / "route_analysis")
    df = spark.range(20).repartition(3)
    sinks.write_run(df, path, "London", "20260101T000000Z")
    sinks.write_run(df, path, "Leeds", "20260105T000000Z")
    df.limit(3).write.parquet(f"{path}/region=London/run_utc=20260102T000000Z")
    newest = readers.latest_committed(spark, path, "London")
    assert newest.count() == 20 and newest.select("run_utc").distinct().collect() == [("20260101T000000Z",)]
    # A repeated run replaces its own manifest only.
    sinks.write_run(df.limit(5), path, "London", "20260101T000000Z")
    assert readers.latest_committed(spark, path, "London").count() == 5
    assert readers.latest_committed(spark, path, "Leeds").count() == 20
    with pytest.raises(FileNotFoundError):
        readers.latest_committed(spark, path, "York")
    # A finished run without rows is the newest; a file lost after the commit is an error.
    sinks.write_run(df.where("id < 0"), path, "London", "20260103T000000Z")
    assert readers.latest_committed(spark, path, "London").count() == 0
    lost = glob.glob(f"{path}/region=Leeds/run_utc=*/part-*.parquet")[0]
    (tmp_path / "moved").mkdir()
    os.rename(lost, str(tmp_path / "moved" / "part.parquet"))
    spark.catalog.clearCache()
    with pytest.raises(ValueError, match="manifest"):
        readers.latest_committed(spark, path, "Leeds")


LAYOUT = "properties struct<n:int>"


def test_collections_are_read_back_in_order(spark, tmp_path):
    rows = spark.range(300).selectExpr(
        "lpad(id div 3, 4, '0') as k", "named_struct('type', 'Feature', 'properties', named_struct('n', cast(id as int))) as feature"
    )
    path = str(tmp_path / "layer")
    # Every key is there three times; the smallest one too.
    sinks.write_collection(rows.repartition(5), path, ["k"])
    document = json.loads(joined_text(path))
    ranked = readers.collection_features(spark, path, LAYOUT).orderBy("rank").collect()
    assert [r.properties.n for r in ranked] == [f["properties"]["n"] for f in document["features"]]
    assert [r["rank"] for r in ranked] == list(range(300)) and ranked[0].properties.n < 3
    sinks.write_collection(rows.limit(0), path, ["k"])
    assert readers.collection_features(spark, path, LAYOUT).count() == 0


@pytest.mark.parametrize(
    "lines, told",
    [
        (['{"type":"Feature"}', ',{"type":"Feature"}'], "begin and end"),
        (['{"type":"FeatureCollection","features":[', '{"type":"Feature"}', '{"type":"Feature"}', "]}"], "feature 1"),
        (['{"type":"FeatureCollection","features":[', ',{"type":"Feature"}', "]}"], "feature 0"),
        (['{"type":"FeatureCollection","features":[', '{"type":"Feat', "]}"], "feature 0"),
        ([], "begin and end"),
    ],
)
def test_broken_collections_are_errors(spark, tmp_path, lines, told):
    (tmp_path / "part-00000.txt").write_text("".join(f"{x}\n" for x in lines))
    with pytest.raises(ValueError, match=told):
        readers.collection_features(spark, str(tmp_path), LAYOUT)
