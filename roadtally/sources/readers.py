"""Scans.  All are lazy reads; Catalyst prunes the columns and pushes the filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.window import Window

from roadtally import schemas
from roadtally.functions.columns import resolve_column
from roadtally.functions.parsing import first_list, first_text
from roadtally.session import broadcast_if_small, cut_lineage
from roadtally.sources.foreign import resolved
from roadtally.sources.sinks import COLLECTION_END, COLLECTION_START, manifest_path, run_files


def csv_strings(spark: SparkSession, path: str) -> DataFrame:
    """All CSV files below ``path``, every column as text; folder names add no columns."""
    return (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("recursiveFileLookup", True)
        .csv(path)
    )


def csv_quoted(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text columns with doubled quotes inside quoted fields.

    Spark itself passes over names starting with ``_`` or ``.`` and unpacks ``.gz``.
    """
    return (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("recursiveFileLookup", True)
        .csv(path)
    )


def csv_typed(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """With a schema one pass is enough; without one Spark reads the data twice to infer it."""
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)


def parquet_files(
    spark: SparkSession,
    path: str,
    recursive: bool = True,
    skip_corrupt: bool = False,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """Only ``*.parquet`` below ``path``, whatever else lies there.

    Skipping corrupt files loses their rows silently, so it must be asked for; give a schema
    with it, as the file it would be read from may be a corrupt one.
    """
    reader = spark.read.option("pathGlobFilter", "*.parquet")
    if schema is not None:
        reader = reader.schema(schema)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    if skip_corrupt:
        reader = reader.option("ignoreCorruptFiles", True)
    return reader.parquet(path)


def parquet_columns(
    spark: SparkSession, path: str, roles: dict[str, Sequence[str]]
) -> DataFrame:
    """Read just one column per role, found by candidate names and renamed to the role."""
    df = spark.read.parquet(path)
    return df.select(
        *[F.col(resolve_column(df.columns, names)).alias(role) for role, names in roles.items()]
    )


def edges_csv(spark: SparkSession, path: str) -> DataFrame:
    return csv_typed(spark, path, schemas.EDGES)


def nodes_csv(spark: SparkSession, path: str) -> DataFrame:
    """Nodes with their positions, whatever known names the columns have."""
    return resolved(csv_strings(spark, path), "nodes")


def edge_rates_csv(spark: SparkSession, path: str) -> DataFrame:
    return csv_typed(spark, path, schemas.EDGE_RATES)


def route_edges_csv(spark: SparkSession, path: str) -> DataFrame:
    """Route rows under any known column names, with ``place``, their order in the files."""
    return resolved(in_file_order(csv_strings(spark, path), "place"), "routes", "place")


def in_file_order(scan: DataFrame, name: str) -> DataFrame:
    """A scan of files with a sortable column: file, block, and place among the rows of the block.

    A block is read by one task in order, so the numbers that Spark gives the rows of a scan rise
    within it. They must be given to the scan itself, before any shuffle.
    """
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return scan.withColumn(name, place)


def collection_features(spark: SparkSession, path: str, layout: str) -> DataFrame:
    """The features of a collection in the part files of ``path``, with their ``rank`` from 0.

    Lines are numbered over all part files in the order of their names, from the rows of each block;
    no file is read whole.  The document is checked as it stands: its frame, a comma before every
    feature but the first, and that each feature parses by ``layout``.  Anything else is an error.
    """
    lines = in_file_order(spark.read.text(path), "place").select("value", "place.*")
    name_order = F.struct(F.length("file").alias("length"), "file", "block")
    numbered = lines.select("value", name_order.alias("part"), "row")
    blocks = numbered.groupBy("part").agg(F.min("row").alias("first_row"), F.count(F.lit(1)).alias("n"))
    # One row for each block of a file, far fewer than lines.
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = blocks.withColumn("start", F.coalesce(before, F.lit(0))).drop("n")
    placed = cut_lineage(
        numbered.join(broadcast_if_small(starts), "part").select(
            "value", (F.col("start") + F.col("row") - F.col("first_row")).alias("line")
        )
    )
    total = placed.count()
    led = F.col("value").startswith(",")
    text = F.when(led, F.substr("value", F.lit(2))).otherwise(F.col("value"))
    body = placed.where((F.col("line") > 0) & (F.col("line") < total - 1)).select(
        (F.col("line") - 1).alias("rank"),
        led.alias("led"),
        F.from_json(text, f"type string, {layout}").alias("feature"),
    )
    frame = placed.where(F.col("line").isin(0, total - 1)).orderBy("line").collect()
    if [r["value"] for r in frame] != [COLLECTION_START, COLLECTION_END]:
        raise ValueError(f"{path} does not begin and end as a collection")
    right = (F.col("led") == (F.col("rank") > 0)) & (F.col("feature.type") == "Feature")
    wrong = body.where(~F.coalesce(right, F.lit(False))).select("rank").first()
    if wrong is not None:
        raise ValueError(f"{path}: feature {wrong['rank']} is not led or written as it should")
    return body.select("rank", "feature.*").drop("type")


def latest_run(runs: DataFrame, stamp: str = "run_utc") -> DataFrame:
    """Rows of the newest run; the UTC stamp sorts as text.

    The maximum comes from partition values alone when ``stamp`` is a partition column,
    and the filter then prunes to one folder.
    """
    newest = runs.agg(F.max(stamp).alias("newest")).first()["newest"]
    return runs.where(F.col(stamp) == F.lit(newest))


def latest_committed(spark: SparkSession, path: str, region: str) -> DataFrame:
    """Rows of the newest run of a region that has a manifest, once its files are found whole.

    Newer folders without a manifest belong to runs that broke off and are passed over.  Only the
    chosen folder is listed and counted.  A committed run whose files changed since is an error;
    one that wrote no rows gives an empty table with the columns of the other runs.
    """
    layout = "file string, n_rows bigint, region string, run_utc string"
    manifests = spark.read.schema(layout).json(manifest_path(path)).where(F.col("region") == region)
    newest = manifests.agg(F.max("run_utc").alias("newest")).first()["newest"]
    if newest is None:
        raise FileNotFoundError(f"no committed run of {region} below {path}")
    listed = manifests.where((F.col("run_utc") == newest) & (F.col("file") != "")).select("file", "n_rows")
    runs = spark.read.parquet(path)
    run = runs.where((F.col("region") == region) & (F.col("run_utc") == newest))
    stored = run_files(run)
    both = stored.withColumn("sign", F.lit(1)).unionByName(listed.withColumn("sign", F.lit(-1)))
    odd = both.groupBy("file", "n_rows").agg(F.sum("sign").alias("sign")).where("sign <> 0")
    if not odd.isEmpty():
        raise ValueError(f"the files of run {newest} of {region} differ from its manifest")
    return run


def first_readable(spark: SparkSession, paths: Sequence[str], **options) -> DataFrame:
    """The first of several Parquet locations that exists: stable export before run folders."""
    for path in paths:
        try:
            return spark.read.options(**options).parquet(path)
        except AnalysisException as err:
            if err.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
    raise FileNotFoundError(f"none of {list(paths)} can be read")


def latest_routes(spark: SparkSession, root: str, region: str) -> DataFrame:
    """Route edges by preference: bulk export, single-route export, newest finished run."""
    try:
        return first_readable(
            spark, [f"{root}/exports/routes_edges", f"{root}/exports/route_edges"]
        )
    except FileNotFoundError:
        return latest_committed(spark, f"{root}/route_analysis", region)


def disruption_feed(spark: SparkSession, path: str, one_per_line: bool = True) -> DataFrame:
    """Nested disruption records on disk; a file holding one JSON array needs ``False``.

    Line-delimited files are splittable, a single array is not.
    """
    return (
        spark.read.schema(schemas.DISRUPTION_JSON).option("multiLine", not one_per_line).json(path)
    )


def flatten_disruptions(feed: DataFrame) -> DataFrame:
    start = F.try_to_timestamp("startDateTime")
    return feed.select(
        F.col("id").alias("disruption_id"),
        "category",
        F.col("subCategory").alias("sub_category"),
        first_text("severity", "statusSeverity").alias("severity"),
        first_text("severityDescription", "statusSeverityDescription").alias(
            "severity_description"
        ),
        "location",
        F.array_join(first_list("corridorIds", "roadDisruptionLines"), ",").alias("corridor_ids"),
        start.alias("start_datetime"),
        F.try_to_timestamp("endDateTime").alias("end_datetime"),
        "comments",
        F.date_trunc("hour", start).alias("timestamp_hour"),
    )
