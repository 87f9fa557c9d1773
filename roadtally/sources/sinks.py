"""Writes.  Executors write in parallel; one file is made only where the caller asks for it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from roadtally.functions.geojson import feature_text
from roadtally.session import cut_lineage

# Headers, doubled quotes, and no trimming of spaces on the way out.
CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}

# The first and the last line of a collection.
COLLECTION_START = '{"type":"FeatureCollection","features":['
COLLECTION_END = "]}"


def write_months(df: DataFrame, path: str, keys: Sequence[str] = ("p_year", "p_month")) -> None:
    """Partitioned Parquet; a re-run replaces only the months it holds.

    Rows are gathered by month so that a task writes few files; AQE splits a month that is
    too large for one task over several.
    """
    (
        df.hint("rebalance", *keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )


def write_region(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    repartition: int | None = None,
    coalesce: int | None = None,
) -> None:
    """Parquet by region; overwriting one region leaves the others alone."""
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode must be overwrite or append, not {mode!r}")
    if repartition:
        df = df.repartition(repartition)
    elif coalesce:
        df = df.coalesce(coalesce)
    (
        df.write.mode(mode)
        .option("compression", "snappy")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("region")
        .parquet(path)
    )


def write_run(df: DataFrame, path: str, region: str, run_utc: str) -> None:
    """One run under ``region=/run_utc=``; the caller passes the stamp.

    The run's manifest is written last, so a run that broke off has none.
    """
    (
        df.withColumns({"region": F.lit(region), "run_utc": F.lit(run_utc)})
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("region", "run_utc")
        .parquet(path)
    )
    commit_run(df.sparkSession, path, region, run_utc)


def manifest_path(path: str) -> str:
    """Where the manifests of the runs below ``path`` lie: beside it, so scans of it do not meet them."""
    return f"{path.rstrip('/')}-committed"


def run_files(run: DataFrame) -> DataFrame:
    """The files of a scanned run with their rows; a file without rows is not listed."""
    return run.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count(F.lit(1)).alias("n_rows"))


def commit_run(spark: SparkSession, path: str, region: str, run_utc: str) -> None:
    """Record the files of a finished run and their rows; a run without rows has an entry as well."""
    try:
        runs = spark.read.parquet(path)
        files = run_files(runs.where((F.col("region") == region) & (F.col("run_utc") == run_utc)))
    except AnalysisException as err:
        if err.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        files = spark.createDataFrame([], "file string, n_rows bigint")
    end = spark.createDataFrame([("", 0)], "file string, n_rows bigint")
    (
        files.unionByName(end)
        .withColumns({"region": F.lit(region), "run_utc": F.lit(run_utc)})
        .coalesce(1)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("region", "run_utc")
        .json(manifest_path(path))
    )


def write_predictions(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header per part file; ``single_file`` is for tables known to stay small."""
    if single_file:
        df = df.coalesce(1)
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def write_metadata(counts: DataFrame, path: str, **parameters) -> None:
    """One JSON record: the parameters of a run beside its one-row table of counts."""
    counts.select(
        *[F.lit(v).alias(k) for k, v in parameters.items()], *counts.columns
    ).coalesce(1).write.mode("overwrite").json(path)


def write_scores(scores: DataFrame, path: str, quantile: float) -> None:
    """The one-row evaluation as ``name: value`` lines."""
    # The lines of the evaluation file.
    lines = F.array(
        F.format_string("Scoring window rows: %d", "score_rows"),
        F.format_string("Train rows: %d", "train_rows"),
        F.format_string("RMSE: %.3f", "rmse"),
        F.format_string("MAE : %.3f", "mae"),
        F.format_string("R2  : %.6f", "r2"),
        F.concat(F.lit("Hotspot quantile (per hour): "), F.lit(quantile).cast("string")),
    )
    scores.select(F.array_join(lines, "\n").alias("value")).coalesce(1).write.mode(
        "overwrite"
    ).text(path)


def write_features(features: DataFrame, path: str) -> None:
    """One GeoJSON feature per line."""
    features.select(feature_text(F.col("feature")).alias("value")).write.mode("overwrite").text(
        path
    )


def collection_lines(features: DataFrame, key: Sequence[str | Column]) -> DataFrame:
    """Lines of a FeatureCollection, in the order of ``part``, ``rank_key`` and ``tie``.

    Every feature but the first is led by a comma, so the sorted part files read one after
    another are a single valid document and no task has to hold it whole.  ``features`` must be
    stored: rows of equal keys are told apart by their place in it.
    """
    spark = features.sparkSession
    keyed = features.select(
        F.to_json(F.struct(*key)).alias("rank_key"),
        F.monotonically_increasing_id().alias("tie"),
        feature_text(F.col("feature")).alias("text"),
    )
    first = keyed.agg(F.min(F.struct("rank_key", "tie")).alias("first")).first()["first"]
    leads = F.lit(False) if first is None else (F.col("rank_key") == first["rank_key"]) & (F.col("tie") == first["tie"])
    body = keyed.select(
        F.lit(1).alias("part"),
        "rank_key",
        "tie",
        F.when(leads, F.col("text")).otherwise(F.concat(F.lit(","), F.col("text"))).alias("value"),
    )
    frame = spark.createDataFrame(
        [(0, "", 0, COLLECTION_START), (2, "", 0, COLLECTION_END)],
        "part int, rank_key string, tie bigint, value string",
    )
    return body.unionByName(frame)


def write_collection(
    features: DataFrame, path: str, key: Sequence[str | Column], limit: int | None = None
) -> None:
    """A FeatureCollection over sorted part files, in the order of ``key`` as text.

    ``limit`` is a map's own choice of how many lines it draws, in the order of ``key``; without it
    all are written.
    """
    if limit is not None:
        features = features.orderBy(*key).limit(limit)
    features = cut_lineage(features)  # read three times: for the first key, the sort, the write
    lines = collection_lines(features, key).orderBy("part", "rank_key", "tie")
    lines.select("value").write.mode("overwrite").text(path)
