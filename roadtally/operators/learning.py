"""Training and scoring with Spark ML."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, functions as F

from roadtally.functions.columns import listed_features, require_columns
from roadtally.operators.folds import fold_split, walkforward_folds
from roadtally.operators.metrics import regression_scores
from roadtally.schemas import FOLD_METRICS

SEED = 42

# Rows a task of a fit gets at least: trees take a job for each level of each tree, and many tasks
# of few rows cost more than the rows.
TASK_ROWS = 50_000

# The parameters of the models.
LINEAR = {"maxIter": 100, "regParam": 0.1, "elasticNetParam": 0.0, "standardization": True}
BOOSTED_FOLDS = {
    "maxIter": 40,
    "maxDepth": 5,
    "maxBins": 64,
    "stepSize": 0.1,
    "subsamplingRate": 0.7,
    "minInstancesPerNode": 10,
}
BOOSTED_SCORING = {"maxIter": 60, "maxDepth": 6}
BOOSTED_SCALED = {"maxIter": 80, "maxDepth": 6, "stepSize": 0.1}
FOREST = {
    "numTrees": 40,
    "maxDepth": 8,
    "maxBins": 64,
    "subsamplingRate": 0.7,
    "featureSubsetStrategy": "sqrt",
    "minInstancesPerNode": 10,
}

# Columns kept beside a prediction.
PREDICTION_KEYS = (
    "ts_hour",
    "count_point_id",
    "latitude",
    "longitude",
    "start_junction_road_name",
    "end_junction_road_name",
)
CALENDAR_COLUMNS = ("hour_of_day", "day_of_week", "is_weekend", "month", "year")


def linear(label: str, **changes) -> LinearRegression:
    return LinearRegression(labelCol=label, **{**LINEAR, **changes})


def boosted(label: str, preset: dict = BOOSTED_FOLDS, **changes) -> GBTRegressor:
    return GBTRegressor(labelCol=label, seed=SEED, **{**preset, **changes})


def forest(label: str, **changes) -> RandomForestRegressor:
    return RandomForestRegressor(labelCol=label, seed=SEED, **{**FOREST, **changes})


def vectors(features: Sequence[str], invalid: str, out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid=invalid)


def scaled_boosting(label: str, features: Sequence[str], **changes) -> Pipeline:
    """Assemble, standardise by mean and deviation, boost."""
    return Pipeline(
        stages=[
            vectors(features, "error", "raw"),
            StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True),
            boosted(label, BOOSTED_SCALED, **changes),
        ]
    )


def in_tasks(df: DataFrame, n_rows: int) -> DataFrame:
    """A persisted table in no more partitions than its rows fill, without a shuffle."""
    return df.coalesce(max(1, -(-n_rows // TASK_ROWS)))


def row_bucket(*key: str) -> Column:
    """A number from 0 to 2**32 - 1 told by the row's key alone, the same on any layout."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


BUCKETS = 1 << 32


def down_sample(df: DataFrame, max_rows: int, key: Sequence[str], n_rows: int | None = None) -> DataFrame:
    """About ``max_rows`` rows if there are more, chosen by ``key``; 0 keeps all."""
    if max_rows <= 0:
        return df
    n = df.count() if n_rows is None else n_rows
    return df.where(row_bucket(*key) < F.lit(max_rows * BUCKETS // n)) if n > max_rows else df


def random_split(df: DataFrame, key: Sequence[str], train: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Two parts; a row's ``key`` tells where it goes."""
    first = split_test(key, train)
    return df.where(first), df.where(~first)


def split_test(key: Sequence[str], train: float = 0.8) -> Column:
    """Whether a row belongs to the larger part of :func:`random_split`."""
    return row_bucket(*key) < F.lit(int(train * BUCKETS))


def model_rows(
    df: DataFrame, label: str, features: Sequence[str] | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Label and features as doubles; rows lacking any of them or a time are dropped."""
    features = features or listed_features(df)
    numeric = {label: F.col(label).cast("double")}
    numeric |= {c: F.col(c).cast("double") for c in features}
    kept = list(dict.fromkeys([*keep, label, *features]))
    needed = [c for c in ("ts_hour", label, *features) if c in kept]
    return df.select(*kept).withColumns(numeric).dropna(subset=needed)


def last_days_split(df: DataFrame, ts: str, days: int) -> tuple[DataFrame, DataFrame]:
    """Rows up to ``days`` before the newest, and those after; 0 days gives all rows twice."""
    if days <= 0:
        return df, df
    newest = df.agg(F.max(ts)).first()[0]
    if newest is None:
        raise ValueError(f"no timestamps in {ts}")
    cutoff = F.lit(newest) - F.make_dt_interval(F.lit(days))
    return df.where(F.col(ts) <= cutoff), df.where(F.col(ts) > cutoff)


def lag_baseline(df: DataFrame, label: str, lag: str, keep: Sequence[str] = ()) -> DataFrame:
    """The value so many rows back as the forecast: ``lag_1h`` persists, ``lag_24h`` is seasonal."""
    return df.select(*keep, F.col(label).alias("label"), F.col(lag).alias("prediction"))


def walk_forward(
    df: DataFrame,
    label: str,
    models: dict[str, object],
    *,
    ts: str = "ts_hour",
    features: Sequence[str] | None = None,
    n_folds: int = 3,
    test_days: int = 30,
    max_train_rows: int = 0,
) -> DataFrame:
    """Train each model on each growing window and score it on the next one.

    The loop runs over the few fold bounds on the driver; training, scoring and the scores
    themselves are Spark jobs, and one row of scores per fold and model comes back.
    ``max_train_rows`` bounds the labelled rows a model is fitted on (0: all of them); test rows
    are never sampled, and ``train_rows`` is counted before any sampling.
    """
    features = list(features or listed_features(df))
    rows = df.where(F.col(label).isNotNull() & F.col(ts).isNotNull())
    rows = rows.withColumns({c: F.col(c).cast("double") for c in [label, *features]})
    ready = vectors(features, "skip").transform(rows).select(ts, label, "features")
    held = ready = ready.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        scores = []
        ready = in_tasks(ready, ready.count())
        bounds = walkforward_folds(ready, ts, n_folds, test_days).orderBy("fold").collect()
        for fold, train_end, test_end in bounds:
            train, test = fold_split(ready, ts, train_end, test_end)
            n_train, n_test = train.count(), test.count()
            if not n_train or not n_test:
                continue
            sampled = down_sample(train, max_train_rows, [ts, label, "features"], n_train)
            for name, estimator in models.items():
                preds = estimator.fit(sampled).transform(test)
                got = regression_scores(preds, label, "prediction").first()
                scores.append(
                    (fold, name, train_end, test_end, n_train, n_test)
                    + (got.rmse, got.mae, got.r2, got.geh_pct_lt5)
                )
        if not scores:
            raise ValueError("no fold had both training and test rows")
        return df.sparkSession.createDataFrame(scores, FOLD_METRICS)
    finally:
        held.unpersist()


def score_last_days(
    df: DataFrame,
    label: str = "y_t_plus_1h",
    *,
    score_days: int = 90,
    max_train_rows: int = 200_000,
    **changes,
) -> tuple[DataFrame, PipelineModel, int]:
    """Train boosted trees on the old rows and predict the last days.

    ``max_train_rows`` bounds the labelled rows the model is fitted on (0: all of them); every row
    of the last days is predicted. Returns the predictions, the model and the number of training
    rows after sampling.
    The predictions are lazy; persist them before several uses.
    """
    require_columns(df, [*PREDICTION_KEYS, label])
    features = listed_features(df)
    rows = model_rows(df, label, features, PREDICTION_KEYS)
    train, score = last_days_split(rows, "ts_hour", score_days)
    train = down_sample(train, max_train_rows, [*PREDICTION_KEYS, label]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n_train = train.count()
        if n_train == 0 or score.isEmpty():
            raise ValueError(f"empty split: {n_train} training rows; try fewer score days")
        trees = boosted(label, BOOSTED_SCORING, **changes).setPredictionCol("y_pred")
        model = Pipeline(stages=[vectors(features, "keep"), trees]).fit(in_tasks(train, n_train))
    finally:
        train.unpersist()
    renamed = {"start_junction_road_name": "from_node", "end_junction_road_name": "to_node"}
    preds = model.transform(score).select(
        *[F.col(c).alias(renamed.get(c, c)) for c in PREDICTION_KEYS],
        F.col(label).alias("y_true"),
        "y_pred",
        *[c for c in CALENDAR_COLUMNS if c in rows.columns],
    )
    return preds, model, n_train
