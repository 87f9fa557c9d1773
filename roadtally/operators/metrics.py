"""Scores of predictions, each from one aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame, functions as F

# The GEH limit for an acceptable fit, and the hours the report calls peak.
GEH_LIMIT = 5.0
PEAK_HOURS = (7, 8, 9, 16, 17, 18)


def geh_share(label: str, pred: str) -> Column:
    """Percentage of rows with GEH below the limit among those where it is defined."""
    o, p = F.col(label).cast("double"), F.col(pred).cast("double")
    total = p + o
    geh = F.sqrt(F.when(total > 0, 2.0 * (p - o) * (p - o) / total))
    close = F.when(geh.isNotNull(), (geh < GEH_LIMIT).cast("double"))
    return F.coalesce(F.avg(close) * 100.0, F.lit(0.0))


def error_columns(label: str, pred: str) -> dict[str, Column]:
    """RMSE, MAE, R2 and GEH share as aggregates over rows with both values.

    R2 is NULL where the label does not vary.
    """
    both = F.col(label).isNotNull() & F.col(pred).isNotNull()
    y = F.when(both, F.col(label).cast("double"))
    miss = F.col(pred).cast("double") - y
    mse = F.avg(miss * miss)
    return {
        "n_rows": F.count(y),
        "rmse": F.sqrt(mse),
        "mae": F.avg(F.abs(miss)),
        "r2": 1.0 - F.try_divide(mse, F.var_pop(y)),
        "geh_pct_lt5": geh_share(label, pred),
    }


def regression_scores(
    preds: DataFrame, label: str, pred: str, by: Sequence[str] = ()
) -> DataFrame:
    """Scores overall or per group: period, area, month, fold."""
    scores = [c.alias(name) for name, c in error_columns(label, pred).items()]
    return preds.groupBy(*by).agg(*scores)


def peak_label(hour: str = "hour_of_day", peak: Sequence[int] = PEAK_HOURS) -> Column:
    return F.when(F.col(hour).isin(*peak), "peak").otherwise("off_peak")


def _finite(name: str) -> Column:
    bounded = F.abs(F.col(name)) < float("inf")
    return F.when(bounded & ~F.isnan(name), F.col(name))


def model_summary(folds: DataFrame) -> DataFrame:
    """Mean and spread of the finite fold scores per model, best mean RMSE first."""
    means = [
        F.coalesce(F.avg(_finite(source)), F.lit(0.0)).alias(f"avg_{name}")
        for name, source in (("rmse", "rmse"), ("mae", "mae"), ("r2", "r2"), ("geh", "geh_pct_lt5"))
    ]
    spread = F.stddev_samp(_finite("rmse")).alias("std_rmse")
    return (
        folds.groupBy("model")
        .agg(F.count(F.lit(1)).alias("folds"), *means, spread)
        .orderBy("avg_rmse", "model")
    )


# The rules below are specified by the report, not by code.


def flag_scores(flags: DataFrame, flag: str, truth: str) -> DataFrame:
    """Confusion counts, precision, recall and F1 of a 0/1 flag."""
    f, t = F.col(flag) == 1, F.col(truth) == 1
    counts = flags.agg(
        F.count_if(f & t).alias("tp"),
        F.count_if(f & ~t).alias("fp"),
        F.count_if(~f & t).alias("fn"),
        F.count_if(~f & ~t).alias("tn"),
    )
    tp = F.col("tp").cast("double")
    return counts.withColumns(
        {
            "precision": F.try_divide(tp, F.col("tp") + F.col("fp")),
            "recall": F.try_divide(tp, F.col("tp") + F.col("fn")),
            "f1": F.try_divide(2.0 * tp, 2.0 * tp + F.col("fp") + F.col("fn")),
        }
    )


def flag_auc(preds: DataFrame, score: str, truth: str) -> float:
    """Area under the ROC curve over every distinct score, computed by a distributed sort."""
    evaluator = BinaryClassificationEvaluator(
        rawPredictionCol=score, labelCol=truth, metricName="areaUnderROC", numBins=0
    )
    return evaluator.evaluate(
        preds.select(F.col(score).cast("double"), F.col(truth).cast("double"))
    )


def reliability_curve(
    preds: DataFrame, probability: str, truth: str, buckets: int = 10
) -> DataFrame:
    """Mean forecast against observed share per bucket of the forecast."""
    bucket = F.least(F.floor(F.col(probability) * buckets), F.lit(buckets - 1)).cast("int")
    return preds.groupBy(bucket.alias("bucket")).agg(
        F.avg(probability).alias("mean_forecast"),
        F.avg(F.col(truth).cast("double")).alias("observed_share"),
        F.count(F.lit(1)).alias("n_rows"),
    )
