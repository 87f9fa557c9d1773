"""Linear models of all folds, and scaling, from sums that merge."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from roadtally.operators.folds import walkforward_folds

FOLD_FITS = (
    "fold int, train_end timestamp, test_end timestamp, train_rows bigint, test_rows bigint, intercept double, "
    "coefficients array<double>, train_rmse double, rmse double, r2 double"
)


def block_moments(df: DataFrame, columns: Sequence[str], block: Column) -> DataFrame:
    """Per block of rows: their number, means, and products of deviations of every two columns.

    Deviations are from the block's own means, so large values lose no digits; blocks are merged by
    :func:`merged`.  One scan, combined map-side: a task keeps one buffer per block.  A row that
    lacks a block or a value in any column does not count.
    """
    whole = df.select(block.alias("block"), *[F.col(c).cast("double").alias(c) for c in columns]).dropna()
    n = F.count(F.lit(1))
    products = [
        F.array(*[F.covar_pop(a, b) * n for b in columns]) for a in columns
    ]
    return whole.groupBy("block").agg(
        n.alias("n"), F.array(*[F.avg(c) for c in columns]).alias("means"), F.array(*products).alias("products")
    )


def merged(parts: Sequence[tuple[int, np.ndarray, np.ndarray]]) -> tuple[int, np.ndarray, np.ndarray]:
    """Number, means and products of deviations of several blocks together."""
    n = sum(p[0] for p in parts)
    means = sum(p[0] * p[1] for p in parts) / n
    return n, means, sum(c + k * np.outer(m - means, m - means) for k, m, c in parts)


def ridge(n: int, means: np.ndarray, products: np.ndarray, penalty: float) -> tuple[float, np.ndarray]:
    """Intercept and coefficients of the last column on the others.

    The penalty falls on coefficients of standardised features and is divided by the label's
    deviation, as in Spark's linear regression.  A feature that does not vary has coefficient 0, and
    a label that does not vary makes all of them 0.
    """
    spread = products[-1, -1] / n
    own = np.diag(products)[:-1] / n
    coefficients = np.zeros(len(own))
    varies = own > 0
    if spread > 0 and varies.any():
        normal = products[:-1, :-1][np.ix_(varies, varies)] / n + np.diag(penalty / np.sqrt(spread) * own[varies])
        right = products[:-1, -1][varies] / n
        coefficients[varies] = np.linalg.lstsq(normal, right, rcond=None)[0]
    return float(means[-1] - coefficients @ means[:-1]), coefficients


def mean_square(part: tuple[int, np.ndarray, np.ndarray], intercept: float, coefficients: np.ndarray) -> float:
    """The model's mean squared error on rows known by their moments only."""
    n, means, products = part
    signs = np.append(-coefficients, 1.0)
    bias = signs @ means - intercept
    return max(float(signs @ products @ signs) / n, 0.0) + float(bias) ** 2


def fold_linear_fits(
    df: DataFrame,
    label: str,
    features: Sequence[str],
    *,
    ts: str = "ts_hour",
    penalty: float = 0.1,
    n_folds: int = 3,
    test_days: int = 30,
) -> DataFrame:
    """The penalised linear model of every walk-forward fold, and its errors, from one scan.

    The ends of all training and test windows cut time into at most twice as many blocks as there
    are folds. The scan gives moments per block; a fold's training rows are the first blocks, its
    test rows the ones after them, so both come from merging blocks.  What reaches the driver is one
    row of k x k numbers for each block, whatever the number of rows.  Folds are cut over all
    timestamps of rows with a label; one without training or test rows is left out.
    """
    rows = df.where(F.col(label).isNotNull() & F.col(ts).isNotNull())
    columns = [*features, label]
    rows = rows.select(ts, *columns).dropna()
    bounds = walkforward_folds(rows, ts, n_folds, test_days).orderBy("fold").collect()
    ends = sorted({t for b in bounds for t in (b.train_end, b.test_end)})
    block = sum(((F.col(ts) > F.lit(t)).cast("int") for t in ends), F.lit(0))
    found = {
        r["block"]: (r["n"], np.array(r["means"]), np.array(r["products"]).reshape(len(columns), -1))
        for r in block_moments(rows, columns, block).collect()
    }
    fits = []
    for fold, train_end, test_end in bounds:
        first, last = ends.index(train_end), ends.index(test_end)
        train = [found[b] for b in range(first + 1) if b in found]
        test = [found[b] for b in range(first + 1, last + 1) if b in found]
        if not train or not test:
            continue
        train, test = merged(train), merged(test)
        intercept, coefficients = ridge(*train, penalty)
        wrong = mean_square(test, intercept, coefficients)
        spread = float(test[2][-1, -1]) / test[0]
        fits.append(
            (fold, train_end, test_end, train[0], test[0], intercept, coefficients.tolist(),
             mean_square(train, intercept, coefficients) ** 0.5, wrong**0.5, 1 - wrong / spread if spread > 0 else None)
        )
    return df.sparkSession.createDataFrame(fits, FOLD_FITS)


def standardised(df: DataFrame, columns: Sequence[str], fitted_on: Column) -> DataFrame:
    """``columns`` less their mean, over their sample deviation, both of the rows ``fitted_on`` holds for.

    Means and squared deviations merge map-side, so one small row returns from a single scan. Nulls
    stay null and do not count; a column that does not vary becomes 0, as does one of fewer than two
    rows.
    """
    whole = {c: F.col(c).cast("double") for c in columns}
    on = {c: F.when(fitted_on, x) for c, x in whole.items()}
    seen = df.agg(
        *[F.avg(x).alias(f"mean_{i}") for i, x in enumerate(on.values())],
        *[F.stddev_samp(x).alias(f"spread_{i}") for i, x in enumerate(on.values())],
    ).first()
    scaled = {}
    for i, (c, x) in enumerate(whole.items()):
        mean, spread = seen[f"mean_{i}"], seen[f"spread_{i}"]
        scaled[c] = (x - F.lit(mean)) / F.lit(spread) if spread else F.when(x.isNotNull(), F.lit(0.0))
    return df.withColumns(scaled)
