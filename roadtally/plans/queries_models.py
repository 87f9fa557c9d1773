"""Scores, folds, baselines and models."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame, SparkSession, functions as F

from roadtally.operators import fold_statistics, folds, learning, metrics, series, tree_tables
from roadtally.operators.hotspots import flag_hotspots, with_threshold
from roadtally.plans import stand_ins
from roadtally.plans.queries_series import gold_features
from roadtally.plans.registry import ORACLES, query, rounded, table
from roadtally.session import scratch_path
from roadtally.sources.sinks import write_scores
from roadtally.plans.stand_ins import FLAGS, PREDICTIONS, SERIES, predictions

SCORES = """count(*) AS n_rows, round(sqrt(avg(pow(p - y, 2))), 6) AS rmse,
       round(avg(abs(p - y)), 6) AS mae,
       round(1 - avg(pow(p - y, 2)) / nullif(var_pop(y), 0), 6) AS r2,
       round(coalesce(100.0::DOUBLE * avg(CASE WHEN p + y > 0 THEN
         (sqrt(2.0 * (p - y) * (p - y) / (p + y)) < 5.0)::INT END), 0.0), 6) AS geh_pct_lt5"""

SCORED = f"""{PREDICTIONS},
scored AS (SELECT *, y_true AS y, y_pred AS p FROM predictions)"""


@query(f"WITH {SCORED} SELECT {SCORES} FROM scored")
def regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.regression_scores(predictions(spark, sf_dir), "y_true", "y_pred"))


@query(
    f"""WITH {SCORED},
s AS (SELECT count(*) AS n, sqrt(avg(pow(p - y, 2))) AS rmse, avg(abs(p - y)) AS mae,
             1 - avg(pow(p - y, 2)) / nullif(var_pop(y), 0) AS r2 FROM scored)
SELECT unnest(['Scoring window rows: ' || n, 'Train rows: ' || n,
  'RMSE: ' || format('{{:.3f}}', rmse), 'MAE : ' || format('{{:.3f}}', mae), 'R2  : ' || format('{{:.6f}}', r2),
  'Hotspot quantile (per hour): 0.8']) AS value
FROM s"""
)
def evaluation_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The evaluation file of a scoring window, written and read back."""
    path = scratch_path(spark, "evaluation")
    scores = metrics.regression_scores(predictions(spark, sf_dir), "y_true", "y_pred")
    named = scores.withColumnRenamed("n_rows", "score_rows").withColumn("train_rows", F.col("score_rows"))
    write_scores(named, path, 0.8)
    return spark.read.text(path)


@query(
    f"""WITH {SCORED}
SELECT CASE WHEN hour_of_day IN (7, 8, 9, 16, 17, 18) THEN 'peak' ELSE 'off_peak' END AS period,
       {SCORES}
FROM scored GROUP BY 1"""
)
def error_by_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = predictions(spark, sf_dir).withColumn("period", metrics.peak_label())
    return rounded(metrics.regression_scores(rows, "y_true", "y_pred", ["period"]))


@query(f"WITH {SCORED} SELECT from_node, {SCORES} FROM scored GROUP BY 1")
def error_by_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = predictions(spark, sf_dir)
    return rounded(metrics.regression_scores(rows, "y_true", "y_pred", ["from_node"]))


@query(
    """SELECT month(o_orderdate)::INT AS month, round(avg(o_totalprice / 7.0::DOUBLE), 6) AS mean_volume,
       count(*) AS n_rows
FROM orders GROUP BY 1"""
)
def monthly_mean_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return rounded(
        orders.groupBy(F.month("o_orderdate").alias("month")).agg(
            F.avg(F.col("o_totalprice") / 7.0).alias("mean_volume"), F.count(F.lit(1)).alias("n_rows")
        )
    )


@query(
    f"""WITH {PREDICTIONS}
SELECT hour_of_day, round(coalesce(100.0::DOUBLE * avg(CASE WHEN y_pred + y_true > 0 THEN
         (sqrt(2.0 * (y_pred - y_true) * (y_pred - y_true) / (y_pred + y_true)) < 5.0)::INT END),
         0.0), 6) AS geh_pct_lt5
FROM predictions GROUP BY 1"""
)
def geh_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = predictions(spark, sf_dir).groupBy("hour_of_day")
    return rounded(rows.agg(metrics.geh_share("y_true", "y_pred").alias("geh_pct_lt5")))


@query(
    f"""WITH {SCORED},
folds AS (SELECT day_of_week AS fold, month, CASE WHEN hour_of_day < 12 THEN 'AM' ELSE 'PM' END AS model,
  {SCORES} FROM scored GROUP BY 1, 2, 3)
SELECT model, count(*) AS folds, round(avg(rmse), 6) AS avg_rmse, round(avg(mae), 6) AS avg_mae,
       round(avg(r2), 6) AS avg_r2, round(avg(geh_pct_lt5), 6) AS avg_geh,
       round(stddev_samp(rmse), 6) AS std_rmse
FROM folds GROUP BY 1"""
)
def model_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores per weekday stand for folds, the two halves of the day for models."""
    half = F.when(F.col("hour_of_day") < 12, "AM").otherwise("PM")
    rows = predictions(spark, sf_dir).withColumn("model", half)
    scored = metrics.regression_scores(
        rows, "y_true", "y_pred", ["day_of_week", "month", "model"]
    )
    return rounded(metrics.model_summary(rounded(scored)))


@query(
    f"""WITH {SERIES},
times AS (
  SELECT ts_hour, row_number() OVER (ORDER BY ts_hour) - 1 AS place, count(*) OVER () AS n
  FROM (SELECT DISTINCT ts_hour FROM series)),
cuts AS (
  SELECT fold, n, greatest(1, least(floor(fold / 4.0 * (n - 1))::BIGINT, n - 2)) AS e
  FROM (SELECT max(n) AS n FROM times), (VALUES (1), (2), (3)) AS f(fold))
SELECT fold::INT AS fold, a.ts_hour AS train_end, b.ts_hour AS test_end
FROM cuts JOIN times a ON a.place = e JOIN times b ON b.place = least(e + 240, cuts.n - 1)"""
)
def walkforward_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folds.walkforward_folds(stand_ins.series(spark, sf_dir), "ts_hour", test_days=10)


@query(
    f"""WITH {SERIES}
SELECT DISTINCT ts_hour, dense_rank() OVER (ORDER BY ts_hour) - 1 AS place FROM series"""
)
def ordered_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    times = folds.numbered_times(stand_ins.series(spark, sf_dir), "ts_hour")
    return times.withColumnRenamed("t", "ts_hour")


def _baseline(lag: int) -> str:
    return f"""WITH {SERIES},
rows_ AS (
  SELECT lead(volume, 1) OVER w AS y, lag(volume, {lag}) OVER w AS p FROM series
  WINDOW w AS (PARTITION BY segment_id ORDER BY ts_hour))
SELECT {SCORES} FROM rows_ WHERE y IS NOT NULL AND p IS NOT NULL"""


def _lag_scores(spark: SparkSession, sf_dir: str, lag: str) -> DataFrame:
    rows = series.sequence_features(
        stand_ins.series(spark, sf_dir), "segment_id", ["ts_hour"], "volume", split_above=None
    )
    base = learning.lag_baseline(rows, "y_t_plus_1h", lag)
    return rounded(metrics.regression_scores(base, "label", "prediction"))


@query(_baseline(1))
def persistence_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lag_scores(spark, sf_dir, "lag_1h")


@query(_baseline(24))
def seasonal_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lag_scores(spark, sf_dir, "lag_24h")


@query(
    f"""WITH {SERIES}, cut AS (SELECT max(ts_hour) - INTERVAL 7 DAY AS c FROM series)
SELECT segment_id, ts_hour, CASE WHEN ts_hour <= c THEN 'train' ELSE 'score' END AS part
FROM series, cut"""
)
def score_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stand_ins.series(spark, sf_dir).drop("volume")
    train, score = learning.last_days_split(rows, "ts_hour", 7)
    return train.withColumn("part", F.lit("train")).unionByName(
        score.withColumn("part", F.lit("score"))
    )


def _truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flags with the truth beside them: the true value in the top part of its hour."""
    flags = flag_hotspots(predictions(spark, sf_dir)).drop("hotspot_threshold")
    rows = with_threshold(flags, "ts_hour", "y_true", 0.6)
    return rows.withColumn("truth", (F.col("y_true") >= F.col("hotspot_threshold")).cast("int"))


TRUTH = (
    FLAGS
    + """,
tops AS (SELECT ts_hour, quantile_disc(y_true, 0.6) AS top FROM predictions GROUP BY 1),
judged AS (SELECT f.*, (y_true >= top)::INT AS truth FROM flags f JOIN tops USING (ts_hour))"""
)


@query(
    f"""WITH {TRUTH},
counts AS (
  SELECT count(*) FILTER (WHERE is_hotspot = 1 AND truth = 1) AS tp,
         count(*) FILTER (WHERE is_hotspot = 1 AND truth = 0) AS fp,
         count(*) FILTER (WHERE is_hotspot = 0 AND truth = 1) AS fn,
         count(*) FILTER (WHERE is_hotspot = 0 AND truth = 0) AS tn
  FROM judged)
SELECT *, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall,
       round(2.0::DOUBLE * tp / (2 * tp + fp + fn), 6) AS f1
FROM counts"""
)
def flag_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.flag_scores(_truth(spark, sf_dir), "is_hotspot", "truth"))


@query(
    f"""WITH {TRUTH},
by_score AS (
  SELECT y_pred, sum(truth) AS pos, sum(1 - truth) AS neg FROM judged GROUP BY 1),
below AS (
  SELECT *, coalesce(sum(neg) OVER (ORDER BY y_pred ROWS BETWEEN UNBOUNDED PRECEDING
    AND 1 PRECEDING), 0) AS neg_below FROM by_score)
SELECT round((sum(pos * (neg_below + neg / 2.0)) / (sum(pos) * sum(neg)))::DOUBLE, 6) AS auc
FROM below"""
)
def flag_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    auc = metrics.flag_auc(_truth(spark, sf_dir), "y_pred", "truth")
    return rounded(spark.createDataFrame([(auc,)], "auc double"))


@query(
    f"""WITH {TRUTH},
probs AS (SELECT truth, least(y_pred / 70.0::DOUBLE, 1.0::DOUBLE) AS prob FROM judged)
SELECT least(floor(prob * 10), 9)::INT AS bucket, round(avg(prob), 6) AS mean_forecast,
       round(avg(truth), 6) AS observed_share, count(*) AS n_rows
FROM probs GROUP BY 1"""
)
def reliability_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    prob = F.least(F.col("y_pred") / F.lit(70.0), F.lit(1.0))
    rows = _truth(spark, sf_dir).withColumn("prob", prob)
    return rounded(metrics.reliability_curve(rows, "prob", "truth"))


# ---- models: what SQL can say of them -------------------------------------------------------

READY = f"""gold AS ({ORACLES["gold_features"]}),
ready AS (
  SELECT *, y_t_plus_1h AS y FROM gold WHERE lag_2h IS NOT NULL AND lag_24h IS NOT NULL
    AND roll_mean_24h IS NOT NULL AND roll_std_24h IS NOT NULL)"""


def _folds_sql(model: str) -> str:
    """Folds of five days, how many rows each trains and tests on, and that scores beat persistence."""
    return f"""WITH {READY},
times AS (
  SELECT ts_hour, row_number() OVER (ORDER BY ts_hour) - 1 AS place, count(*) OVER () AS n
  FROM (SELECT DISTINCT ts_hour FROM ready)),
cuts AS (
  SELECT fold, n, greatest(1, least(floor(fold / 4.0 * (n - 1))::BIGINT, n - 2)) AS e
  FROM (SELECT max(n) AS n FROM times), (VALUES (1), (2), (3)) AS f(fold)),
bounds AS (
  SELECT fold, a.ts_hour AS train_end, b.ts_hour AS test_end
  FROM cuts JOIN times a ON a.place = e JOIN times b ON b.place = least(e + 120, cuts.n - 1))
SELECT fold::INT AS fold, '{model}' AS model, train_end, test_end,
       count(*) FILTER (WHERE ts_hour <= train_end) AS train_rows,
       count(*) FILTER (WHERE ts_hour > train_end AND ts_hour <= test_end) AS test_rows,
       TRUE AS sound
FROM ready, bounds GROUP BY 1, 3, 4"""


def _walk(spark: SparkSession, sf_dir: str, **models) -> DataFrame:
    """``sound``: scores are finite, in order, and better than those of the last value as forecast."""
    gold = gold_features(spark, sf_dir)
    scores = learning.walk_forward(gold, "y_t_plus_1h", models, test_days=5)
    bounds = scores.select("fold", "train_end", "test_end").distinct()
    held = gold.join(F.broadcast(bounds), (F.col("ts_hour") > F.col("train_end")) & (F.col("ts_hour") <= F.col("test_end")))
    base = learning.lag_baseline(held, "y_t_plus_1h", "lag_1h", ["fold"])
    persisted = metrics.regression_scores(base, "label", "prediction", ["fold"]).select("fold", F.col("rmse").alias("base"))
    sound = (F.col("rmse") >= 0) & (F.col("rmse") < F.col("base")) & (F.col("mae") <= F.col("rmse")) & (F.col("r2") <= 1)
    return scores.join(F.broadcast(persisted), "fold", "left").select(
        "fold", "model", "train_end", "test_end", "train_rows", "test_rows", F.coalesce(sound, F.lit(False)).alias("sound")
    )


@query(_folds_sql("LR"))
def walkforward_lr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _walk(spark, sf_dir, LR=learning.linear("y_t_plus_1h"))


@query(_folds_sql("GBT"))
def walkforward_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _walk(spark, sf_dir, GBT=learning.boosted("y_t_plus_1h"))


@query(_folds_sql("RF"))
def walkforward_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _walk(spark, sf_dir, RF=learning.forest("y_t_plus_1h"))


@query(
    f"""WITH {READY}
SELECT round(regr_slope(y, lag_1h), 4) AS slope, round(regr_intercept(y, lag_1h), 2) AS intercept,
       count(*) AS n_rows
FROM ready"""
)
def linear_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The linear model on one feature and without a penalty is the least-squares line."""
    ready = gold_features(spark, sf_dir).dropna(
        subset=["lag_2h", "lag_24h", "roll_mean_24h", "roll_std_24h", "y_t_plus_1h"]
    )
    rows = learning.vectors(["lag_1h"], "skip").transform(ready)
    model = learning.linear("y_t_plus_1h", regParam=0.0, solver="normal").fit(rows)
    return rows.agg(
        F.round(F.lit(float(model.coefficients[0])), 4).alias("slope"),
        F.round(F.lit(float(model.intercept)), 2).alias("intercept"),
        F.count(F.lit(1)).alias("n_rows"),
    )


FITTED = ["lag_1h", "lag_24h"]


@query(
    f"""WITH {READY},
used AS (SELECT ts_hour, lag_1h::DOUBLE AS a, lag_24h::DOUBLE AS b, y::DOUBLE AS y FROM ready),
times AS (
  SELECT ts_hour, row_number() OVER (ORDER BY ts_hour) - 1 AS place, count(*) OVER () AS n
  FROM (SELECT DISTINCT ts_hour FROM used)),
cuts AS (
  SELECT fold, n, greatest(1, least(floor(fold / 5.0 * (n - 1))::BIGINT, n - 2)) AS e
  FROM (SELECT max(n) AS n FROM times), (VALUES (1), (2), (3), (4)) AS f(fold)),
bounds AS (
  SELECT fold, s.ts_hour AS train_end, t.ts_hour AS test_end
  FROM cuts JOIN times s ON s.place = e JOIN times t ON t.place = least(e + 120, cuts.n - 1)),
sums AS (
  SELECT fold, train_end, test_end, count(*) AS train_rows, avg(a) AS ma, avg(b) AS mb, avg(y) AS my,
         var_pop(a) AS aa, var_pop(b) AS bb, covar_pop(a, b) AS ab, covar_pop(a, y) AS ay, covar_pop(b, y) AS by_,
         0.1::DOUBLE / stddev_pop(y) AS p
  FROM bounds JOIN used ON ts_hour <= train_end GROUP BY 1, 2, 3),
fits AS (
  SELECT *, (ay * bb * (1 + p) - by_ * ab) / (aa * bb * (1 + p) * (1 + p) - ab * ab) AS c1,
         (by_ * aa * (1 + p) - ay * ab) / (aa * bb * (1 + p) * (1 + p) - ab * ab) AS c2
  FROM sums),
judged AS (
  SELECT fold, count(*) AS test_rows, sqrt(avg(pow(y - (my - c1 * ma - c2 * mb) - c1 * a - c2 * b, 2))) AS rmse
  FROM fits JOIN used ON ts_hour > train_end AND ts_hour <= test_end GROUP BY 1)
SELECT fold::INT AS fold, train_end, test_end, train_rows, test_rows, round(my - c1 * ma - c2 * mb, 3) AS intercept,
       round(c1, 6) AS coef_lag_1h, round(c2, 6) AS coef_lag_24h, round(rmse, 3) AS rmse
FROM fits JOIN judged USING (fold)"""
)
def fold_linear_fits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The penalised model of four folds from one scan, with the errors on their test windows."""
    ready = gold_features(spark, sf_dir).dropna(subset=["lag_2h", "lag_24h", "roll_mean_24h", "roll_std_24h"])
    fits = fold_statistics.fold_linear_fits(ready, "y_t_plus_1h", FITTED, n_folds=4, test_days=5)
    return fits.select(
        "fold", "train_end", "test_end", "train_rows", "test_rows", F.round("intercept", 3).alias("intercept"),
        *[F.round(F.col("coefficients")[i], 6).alias(f"coef_{c}") for i, c in enumerate(FITTED)],
        F.round("rmse", 3).alias("rmse"),
    )


@query(
    f"""WITH {READY},
parted AS (
  SELECT segment_id, ts_hour, volume, lag_1h, y,
         ('0x' || substr(md5(segment_id || '|' || epoch(ts_hour)::BIGINT), 1, 8))::BIGINT < 3435973836 AS train
  FROM ready),
fitted AS (
  SELECT avg(volume) AS mv, stddev_samp(volume) AS sv, avg(lag_1h) AS ml, stddev_samp(lag_1h) AS sl FROM parted WHERE train)
SELECT segment_id, ts_hour, CASE WHEN train THEN 'train' ELSE 'test' END AS part,
       round((volume - mv) / sv, 6) AS volume, round((lag_1h - ml) / sl, 6) AS lag_1h
FROM parted, fitted"""
)
def scaled_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of both parts of a split, scaled by the mean and deviation of its larger part."""
    ready = gold_features(spark, sf_dir).dropna(
        subset=["lag_2h", "lag_24h", "roll_mean_24h", "roll_std_24h", "y_t_plus_1h"]
    )
    rows = ready.withColumn("second", F.unix_timestamp("ts_hour"))
    train = learning.split_test(["segment_id", "second"])
    parted = rows.withColumn("part", F.when(train, "train").otherwise("test"))
    scaled = fold_statistics.standardised(parted, ["volume", "lag_1h"], F.col("part") == "train")
    return rounded(scaled.select("segment_id", "ts_hour", "part", "volume", "lag_1h"))


STUMP = ["hour_of_day", "day_of_week", "month"]
STEP = 0.1


def _best_split(name: str, rows: str) -> str:
    """The split of ``rows`` (features ``f0, f1, ...`` and label ``y``) that leaves the least squares."""
    places, columns = list(range(len(STUMP))), ", ".join(f"f{i}" for i in range(len(STUMP)))
    return f"""{name}_levels AS (
  SELECT feature, x, count(*) AS n, sum(y) AS s
  FROM (SELECT unnest({places}) AS feature, unnest([{columns}]) AS x, y FROM {rows}) GROUP BY 1, 2),
{name}_sides AS (
  SELECT feature, x, lead(x) OVER w AS next, sum(n) OVER w AS n, sum(s) OVER w AS s,
         sum(n) OVER (PARTITION BY feature) AS all_n, sum(s) OVER (PARTITION BY feature) AS all_s
  FROM {name}_levels WINDOW w AS (PARTITION BY feature ORDER BY x)),
{name} AS (
  SELECT feature, (x + next) / 2 AS threshold, s / n AS low, (all_s - s) / (all_n - n) AS high
  FROM {name}_sides WHERE next IS NOT NULL
  ORDER BY s * s / n + (all_s - s) * (all_s - s) / (all_n - n) DESC, feature, x LIMIT 1)"""


_START = f"""{PREDICTIONS},
labelled AS (
  SELECT ts_hour, count_point_id, y_true::DOUBLE AS truth, y_true::DOUBLE AS y,
         {", ".join(f"{c}::DOUBLE AS f{i}" for i, c in enumerate(STUMP))}
  FROM predictions)"""


def _boosted_sql(rounds: int) -> str:
    """Stumps one after another, each on twice what the ones before leave over."""
    parts, rows = [_START, "left_0 AS (SELECT *, 0.0::DOUBLE AS p FROM labelled)"], "left_0"
    for i in range(rounds):
        value = f"CASE WHEN [f0, f1, f2][feature + 1] <= threshold THEN low ELSE high END * {1.0 if i == 0 else STEP}::DOUBLE"
        parts.append(_best_split(f"split_{i}", rows))
        parts.append(
            f"""left_{i + 1} AS (
  SELECT ts_hour, count_point_id, truth, f0, f1, f2, p + {value} AS p, 2 * (truth - p - {value}) AS y
  FROM {rows}, split_{i})"""
        )
        rows = f"left_{i + 1}"
    return f"WITH {', '.join(parts)} SELECT ts_hour, count_point_id, round(p, 6) AS prediction FROM {rows}"


@query(_boosted_sql(4))
def tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four boosted stumps: the fit as Spark ML makes it, the scores from the table of its nodes."""
    rows = predictions(spark, sf_dir)
    ready = rows.withColumns({"y_true": F.col("y_true").cast("double"), "row": F.struct("ts_hour", "count_point_id")})
    model = learning.boosted("y_true", {"maxIter": 4, "maxDepth": 1, "maxBins": 64, "stepSize": STEP}).fit(
        learning.vectors(STUMP, "error").transform(ready)
    )
    features = F.array(*[F.col(c).cast("double") for c in STUMP])
    scored = tree_tables.tree_scores(ready, tree_tables.tree_nodes(spark, model), "row", features)
    return rounded(scored.select("row.*", "prediction"))


@query(
    f"""WITH {_START},
{_best_split("best", "labelled")}
SELECT feature::INT AS feature, threshold, round(low, 6) AS left_value, round(high, 6) AS right_value FROM best"""
)
def stump_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tree of depth one on few distinct values: its split and the means of its leaves."""
    nodes = tree_tables.tree_nodes(spark, _stump(predictions(spark, sf_dir)))
    leaf = {
        side: nodes.select(F.col("node").alias(side), F.col("value").alias(f"{side}_value")) for side in ("left", "right")
    }
    root = nodes.where("node = 0").select("feature", "threshold", "left", "right")
    return rounded(
        root.join(leaf["left"], "left").join(leaf["right"], "right").select("feature", "threshold", "left_value", "right_value")
    )


def _stump(rows: DataFrame):
    tree = DecisionTreeRegressor(labelCol="y_true", maxDepth=1, maxBins=64, minInstancesPerNode=1)
    return tree.fit(learning.vectors(STUMP, "error").transform(rows.withColumn("y_true", F.col("y_true").cast("double"))))


def point_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature rows with a place and two junctions, as the scoring job wants them."""
    preds = predictions(spark, sf_dir).select(
        "ts_hour",
        "count_point_id",
        "latitude",
        "longitude",
        F.col("from_node").alias("start_junction_road_name"),
        F.col("to_node").alias("end_junction_road_name"),
        F.col("y_true").alias("all_motor_vehicles"),
    )
    return series.gold_features(preds, "London", split_above=None)


@query()
def score_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    preds, _, _ = learning.score_last_days(point_features(spark, sf_dir), score_days=7)
    return flag_hotspots(preds)


@query()
def scaled_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Random split, scaled features, boosted trees, scores on the smaller part."""
    features = ["hour_of_day", "day_of_week", "month", "latitude", "longitude"]
    label = "all_motor_vehicles"
    rows = learning.model_rows(point_features(spark, sf_dir), label, features, ["ts_hour"])
    train, test = learning.random_split(rows, ["ts_hour", *features, label])
    train = train.persist(StorageLevel.MEMORY_AND_DISK)  # read by the scaler, the bins and the trees
    try:
        model = learning.scaled_boosting(label, features).fit(learning.in_tasks(train, train.count()))
    finally:
        train.unpersist()
    return metrics.regression_scores(model.transform(test), label, "prediction")


@query(
    """SELECT event_id FROM events
WHERE ('0x' || substr(md5(event_id::VARCHAR), 1, 8))::BIGINT
      < (SELECT greatest(count(*) // 5, 1) * 4294967296 // count(*) FROM events)"""
)
def train_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """About a fifth of the events, chosen by their id."""
    events = table(spark, sf_dir, "events")
    n = events.count()
    return learning.down_sample(events, max(n // 5, 1), ["event_id"], n).select("event_id")
