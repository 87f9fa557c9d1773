"""Walk-forward folds over the observed timestamps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from roadtally.session import broadcast_if_small, cut_lineage

MIN_TIMES = 10


def numbered_times(df: DataFrame, ts: str) -> DataFrame:
    """The distinct timestamps with their 0-based place in time order.

    Times are numbered within a day and shifted by the count of earlier days, so nothing but
    the table of days, one row per calendar day, is ever ordered as a whole.
    """
    times = df.where(F.col(ts).isNotNull()).select(F.col(ts).cast("timestamp").alias("t")).distinct()
    dated = cut_lineage(times.withColumn("day", F.to_date("t")))
    per_day = dated.groupBy("day").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    shifts = per_day.select(
        "day", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("shift")
    )
    in_day = Window.partitionBy("day").orderBy("t")
    return dated.join(broadcast_if_small(shifts), "day").select(
        "t", (F.col("shift") + F.row_number().over(in_day) - 1).alias("place")
    )


def walkforward_folds(df: DataFrame, ts: str, n_folds: int = 3, test_days: int = 30) -> DataFrame:
    """``fold, train_end, test_end``: train up to the first, test after it up to the second.

    Cuts lie at even places in the list of observed timestamps, so ``test_days`` means
    24 observed timestamps a day, however far apart they lie.
    """
    times = numbered_times(df, ts)
    n = times.count()
    if n < MIN_TIMES:
        raise ValueError(f"{n} distinct timestamps in {ts}; at least {MIN_TIMES} are needed")
    cuts = []
    for fold in range(1, n_folds + 1):
        train = min(max(int(fold / (n_folds + 1) * (n - 1)), 1), n - 2)
        test = min(train + max(1, test_days * 24), n - 1)
        if test > train:
            cuts.append((fold, train, test))
    wanted = df.sparkSession.createDataFrame(cuts, "fold int, train bigint, test bigint")
    ends = wanted.select(
        "fold",
        F.inline(
            F.array(
                F.struct(F.lit("train").alias("end"), F.col("train").alias("place")),
                F.struct(F.lit("test").alias("end"), F.col("test").alias("place")),
            )
        ),
    )
    hits = times.join(F.broadcast(ends), "place")
    return hits.groupBy("fold").agg(
        F.max(F.when(F.col("end") == "train", F.col("t"))).alias("train_end"),
        F.max(F.when(F.col("end") == "test", F.col("t"))).alias("test_end"),
    )


def fold_split(df: DataFrame, ts: str, train_end, test_end) -> tuple[DataFrame, DataFrame]:
    when = F.col(ts)
    return df.where(when <= F.lit(train_end)), df.where(
        (when > F.lit(train_end)) & (when <= F.lit(test_end))
    )
