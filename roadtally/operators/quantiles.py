"""Exact quantiles per key without gathering a key's rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from roadtally.session import broadcast_if_small, cut_and_measure, cut_lineage, is_small, size_measures

# A sketch of this accuracy is off by at most one rank in so many.
ACCURACY = 10_000


# Values of a key that one task may order; a wider bracket is narrowed first.
FEW = 100_000
MAX_ROUNDS = 40
CELLS = 256


def exact_quantiles(df: DataFrame, key: str, value: str, q: float, name: str) -> DataFrame:
    """Per key the smallest value whose cumulative share of rows reaches ``q``.

    Nulls do not count; NaN counts and is larger than all numbers; a null key is a key like any
    other; a key without values has a null quantile.  Mergeable sketches give a bracket that should
    hold the quantile.  A second pass counts rows below it and inside: a bracket that turns out not
    to hold the wanted rank becomes the whole range.  One that holds many values is cut into cells
    and replaced by the cell of the wanted rank until few are left.  All passes combine map-side,
    and only a few values of a key are ever ordered in one task.
    """
    x = F.col(value).cast("double")
    number = F.when(~F.isnan(x), x)
    rows = df.select(F.col(key).alias("_key"), number.alias("_x"), x.isNotNull().alias("_counts"))
    margin = 2.0 / ACCURACY
    ends = F.percentile_approx("_x", [max(q - margin, 0.0), min(q + margin, 1.0)], ACCURACY)
    keys = rows.groupBy("_key").agg(
        F.count_if("_counts").alias("n"),
        F.count("_x").alias("m"),
        F.min("_x").alias("least"),
        F.max("_x").alias("most"),
        ends.alias("ends"),
    )
    # The rank is the ceiling of q n, written so that rounding of q n does no harm.
    rank = F.greatest(F.col("n") - F.floor(F.col("n") - F.lit(q) * F.col("n")), F.lit(1))
    # Beside NaN the rank lies further up among the numbers than the sketch was asked for.
    high = F.when(F.col("n") == F.col("m"), F.col("ends")[1]).otherwise(F.col("most"))
    brackets = cut_lineage(
        keys.select("_key", "n", "m", "least", "most", rank.alias("rank"), F.col("ends")[0].alias("low"), high.alias("high"))
    )
    open_ = brackets.where(F.col("rank") <= F.col("m"))

    def counted(now: DataFrame) -> DataFrame:
        """The bracket's cells with their rows; the rows below it are one cell, -1."""
        held = rows.join(broadcast_if_small(now.withColumnRenamed("_key", "_k"), stored=True), F.col("_key").eqNullSafe(F.col("_k")))
        width = F.col("high") - F.col("low")
        inner = F.when(width > 0, F.least(F.floor((F.col("_x") / width - F.col("low") / width) * CELLS), F.lit(CELLS - 1))).otherwise(0)
        cell = F.when(F.col("_x") < F.col("low"), -1).otherwise(F.greatest(inner, F.lit(0))).cast("int")
        return (
            held.where(F.col("_x") <= F.col("high"))
            .groupBy("_key", "least", "most", "rank", cell.alias("cell"))
            .agg(F.count(F.lit(1)).alias("times"), F.min("_x").alias("from"), F.max("_x").alias("to"))
        )

    settled = None
    for _ in range(MAX_ROUNDS):
        upward = Window.partitionBy("_key").orderBy("cell")
        reached = counted(open_).withColumn("upto", F.sum("times").over(upward))
        hit = (F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("times") < F.col("rank"))
        found = reached.where(hit).select(
            "_key", "least", "most", "rank", "cell", "times",
            F.when(F.col("cell") < 0, F.col("least")).otherwise(F.col("from")).alias("low"),
            F.when(F.col("cell") < 0, F.col("most")).otherwise(F.col("to")).alias("high"),
        )
        missed = open_.join(found.select(F.col("_key").alias("_k")), F.col("_key").eqNullSafe(F.col("_k")), "left_anti")
        widened = missed.select(
            "_key", "least", "most", "rank", F.lit(-1).alias("cell"), F.lit(FEW + 1).alias("times"),
            F.col("least").alias("low"), F.col("most").alias("high"),
        )
        state, seen = cut_and_measure(
            found.unionByName(widened),
            wide=F.count_if((F.col("cell") < 0) | ((F.col("times") > FEW) & (F.col("low") < F.col("high")))),
        )
        done = state.where((F.col("cell") >= 0) & ((F.col("times") <= FEW) | (F.col("low") == F.col("high"))))
        settled = done if settled is None else settled.unionByName(done)
        if not seen["wide"]:
            break
        open_ = state.join(done.select(F.col("_key").alias("_k")), F.col("_key").eqNullSafe(F.col("_k")), "left_anti")
    else:
        raise RuntimeError("a quantile's bracket did not narrow")

    last = broadcast_if_small(settled.select(F.col("_key").alias("_k"), "rank", "low", "high"))
    inside = rows.join(last, F.col("_key").eqNullSafe(F.col("_k"))).where(F.col("_x") <= F.col("high"))
    values = inside.groupBy("_key", "rank", F.when(F.col("_x") >= F.col("low"), F.col("_x")).alias("at")).agg(
        F.count(F.lit(1)).alias("times")
    )
    order = Window.partitionBy("_key").orderBy(F.asc_nulls_first("at"))
    exact = (
        values.withColumn("upto", F.sum("times").over(order))
        .where(F.col("upto") >= F.col("rank"))
        .groupBy(F.col("_key").alias("_k"))
        .agg(F.min("at").alias("at"))
    )
    nan = F.when((F.col("n") > 0) & (F.col("rank") > F.col("m")), F.lit(float("nan")))
    return brackets.join(exact, F.col("_key").eqNullSafe(F.col("_k")), "left").select(
        F.col("_key").alias(key), F.coalesce("at", nan).cast(df.schema[value].dataType).alias(name)
    )


def weighted_medians(
    counted: DataFrame, key: str, values: Sequence[str], weight: str, few: int = FEW
) -> DataFrame:
    """Per key the median of each of ``values``, a row counting ``weight`` times, and the weights' sum.

    The mean of the two middle values where the sum is even.  Null values do not count, NaN is the
    largest, a null key is a key like any other, and a key without values has null medians.  All
    value columns travel as rows of one table of distinct values and weights.  A key with up to
    ``few`` distinct values is settled by one aggregation; the ranks of the others are narrowed to
    ranges of ``few`` values first, so no task ever holds the values of a busy key.
    """
    axes = F.array(*[F.struct(F.lit(i).alias("axis"), F.col(v).cast("double").alias("x")) for i, v in enumerate(values)])
    rows = counted.select(F.col(key).alias("_key"), F.col(weight).alias("n"), F.explode(axes).alias("at"))
    pairs = cut_lineage(
        rows.select("_key", "n", "at.*")
        .where(F.col("x").isNotNull() & (F.col("n") > 0))
        .groupBy("_key", "axis", "x")
        .agg(F.sum("n").alias("n"))
    )
    number = F.when(_finite("x"), F.col("x"))
    sums = pairs.groupBy("_key", "axis").agg(
        F.sum("n").alias("total"),
        F.count(F.lit(1)).alias("held"),
        F.min(number).alias("low"),
        F.max(number).alias("high"),
    )
    busy, seen = cut_and_measure(sums.where(F.col("held") > few), **size_measures(["_key", "axis", "total"]))
    plain = pairs
    if seen["n"]:
        named = busy.select(F.col("_key").alias("_k"), F.col("axis").alias("_a"))
        plain = pairs.join(F.broadcast(named) if is_small(seen) else named, _same_key(), "left_anti")
    found = plain.groupBy("_key", "axis").agg(F.percentile("x", F.lit(0.5), F.col("n")).alias("x"))
    if seen["n"]:
        middle = F.array_distinct(F.array(F.floor((F.col("total") - 1) / 2), F.floor(F.col("total") / 2)))
        wanted = busy.select(
            "_key", "axis", F.explode(middle).alias("rank"), F.lit(0).cast("bigint").alias("below"), "held", "low", "high"
        )
        found = found.unionByName(_middle_values(pairs, narrowed(pairs, wanted, few)))
    keys = counted.select(
        F.col(key).alias("_key"), F.lit(-1).alias("axis"), F.lit(None).cast("double").alias("x"), F.col(weight).alias("n")
    )
    every = keys.unionByName(found.withColumn("n", F.lit(0).cast(counted.schema[weight].dataType)))
    medians = [F.max(F.when(F.col("axis") == i, F.col("x"))).alias(v) for i, v in enumerate(values)]
    return every.groupBy(F.col("_key").alias(key)).agg(*medians, F.sum("n").alias(weight))


def narrowed(pairs: DataFrame, wanted: DataFrame, few: int = FEW) -> DataFrame:
    """Ranges of at most ``few`` distinct values that hold the wanted ranks, counted from 0.

    ``pairs`` has ``_key, axis, x, n``; ``wanted`` has ``_key, axis, rank`` and the finite ends of the
    values.  Each round cuts every open range into cells of equal width, sums the weights of a cell
    map-side and goes on with the cell of the rank; ``below`` is the weight before it.  Infinities
    and NaN have cells of their own.  A range is one value once its ends are equal.
    """
    group = ["_key", "axis", "rank"]
    upward = Window.partitionBy(*group).orderBy("cell")
    open_, settled, first = wanted, None, True
    for _ in range(MAX_ROUNDS):
        named = open_.select(
            F.col("_key").alias("_k"), F.col("axis").alias("_a"), "rank", "below", "low", "high"
        )
        held = pairs.join(broadcast_if_small(named, stored=not first), _same_key())
        half = F.col("high") * 0.5 - F.col("low") * 0.5
        share = F.try_divide(F.col("x") * 0.5 - F.col("low") * 0.5, half)
        inner = F.least(F.floor(F.coalesce(share, F.lit(0.0)) * CELLS), F.lit(CELLS - 1))
        cell = F.when(F.isnan("x"), CELLS + 1).when(_finite("x"), inner).otherwise(F.when(F.col("x") > 0, CELLS).otherwise(-1))
        inside = held if first else held.where(F.col("x").between(F.col("low"), F.col("high")))
        cells = inside.groupBy(*group, "below", cell.cast("int").alias("cell")).agg(
            F.sum("n").alias("times"), F.count(F.lit(1)).alias("held"), F.min("x").alias("low"), F.max("x").alias("high")
        )
        upto = cells.withColumn("upto", F.col("below") + F.sum("times").over(upward))
        hit = (F.col("upto") > F.col("rank")) & (F.col("upto") - F.col("times") <= F.col("rank"))
        found = upto.where(hit).select(*group, (F.col("upto") - F.col("times")).alias("below"), "held", "low", "high")
        state, seen = cut_and_measure(found, wide=F.count_if(F.col("held") > few))
        done = state.where(F.col("held") <= few)
        settled = done if settled is None else settled.unionByName(done)
        if not seen["wide"]:
            return settled
        open_, first = state.where(F.col("held") > few), False
    raise RuntimeError("a median's range did not narrow")


def _middle_values(pairs: DataFrame, ranges: DataFrame) -> DataFrame:
    """The mean of the values at the ranks that :func:`narrowed` has found ranges for."""
    ends = ranges.select(F.col("_key").alias("_k"), F.col("axis").alias("_a"), "rank", "below", "low", "high")
    inside = pairs.join(broadcast_if_small(ends, stored=True), _same_key()).where(
        F.col("x").between(F.col("low"), F.col("high"))
    )
    upward = Window.partitionBy("_key", "axis", "rank").orderBy("x")
    reached = inside.withColumn("upto", F.col("below") + F.sum("n").over(upward))
    at = reached.where(F.col("upto") > F.col("rank")).groupBy("_key", "axis", "rank").agg(F.min("x").alias("x"))
    return at.groupBy("_key", "axis").agg(F.avg("x").alias("x"))


def _finite(name: str) -> Column:
    return ~F.isnan(name) & (F.abs(F.col(name)) < float("inf"))


def _same_key() -> Column:
    return F.col("_key").eqNullSafe(F.col("_k")) & (F.col("axis") == F.col("_a"))
