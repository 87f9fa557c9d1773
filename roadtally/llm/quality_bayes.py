"""Quality classifier: document evidence over priors that are pooled by host and path."""

from __future__ import annotations

from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame, functions as F

from roadtally.llm.columns import narrow
from roadtally.llm.statistics import FEATURES, with_statistics
from roadtally.session import cut_lineage

BINS = 24
# Documents whose probability of being good is lower are rejected: those more likely bad than good.
# On the labelled rows of sf0.1 this rejects 566 of 571 bad ones (0.1: 548) and 6 of 3,409 good (0.1: 1).
LEAST_GOOD = 0.5
# Weight of a label against the evidence of an unlabelled document in the counts of a site.
LABEL_WEIGHT = 1.0
# Limits of the pooling strength, in documents.
STRENGTH = (5.0, 1000.0)


@dataclass(frozen=True)
class Evidence:
    """Log likelihood ratio of good against bad: one table for each feature's quantile bins."""

    thresholds: dict[str, list[float]]
    weights: dict[str, list[float]]
    scale: float
    shift: float

    def of(self, stats: str) -> Column:
        total = F.lit(0.0)
        for f, cuts in self.thresholds.items():
            value = F.col(f"{stats}.{f}").cast("double")
            inner = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda t: t < value))
            total = total + F.array(*map(F.lit, self.weights[f]))[inner]
        return F.lit(self.shift) + self.scale * total


def learn_evidence(stats: DataFrame) -> Evidence:
    """Fit the tables on ``good, s`` by counts of each feature's bins, over all rows given.

    The features depend on each other, so their sum says too much: it is scaled and shifted by a
    logistic fit of the label on counts of the rounded sum. Without both kinds of labels the
    evidence is 0 everywhere.
    """
    ranks = [k / BINS for k in range(1, BINS)]
    row = stats.agg(
        *[F.percentile_approx(F.col(f"s.{f}").cast("double"), ranks, 10_000).alias(f) for f in FEATURES],
        F.count_if("good").alias("_good"),
        F.count_if(~F.col("good")).alias("_bad"),
    ).first()
    good, bad = row["_good"], row["_bad"]
    if not good or not bad:
        return Evidence({}, {}, 0.0, 0.0)
    thresholds = {f: sorted(set(row[f])) for f in FEATURES}

    def bin_of(f: str) -> Column:
        value = F.col(f"s.{f}").cast("double")
        return F.size(F.filter(F.array(*map(F.lit, thresholds[f])), lambda t: t < value))

    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), bin_of(f).alias("b")) for f in FEATURES])).alias("x")
    table = {
        (r["f"], r["b"]): (r["g"], r["n"] - r["g"])
        for r in stats.select("good", pairs)
        .groupBy("x.f", "x.b")
        .agg(F.count_if("good").alias("g"), F.count(F.lit(1)).alias("n"))
        .collect()  # at most a row for each feature and bin
    }
    weights = {}
    for f in FEATURES:
        size = len(thresholds[f]) + 1
        seen = [table.get((f, b), (0, 0)) for b in range(size)]
        weights[f] = [log((g + 1) / (good + size) * (bad + size) / (n + 1)) for g, n in seen]

    raw = Evidence(thresholds, weights, 1.0, 0.0)
    sums = [
        (r["x"] / 4, r["g"], r["n"] - r["g"])
        for r in stats.groupBy(F.floor(4 * raw.of("s") + 0.5).alias("x"))
        .agg(F.count_if("good").alias("g"), F.count(F.lit(1)).alias("n"))
        .collect()  # the sum is bounded by the smoothed tables
    ]
    scale, shift = _logistic(sums, log(good / bad))
    return Evidence(thresholds, weights, scale, shift)


def _logistic(points: list[tuple[float, int, int]], prior: float) -> tuple[float, float]:
    """Slope and intercept, less the prior log odds, by a few damped Newton steps."""
    import numpy as np

    x, g, n = (np.array(v, float) for v in zip(*points))
    design = np.stack([x, np.ones_like(x)], 1)
    beta = np.array([0.5, prior])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        grad = design.T @ (g - (g + n) * p) - 0.01 * np.array([beta[0] - 0.5, 0])
        hess = (design * ((g + n) * p * (1 - p))[:, None]).T @ design + 0.01 * np.eye(2)
        step = np.clip(np.linalg.solve(hess, grad), -1, 1)
        beta = beta + step
        if abs(step).max() < 1e-9:
            break
    return float(max(beta[0], 0.0)), float(beta[1] - prior)


def _pooled(sites: DataFrame, mean: Column) -> tuple[float, float]:
    """Overall mean and pooling strength of site shares, by the method of moments.

    The share varies between sites by more than chance if sites differ; the strength is the number
    of documents at which a site's own share counts as much as the mean of all.
    """
    r = sites.agg(
        F.sum("n").alias("n"),
        F.sum("g").alias("g"),
        F.count_if(F.col("n") > 1).alias("sites"),
        F.sum(F.col("n") * F.col("n")).alias("n2"),
    ).first()
    if not r["n"]:
        return 0.5, STRENGTH[1]
    m = r["g"] / r["n"]
    spread = sites.agg(F.sum(F.col("n") * (F.col("g") / F.col("n") - mean) * (F.col("g") / F.col("n") - mean)).alias("q")).first()["q"]
    inner = m * (1 - m)
    extra = spread - max(r["sites"] - 1, 0) * inner
    room = r["n"] - r["n2"] / r["n"]
    between = max(extra / room, 0.0) if room > 0 else 0.0
    strength = inner / between - 1 if between > 0 else STRENGTH[1]
    return m, min(max(strength, STRENGTH[0]), STRENGTH[1])


def site_posteriors(scored: DataFrame) -> DataFrame:
    """Pooled share of good documents of each path: ``host, path, host_good, path_good``.

    ``scored`` is ``host, path, share``, where share is a label or a document's own probability.
    Hosts shrink towards the share of all documents, paths towards their host, the more the fewer
    documents they have. Rows are summed before they are shuffled, so a hot host costs no more than
    another. A null host or path is one of its own.
    """
    paths = cut_lineage(
        scored.groupBy("host", "path").agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("share").alias("g"))
    )
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("g").alias("g"))
    total = hosts.agg(F.sum("g") / F.sum("n")).first()[0]
    m, strength = _pooled(hosts, F.lit(total if total is not None else 0.5))
    hosts = hosts.select("host", ((F.col("g") + strength * m) / (F.col("n") + strength)).alias("host_good"))
    both = paths.join(hosts.withColumnRenamed("host", "_host"), F.col("host").eqNullSafe(F.col("_host"))).drop("_host")
    _, inner = _pooled(both, F.col("host_good"))
    return both.select(
        "host", "path", "host_good", ((F.col("g") + inner * F.col("host_good")) / (F.col("n") + inner)).alias("path_good")
    )


def classify(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, host: Column, path: Column,
    label_id: str, label_col: str, least_good: float = LEAST_GOOD,
) -> DataFrame:
    """Verdict on each document: ``id, key, evidence, host_good, path_good, p_good, kept``.

    ``p_good`` combines the document's likelihood ratio with the pooled share of its path.
    ``key`` hashes the text, so that rows of one id but other texts are told apart. Null or
    contradicting labels count as none; null ids are never labelled; a null or empty text is
    classified like any other. Without labels of both kinds everything is kept. Extra columns are
    ignored. Texts are read once: only their statistics are stored.
    """
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), host.cast("string").alias("host"), path.cast("string").alias("path")
    )
    stats = with_statistics(rows, "text", "s").withColumn("key", F.xxhash64("text")).drop("text")
    stats = cut_lineage(stats)
    one = (
        narrow(labels, label_of=label_id, label=label_col)
        .where(F.col("label_of").isNotNull() & F.col("label").isNotNull())
        .groupBy("label_of")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"))
        .where(F.col("low") == F.col("high"))
        .select("label_of", (F.col("low") > 0).alias("good"))
    )
    labelled = cut_lineage(stats.join(one, F.col("id") == F.col("label_of"), "left").drop("label_of"))
    known = labelled.where(F.col("good").isNotNull())
    evidence = learn_evidence(known.select("good", "s"))
    overall = known.agg(F.avg(F.col("good").cast("double"))).first()[0]
    odds = log(overall / (1 - overall)) if overall not in (None, 0.0, 1.0) else 0.0

    def logistic(x: Column) -> Column:
        return 1 / (1 + F.exp(-x))

    scored = labelled.withColumn("evidence", evidence.of("s"))
    own = logistic(F.lit(odds) + F.col("evidence"))
    share = F.coalesce(LABEL_WEIGHT * F.col("good").cast("double"), own)
    sites = site_posteriors(scored.select("host", "path", share.alias("share")))
    joined = scored.join(
        sites.withColumnsRenamed({"host": "_host", "path": "_path"}),
        F.col("host").eqNullSafe(F.col("_host")) & F.col("path").eqNullSafe(F.col("_path")),
    )
    prior = F.log(F.col("path_good") / (1 - F.col("path_good")))
    p = logistic(prior + F.col("evidence"))
    return joined.select(
        "id", "key", "evidence", "host_good", "path_good", p.alias("p_good"),
        (F.lit(not evidence.thresholds) | (p >= least_good)).alias("kept"),
    )
