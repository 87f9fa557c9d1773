"""Quality rules: base checks, and an ordered decision list learned by sequential covering."""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame, functions as F

from roadtally.llm.columns import narrow
from roadtally.llm.statistics import COUNTS, FEATURES, with_statistics
from roadtally.session import cut_lineage

LEAST_WORDS = 10
MOST_REPEAT_PERCENT = 20
# At most about so many labelled documents are learned from; which ones is told by their id.
MOST_LABELLED = 20_000


@dataclass(frozen=True)
class Literal:
    feature: str
    above: bool
    threshold: float

    def holds(self, stats: str) -> Column:
        value = F.col(f"{stats}.{self.feature}").cast("double")
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Literal, ...]


def base_failed(stats: str) -> Column:
    n = F.col(f"{stats}.n_words")
    return (n < LEAST_WORDS) | (100 * F.col(f"{stats}.n_repeat_words") > MOST_REPEAT_PERCENT * n)


def labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_id: str, label_col: str, most: int) -> DataFrame:
    """Labelled documents: ``id, text, good``; about ``most`` of them, chosen by a hash of the id.

    Null ids and labels, and ids with contradicting labels, are left out; repeated labels count once.
    """
    one = (
        narrow(labels, id=label_id, label=label_col)
        .where(F.col("id").isNotNull() & F.col("label").isNotNull())
        .groupBy("id")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"))
        .where(F.col("low") == F.col("high"))
        .select("id", (F.col("low") > 0).alias("good"))
    )
    total = one.count()
    if total > most:
        one = one.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int((1 << 30) * most / total))
        # The sample's ids and flags are some hundred KB, as ``most`` bounds them.
        one = F.broadcast(one)
    return narrow(docs, id=id_col, text=text_col).join(one, "id")


def learn_rules(
    sample: DataFrame, max_rules: int = 8, max_literals: int = 4, bins: int = 32, precision: float = 0.97
) -> list[Rule]:
    """Rules that tell bad documents, in the order in which they were found.

    ``sample`` is ``id, text, good``. Features are cut at quantiles, and the rows are reduced to
    counts of equal bins, of which two thirds grow rules and one third prunes them. A rule grows by
    the threshold of the best information gain until it covers no good document, loses literals
    from its end while that helps on the pruning part, and is kept if its smoothed precision there
    reaches ``precision``. Its rows are then taken away. One kind of label gives no rules.
    """
    stats = with_statistics(sample, "text", "s").select("id", "good", "s")
    stats = cut_lineage(stats)
    ranks = [k / bins for k in range(1, bins)]
    cuts = stats.agg(
        *[F.percentile_approx(F.col(f"s.{f}").cast("double"), ranks, 10_000).alias(f) for f in FEATURES]
    ).first()
    thresholds = {f: sorted(set(cuts[f] or ())) for f in FEATURES}

    def bin_of(f: str) -> Column:
        value = F.col(f"s.{f}").cast("double")
        return F.size(F.filter(F.array(*map(F.lit, thresholds[f])), lambda t: t < value)).alias(f)

    usable = [f for f in FEATURES if thresholds[f]]
    if not usable:
        return []
    grow = (F.pmod(F.xxhash64(F.col("id"), F.lit(7)), F.lit(3)) > 0).alias("grow")
    counts = cut_lineage(
        stats.select("good", grow, *[bin_of(f) for f in usable])
        .groupBy("grow", *usable)
        .agg(F.count_if(~F.col("good")).alias("bad"), F.count_if("good").alias("fine"))
        .coalesce(4)
    )

    def binned(literal: Literal) -> Column:
        k = thresholds[literal.feature].index(literal.threshold)
        return F.col(literal.feature) > k if literal.above else F.col(literal.feature) <= k

    def all_of(literals: Rule) -> Column:
        out = F.lit(True)
        for x in literals:
            out = out & binned(x)
        return out

    left, rules = F.lit(True), []
    for _ in range(max_rules):
        rule = _grow(counts.where(left & F.col("grow")), usable, thresholds, all_of, max_literals)
        rule = _prune(counts.where(left & ~F.col("grow")), rule, all_of, precision)
        if not rule:
            break
        rules.append(rule)
        left = left & ~all_of(rule)
    return rules


def _grow(rows: DataFrame, features, thresholds, all_of, most: int) -> Rule:
    rule: Rule = ()
    for _ in range(most):
        pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("b")) for f in features])).alias("x")
        found = (
            rows.where(all_of(rule))
            .select("bad", "fine", pairs)
            .groupBy("x.f", "x.b")
            .agg(F.sum("bad").alias("bad"), F.sum("fine").alias("fine"))
            .collect()  # at most a row for each feature and bin
        )
        table: dict[str, dict[int, tuple[int, int]]] = {}
        for r in found:
            table.setdefault(r["f"], {})[r["b"]] = (r["bad"], r["fine"])
        if not table:
            break
        bad, fine = map(sum, zip(*next(iter(table.values())).values()))
        if not bad or not fine:
            break
        before = log2(bad / (bad + fine))
        best: tuple[float, Literal] | None = None
        for f in features:
            p = n = 0
            for k, threshold in enumerate(thresholds[f]):
                p, n = p + table[f].get(k, (0, 0))[0], n + table[f].get(k, (0, 0))[1]
                for above, (a, b) in ((False, (p, n)), (True, (bad - p, fine - n))):
                    if a:
                        gain = a * (log2((a + 0.5) / (a + b + 1)) - before)
                        if best is None or gain > best[0]:
                            best = gain, Literal(f, above, threshold)
        if best is None or best[0] <= 0:
            break
        rule += (best[1],)
    return rule


def _prune(rows: DataFrame, rule: Rule, all_of, precision: float) -> Rule:
    if not rule:
        return ()
    heads = [rule[:k] for k in range(1, len(rule) + 1)]
    sums = rows.agg(
        *[F.sum(F.when(all_of(h), F.col(c))).alias(f"{c}{k}") for k, h in enumerate(heads) for c in ("bad", "fine")]
    ).first()
    seen = [(sums[f"bad{k}"] or 0, sums[f"fine{k}"] or 0) for k in range(len(heads))]
    good = [k for k, (p, n) in enumerate(seen) if p and (p + 1) / (p + n + 1) >= precision]
    if not good:
        return ()
    return heads[max(good, key=lambda k: (seen[k][0] - seen[k][1], -k))]


def first_rule(rules: list[Rule], stats: str) -> Column:
    """Number of the first rule that holds, from 1; null if none does."""
    out = F.lit(None).cast("int")
    for number, rule in reversed(list(enumerate(rules, 1))):
        holds = F.lit(True)
        for literal in rule:
            holds = holds & literal.holds(stats)
        out = F.when(holds, F.lit(number)).otherwise(out)
    return out


def judge(docs: DataFrame, rules: list[Rule], text_col: str, out: str) -> DataFrame:
    """Add the struct ``out``: the counts, ``base_failed``, ``rule`` (first that holds), ``kept``.

    One pass over the rows without a shuffle. A null or empty text fails the base check.
    """
    stats = f"{out}_stats"
    scored = with_statistics(docs, text_col, stats)
    failed, rule = base_failed(stats), first_rule(rules, stats)
    return scored.withColumn(
        out,
        F.struct(
            *[F.col(f"{stats}.{c}").alias(c) for c in COUNTS],
            failed.alias("base_failed"),
            rule.alias("rule"),
            (~failed & rule.isNull()).alias("kept"),
        ),
    ).drop(stats)
