"""Statistics of whole texts, as one struct of built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from roadtally.llm.columns import GAP_CHARS, WORD_GAP, let, words

WINDOW_WORDS = 5
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
# Shares that rules and classifiers look at; all are 0 for a text without words.
FEATURES = (
    "n_words",
    "mean_word_chars",
    "symbol_share",
    "mark_share",
    "upper_share",
    "dup_line_share",
    "repeat_share",
    "distinct_share",
)


def _only(text: Column, kind: str) -> Column:
    """How many characters of ``text`` are in the character class."""
    return F.length(F.regexp_replace(text, f"[^{kind}]+", ""))


def _covered(w: Column) -> Column:
    """Words inside windows of five that stand in the text twice or more."""

    def window(i: Column) -> Column:
        return F.slice(w, i + 1, F.lit(WINDOW_WORDS))

    windows = F.slice(w, F.lit(1), F.size(w) - (WINDOW_WORDS - 1))
    entries = F.transform(
        windows, lambda _, i: F.struct(F.xxhash64(window(i)).alias("h"), F.array_join(window(i), " ").alias("t"), i.alias("i"))
    )

    def repeated(sorted_: Column) -> Column:
        def start(e: Column, k: Column) -> Column:
            alike = [F.coalesce(F.get(sorted_, j)["t"] == e["t"], F.lit(False)) for j in (k - 1, k + 1)]
            return F.when(alike[0] | alike[1], e["i"])

        return F.sort_array(F.filter(F.transform(sorted_, start), lambda i: i.isNotNull()))

    def step(state: Column, i: Column) -> Column:
        new = F.least(F.lit(WINDOW_WORDS), i - state["last"])
        return F.struct(i.alias("last"), (state["total"] + new).alias("total"))

    begin = F.struct(F.lit(-WINDOW_WORDS).alias("last"), F.lit(0).alias("total"))
    return F.aggregate(let(F.sort_array(entries), repeated), begin, step, lambda s: s["total"])


def with_statistics(docs: DataFrame, text_col: str, out: str) -> DataFrame:
    """Add the struct ``out`` of :data:`COUNTS` and :data:`FEATURES`; all other columns stay.

    Hashes of the five-word windows tell which texts may repeat one; only there are the windows
    themselves compared, so the counts are exact. A null text counts as empty.
    """
    text, w, h = (f"{out}_{x}" for x in ("text", "words", "hashes"))
    enough = F.size(w) >= WINDOW_WORDS
    hashed = F.when(
        F.size(w) > WINDOW_WORDS,
        F.transform(
            F.slice(w, F.lit(1), F.size(w) - (WINDOW_WORDS - 1)),
            lambda _, i: F.xxhash64(F.slice(F.col(w), i + 1, F.lit(WINDOW_WORDS))),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(GAP_CHARS)) != "")
    step1 = docs.withColumn(text, F.coalesce(F.col(text_col), F.lit(""))).withColumn(w, words(F.col(text)))
    step2 = step1.withColumn(h, hashed)
    n = F.size(w).cast("long")
    repeats = enough & (F.size(F.array_distinct(h)) < F.size(h))
    counts = step2.withColumn(
        out,
        F.struct(
            n.alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _only(F.col(text), r"#*$%&|<>").cast("long").alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            F.when(repeats, _covered(F.col(w))).otherwise(0).cast("long").alias("n_repeat_words"),
            _only(F.col(text), "!?").alias("marks"),
            _only(F.col(text), r"\p{Lu}").alias("upper"),
            F.size(F.array_distinct(w)).alias("distinct"),
            F.size(F.split(text, "\n")).alias("lines"),
        ),
    )

    def share(a: str, b: str) -> Column:
        return F.coalesce(F.try_divide(F.col(f"{out}.{a}").cast("double"), F.col(f"{out}.{b}")), F.lit(0.0))

    features = F.struct(
        *[F.col(f"{out}.{c}").alias(c) for c in COUNTS],
        share("word_chars", "n_words").alias("mean_word_chars"),
        share("n_symbols", "n_words").alias("symbol_share"),
        share("marks", "n_words").alias("mark_share"),
        share("upper", "word_chars").alias("upper_share"),
        share("n_dup_lines", "lines").alias("dup_line_share"),
        share("n_repeat_words", "n_words").alias("repeat_share"),
        share("distinct", "n_words").alias("distinct_share"),
    )
    return counts.withColumn(out, features).drop(text, w, h)
