"""Small column helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

# What separates words in plain statistics: space and the ASCII controls 9 to 13.
WORD_GAP = r"[\x20\x09-\x0D]+"
GAP_CHARS = " \t\n\x0b\x0c\r"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once although ``body`` may use it in lambdas."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words of a text that is not null, in order."""
    bare = F.btrim(text, F.lit(GAP_CHARS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, WORD_GAP))


def narrow(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns under the operator's own names, so that others cannot clash."""
    return df.select(*[F.col(old).alias(new) for new, old in columns.items()])


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` begins with it in either case."""
    taken = [c.lower() for c in df.columns]
    while any(c.startswith(name.lower()) for c in taken):
        name += "_"
    return name
