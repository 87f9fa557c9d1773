"""Column expressions that turn dirty text into typed values; a bad value becomes NULL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Spellings of "no value".
EXACT_NULLS = ("NULL", "null", "NaN", "nan", "")
FOLDED_NULLS = ("NULL", "N/A", "NA", "NONE", "")

# Timestamp layouts tried after the default parse.
EVENT_FORMATS = ("dd/MM/yyyy HH:mm", "dd/MM/yyyy HH:mm:ss", "yyyy-MM-dd HH:mm:ss")

# Severity words and their scores; any other word scores 0.
SEVERITY_SCORES = {"Severe": 3.0, "Serious": 2.0, "Moderate": 1.0, "Minor": 1.0}

NUMBER_PATTERN = r"^-?\d+(\.\d+)?$"

DECIMAL_PATTERN = r"^\s*[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?\s*$"


def null_if_token(name: str, fold_case: bool = False) -> Column:
    """NULL for a null token, else the value as it stands, spaces included."""
    trimmed = F.trim(F.col(name))
    hit = F.upper(trimmed).isin(*FOLDED_NULLS) if fold_case else trimmed.isin(*EXACT_NULLS)
    return F.when(~hit, F.col(name)).alias(name)


def null_tokens(
    df: DataFrame, fold_case: bool = False, leave: Sequence[str] = ()
) -> DataFrame:
    """Apply :func:`null_if_token` in one projection to every string column not to be left."""
    return df.select(
        *[
            null_if_token(c, fold_case) if t == "string" and c not in leave else F.col(c)
            for c, t in df.dtypes
        ]
    )


def as_number(text: Column, to: str = "double") -> Column:
    """Text as a number, else NULL; null tokens are no numbers, ``"7.0"`` is a whole 7.

    A failing cast costs an exception per row, so text that is no number is sorted out by
    pattern first.  Whole numbers pass through an exact decimal, not through double.
    """
    if to in ("int", "bigint"):
        value = text.try_cast("decimal(38,6)").try_cast(to)
    else:
        value = text.try_cast(to)
    return F.when(text.rlike(DECIMAL_PATTERN), value)


def to_number(df: DataFrame, name: str, to: str = "double") -> Column:
    """The column as a number, whether it is text or a number already."""
    col = F.col(name)
    return as_number(col, to) if dict(df.dtypes)[name] == "string" else col.try_cast(to)


def plain_number(name: str) -> Column:
    """The text without thousands separators."""
    return F.translate(F.col(name), ",", "")


def parse_time(col: Column, formats: Sequence[str]) -> Column:
    return F.coalesce(*[F.try_to_timestamp(col, F.lit(f)) for f in formats])


def parse_event_time(name: str) -> Column:
    text = F.col(name).cast("string")
    return F.coalesce(F.try_to_timestamp(text), parse_time(text, EVENT_FORMATS))


def _by_layout(date_text: Column, text: Column, suffix: str) -> Column:
    """ISO where the date has a dash, day first elsewhere; only one layout is tried."""
    iso = F.try_to_timestamp(text, F.lit("yyyy-MM-dd" + suffix))
    day_first = F.try_to_timestamp(text, F.lit("dd/MM/yyyy" + suffix))
    return F.when(F.contains(date_text, F.lit("-")), iso).otherwise(day_first)


def _day(name: str) -> Column:
    """The ten characters of a date, whatever spaces or time stand around it."""
    return F.substring(F.trim(F.col(name).cast("string")), 1, 10)


def parse_date(name: str) -> Column:
    """ISO or day-first dates; a date may carry a time."""
    return _by_layout(_day(name), _day(name), "").cast("date")


def hour_timestamp(df: DataFrame, date_name: str, hour_name: str) -> Column:
    """Date and hour joined; the date is read as by :func:`parse_date`, hours may be ``7`` or ``7.0``."""
    hour = F.lpad(to_number(df, hour_name, "int").cast("string"), 2, "0")
    return _by_layout(_day(date_name), F.concat(_day(date_name), F.lit(" "), hour), " HH")


def severity_score(name: str) -> Column:
    score = F.lit(0.0)
    for word, value in SEVERITY_SCORES.items():
        score = F.when(F.col(name) == word, value).otherwise(score)
    return score


def first_text(*names: str) -> Column:
    """The first alternative that is neither NULL nor empty."""
    return F.coalesce(*[F.nullif(F.col(n), F.lit("")) for n in names])


def first_list(*names: str) -> Column:
    """The first non-empty list, else an empty one."""
    filled = [F.when(F.size(n) > 0, F.col(n)) for n in names]
    return F.coalesce(*filled, F.array().cast("array<string>"))


def clip(col: Column, low: float, high: float) -> Column:
    """``col`` inside ``[low, high]``; a missing value counts as 0 before clipping."""
    return F.least(F.greatest(F.coalesce(col, F.lit(0.0)), F.lit(low)), F.lit(high))
