"""Column rules shared by the silver transforms. All are built-in expressions, so they stay inside codegen."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Shapes of dates and timestamps in raw data, `y-M-d` and `y-M-d H:m:s`; months, days and times of day may
# have one digit. What follows is not read.
DAY_SHAPE = r"^\d{4}-\d{1,2}-\d{1,2}"
SECOND_SHAPE = r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}"


def filled(*names: str) -> Column:
    """True where every named key is neither null nor the empty string (`<>` already rejects null)."""
    condition = F.col(names[0]) != ""
    for name in names[1:]:
        condition = condition & (F.col(name) != "")
    return condition


def within(column: str, low: float, high: float) -> Column:
    """The value if it lies in [low, high], else null."""
    return F.when(F.col(column).between(low, high), F.col(column))


def at_least_zero(column: str) -> Column:
    """Negative counts become 0; null stays null."""
    return F.when(F.col(column) < 0, F.lit(0)).otherwise(F.col(column)).cast("int")


def _has(text: Column, marks: str) -> Column:
    """Whether the characters of `marks` other than `?` stand where it has them."""
    return reduce(Column.__and__, [F.substring(text, i, 1) == c for i, c in enumerate(marks, 1) if c != "?"])


def parse_day(text: Column) -> Column:
    """Date at the start of the text, whatever follows; null when there is none.

    Padded dates, nearly all of them, are cut out and cast. What that does not read is matched with the shape first, which
    allows one-digit months and days; the cast reads those too, and junk costs no exception.
    """
    padded = F.when(_has(text, "????-??-"), F.substring(text, 1, 10).try_cast("date"))
    return F.coalesce(padded, F.regexp_extract(text, DAY_SHAPE, 0).try_cast("date"))


def parse_second(text: Column) -> Column:
    """Timestamp at the start of the text; null when there is no time of day. Padded ones take the short way, as in `parse_day`;
    their last character must be a digit, as the cast would read the letter of a time zone."""
    shaped = _has(text, "????-??-?? ??:??:") & F.substring(text, 19, 1).between("0", "9")
    padded = F.when(shaped, F.substring(text, 1, 19).try_cast("timestamp"))
    return F.coalesce(padded, F.regexp_extract(text, SECOND_SHAPE, 0).try_cast("timestamp"))


def parse_second_or_midnight(text: Column) -> Column:
    """Timestamp from text with or without a time of day; a bare date means its midnight."""
    padded = F.when(text.contains(" "), text).otherwise(F.concat(text, F.lit(" 00:00:00")))
    return parse_second(padded)
