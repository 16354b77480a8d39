"""Calendar logic as columns and predicates."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ONE_DAY = dt.timedelta(days=1)


def as_date(value: str | dt.date) -> dt.date:
    return dt.date.fromisoformat(value) if isinstance(value, str) else value


def month_end(value: str | dt.date) -> dt.date:
    first = as_date(value).replace(day=1)
    return (first + dt.timedelta(days=32)).replace(day=1) - ONE_DAY


def is_month_end(value: str | dt.date) -> bool:
    return month_end(value) == as_date(value)


def month_ends_between(start: str | dt.date, end: str | dt.date) -> list[dt.date]:
    """Month-end days inside [start, end]."""
    found, day = [], month_end(start)
    while day <= as_date(end):
        found.append(day)
        day = month_end(day + ONE_DAY)
    return found


def period_month(day: Column) -> Column:
    """`YYYY-MM` label of a day."""
    return F.date_format(day, "yyyy-MM")


def in_days(column: str, start: str | dt.date, end: str | dt.date) -> Column:
    """Whole days `start` to `end`, both included, for date and timestamp columns alike.

    Half-open, with no cast around the column, so the bounds reach the file scan.
    """
    return (F.col(column) >= F.lit(as_date(start))) & (F.col(column) < F.lit(as_date(end) + ONE_DAY))


def event_rows(
    df: DataFrame, within: Callable[[str], Column], column: str = "date", by_event_day: bool = False
) -> DataFrame:
    """Event rows whose `column` meets a day or month range. With `by_event_day` the table is stored by the event's own day
    in `day`; the same range on it prunes directories and loses no row. Without, a `day` column is not looked at."""
    wanted = within(column)
    return df.filter(wanted & within("day") if by_event_day else wanted)


def in_months(column: str, ends: Iterable[str | dt.date]) -> Column:
    """Whole calendar months, named by their last day. Neighbouring months join into one plain range, so the bounds
    reach the scan."""
    spans: list[list[dt.date]] = []
    for end in sorted({as_date(e) for e in ends}):
        start = end.replace(day=1)
        if spans and spans[-1][1] + ONE_DAY == start:
            spans[-1][1] = end
        else:
            spans.append([start, end])
    if not spans:
        raise ValueError("at least one month is needed")
    return reduce(lambda a, b: a | b, [in_days(column, start, end) for start, end in spans])


def calendar(bounds: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """One row per day of each [start, end] row in `bounds`, with its month facts."""
    day = F.col("day")
    return bounds.select(F.explode(F.sequence(F.to_date(start), F.to_date(end))).alias("day")).select(
        "day",
        period_month(day).alias("period_month"),
        F.trunc(day, "MM").alias("month_start"),
        F.last_day(day).alias("month_end"),
        (day == F.last_day(day)).alias("is_month_end"),
    )
