"""Raw -> silver cleaning. Every transform is map-only: one filter, one projection, no shuffle."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bizpulse.functions.cleaning import (
    at_least_zero,
    filled,
    parse_day,
    parse_second,
    parse_second_or_midnight,
    within,
)
from bizpulse.functions.dates import as_date, in_days
from bizpulse.schemas import EVENT_TABLES

INGEST_TS = "_ingest_ts"
#: Typed day of an event in bronze, by which its files are clustered.
EVENT_DAY = "_event_day"


def _carried(df: DataFrame) -> list[str]:
    """Bookkeeping columns that pass through cleaning when present."""
    return [c for c in (INGEST_TS, "day") if c in df.columns]


def clean_business(raw: DataFrame) -> DataFrame:
    return raw.filter(filled("business_id")).select(
        "business_id",
        F.trim("name").alias("name"),
        F.trim(F.initcap("city")).alias("city"),
        F.upper(F.trim("state")).alias("state"),
        within("latitude", -90, 90).alias("latitude"),
        within("longitude", -180, 180).alias("longitude"),
        # Range test first, then truncation: 4.5 -> 4, 5.5 -> null.
        within("stars", 1, 5).cast("int").alias("stars"),
        at_least_zero("review_count").alias("review_count"),
        F.col("is_open").cast("boolean").alias("is_open"),
        F.trim("categories").alias("categories"),
        *_carried(raw),
    )


def clean_user(raw: DataFrame) -> DataFrame:
    # "None", the empty string and null all mean: no friends.
    named_friends = (F.col("friends") != "") & (F.col("friends") != "None")
    friend_count = F.when(named_friends, F.size(F.split("friends", ","))).otherwise(F.lit(0))
    return raw.filter(filled("user_id")).select(
        "user_id",
        F.trim("name").alias("name"),
        parse_day(F.col("yelping_since")).alias("yelping_since"),
        at_least_zero("review_count").alias("review_count"),
        at_least_zero("fans").alias("fans"),
        within("average_stars", 1, 5).alias("average_stars"),
        at_least_zero("useful").alias("useful"),
        at_least_zero("funny").alias("funny"),
        at_least_zero("cool").alias("cool"),
        friend_count.alias("friend_count"),
        *_carried(raw),
    )


def clean_review(raw: DataFrame) -> DataFrame:
    return raw.filter(filled("review_id", "user_id", "business_id")).select(
        "review_id",
        "user_id",
        "business_id",
        within("stars", 1, 5).cast("int").alias("stars"),
        at_least_zero("useful").alias("useful"),
        at_least_zero("funny").alias("funny"),
        at_least_zero("cool").alias("cool"),
        # With or without a time of day, the date is at the start.
        parse_day(F.col("date")).alias("date"),
        F.trim("text").alias("text"),
        *_carried(raw),
    )


def clean_checkin(raw: DataFrame) -> DataFrame:
    one = F.col("_one")
    return (
        raw.filter(filled("business_id"))
        .select("business_id", F.explode(F.split("date", r",\s*")).alias("_one"), *_carried(raw))
        .filter(one != "")
        .select("business_id", parse_second_or_midnight(one).alias("checkin_date"), *_carried(raw))
        .filter(F.col("checkin_date").isNotNull())
    )


def clean_tip(raw: DataFrame) -> DataFrame:
    return raw.filter(filled("user_id", "business_id")).select(
        "user_id",
        "business_id",
        F.trim("text").alias("text"),
        parse_second(F.col("date")).alias("date"),
        at_least_zero("compliment_count").alias("compliment_count"),
        *_carried(raw),
    )


CLEANERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "business": clean_business,
    "user": clean_user,
    "review": clean_review,
    "checkin": clean_checkin,
    "tip": clean_tip,
}


def clean(table: str, raw: DataFrame) -> DataFrame:
    """The table's cleaning rule; a table without one passes through."""
    return CLEANERS.get(table, lambda df: df)(raw)


def slice_raw_events(raw: DataFrame, start: str | dt.date, end: str | dt.date | None = None) -> DataFrame:
    """Raw event rows dated `start` (to `end`).

    Bronze carries the parsed day and lies in its order, so a range on it skips all row groups but those of the days asked
    for. Without that column, dates of one year sort as text between its number and the next, padded or not, so a plain string
    range over whole years comes first, which is pushed to the scan too, and the parse then decides.
    """
    first, last = as_date(start), as_date(end or start)
    if EVENT_DAY in raw.columns:
        return raw.filter(in_days(EVENT_DAY, first, last))
    text = F.col("date")
    sorts_inside = (text >= F.lit(f"{first.year:04d}-")) & (text < F.lit(f"{last.year:04d}."))
    return raw.filter(sorts_inside & parse_day(text).between(F.lit(first), F.lit(last)))


def stamp_event_day(raw: DataFrame) -> DataFrame:
    """Event tables: `day` is the day of the event, so a range needs one pass and no copy per run day.

    Taken from the raw text, or from the day that bronze read from it, because cleaning nulls the timestamp of a tip that has a
    bare date.
    """
    return raw.withColumn("day", F.col(EVENT_DAY) if EVENT_DAY in raw.columns else parse_day(F.col("date")))


def by_event_day(raw: DataFrame) -> DataFrame:
    """Raw events with their parsed day, dealt out by it: rows of a day come together, and what is too much for one file is
    split at run time, as are the rows without a date. Sorted by that day, files have narrow bounds for it."""
    return raw.withColumn(EVENT_DAY, parse_day(F.col("date"))).hint("rebalance", EVENT_DAY)


def stamp_run_days(silver: DataFrame, days: Sequence[str | dt.date]) -> DataFrame:
    """Snapshot tables: the whole table, once per run day."""
    if len(days) == 1:
        return silver.withColumn("day", F.lit(as_date(days[0])))
    return silver.withColumn("day", F.explode(F.array(*[F.lit(as_date(d)) for d in days])))


def silver_snapshot(
    table: str,
    raw: DataFrame,
    run_days: Sequence[str | dt.date],
    full_load: bool = False,
) -> DataFrame:
    """Slice, clean and stamp one table for its run days.

    Event tables keep only rows of the run days (all rows when `full_load`) and carry their own date as `day`.
    Other tables are stamped whole with every run day.
    """
    days = sorted({as_date(d) for d in run_days})
    if not days:
        raise ValueError("at least one run day is needed")
    if table not in EVENT_TABLES:
        return stamp_run_days(clean(table, raw), days)
    if full_load:
        return clean(table, stamp_event_day(raw))
    stamped = stamp_event_day(slice_raw_events(raw, days[0], days[-1]))
    if (days[-1] - days[0]).days + 1 > len(days):
        stamped = stamped.filter(F.col("day").isin(days))
    return clean(table, stamped)


def latest_per_key(df: DataFrame, keys: Sequence[str], newest: str = INGEST_TS) -> DataFrame:
    """One row per key: the newest, ties broken by the remaining columns in order.

    `max` over a struct combines on the map side, so a key with very many copies shrinks before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys and c != newest]
    ranked = ([newest] if newest in df.columns else []) + rest
    picked = df.groupBy(*keys).agg(F.max(F.struct(*ranked)).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def date_range_filter(df: DataFrame, column: str, start: str | dt.date, end: str | dt.date) -> DataFrame:
    return df.filter(in_days(column, start, end))
