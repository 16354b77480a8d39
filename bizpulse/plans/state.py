"""Jobs that keep daily state of the fact table and merge a month from it (see `operators.state`)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bizpulse.functions.dates import as_date, event_rows, in_days, month_end
from bizpulse.operators import state, summaries
from bizpulse.plans.gold import FACT_INPUTS
from bizpulse.session import materialize
from bizpulse.sources.lake import replace_slice, write_table
from bizpulse.sources.readers import DEFAULT_FORMAT, read_table, read_table_if_exists

NUMBERS, SUMS, BITMAPS = "numbers", "sums", "bitmaps"


def update_state(
    spark: SparkSession,
    silver_dir: str,
    state_dir: str,
    days: Sequence[str | dt.date],
    fmt: str = DEFAULT_FORMAT,
    options: Mapping[str, str] | None = None,
) -> None:
    """Replace the state of `days` by what silver holds for them; a day without events is emptied. Other days are not read.

    Ids met for the first time get the next numbers, which are appended and never change; a job that dies after that leaves
    numbers that no bitmap uses yet.
    """
    wanted = sorted({as_date(d) for d in days})
    if not wanted:
        raise ValueError("at least one day is needed")

    def events(table: str) -> DataFrame:
        rows = read_table(spark, f"{silver_dir}/{table}_snapshot", FACT_INPUTS[table] + ["day"])
        own = event_rows(rows, lambda c: in_days(c, wanted[0], wanted[-1]), by_event_day=True)
        return own.filter(F.to_date("date").isin(wanted)).drop("day")

    reviews, tips = events("review"), events("tip")
    ids = state.event_ids(reviews, tips)
    numbers, new = state.numbers_of(ids, read_table_if_exists(spark, f"{state_dir}/{NUMBERS}", fmt))
    write_table(new, f"{state_dir}/{NUMBERS}", "append", fmt=fmt)
    slices = [{"day": d} for d in wanted]
    for name, rows in ((SUMS, state.day_sums(reviews, tips)), (BITMAPS, state.day_bitmaps(ids, numbers))):
        replace_slice(spark, rows, f"{state_dir}/{name}", ["day"], slices, ["day"], fmt, ["business_id"], options, balance=False)


def month_from_state(spark: SparkSession, state_dir: str, month: str | dt.date, fmt: str = DEFAULT_FORMAT) -> DataFrame:
    """Monthly fact rows of the month that `month` lies in, from its days' state; no event is read."""
    end = month_end(month)
    own = [read_table(spark, f"{state_dir}/{name}", conditions=[in_days("day", end.replace(day=1), end)], fmt=fmt) for name in (SUMS, BITMAPS)]
    return state.monthly_from_state(*own)


def update_city_sums(
    spark: SparkSession,
    popularity: DataFrame,
    fact: DataFrame,
    sums_dir: str,
    days: Sequence[str | dt.date],
    digits: int = 9,
    fmt: str = DEFAULT_FORMAT,
) -> None:
    """Replace the city sums of the month ends `days` by those of the gold tables; a month without scores is emptied. Only those
    days' partitions of the gold tables are read."""
    wanted = sorted({as_date(d) for d in days})
    own = [df.filter(F.col("day").isin(wanted)) for df in (popularity, fact)]
    known = read_table_if_exists(spark, f"{sums_dir}/{NUMBERS}", fmt)
    new = materialize(state.new_numbers(summaries.business_ids(own[0]), known), "state-numbers")
    write_table(new, f"{sums_dir}/{NUMBERS}", "append", fmt=fmt)
    numbers = new if known is None else known.unionByName(new)
    rows = summaries.city_sums(*own, numbers, digits)
    replace_slice(spark, rows, f"{sums_dir}/{SUMS}", ["day"], [{"day": d} for d in wanted], ["day"], fmt, ["city"])


def read_city_sums(spark: SparkSession, sums_dir: str, fmt: str = DEFAULT_FORMAT) -> DataFrame:
    return read_table(spark, f"{sums_dir}/{SUMS}", fmt=fmt)
