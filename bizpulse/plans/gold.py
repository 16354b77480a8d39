"""Jobs of the gold layer: the review/tip fact table and the monthly popularity table."""

from __future__ import annotations

import datetime as dt
import logging
import time
from collections.abc import Mapping, Sequence
from contextlib import nullcontext

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bizpulse.functions.dates import as_date, in_days, month_end, month_ends_between
from bizpulse.functions.scoring import WEIGHTS
from bizpulse.operators.facts import fact_for_range
from bizpulse.operators.popularity import popularity_inputs, ranked_popularity
from bizpulse.schemas import DAILY, FACT_KEY, GOLD_PARTITIONS, MONTHLY, POPULARITY_KEY
from bizpulse.operators.merging import rows_in_slices
from bizpulse.session import materialize, small_tasks
from bizpulse.sources.bucketed import save_bucketed
from bizpulse.sources.history import append_run
from bizpulse.sources.database import replace_slice_in_database
from bizpulse.sources.lake import replace_slice, upsert, write_counted
from bizpulse.sources.readers import DEFAULT_FORMAT, read_table

log = logging.getLogger(__name__)

FACT_TABLE = "fact_review_tip_metrics"
POPULARITY_TABLE = "business_popularity"

# Silver columns each job reads.
FACT_INPUTS = {
    "review": ["business_id", "review_id", "user_id", "date", "stars", "useful", "funny", "cool"],
    "tip": ["business_id", "user_id", "date", "compliment_count"],
}
POPULARITY_INPUTS = {
    "business": ["business_id", "day", "name", "city", "state", "categories", "is_open", "_ingest_ts"],
    "review": ["business_id", "date", "stars"],
    "tip": ["business_id", "date", "compliment_count"],
    "checkin": ["business_id", "day", "checkin_date"],
}


def _silver(
    spark: SparkSession, silver_dir: str, table: str, columns: Sequence[str], start: dt.date, end: dt.date, fmt: str
) -> DataFrame:
    """A silver table cut to partitions `start`..`end`. For events the partition day is the event's own day, so the
    range prunes directories without losing a row."""
    return read_table(spark, f"{silver_dir}/{table}_snapshot", columns, [in_days("day", start, end)], fmt)


def _store(spark, df, path, keys, slices, mode, fmt, options, database, table, metrics, history, gathered=False):
    """Write the rows once, then hand the stored slices to the database if one is given. The counts of the write go to the
    dictionary `metrics` and the table `history`, if they are given. `gathered` rows lie by their slices and businesses already."""
    began = time.monotonic()
    if mode not in ("replace", "upsert"):
        raise ValueError(f"mode must be 'replace' or 'upsert', not {mode!r}")
    stamped = df.withColumn("_gold_ingest_ts", F.current_timestamp())

    def write(rows: DataFrame) -> None:
        if mode == "replace":
            replace_slice(spark, rows, path, GOLD_PARTITIONS, slices, GOLD_PARTITIONS, fmt, [] if gathered else ["business_id"], options, balance=not gathered)
        else:
            upsert(spark, rows, path, keys, GOLD_PARTITIONS, fmt, options)

    counts = {"status": "ok", **write_counted(stamped, write, not_null=keys), "seconds": time.monotonic() - began}
    log.info("%s: %s", table, counts)
    if metrics is not None:
        metrics[table] = counts
    if history:
        append_run(spark, history, "gold", {table: counts}, fmt)
    if database:
        stored = read_table(spark, path, fmt=fmt)
        days = sorted({s["day"] for s in slices})
        named = spark.createDataFrame([tuple(s[c] for c in GOLD_PARTITIONS) for s in slices], stored.select(*GOLD_PARTITIONS).schema)
        own = rows_in_slices(stored.filter(F.col("day").between(days[0], days[-1])), named, GOLD_PARTITIONS)
        replace_slice_in_database(own, table=table, slice_columns=GOLD_PARTITIONS, slices=slices, **database)


def store_monthly(
    spark: SparkSession, fact: DataFrame, popularity: DataFrame, database: str, root: str, buckets: int, fmt: str = DEFAULT_FORMAT
) -> tuple[DataFrame, DataFrame]:
    """Monthly rows of both gold tables as catalog tables in `database`, bucketed by business: what reports over all months join
    and follow through time. A business has at most as many rows as months and measures, so none is hot.

    Both have the same number of buckets; a report on them needs no shuffle by business. Rebuild them after the gold jobs.
    """
    monthly = F.col("granularity") == MONTHLY
    stored = {}
    for table, rows in ((FACT_TABLE, fact), (POPULARITY_TABLE, popularity)):
        name = f"{table}_monthly"
        own = rows.filter(monthly)
        stored[table] = save_bucketed(own, f"{database}.{name}", f"{root}/{name}", ["business_id"], buckets, ["business_id", "day"], fmt)
    return stored[FACT_TABLE], stored[POPULARITY_TABLE]


def build_fact(
    spark: SparkSession,
    silver_dir: str,
    gold_dir: str,
    start: str | dt.date,
    end: str | dt.date | None = None,
    skip_daily: bool = False,
    force_month: str | dt.date | None = None,
    mode: str = "replace",
    dry_run: bool = False,
    fmt: str = DEFAULT_FORMAT,
    options: Mapping[str, str] | None = None,
    database: Mapping | None = None,
    metrics: dict | None = None,
    history: str | None = None,
) -> DataFrame | None:
    """Fact rows for the run days `start` to `end`.

    Daily rows for each day (unless skipped); monthly rows for each month that ends in the range, or for
    `force_month` if the range touches it. `dry_run` returns the rows without running or writing anything. `options` are options
    of the writer, such as maxRecordsPerFile. `database` (url, user, password and the like) names a database whose table takes the
    same slices. `metrics`, a dictionary, receives the counts of the write under the table's name; `history` is the path of a
    table that they are appended to.
    """
    first, last = as_date(start), as_date(end or start)
    months = set(month_ends_between(first, last))
    if force_month is not None:
        forced = month_end(force_month)
        if first <= forced and last >= forced.replace(day=1):
            months.add(forced)
    if skip_daily and not months:
        return None
    read_from = min([first, *(m.replace(day=1) for m in months)])
    read_to = max([last, *months])
    reviews, tips = (
        _silver(spark, silver_dir, t, columns, read_from, read_to, fmt) for t, columns in FACT_INPUTS.items()
    )
    gathered = mode == "replace" and not dry_run
    rows = fact_for_range(
        reviews, tips, first, last, not skip_daily, monthly=False, force_months=sorted(months), by_event_day=True, balance=gathered
    )
    if dry_run:
        return rows
    days = [] if skip_daily else [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]
    slices = [{"day": d, "granularity": DAILY} for d in days]
    slices += [{"day": m, "granularity": MONTHLY} for m in sorted(months)]
    path = f"{gold_dir}/{FACT_TABLE}"
    # Gathered rows unfold before they are written, so their tasks are half as large.
    with small_tasks(spark, "8m") if gathered else nullcontext():
        _store(spark, rows, path, FACT_KEY, slices, mode, fmt, options, database, FACT_TABLE, metrics, history, gathered)
    return read_table(spark, path, fmt=fmt)


def build_popularity(
    spark: SparkSession,
    silver_dir: str,
    gold_dir: str,
    start: str | dt.date,
    end: str | dt.date | None = None,
    weights: Mapping[str, float] = WEIGHTS,
    digits: int | None = None,
    mode: str = "replace",
    dry_run: bool = False,
    fmt: str = DEFAULT_FORMAT,
    options: Mapping[str, str] | None = None,
    database: Mapping | None = None,
    metrics: dict | None = None,
    history: str | None = None,
) -> DataFrame | None:
    """Popularity rows for every month end among the run days; None when there is no month end. See `build_fact`."""
    days = month_ends_between(as_date(start), as_date(end or start))
    if not days:
        return None
    inputs = {
        t: _silver(spark, silver_dir, t, columns, days[0].replace(day=1), days[-1], fmt)
        for t, columns in POPULARITY_INPUTS.items()
    }
    own = popularity_inputs(inputs["business"], inputs["review"], inputs["tip"], inputs["checkin"], days, by_event_day=True)
    if dry_run:
        return ranked_popularity(own, weights, digits=digits)
    rows = ranked_popularity(materialize(own, "popularity-inputs"), weights, digits=digits)
    path = f"{gold_dir}/{POPULARITY_TABLE}"
    slices = [{"day": d, "granularity": MONTHLY} for d in days]
    _store(spark, rows, path, POPULARITY_KEY, slices, mode, fmt, options, database, POPULARITY_TABLE, metrics, history)
    return read_table(spark, path, fmt=fmt)
