"""Jobs of the lower layers: raw -> bronze and bronze -> silver."""

from __future__ import annotations

import datetime as dt
import logging
import time
from collections.abc import Callable, Iterable, Mapping, Sequence
from contextlib import nullcontext

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bizpulse.functions.dates import as_date
from bizpulse.functions.cleaning import filled
from bizpulse.operators.silver import EVENT_DAY, by_event_day, silver_snapshot
from bizpulse.schemas import EVENT_TABLES, RAW_TABLES, raw_schema
from bizpulse.sources.history import append_run
from bizpulse.sources.lake import overwrite_partitions, write_counted, write_table
from bizpulse.sources.readers import DEFAULT_FORMAT, read_raw, read_table_if_exists
from bizpulse.session import small_scans
from bizpulse.sources.versions import publish

log = logging.getLogger(__name__)

# Columns that identify a row of each raw table.
KEYS = {
    "business": ["business_id"], "user": ["user_id"], "review": ["review_id", "user_id", "business_id"],
    "checkin": ["business_id"], "tip": ["user_id", "business_id"],
}
# What to do when one table fails: stop at once, go on with a warning, or go on and raise at the end.
ON_ERROR = ("fail_fast", "skip", "fail_at_end")


def _each_table(
    spark: SparkSession, layer: str, tables: Iterable[str], on_error: str, work: Callable[[str], dict], history: str | None
) -> dict[str, dict]:
    """Run `work` for every table and report rows, seconds and outcome, to the table `history` too if one is named."""
    if on_error not in ON_ERROR:
        raise ValueError(f"on_error must be one of {ON_ERROR}, not {on_error!r}")
    report: dict[str, dict] = {}
    for table in tables:
        began = time.monotonic()
        try:
            outcome = {"status": "ok", **work(table)}
        except Exception as error:
            if on_error == "fail_fast":
                raise
            log.warning("table %s failed: %s", table, error)
            outcome = {"status": "failed", "error": str(error)}
        report[table] = {**outcome, "seconds": time.monotonic() - began}
    if history and report:
        append_run(spark, history, layer, report)
    failed = [t for t, r in report.items() if r["status"] == "failed"]
    if failed and on_error == "fail_at_end":
        raise RuntimeError("tables failed: " + "; ".join(f"{t}: {report[t]['error']}" for t in failed))
    return report


def stamp_ingest(df: DataFrame) -> DataFrame:
    """Load time and load date of bronze rows; one clock reading for the whole query."""
    return df.withColumn("_ingest_ts", F.current_timestamp()).withColumn("_ingest_date", F.to_date("_ingest_ts"))


def ingest_bronze(
    spark: SparkSession,
    bronze_dir: str,
    source: str,
    tables: Sequence[str] = RAW_TABLES,
    files: str = "",
    store: Mapping | None = None,
    on_error: str = "fail_at_end",
    fmt: str = DEFAULT_FORMAT,
    options: Mapping[str, str] | None = None,
    publish_in: str | None = None,
    history: str | None = None,
) -> dict[str, dict]:
    """Read each raw table with its fixed schema, stamp it and replace its bronze table whole.

    Event tables carry their parsed day and lie in its order, so a later run of one day reads that day's row groups only. With
    `publish_in`, a database of the catalog, each load goes to a fresh folder under `bronze_dir`, and the table of that name
    moves to it once it is whole; otherwise the table's folder is overwritten, and readers may see the moment of the change.

    The report counts rows and `rejected`, the rows whose keys are null or blank, which cleaning will drop. `history` is the path
    of a table that reports are appended to (see `sources.history`).
    """

    def work(table: str) -> dict:
        rows = read_raw(spark, table, source, raw_schema(table), files, store)
        order = [EVENT_DAY] if table in EVENT_TABLES else []
        # Stamped after the rows are dealt out, so the stamps are not moved.
        stamped = stamp_ingest(by_event_day(rows) if order else rows)

        def write(df: DataFrame) -> None:
            if publish_in:
                publish(df, f"{publish_in}.{table}", f"{bronze_dir}/{table}", options, fmt, order)
            else:
                write_table(df, f"{bronze_dir}/{table}", "overwrite", ["_ingest_date"], options, fmt, cluster_by=order)

        return write_counted(
            stamped,
            write,
            rejected=~F.coalesce(filled(*KEYS[table]), F.lit(False)) if table in KEYS else None,
        )

    return _each_table(spark, "bronze", tables, on_error, work, history)


def ingest_silver(
    spark: SparkSession,
    bronze_dir: str,
    silver_dir: str,
    run_days: Sequence[str | dt.date],
    tables: Sequence[str] = RAW_TABLES,
    full_load: bool = False,
    on_error: str = "fail_at_end",
    fmt: str = DEFAULT_FORMAT,
    options: Mapping[str, str] | None = None,
    history: str | None = None,
    bronze_in: str | None = None,
) -> dict[str, dict]:
    """Clean each bronze table for the run days and replace the silver partitions of those days.

    A missing bronze table is skipped. A result without rows replaces nothing; whether it had rows comes from the
    write itself, not from a second scan. Event tables that lie by their day in bronze are written as they are read, without a shuffle:
    a task reads few days. `bronze_in` is the database that bronze was published in, if it was. The report also counts nulls in dates and stars, which cleaning makes of
    values it cannot read.
    """
    days = sorted({as_date(d) for d in run_days})

    def work(table: str) -> dict:
        if bronze_in:
            bronze = spark.table(f"{bronze_in}.{table}") if spark.catalog.tableExists(f"{bronze_in}.{table}") else None
        else:
            bronze = read_table_if_exists(spark, f"{bronze_dir}/{table}", fmt)
        if bronze is None:
            log.warning("no bronze table %s", table)
            return {"status": "skipped"}
        silver = silver_snapshot(table, bronze.drop("_ingest_date"), days, full_load)
        stamped = silver.withColumn("_silver_ingest_ts", F.current_timestamp())
        by_day = table in EVENT_TABLES and EVENT_DAY in bronze.columns

        def write(df: DataFrame) -> None:
            with small_scans(spark) if by_day else nullcontext():
                overwrite_partitions(df, f"{silver_dir}/{table}_snapshot", ["day"], options=options, fmt=fmt, balance=not by_day)

        return write_counted(stamped, write, not_null=[c for c in ("date", "checkin_date", "yelping_since", "stars") if c in stamped.columns])

    return _each_table(spark, "silver", tables, on_error, work, history)
