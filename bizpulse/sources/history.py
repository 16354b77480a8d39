"""A stored history of what jobs counted while they wrote: one row per table and run."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from bizpulse.sources.lake import write_table
from bizpulse.sources.readers import DEFAULT_FORMAT, read_table

HISTORY_DDL = (
    "run_ts timestamp, layer string, table_name string, status string, rows long, rejected long, nulls map<string, long>,"
    " error string, seconds double"
)


def append_run(spark: SparkSession, path: str, layer: str, report: Mapping[str, Mapping], fmt: str = DEFAULT_FORMAT) -> None:
    """Append the report of one job, table -> outcome and counts, to the history at `path`.

    Counts that a job did not take are null, null counts of columns go to the map `nulls`. A run adds one file, so the history
    grows with the runs and not with the data.
    """
    now = dt.datetime.now(dt.timezone.utc)
    rows = [
        (
            now, layer, table, own.get("status", "ok"), own.get("rows"), own.get("rejected"),
            {name.removeprefix("null_"): n for name, n in own.items() if name.startswith("null_")}, own.get("error"), own.get("seconds"),
        )
        for table, own in report.items()
    ]
    write_table(spark.createDataFrame(rows, HISTORY_DDL).coalesce(1), path, "append", fmt=fmt)


def read_history(spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT) -> DataFrame:
    return read_table(spark, path, fmt=fmt)
