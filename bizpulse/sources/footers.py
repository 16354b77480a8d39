"""Counts and bounds of Parquet tables from file footers: no data page is read.

Spark answers count, min and max from footers when they are all that a query asks of a Parquet table, grouped by all partition
columns or by none. That needs the table to be opened by Spark's second-generation reader.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

READERS = "spark.sql.sources.useV1SourceList"
PUSHDOWN = "spark.sql.parquet.aggregatePushdown"


def open_footers(spark: SparkSession, path: str) -> DataFrame:
    """The Parquet table at `path`, opened so that counts and bounds come from footers.

    Which reader opens a table is decided while it is opened, so the session's choice is changed only for that moment. Pushing
    aggregates down is decided when a query runs; it is switched on and touches no table that is opened otherwise.
    """
    spark.conf.set(PUSHDOWN, "true")
    before = spark.conf.get(READERS)
    spark.conf.set(READERS, ",".join(name for name in before.split(",") if name.strip() != "parquet"))
    try:
        return spark.read.parquet(path)
    finally:
        spark.conf.set(READERS, before)


def slice_counts(spark: SparkSession, path: str, partition_by: Sequence[str]) -> DataFrame:
    """Rows of each partition that has some: the partition columns, all of them and in the table's order, and `row_count`."""
    counted = open_footers(spark, path).groupBy(*partition_by).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.filter("row_count > 0")


def column_bounds(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """One row with `min_<column>` and `max_<column>` of data columns that are numbers, booleans or dates."""
    table = open_footers(spark, path)
    return table.agg(*[f(c).alias(f"{name}_{c}") for c in columns for name, f in (("min", F.min), ("max", F.max))])
