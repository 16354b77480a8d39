"""Tables whose folder is never overwritten: every version is written to a folder of its own and then published.

A catalog table points at one folder. A load writes a fresh one beside it and moves the table there in a single change of the
catalog, so readers see the old version or the new one, and a load that dies leaves the table as it was. The old folder stays
until it is dropped, so queries that began before the change end on it. One writer per table at a time.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bizpulse.operators.merging import one_per_key, upsert_rows
from bizpulse.session import materialize
from bizpulse.sources.lake import write_table
from bizpulse.sources.readers import DEFAULT_FORMAT

VERSION = "version-"


def publish(
    df: DataFrame,
    table: str,
    root: str,
    options: Mapping[str, str] | None = None,
    fmt: str = DEFAULT_FORMAT,
    cluster_by: Sequence[str] = (),
) -> str:
    """Write `df` as the next version of `table` under `root` and point the table at it; return the version's folder.

    The table is made if there is none. A version may have other columns than the last one. Tables with partition columns are
    refused, as the catalog would keep the old version's partitions.
    """
    path = f"{root.rstrip('/')}/{VERSION}{uuid.uuid4().hex}"
    write_table(df, path, "errorifexists", options=options, fmt=fmt, cluster_by=cluster_by)
    _point(df.sparkSession, table, path, fmt, df)
    return path


def _point(spark: SparkSession, table: str, path: str, fmt: str, df: DataFrame) -> None:
    """One change of the catalog makes the version at `path` the table."""
    if not spark.catalog.tableExists(table):
        spark.sql(f"CREATE TABLE {table} ({_columns(df)}) USING {fmt} LOCATION '{path}'")
        return
    there = spark.table(table)
    if spark.sql(f"DESCRIBE TABLE {table}").filter(F.col("col_name") == "# Partition Information").count():
        raise ValueError(f"{table} has partition columns; publish tables without them")
    added = [f for f in df.schema.fields if f.name not in there.columns]
    if added:  # old files answer null for them, so the old version stays readable in between
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({_columns(df.select([f.name for f in added]))})")
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    spark.catalog.refreshTable(table)


def _columns(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def location(spark: SparkSession, table: str) -> str:
    """The folder that the table points at."""
    return spark.sql(f"DESCRIBE FORMATTED {table}").filter("col_name = 'Location'").first()["data_type"]


def upsert_published(
    spark: SparkSession,
    source: DataFrame,
    table: str,
    root: str,
    keys: Sequence[str],
    options: Mapping[str, str] | None = None,
    fmt: str = DEFAULT_FORMAT,
    cluster_by: Sequence[str] = (),
) -> str:
    """Publish a version in which rows with a matching key are updated and the others inserted; return its folder.

    Null or duplicate source keys fail the job before anything is written. The old version is read while the new one is
    written, so nothing is copied twice and nothing is lost if the job dies.
    """
    staged = one_per_key(materialize(source, "upsert-source"), keys)
    merged = upsert_rows(spark.table(table), staged, keys) if spark.catalog.tableExists(table) else staged
    return publish(merged, table, root, options, fmt, cluster_by)


def drop_old_versions(spark: SparkSession, table: str, root: str, keep: Sequence[str] = ()) -> list[str]:
    """Remove the folders under `root` that neither the table nor `keep` names; return them. Call it when no query may still
    read them and no load is under way. Loads that died leave such folders too."""
    plain = lambda p: re.sub("^[a-z0-9+.-]+:/*", "/", p).rstrip("/")
    held = {plain(p) for p in (location(spark, table), *keep)}
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    folder = jvm.org.apache.hadoop.fs.Path(root)
    system = folder.getFileSystem(conf)
    dropped = []
    for status in system.listStatus(folder):
        path = status.getPath()
        if path.getName().startswith(VERSION) and plain(path.toString()) not in held:
            if not system.delete(path, True):
                raise RuntimeError(f"could not remove {path}")
            dropped.append(path.toString())
    return dropped
