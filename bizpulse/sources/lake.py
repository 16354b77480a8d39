"""Writing lake tables: partitioned writes, partition overwrite, keyed upsert, slice replacement, registration.

The default format is Parquet, whose writes are atomic per task but not per table: one writer per table at a time, and
a reader may see the moment of a commit. Tables without partitions are better changed by `sources.versions`, which never
overwrites. On a table format with transactions use `merge_into` instead of `upsert`.

Partitions that a run leaves without rows are cleared after its write. A run that dies in between leaves their old rows; the
same run, done again, clears them, as it finds them by its slices and not by what the first one did.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Callable, Mapping, Sequence
from contextlib import nullcontext
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from bizpulse.operators.merging import (
    absent_rows,
    one_per_key,
    replace_slice_rows,
    rows_in_slices,
    slice_keys,
    upsert_rows,
)
from bizpulse.session import brief_shuffles, codec, materialize, observed, small_tasks
from bizpulse.sources.readers import DEFAULT_FORMAT, read_table_if_exists

log = logging.getLogger(__name__)


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "append",
    partition_by: Sequence[str] = (),
    options: Mapping[str, str] | None = None,
    fmt: str = DEFAULT_FORMAT,
    cluster_by: Sequence[str] = (),
    balance: bool = False,
) -> None:
    """One partitioned write.

    `balance` gathers each partition's rows before writing, so a long range of days does not leave a file per task
    and day; oversized partitions are split again at run time. `cluster_by` sorts inside the files, which makes the
    min/max statistics selective; tasks are then kept small enough to sort in memory (see `small_tasks`). Rows per file are not
    capped unless `options` has maxRecordsPerFile. Parquet is compressed by zstd unless `options` or the session name a codec.
    """
    if balance and partition_by:
        df = df.hint("rebalance", *partition_by)
    if cluster_by:
        df = df.sortWithinPartitions(*partition_by, *cluster_by)
    writer = df.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with brief_shuffles(df.sparkSession), small_tasks(df.sparkSession) if cluster_by else nullcontext():
        writer.options(**{**codec(df.sparkSession, fmt), **(options or {})}).save(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str], **kwargs) -> None:
    """Replace only the partitions that `df` holds; the others stay. An empty frame replaces nothing."""
    options = {**(kwargs.pop("options", None) or {}), "partitionOverwriteMode": "dynamic"}
    write_table(df, path, "overwrite", partition_by, options, **kwargs)


def write_counted(df: DataFrame, writer, not_null: Sequence[str] = (), rejected: Column | None = None) -> dict:
    """Run `writer(df)` and return row, null and reject counts taken during that same write."""
    metrics = [F.count(F.lit(1)).alias("rows")]
    metrics += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in not_null]
    if rejected is not None:
        metrics.append(F.count_if(rejected).alias("rejected"))
    seen = Observation()
    writer(df.observe(seen, *metrics))
    names = ["rows", *[f"null_{c}" for c in not_null], *(["rejected"] if rejected is not None else [])]
    return {**dict.fromkeys(names, 0), **observed(seen)}


#: Partitions that one run may touch; more mean that a table is partitioned by a key.
MOST_PARTITIONS = 100_000


def _partition_values(df: DataFrame, columns: Sequence[str]) -> list[dict]:
    """Distinct partition values: as many as directories, which a table keeps few; metadata, not data. A run that touches more
    than MOST_PARTITIONS fails before it writes."""
    found = df.select(*columns).distinct().limit(MOST_PARTITIONS + 1).collect()
    if len(found) > MOST_PARTITIONS:
        raise ValueError(f"more than {MOST_PARTITIONS} partitions of {list(columns)}: partition by fewer values")
    return [row.asDict() for row in found]


def _is_one_of(parts: Sequence[Mapping]) -> Column:
    """Partition predicate of literal values, so unneeded directories are not even read.

    The column with most values becomes one IN list per combination of the others: a year of days stays one lookup.
    """
    if not parts:
        return F.lit(False)
    columns = list(parts[0])
    widest = max(columns, key=lambda c: len({p[c] for p in parts}))
    grouped: dict[tuple, list] = {}
    for part in parts:
        grouped.setdefault(tuple((c, part[c]) for c in columns if c != widest), []).append(part[widest])

    def listed(values: list) -> Column:
        known = F.col(widest).isin([v for v in values if v is not None])
        return known | F.col(widest).isNull() if None in values else known

    one = [
        reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(v)) for c, v in others], listed(values))
        for others, values in grouped.items()
    ]
    return reduce(lambda a, b: a | b, one)


def _rewrite(
    target: DataFrame,
    merge: Callable[[DataFrame], DataFrame],
    touched: Sequence[Mapping],
    path: str,
    partition_by: Sequence[str],
    fmt: str,
    cluster_by: Sequence[str] = (),
    options: Mapping[str, str] | None = None,
    balance: bool = True,
) -> None:
    """Replace the touched partitions of a table by `merge` of their rows; clear those left without rows.

    Other partitions are neither read nor written. A table without partitions is rewritten whole, by way of scratch.
    """
    if not partition_by:
        # Not safe from a crash: the copy stays in scratch, and the log names what to restore from. `sources.versions` is.
        whole = materialize(merge(target), "whole-table")
        log.info("rewriting %s from %s", path, whole.inputFiles()[:1])
        write_table(whole, path, "overwrite", options=options, fmt=fmt, cluster_by=cluster_by)
        return
    seen = Observation()
    parts = F.collect_set(F.struct(*partition_by)).alias("parts")
    merged = merge(target.filter(_is_one_of(touched))).observe(seen, parts)
    overwrite_partitions(merged, path, partition_by, options=options, fmt=fmt, cluster_by=cluster_by, balance=balance)
    filled = _filled(seen, merged)
    _empty_partitions(target, [p for p in touched if dict(p) not in filled], fmt)


def _filled(seen: Observation, written: DataFrame) -> list[dict]:
    """Partitions a write filled. Without metrics only a frame that is known to be empty filled none; never guess, as
    the partitions not listed here are cleared."""
    metrics = observed(seen)
    if "parts" in metrics:
        return [row.asDict() for row in metrics["parts"]]
    if written.isEmpty():
        return []
    raise RuntimeError("the write reported no metrics, so emptied partitions were not cleared")


def _joined(*lists: Sequence[Mapping]) -> list[Mapping]:
    """The lists in one, without repeats."""
    return list({tuple(p.items()): p for some in lists for p in some}.values())


def upsert(
    spark: SparkSession,
    source: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_by: Sequence[str] = (),
    fmt: str = DEFAULT_FORMAT,
    options: Mapping[str, str] | None = None,
) -> None:
    """Update rows with a matching key, insert the others; create the table if there is none.

    Null or duplicate source keys fail the job before the table is touched. The source is staged once in shared
    scratch. Rewritten are the partitions of the source and, when the key does not contain the partition columns and
    a row may move, those in which its keys are found.
    """
    absent = [c for c in partition_by if c not in source.columns]
    if absent:
        log.warning("upsert into %s: not partitioning by absent columns %s", path, absent)
    partition_by = [c for c in partition_by if c in source.columns]
    staged = one_per_key(materialize(source, "upsert-source"), keys)
    target = read_table_if_exists(spark, path, fmt)
    if target is None:
        write_table(staged, path, "overwrite", partition_by, options, fmt=fmt, balance=True)
        return
    touched = _partition_values(staged, partition_by) if partition_by else []
    if partition_by and not set(partition_by) <= set(keys):
        found = target.join(staged.select(*keys), list(keys), "left_semi")
        touched = _joined(touched, _partition_values(found, partition_by))
    _rewrite(target, lambda rows: upsert_rows(rows, staged, keys), touched, path, partition_by, fmt, options=options)


def merge_into(source: DataFrame, table: str, keys: Sequence[str]) -> None:
    """Upsert into a catalog table whose format supports row-level operations."""
    target = table.split(".")[-1]
    matches = reduce(lambda a, b: a & b, [F.col(f"{target}.{k}") == F.col(f"_source.{k}") for k in keys])
    merge = one_per_key(source, keys).alias("_source").mergeInto(table, matches)
    merge.whenMatched().updateAll().whenNotMatched().insertAll().merge()


def replace_slice(
    spark: SparkSession,
    source: DataFrame,
    path: str,
    slice_columns: Sequence[str],
    slices: Sequence[Mapping] | None = None,
    partition_by: Sequence[str] = (),
    fmt: str = DEFAULT_FORMAT,
    cluster_by: Sequence[str] = (),
    options: Mapping[str, str] | None = None,
    balance: bool = True,
) -> None:
    """Delete the rows of the slices and insert all source rows.

    `slices` lists the slice values of this run, so a slice without source rows ends up empty; without it the slices
    are those in the source. A source row outside the given slices fails the job, as the next run would not remove it.
    Slices that are exactly the partitions need no look at the target at all; otherwise only partitions that hold rows
    of the slices, or receive rows, are rewritten. Rows that come dealt out by partitions already need no `balance`.
    """
    if slices is not None:
        if any(set(s) != set(slice_columns) for s in slices):
            raise ValueError(f"every slice needs exactly the columns {list(slice_columns)}")
        inside = F.coalesce(_is_one_of(slices), F.lit(False))
        refuse = F.raise_error(F.lit("source row outside the given slices")).cast("boolean")
        source = source.filter(F.when(inside, F.lit(True)).otherwise(refuse))
    target = read_table_if_exists(spark, path, fmt)
    if target is None:
        write_table(source, path, "overwrite", partition_by, options, fmt=fmt, cluster_by=cluster_by, balance=balance)
        return
    if partition_by and set(partition_by) == set(slice_columns):
        if slices is None:
            overwrite_partitions(source, path, partition_by, options=options, fmt=fmt, cluster_by=cluster_by, balance=balance)
            return
        # The write itself reports which partitions it filled.
        seen = Observation()
        watched = source.observe(seen, F.collect_set(F.struct(*partition_by)).alias("parts"))
        overwrite_partitions(watched, path, partition_by, options=options, fmt=fmt, cluster_by=cluster_by, balance=balance)
        filled = _filled(seen, watched)
        _empty_partitions(target, [s for s in slices if dict(s) not in filled], fmt)
        return
    staged = materialize(source, "slice-source")
    if slices is None:
        named = slice_keys(staged, slice_columns)
    else:
        rows = [tuple(s[c] for c in slice_columns) for s in slices]
        named = spark.createDataFrame(rows, target.select(*slice_columns).schema)
    known = _few_values(named, target)
    inside = None if known is None else F.coalesce(_is_one_of(known), F.lit(False))
    touched = []
    if partition_by:
        found = rows_in_slices(target, named, slice_columns) if inside is None else target.filter(inside)
        touched = _joined(_partition_values(staged, partition_by), _partition_values(found, partition_by))

    def merge(rows: DataFrame) -> DataFrame:
        if inside is None:
            return replace_slice_rows(rows, staged, slice_columns, named)
        return rows.filter(~inside).unionByName(staged, allowMissingColumns=True)

    _rewrite(target, merge, touched, path, partition_by, fmt, cluster_by, options)


#: Slices up to this number are matched as values in a filter; more are joined.
MOST_LISTED_SLICES = 1000
#: Types whose values come back from the driver as they went there.
LISTED_TYPES = ("string", "tinyint", "smallint", "int", "bigint", "boolean", "date")


def _few_values(named: DataFrame, target: DataFrame) -> list[dict] | None:
    """The slices as values, if they are few and of types that a filter compares as a join does; else None.

    Few slices hold many rows each. A join would move all rows of a slice to one task, a filter moves none.
    """
    if any(kind not in LISTED_TYPES or dict(target.dtypes).get(name) != kind for name, kind in named.dtypes):
        return None
    found = named.distinct().limit(MOST_LISTED_SLICES + 1).collect()
    return None if len(found) > MOST_LISTED_SLICES else [row.asDict() for row in found]


#: Formats whose partitions are plain directories of files.
FILE_FORMATS = ("parquet", "orc", "json", "csv", "text", "avro")


def _empty_partitions(target: DataFrame, parts: Sequence[Mapping], fmt: str) -> None:
    """Clear whole partitions, which a dynamic overwrite without rows leaves as they were.

    One job finds the directories: those of the files that hold the partitions' rows, as Spark names them. They are then
    removed, a call to the file system each; there are as many as partitions of this run's slices.
    """
    if not parts:
        return
    if fmt not in FILE_FORMATS:
        raise ValueError(f"partitions of a {fmt} table are not plain directories; delete its rows by its own means")
    folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")
    found = target.filter(_is_one_of(parts)).select(folder.alias("folder")).distinct().collect()
    jvm = target.sparkSession._jvm
    conf = target.sparkSession._jsparkSession.sessionState().newHadoopConf()
    for row in found:
        directory = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(row["folder"]))
        if not directory.getFileSystem(conf).delete(directory, True):
            raise RuntimeError(f"could not clear {row['folder']}")


def seed_rows(spark: SparkSession, rows: DataFrame, path: str, keys: Sequence[str], fmt: str = DEFAULT_FORMAT) -> None:
    """Insert reference rows whose key is not there yet; existing rows stay as they are."""
    target = read_table_if_exists(spark, path, fmt)
    new = rows if target is None else materialize(absent_rows(target, rows, keys), "seed")
    write_table(new, path, "append", fmt=fmt)


def add_column(spark: SparkSession, table: str, name: str, kind: str, default: str) -> bool:
    """Add a column with a default to a catalog table; say whether it was added.

    The default, a literal of SQL, is kept in the catalog: files written before have no such column and answer with it, so no
    file is rewritten and no schema is merged when the table is read. Rows inserted without the column take it too. A column
    that is there already stays as it is.
    """
    if name.lower() in {c.lower() for c in spark.table(table).columns}:
        return False
    spark.sql(f"ALTER TABLE {table} ADD COLUMNS (`{name}` {kind} DEFAULT {default})")
    return True


def rows_per_file(df: DataFrame) -> DataFrame:
    """Rows of every file that a stored frame is read from: `file` and `row_count`. Reads no column; a file without rows is not
    listed."""
    return df.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("row_count"))


def register_table(
    spark: SparkSession, path: str, table: str, view: str | None = None, fmt: str = DEFAULT_FORMAT
) -> None:
    """Expose a stored table in the catalog under `table`, and optionally as a view. A table of that name over another
    location fails the call."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} USING {fmt} LOCATION '{path}'")
    there = spark.sql(f"DESCRIBE FORMATTED {table}").filter("col_name = 'Location'").first()["data_type"]
    plain = [re.sub("^[a-z0-9+.-]+:/*", "/", p).rstrip("/") for p in (there, path)]
    if plain[0] != plain[1]:
        raise ValueError(f"{table} is registered over {there}, not {path}")
    if spark.sql(f"DESCRIBE TABLE {table}").filter(F.col("col_name") == "# Partition Information").count():
        spark.catalog.recoverPartitions(table)
    if view:
        spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM {table}")
