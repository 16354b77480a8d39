"""Row-level maintenance as plain DataFrame operations; `sources.lake` applies them to stored tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`df` unchanged, after a job that fails if a key is null or occurs twice.

    The job reads the key columns alone and hashes them; copies of a key combine on the map side and no row is sorted or
    moved. Hand in a stored frame.
    """
    missing = [k for k in keys if k not in df.columns]
    if missing or not keys:
        raise ValueError(f"key columns missing from the source: {', '.join(missing) or 'none given'}")
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"))
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    bad = counted.filter(any_null | (F.col("_copies") > 1)).withColumn("_null", any_null).first()
    if bad:
        shown = ", ".join("null" if bad[k] is None else str(bad[k]) for k in keys)
        raise ValueError(f"{'null in' if bad['_null'] else 'duplicate'} source key: {shown}")
    return df


def upsert_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is not in the source, plus all source rows. Source keys must be unique. They are merged, as a stored
    source looks many times smaller than its keys are when they are broadcast."""
    kept = target.join(source.select(*keys).hint("merge"), list(keys), "left_anti")
    return kept.unionByName(source, allowMissingColumns=True)


def slice_keys(df: DataFrame, slice_columns: Sequence[str]) -> DataFrame:
    """The distinct slices a frame holds."""
    return df.select(*slice_columns).distinct()


def _match_slices(df: DataFrame, slices: DataFrame, slice_columns: Sequence[str], how: str) -> DataFrame:
    """Semi or anti join with the slices; null matches null."""
    renamed = slice_keys(slices, slice_columns).toDF(*[f"_s_{c}" for c in slice_columns])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in slice_columns])
    return df.join(renamed, same, how)


def rows_in_slices(df: DataFrame, slices: DataFrame, slice_columns: Sequence[str]) -> DataFrame:
    """Rows whose slice values are among the slices."""
    return _match_slices(df, slices, slice_columns, "left_semi")


def replace_slice_rows(
    target: DataFrame, source: DataFrame, slice_columns: Sequence[str], slices: DataFrame | None = None
) -> DataFrame:
    """Target rows outside the slices, plus all source rows.

    The slices default to those in the source. Pass them to clear a slice for which the source has no rows left.
    """
    kept = _match_slices(target, source if slices is None else slices, slice_columns, "left_anti")
    return kept.unionByName(source, allowMissingColumns=True)


def absent_rows(target: DataFrame, candidates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Candidates whose key the target does not hold yet."""
    return candidates.join(target.select(*keys), list(keys), "left_anti")


def with_default_column(df: DataFrame, name: str, default: Column) -> DataFrame:
    """Add a column with a default, or fill the nulls of an existing one (files written before it existed)."""
    value = F.coalesce(F.col(name), default) if name in df.columns else default
    return df.withColumn(name, value)
