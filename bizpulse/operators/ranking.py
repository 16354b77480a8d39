"""Rank within groups of any size."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bizpulse.session import materialize


def rank_within(df: DataFrame, by: Sequence[str], score: str, out: str = "rank", slices: Column | None = None) -> DataFrame:
    """`rank()` by `score` descending within `by`, equal scores sharing a rank, nulls in `by` forming one group.

    A window over `by` would sort a whole group in one task, and one city may hold a third of all rows. So, at every size:

    1. rows of one group with the same score collapse to a count (combined on the map side);
    2. these ties are cut into slices by score: by `slices`, a number that does not fall as the score falls and follows from the
       row alone, or else by range-partitioning them on group and score into as many as `spark.sql.shuffle.partitions` says, of
       about equal size; then the slice of each tie is written to shared scratch, so that all later steps see the same cuts;
    3. a rank is 1 + the rows in higher slices (a running sum over a group's slices, a few numbers each)
       + the rows above it inside its slice (a running sum over one slice).

    The rank goes back to the rows by a join on (`by`, `score`). A hot tie makes one large join key there, which AQE
    splits at run time, as its other side holds a single row. `df` is read twice, so hand in a frame that is cheap to rescan.
    With `slices` nothing runs before the result is used.
    """
    group, low = list(by), Window.unboundedPreceding
    best_first = F.col(score).desc_nulls_last()
    ties = df.groupBy(*group, score).agg(F.count(F.lit(1)).alias("_n"))
    if slices is not None:
        sliced = ties.withColumn("_slice", slices)
    else:
        ranges = ties.repartitionByRange(*group, best_first)
        sliced = materialize(ranges.withColumn("_slice", F.spark_partition_id()), "rank-slices")
    above_in_slice = Window.partitionBy(*group, "_slice").orderBy(best_first).rowsBetween(low, -1)
    inside = sliced.withColumn("_inside", F.coalesce(F.sum("_n").over(above_in_slice), F.lit(0)))
    higher_slices = Window.partitionBy(*group).orderBy(F.col("_slice").asc_nulls_last()).rowsBetween(low, -1)
    ahead = (
        sliced.groupBy(*group, "_slice")
        .agg(F.sum("_n").alias("_rows"))
        .select(*group, "_slice", F.coalesce(F.sum("_rows").over(higher_slices), F.lit(0)).alias("_ahead"))
    )
    ranks = _null_safe_join(inside, ahead, [*group, "_slice"]).select(
        *group, score, (1 + F.col("_ahead") + F.col("_inside")).cast("int").alias(out)
    )
    return _null_safe_join(df, ranks, [*group, score]).select(*df.columns, out)


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner equi-join in which null matches null; keys come from the left side."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    matches = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, matches).drop(*[f"_r_{k}" for k in keys])
