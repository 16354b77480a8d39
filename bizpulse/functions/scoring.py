"""Column pieces of the popularity score."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Score weights, recency decay and the age used when a business has no review in the period.
# The last weight is shared evenly by check-ins and tip compliments.
WEIGHTS = {"stars": 0.50, "review_count": 0.25, "recency": 0.15, "checkin_and_tip": 0.10}
RECENCY_DECAY_DAYS = 30.0
NO_REVIEW_AGE_DAYS = 3650


def recency_boost(last_seen: Column, as_of: Column) -> Column:
    """Exponential decay over the days between the last review and `as_of`."""
    age = F.coalesce(F.date_diff(as_of, last_seen), F.lit(NO_REVIEW_AGE_DAYS))
    return F.exp(-age.cast("double") / F.lit(RECENCY_DECAY_DAYS))


def popularity_score(
    stars: Column, review_count: Column, recency: Column, checkin: Column, tip: Column,
    weights: Mapping[str, float] = WEIGHTS,
) -> Column:
    """Weighted sum of parts that already lie in [0, 1]."""
    return (
        stars * F.lit(weights["stars"])
        + review_count * F.lit(weights["review_count"])
        + recency * F.lit(weights["recency"])
        + (checkin + tip) * F.lit(weights["checkin_and_tip"] / 2)
    )


def min_max_normalize(df: DataFrame, columns: Mapping[str, str], by: Sequence[str] = ()) -> DataFrame:
    """Scale each source column to [0, 1] under its target name; a constant or all-null column becomes 0.0.

    All bounds come from one aggregate. Without `by` it is a scalar subquery. With `by` it holds one row per group and is
    joined without a hint: adaptive execution broadcasts it if it is small and splits hot groups if not.
    """
    bounds = F.struct(
        *[F.min(c).cast("double").alias(f"{c}_lo") for c in columns],
        *[F.max(c).cast("double").alias(f"{c}_hi") for c in columns],
    ).alias("_bounds")
    if by:
        framed = df.join(df.groupBy(*by).agg(bounds), list(by))
    else:
        framed = df.withColumn("_bounds", df.agg(bounds).scalar())

    def scaled(c: str) -> Column:
        low, high = F.col(f"_bounds.{c}_lo"), F.col(f"_bounds.{c}_hi")
        return F.when(high > low, (F.col(c).cast("double") - low) / (high - low)).otherwise(F.lit(0.0))

    return framed.select(*df.columns, *[scaled(c).alias(out) for c, out in columns.items()])
