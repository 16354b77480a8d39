"""Monthly popularity of businesses: activity, normalised metrics, score and city rank."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bizpulse.functions.dates import as_date, event_rows, in_months, is_month_end, period_month
from bizpulse.functions.scoring import WEIGHTS, min_max_normalize, popularity_score, recency_boost
from bizpulse.operators.ranking import rank_within
from bizpulse.operators.silver import latest_per_key
from bizpulse.schemas import MONTHLY, POPULARITY_COLUMNS

#: Slices of equal scores' width that a city is ranked in.
SLICES = 4096
# Metric column -> its normalised column.
NORMALIZED = {
    "avg_review_stars": "norm_stars",
    "review_count": "norm_review_count",
    "checkin_count": "norm_checkin_count",
    "tip_compliment_count": "norm_tip_compliments",
}


def review_stats(reviews: DataFrame, by: Sequence[str] = ("business_id",)) -> DataFrame:
    return reviews.groupBy(*by).agg(
        F.count(F.lit(1)).alias("review_count"),
        F.avg("stars").alias("avg_review_stars"),
        F.max("date").alias("last_review_date"),
        F.min("date").alias("first_review_date"),
    )


def checkin_counts(checkins: DataFrame, by: Sequence[str] = ("business_id",)) -> DataFrame:
    return checkins.groupBy(*by).agg(F.count(F.lit(1)).alias("checkin_count"))


def compliment_sums(tips: DataFrame, by: Sequence[str] = ("business_id",)) -> DataFrame:
    return tips.groupBy(*by).agg(F.sum("compliment_count").alias("tip_compliment_count"))


def business_activity(
    reviews: DataFrame, tips: DataFrame, checkins: DataFrame, by: Sequence[str] = ("business_id",)
) -> DataFrame:
    """The three statistics above side by side.

    The event streams are lined up in common columns and aggregated together: one partial aggregate per input task
    and a single shuffle on the key, instead of a shuffle and a join per stream.
    """
    key = list(by)
    none = {
        "_review": F.lit(0),
        "stars": F.lit(None).cast("int"),
        "_review_date": F.lit(None).cast("date"),
        "_checkin": F.lit(0),
        "compliment_count": F.lit(None).cast("int"),
    }

    def lined_up(df: DataFrame, **given) -> DataFrame:
        return df.select(*key, *[given.get(name, empty).alias(name) for name, empty in none.items()])

    events = (
        lined_up(reviews, _review=F.lit(1), stars=F.col("stars"), _review_date=F.col("date"))
        .unionByName(lined_up(tips, compliment_count=F.col("compliment_count")))
        .unionByName(lined_up(checkins, _checkin=F.lit(1)))
    )
    return events.groupBy(*key).agg(
        F.sum("_review").alias("review_count"),
        F.avg("stars").alias("avg_review_stars"),
        F.max("_review_date").alias("last_review_date"),
        F.min("_review_date").alias("first_review_date"),
        F.sum("_checkin").alias("checkin_count"),
        F.sum("compliment_count").alias("tip_compliment_count"),
    )


def popularity_inputs(
    business: DataFrame,
    reviews: DataFrame,
    tips: DataFrame,
    checkins: DataFrame,
    month_ends: Sequence[str | dt.date],
    by_event_day: bool = False,
) -> DataFrame:
    """Open businesses of each month-end snapshot with their activity in that month; no activity counts as 0.

    `business` and `checkins` are snapshots (column `day`), `reviews` and `tips` are dated events, stored by their own
    day if `by_event_day` (see `event_rows`).
    """
    days = sorted({as_date(d) for d in month_ends})
    wrong = [str(d) for d in days if not is_month_end(d)]
    if wrong or not days:
        raise ValueError(f"popularity runs on month-end days only, not on: {', '.join(wrong) or 'no day'}")

    open_now = business.filter(F.col("day").isin(days) & F.col("is_open"))
    # The check-in snapshot repeats every run day; only the copy of its own month-end counts.
    own_month = checkins.filter(
        F.col("day").isin(days) & in_months("checkin_date", days) & (F.last_day("checkin_date") == F.col("day"))
    )
    activity = business_activity(
        *[
            event_rows(events, lambda c: in_months(c, days), by_event_day=by_event_day).withColumn("day", F.last_day("date"))
            for events in (reviews, tips)
        ],
        own_month,
        by=["business_id", "day"],
    )
    attributes = ["business_id", "day", "name", "city", "state", "categories"]
    newest = latest_per_key(
        open_now.select(*attributes, *[c for c in ("_ingest_ts",) if c in open_now.columns]), ["business_id", "day"]
    )
    return (
        newest.select(*attributes)
        .join(activity, ["business_id", "day"], "left")
        .na.fill(0, list(NORMALIZED))
    )


def score_inputs(
    inputs: DataFrame, weights: Mapping[str, float] = WEIGHTS, digits: int | None = None
) -> DataFrame:
    """Normalise each month on its own, add the recency boost and the score (rounded to `digits` if given)."""
    normalized = min_max_normalize(inputs, NORMALIZED, by=["day"])
    boosted = normalized.withColumn("recency_boost", recency_boost(F.col("last_review_date"), F.col("day")))
    score = popularity_score(
        F.col("norm_stars"),
        F.col("norm_review_count"),
        F.col("recency_boost"),
        F.col("norm_checkin_count"),
        F.col("norm_tip_compliments"),
        weights,
    )
    return boosted.withColumn("popularity_score", score if digits is None else F.round(score, digits))


def business_popularity(
    business: DataFrame,
    reviews: DataFrame,
    tips: DataFrame,
    checkins: DataFrame,
    month_ends: Sequence[str | dt.date],
    weights: Mapping[str, float] = WEIGHTS,
    rank_by: Sequence[str] = ("city",),
    digits: int | None = None,
    by_event_day: bool = False,
) -> DataFrame:
    """Popularity rows of one or many months, a frame that runs nothing and writes nothing until it is used."""
    return ranked_popularity(popularity_inputs(business, reviews, tips, checkins, month_ends, by_event_day), weights, rank_by, digits)


def ranked_popularity(
    inputs: DataFrame, weights: Mapping[str, float] = WEIGHTS, rank_by: Sequence[str] = ("city",), digits: int | None = None
) -> DataFrame:
    """Scores and ranks of the per-business inputs, which feed the bounds, the scores and the ranks: a job stores them first, so
    that it reads the events a single time.

    Scores lie between 0 and the sum of the weights, so they are cut into SLICES of equal width for ranking.
    """
    scored = score_inputs(inputs, weights, digits)
    width = sum(map(abs, weights.values())) or 1.0
    slices = -F.floor(F.col("popularity_score") * F.lit(SLICES / width))
    return (
        rank_within(scored, ["day", *rank_by], "popularity_score", "city_rank", slices)
        .withColumn("period_month", period_month(F.col("day")))
        .withColumn("granularity", F.lit(MONTHLY))
        .select(*POPULARITY_COLUMNS)
    )
