"""City reports from partial sums per city and month, of which only replaced months are computed anew.

A summary row holds what a month adds to each report: counts, sums as decimals, and the businesses of the city as bitmaps over
their numbers (see `operators.state`), so distinct businesses over any months are the bits of an OR.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bizpulse.functions.dates import period_month
from bizpulse.operators.serving import latest_of, of_month
from bizpulse.schemas import AVG_STARS, MONTHLY

#: What the numbers of business ids are kept under.
BUSINESS = "business"


def business_ids(popularity: DataFrame) -> DataFrame:
    """Rows (kind, id) for `operators.state.new_numbers`."""
    return popularity.select(F.lit(BUSINESS).alias("kind"), F.col("business_id").alias("id"))


def city_sums(popularity: DataFrame, fact: DataFrame, numbers: DataFrame, digits: int = 9) -> DataFrame:
    """One row per day, city, state and bucket of business numbers.

    `rows` and `scored` count rows and scores, `score_sum` adds the scores. Of businesses with monthly measures, `active` counts
    them, `measures` their measures, `weighted_sum` adds each score once for every measure, `rated` and `rating_sum` are of
    average stars. Averages add decimals of `digits`, so they are equal on every run. Both tables hold each business once a
    day, or once a day and measure; hand in the days to be summed only.
    """

    def decimal(value: Column) -> Column:
        return value.cast(f"decimal(18,{digits})")

    rating = F.max(F.when(F.col("measure") == AVG_STARS, F.col("units")))
    folded = fact.filter(F.col("granularity") == MONTHLY).groupBy("business_id", "day").agg(F.count(F.lit(1)).alias("_measures"), rating.alias("_rating"))
    own = popularity.select("business_id", "day", "city", "state", "popularity_score").join(folded, ["business_id", "day"], "left")
    own = own.join(numbers.filter(F.col("kind") == BUSINESS).select(F.col("id").alias("business_id"), "number"), "business_id")
    score, weight = F.col("popularity_score"), F.col("_measures").cast("int")
    return own.groupBy("day", "city", "state", F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(score).alias("scored"),
        F.sum(decimal(score)).alias("score_sum"),
        F.count("_measures").alias("active"),
        F.sum(F.when(score.isNotNull(), weight)).alias("measures"),
        F.sum(decimal(score) * weight).alias("weighted_sum"),
        F.count("_rating").alias("rated"),
        F.sum(decimal(F.col("_rating"))).alias("rating_sum"),
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"),
    )


def _mean(total: str, count: str) -> Column:
    return F.sum(total).cast("double") / F.nullif(F.sum(count), F.lit(0))


def top_cities(sums: DataFrame, top: int = 5) -> DataFrame:
    """As `serving.top_cities`."""
    per_bucket = sums.groupBy("city", "state", "bucket").agg(
        F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"), F.sum("score_sum").alias("score_sum"), F.sum("scored").alias("scored"), F.max("day").alias("day")
    )
    whole = per_bucket.groupBy("city", "state").agg(
        F.sum("n").alias("business_count"), _mean("score_sum", "scored").alias("avg_popularity"), period_month(F.max("day")).alias("latest_period")
    )
    return whole.orderBy(F.desc("avg_popularity"), "city", "state").limit(top)


def city_dashboard(sums: DataFrame, top: int = 20) -> DataFrame:
    """As `serving.city_dashboard`: the latest month's businesses with activity."""
    latest = sums.filter(F.col("day") == latest_of(sums, "day")).groupBy("city").agg(
        F.sum("active").alias("businesses"), _mean("weighted_sum", "measures").alias("avg_popularity"), _mean("rating_sum", "rated").alias("avg_rating")
    )
    return latest.filter("businesses > 0").orderBy(F.desc("avg_popularity"), "city").limit(top)


def city_time_series(sums: DataFrame) -> DataFrame:
    """As `serving.city_time_series` for all cities."""
    per_bucket = sums.groupBy("city", "day", "bucket").agg(
        F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"), F.sum("score_sum").alias("score_sum"), F.sum("scored").alias("scored")
    )
    series = per_bucket.groupBy("city", period_month(F.col("day")).alias("period_month"))
    return series.agg(F.sum("n").alias("active_businesses"), _mean("score_sum", "scored").alias("avg_popularity"))


def city_period_average(sums: DataFrame, period: str) -> DataFrame:
    """As `serving.city_period_average`."""
    own = sums.filter(of_month(period)).groupBy("city")
    return own.agg(_mean("score_sum", "scored").alias("avg_score"), F.sum("rows").alias("business_count"))
