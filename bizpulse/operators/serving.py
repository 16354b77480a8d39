"""Reports over the gold tables. `fact` is the narrow measure table, `popularity` the monthly score table.

Reports that rank or cut have a unique last sort column, so their result is the same on every run. With `digits`,
averages add decimals of that scale, so they do not depend on the order in which Spark adds.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bizpulse.functions.dates import in_months, month_end, period_month
from bizpulse.operators.quality import duplicate_keys, missing_fields, table_row_counts
from bizpulse.schemas import (
    AVG_STARS,
    DAILY,
    DISTINCT_USERS_REVIEW,
    DISTINCT_USERS_TIP,
    MONTHLY,
    POPULARITY_KEY,
    REVIEW_COUNT,
    TIP_COUNT,
    TOTAL_USEFUL,
)

LATEST_METRICS = {
    "review_count": REVIEW_COUNT,
    "avg_stars": AVG_STARS,
    "tip_count": TIP_COUNT,
    "total_useful": TOTAL_USEFUL,
    "distinct_users_review": DISTINCT_USERS_REVIEW,
    "distinct_users_tip": DISTINCT_USERS_TIP,
}
TREND_METRICS = {
    "review_count": REVIEW_COUNT,
    "avg_stars": AVG_STARS,
    "tip_count": TIP_COUNT,
    "total_useful": TOTAL_USEFUL,
}
SUMMARY_METRICS = {"total_reviews": REVIEW_COUNT, "avg_stars": AVG_STARS, "total_tips": TIP_COUNT}


def _addend(value: Column, digits: int | None) -> Column:
    return value if digits is None else value.cast(f"decimal(18,{digits})")


def _mean(value: Column, digits: int | None, weight: Column | None = None) -> Column:
    """Average of the non-null values, each counted `weight` times."""
    part = _addend(value, digits)
    if weight is None:
        total, count = F.sum(part), F.count(value)
    else:
        # An int weight keeps the product within decimal precision, so no digit is lost.
        total, count = F.sum(part * weight.cast("int")), F.sum(F.when(value.isNotNull(), weight))
    return total.cast("double") / F.nullif(count, F.lit(0))


def pivot_measures(fact: DataFrame, keys: Sequence[str], measures: Mapping[str, int]) -> DataFrame:
    """Narrow -> wide: one column per measure, one shuffle. A key with none of the measures keeps a row of nulls."""
    wide = [F.max(F.when(F.col("measure") == code, F.col("units"))).alias(name) for name, code in measures.items()]
    return fact.groupBy(*keys).agg(*wide)


def latest_of(df: DataFrame, column: str) -> Column:
    """The largest value of a column as a scalar subquery. Of `day`, a partition column, it needs no data column."""
    return df.agg(F.max(column)).scalar()


def of_month(period: str) -> Column:
    """Rows whose `day` lies in the month `YYYY-MM`: the period as a range on the partition column, so it prunes."""
    return in_months("day", [month_end(f"{period}-01")])


def top_businesses_by_city(popularity: DataFrame, top: int = 10) -> DataFrame:
    """Businesses ranked up to `top` in their city for the latest month; ties may give more than `top` rows.

    All cities, so not sorted: a sort of the whole result is for whoever shows it.
    """
    latest = F.col("day") == latest_of(popularity, "day")
    return popularity.filter((F.col("city_rank") <= top) & latest).select(
        "city", "state", "business_id", "name", "categories", "popularity_score", "city_rank", "period_month"
    )


def top_in_city(popularity: DataFrame, city: str, period: str, top: int = 10) -> DataFrame:
    return (
        popularity.filter((F.col("city") == city) & of_month(period))
        .select("business_id", "name", "city_rank", "popularity_score", "categories")
        .orderBy("city_rank", "business_id")
        .limit(top)
    )


def top_per_city(popularity: DataFrame, period: str, top: int = 5) -> DataFrame:
    return popularity.filter(of_month(period) & (F.col("city_rank") <= top)).select(
        "city", "state", "business_id", "name", "city_rank", "popularity_score"
    )


def latest_review_metrics(fact: DataFrame) -> DataFrame:
    """Measures of the latest daily run, one row per business."""
    daily = fact.filter(F.col("granularity") == DAILY)
    latest = daily.filter(F.col("day") == latest_of(daily, "day"))
    return pivot_measures(latest, ["business_id", "day", "period_month"], LATEST_METRICS)


def monthly_business_summary(fact: DataFrame, popularity: DataFrame) -> DataFrame:
    """Monthly measures with score and rank, for every business with activity.

    The left join on business and month is one by business: its scores, one a month, are a short list, of which each row takes
    those of its month. So the business is the only key of all steps, and tables that are bucketed by it are not shuffled.
    """
    own = ["popularity_score", "city_rank", "name", "city", "state"]
    wide = pivot_measures(fact.filter(F.col("granularity") == MONTHLY), ["business_id", "day", "period_month"], SUMMARY_METRICS)
    scores = popularity.filter(F.col("granularity") == MONTHLY)
    listed = scores.groupBy("business_id").agg(F.collect_list(F.struct("day", *own)).alias("_scores"))
    joined = wide.join(listed, "business_id", "left").select(
        "business_id", "period_month", "day", *SUMMARY_METRICS, F.explode_outer(F.filter("_scores", lambda s: s["day"] == F.col("day"))).alias("_own")
    )
    return joined.select("business_id", "period_month", "day", *SUMMARY_METRICS, *(f"_own.{c}" for c in own))


def monthly_trend(fact: DataFrame, business_id: str | None = None) -> DataFrame:
    """Monthly measures over time, for one business (in order of time) or for all (to be stored, so not sorted)."""
    monthly = fact.filter(F.col("granularity") == MONTHLY)
    if business_id is not None:
        monthly = monthly.filter(F.col("business_id") == business_id)
    trend = pivot_measures(monthly, ["business_id", "period_month"], TREND_METRICS)
    return trend if business_id is None else trend.orderBy("period_month")


def review_growth(fact: DataFrame, business_id: str | None = None) -> DataFrame:
    """Reviews per month next to the previous month with activity, for one business or for all.

    The window holds one row per month of a business, so no group grows with the reviews.
    """
    monthly = fact.filter((F.col("granularity") == MONTHLY) & (F.col("measure") == REVIEW_COUNT))
    if business_id is not None:
        monthly = monthly.filter(F.col("business_id") == business_id)
    per_month = monthly.groupBy("business_id", "period_month").agg(F.max("units").alias("reviews"))
    in_time = Window.partitionBy("business_id").orderBy("period_month")
    growth = per_month.withColumn("prev_month", F.lag("reviews").over(in_time))
    return growth if business_id is None else growth.orderBy("period_month")


def top_cities(popularity: DataFrame, top: int = 5, digits: int | None = None) -> DataFrame:
    """Cities with the best average score."""
    return (
        popularity.groupBy("city", "state")
        .agg(
            F.count_distinct("business_id").alias("business_count"),
            _mean(F.col("popularity_score"), digits).alias("avg_popularity"),
            F.max("period_month").alias("latest_period"),
        )
        .orderBy(F.desc("avg_popularity"), "city", "state")
        .limit(top)
    )


def city_comparison(fact: DataFrame, popularity: DataFrame, city: str, period: str, top: int = 20) -> DataFrame:
    """Businesses of one city and month by rank, with their review counts."""
    keys = ["business_id", "day", "granularity"]
    scores = popularity.filter((F.col("city") == city) & of_month(period))
    # The period also holds for the fact side; saying so prunes its scan.
    counts = fact.filter((F.col("measure") == REVIEW_COUNT) & of_month(period)).select(
        *keys, F.col("units").alias("review_count")
    )
    return (
        scores.join(counts, keys)
        .select("business_id", "name", "city_rank", "popularity_score", "review_count")
        .orderBy("city_rank", "business_id")
        .limit(top)
    )


def city_dashboard(fact: DataFrame, popularity: DataFrame, top: int = 20, digits: int | None = None) -> DataFrame:
    """Cities of the latest month: businesses with activity, average score, average rating.

    The averages run over one row per business and measure, so a score counts once for each measure its business has.
    The measures (one row each, by the table's key) are folded to one row per business before the join; the row count
    then serves as the weight. Both sides read the latest day's partitions only.
    """
    latest = F.col("day") == latest_of(popularity, "day")
    current = popularity.filter(latest).select("business_id", "day", "city", "popularity_score")
    rating = F.when(F.col("measure") == AVG_STARS, F.col("units"))
    folded = (
        fact.filter((F.col("granularity") == MONTHLY) & latest)
        .groupBy("business_id", "day")
        .agg(
            F.count(F.lit(1)).alias("_rows"),
            F.max(rating).alias("_rating"),
        )
    )
    return (
        current.join(folded, ["business_id", "day"])
        .groupBy("city")
        .agg(
            # By the table's key a business has one row a day, so counting rows counts businesses.
            F.count("business_id").alias("businesses"),
            _mean(F.col("popularity_score"), digits, weight=F.col("_rows")).alias("avg_popularity"),
            _mean(F.col("_rating"), digits).alias("avg_rating"),
        )
        .orderBy(F.desc("avg_popularity"), "city")
        .limit(top)
    )


def city_time_series(popularity: DataFrame, city: str | None = None, digits: int | None = None) -> DataFrame:
    """Active businesses and average score per month, for one city or for all."""
    rows = popularity if city is None else popularity.filter(F.col("city") == city)
    series = rows.groupBy("city", "period_month").agg(
        F.count_distinct("business_id").alias("active_businesses"),
        _mean(F.col("popularity_score"), digits).alias("avg_popularity"),
    )
    return series if city is None else series.orderBy("period_month")


def city_period_average(popularity: DataFrame, period: str, digits: int | None = None) -> DataFrame:
    return (
        popularity.filter(of_month(period))
        .groupBy("city")
        .agg(
            _mean(F.col("popularity_score"), digits).alias("avg_score"),
            F.count(F.lit(1)).alias("business_count"),
        )
    )


def coverage_stats(popularity: DataFrame) -> DataFrame:
    """Months and days the table covers, and its last load time when it carries one."""
    ingested = [F.max("_gold_ingest_ts").alias("last_update")] if "_gold_ingest_ts" in popularity.columns else []
    return popularity.agg(
        *ingested,
        F.count_distinct("period_month").alias("months_available"),
        F.min("day").alias("first_date"),
        F.max("day").alias("last_date"),
    )


def coverage_of_slices(slices: DataFrame) -> DataFrame:
    """Months and days that a table's slices cover; `slices` has a row for each that has rows, with its `day`. Every row's period
    is the month of its day, so counts of slices tell what the rows would."""
    return slices.agg(
        F.count_distinct(period_month(F.col("day"))).alias("months_available"), F.min("day").alias("first_date"), F.max("day").alias("last_date")
    )


def create_views(fact: DataFrame, popularity: DataFrame) -> list[str]:
    """Register the gold tables, the standing reports and the quality checks as temporary views for SQL users; return
    their names."""
    views = {
        "fact_review_tip_metrics": fact,
        "business_popularity": popularity,
        "v_top_businesses_by_city": top_businesses_by_city(popularity),
        "v_latest_review_metrics": latest_review_metrics(fact),
        "v_monthly_business_summary": monthly_business_summary(fact, popularity),
        "v_table_row_counts": table_row_counts({"business_popularity": popularity, "fact_review_tip_metrics": fact}),
        "v_dq_duplicate_business_popularity": duplicate_keys(popularity, POPULARITY_KEY),
        "v_dq_missing_fields": missing_fields(
            {"business_popularity": (popularity, ["business_id"]), "fact_review_tip_metrics": (fact, ["units"])}
        ),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
