"""Review and tip measures per business, wide and narrow, for one period or for every day and month at once."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bizpulse.functions.dates import as_date, event_rows, in_days, month_end, month_ends_between, period_month
from bizpulse.schemas import (
    AVG_STARS,
    COMPLIMENT_COUNT_SUM,
    DAILY,
    DISTINCT_USERS_REVIEW,
    DISTINCT_USERS_TIP,
    FACT_COLUMNS,
    MONTHLY,
    REVIEW_COUNT,
    TIP_COUNT,
    TOTAL_COOL,
    TOTAL_FUNNY,
    TOTAL_USEFUL,
)

REVIEW_MEASURES = {
    "review_count": REVIEW_COUNT,
    "avg_stars": AVG_STARS,
    "total_useful": TOTAL_USEFUL,
    "total_funny": TOTAL_FUNNY,
    "total_cool": TOTAL_COOL,
    "distinct_users_review": DISTINCT_USERS_REVIEW,
}
TIP_MEASURES = {
    "tip_count": TIP_COUNT,
    "compliment_count_sum": COMPLIMENT_COUNT_SUM,
    "distinct_users_tip": DISTINCT_USERS_TIP,
}


def review_metrics(reviews: DataFrame, by: Sequence[str] = ("business_id",)) -> DataFrame:
    """Wide review measures. The distinct counts shuffle on (key, id) first, so a hot business spreads out."""
    return reviews.groupBy(*by).agg(
        F.count_distinct("review_id").cast("double").alias("review_count"),
        F.avg("stars").alias("avg_stars"),
        F.sum("useful").cast("double").alias("total_useful"),
        F.sum("funny").cast("double").alias("total_funny"),
        F.sum("cool").cast("double").alias("total_cool"),
        F.count_distinct("user_id").cast("double").alias("distinct_users_review"),
    )


def tip_metrics(tips: DataFrame, by: Sequence[str] = ("business_id",)) -> DataFrame:
    """Wide tip measures; a missing compliment count is 0."""
    return tips.groupBy(*by).agg(
        F.count(F.lit(1)).cast("double").alias("tip_count"),
        F.sum(F.coalesce("compliment_count", F.lit(0))).cast("double").alias("compliment_count_sum"),
        F.count_distinct("user_id").cast("double").alias("distinct_users_tip"),
    )


def extra_measures(reviews: DataFrame, tips: DataFrame) -> DataFrame:
    """Measures the catalogue declares beyond the nine: star sum, compliments per tip, positive and negative share."""
    stars = F.col("stars")
    per_review = reviews.groupBy("business_id").agg(
        F.sum(stars).cast("double").alias("stars_sum"),
        (F.avg(F.when(stars >= 4, 1.0).when(stars < 4, 0.0)) * 100).alias("positive_pct"),
        (F.avg(F.when(stars <= 2, 1.0).when(stars > 2, 0.0)) * 100).alias("negative_pct"),
    )
    per_tip = tips.groupBy("business_id").agg(
        F.avg(F.coalesce("compliment_count", F.lit(0))).alias("avg_tip_compliments")
    )
    return per_review.join(per_tip, "business_id", "full")


def to_narrow(wide: DataFrame, keys: Sequence[str], measures: Mapping[str, int]) -> DataFrame:
    """One row per key and measure. Rows with null units stay."""
    pairs = ", ".join(f"{code}, `{name}`" for name, code in measures.items())
    return wide.select(*keys, F.expr(f"stack({len(measures)}, {pairs}) AS (measure, units)"))


def fact_for_period(
    reviews: DataFrame, tips: DataFrame, run_day: str | dt.date, granularity: int, by_event_day: bool = False
) -> DataFrame:
    """Narrow fact rows of one run day: that day alone, or its whole month when `granularity` is monthly.

    Monthly rows are stamped with the month end, so a month has one version whichever day asks for it. `by_event_day`
    says that the events are stored by their own day, in a column `day` (see `event_rows`).
    """
    day = as_date(run_day)
    if granularity == DAILY:
        start = end = day
    elif granularity == MONTHLY:
        start, end = day.replace(day=1), month_end(day)
    else:
        raise ValueError(f"granularity must be {DAILY} or {MONTHLY}, not {granularity}")
    key = ["business_id"]
    own_reviews, own_tips = (
        event_rows(events, lambda c: in_days(c, start, end), by_event_day=by_event_day) for events in (reviews, tips)
    )
    narrow = to_narrow(review_metrics(own_reviews), key, REVIEW_MEASURES).unionByName(
        to_narrow(tip_metrics(own_tips), key, TIP_MEASURES)
    )
    stamped = narrow.withColumn("day", F.lit(end)).withColumn("granularity", F.lit(granularity))
    return stamped.withColumn("period_month", period_month(F.col("day"))).select(*FACT_COLUMNS)


#: Events of a business in a month from which its rows are spread over tasks.
HOT_EVENTS = 100_000


def fact_for_range(
    reviews: DataFrame,
    tips: DataFrame,
    start: str | dt.date,
    end: str | dt.date,
    daily: bool = True,
    monthly: bool = True,
    force_months: Sequence[str | dt.date] = (),
    by_event_day: bool = False,
    balance: bool = False,
) -> DataFrame:
    """Every daily and monthly fact row of the run days `start` to `end` in one job.

    Daily rows exist for each day in the range; monthly rows for each month that ends in it, or that is forced, and
    always cover the whole month. Equal to the union of `fact_for_period` over all those runs, but:

    - an event counts for its day and its month; it says of its ids whether they are the first of their day and of their month, so
      adding these gives the distinct ids. Events are added by day, and these rows once more by day and month;
    - events are dealt out once by business and month, reviews and tips together, and all steps follow within a task. A business
      with HOT_EVENTS in a month or more takes the same steps without that: its rows are spread over the ids and then combined on
      the map side. Such are few, at most the events divided by that number, so the list of them is broadcast;
    - measures stay side by side until the end. With `balance` the rows are gathered by day and granularity and sorted by business
      for a write while they are still that few; then do not let the write gather or cluster them again.

    Only the columns of the measures are read. Ids must not be null, which silver guarantees.
    """
    first, last = as_date(start), as_date(end)
    months = {month_end(m) for m in force_months}
    if monthly:
        months.update(month_ends_between(first, last))
    wanted = ([first, last] if daily else []) + [d for m in months for d in (m.replace(day=1), m)]
    if not wanted:
        raise ValueError("nothing to compute: no daily rows wanted and no month ends in the range")
    read_from, read_to = min(wanted), max(wanted)
    slots = _Slots(first, last, sorted(months), daily)

    dated = [
        event_rows(events, lambda c: in_days(c, read_from, read_to), by_event_day=by_event_day)
        .withColumn("day", F.to_date("date"))
        .withColumn("month", F.last_day("day"))
        for events in (reviews, tips)
    ]
    place = ["business_id", "month"]
    counted = dated[0].select(*place).unionByName(dated[1].select(*place)).groupBy(*place).agg(F.count(F.lit(1)).alias("_events"))
    hot = F.broadcast(counted.filter(F.col("_events") >= HOT_EVENTS).select(*place))
    spread = _wide_rows(_lined_up(*[df.join(hot, place, "left_semi") for df in dated]), slots)
    own = _lined_up(*[df.join(hot, place, "left_anti") for df in dated])
    # Events are sorted by their ids in a task, so twice as many tasks as of other shuffles, and none are put together.
    tasks = 2 * int(own.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wide = _wide_rows(own.repartition(tasks, *place), slots).unionByName(spread)
    if balance:
        wide = wide.hint("rebalance", "day", "granularity").sortWithinPartitions("day", "granularity", "business_id")
    return _narrow_rows(wide.withColumn("period_month", period_month(F.col("day")))).select(*FACT_COLUMNS)


#: Measures of a wide row, in the order of its units.
WIDE_REVIEW = (REVIEW_COUNT, DISTINCT_USERS_REVIEW, AVG_STARS, TOTAL_USEFUL, TOTAL_FUNNY, TOTAL_COOL)
WIDE_TIP = (TIP_COUNT, DISTINCT_USERS_TIP, COMPLIMENT_COUNT_SUM)


def _lined_up(reviews: DataFrame, tips: DataFrame) -> DataFrame:
    """Dated events in common columns; a missing compliment count is 0."""
    key = ["business_id", "month", "day"]
    none = {"review_id": F.lit(None).cast("string"), **{c: F.lit(None).cast("int") for c in ("stars", "useful", "funny", "cool")}}
    compliments = F.coalesce("compliment_count", F.lit(0)).alias("compliments")
    return reviews.select(*key, F.lit(True).alias("_review"), "user_id", *none, F.lit(None).cast("int").alias("compliments")).unionByName(
        tips.select(*key, F.lit(False).alias("_review"), "user_id", *[c.alias(name) for name, c in none.items()], compliments)
    )


def _wide_rows(events: DataFrame, slots: _Slots) -> DataFrame:
    """One row per business, slot and kind of event, with the units of WIDE_REVIEW or WIDE_TIP."""
    place = ["business_id", "month", "_review"]

    def before(by: Column) -> Column:
        """The last day before in the month, or the same, on which an id was met; null for the first event with it."""
        return F.lag("day").over(Window.partitionBy(*place, by).orderBy("day"))

    # Tips have no review; they are spread over their users there too.
    seen = events.withColumn("_user_id", before(F.col("user_id"))).withColumn("_review_id", before(F.coalesce("review_id", "user_id")))

    def firsts(of: str, monthly: bool) -> Column:
        before = F.col(f"_{of}")
        return F.count_if(F.col(of).isNotNull() & (before.isNull() if monthly else before.isNull() | (before < F.col("day"))))

    sums = ("stars", "useful", "funny", "cool", "compliments")
    by_day = seen.groupBy(*place, "day").agg(
        F.count(F.lit(1)).alias("events"),
        F.count("stars").alias("rated"),
        *[firsts(of, monthly).alias(f"{of}_{monthly}") for of in ("review_id", "user_id") for monthly in (False, True)],
        *[F.sum(c).alias(c) for c in sums],
    )
    slotted = by_day.withColumn("s", F.explode(slots.of_day(F.col("day")))).drop("day").select("*", "s.*").drop("s")
    total = {c: F.sum(c).cast("double") for c in ("events", *sums)}

    def ids(of: str) -> Column:
        return F.sum(F.when(F.col("granularity") == DAILY, F.col(f"{of}_False")).otherwise(F.col(f"{of}_True"))).cast("double")

    stars = total["stars"] / F.nullif(F.sum("rated"), F.lit(0))
    units = [
        F.when(F.col("_review"), ids("review_id")).otherwise(total["events"]),
        ids("user_id"),
        F.when(F.col("_review"), stars).otherwise(total["compliments"]),
        *[total[c] for c in ("useful", "funny", "cool")],
    ]
    return slotted.groupBy(*place, "day", "granularity").agg(*[u.alias(f"u{i}") for i, u in enumerate(units)]).drop("month")


def _narrow_rows(wide: DataFrame) -> DataFrame:
    def unfolded(codes: Sequence[int]) -> Column:
        return F.array(*[F.struct(F.lit(code).alias("measure"), F.col(f"u{i}").alias("units")) for i, code in enumerate(codes)])

    both = F.when(F.col("_review"), unfolded(WIDE_REVIEW)).otherwise(unfolded(WIDE_TIP))
    kept = ["business_id", "day", "granularity", "period_month"]
    return wide.select(*kept, F.explode(both).alias("m")).select(*kept, "m.*")


class _Slots:
    """Which (day, granularity) rows a dated row belongs to, as column expressions."""

    def __init__(self, first: dt.date, last: dt.date, months: list[dt.date], daily: bool):
        self.first, self.last, self.months, self.daily = first, last, months, daily

    def of_day(self, day: Column) -> Column:
        """Array of slots for one day, its own and its month's."""
        return F.array_compact(F.array(self._daily_slot(day), self._monthly_slot(F.last_day(day))))

    def _daily_slot(self, day: Column) -> Column:
        return F.when(self._wants_day(day), F.struct(day.alias("day"), F.lit(DAILY).alias("granularity")))

    def _monthly_slot(self, month: Column) -> Column:
        return F.when(self._wants_month(month), F.struct(month.alias("day"), F.lit(MONTHLY).alias("granularity")))

    def _wants_day(self, day: Column) -> Column:
        return day.between(F.lit(self.first), F.lit(self.last)) if self.daily else F.lit(False)

    def _wants_month(self, month: Column) -> Column:
        return month.isin(self.months) if self.months else F.lit(False)
