import datetime as dt
import math

import pytest
from conftest import SF, plan_of, rows
from pyspark.sql import functions as F

from bizpulse.operators import popularity as pop
from checks.catalog import MONTH_END, MONTHS, popularity_sources, silver_table

D, T = dt.date, dt.datetime
END = D(2024, 1, 31)


@pytest.fixture
def small(spark):
    business = spark.createDataFrame(
        [
            ("b1", END, "One", "X", "PA", "c", True, 1), ("b1", END, "One new", "X", "PA", "c", True, 2),
            ("b2", END, "Two", "X", "NY", "c", True, 1), ("b3", END, "Three", None, "PA", "c", True, 1),
            ("b4", END, "Closed", "X", "PA", "c", False, 1), ("b5", D(2024, 1, 30), "Other day", "X", "PA", "c", True, 1),
        ],
        "business_id string, day date, name string, city string, state string, categories string, is_open boolean, _ingest_ts int",
    )
    reviews = spark.createDataFrame(
        [("b1", D(2024, 1, 1), 5), ("b1", END, 3), ("b2", D(2024, 1, 1), None), ("b2", D(2024, 2, 1), 5), ("b4", END, 5)],
        "business_id string, date date, stars int",
    )
    tips = spark.createDataFrame(
        [("b1", T(2024, 1, 31, 23, 0), 4), ("b2", T(2024, 2, 1), 9), ("b3", T(2024, 1, 1), None)],
        "business_id string, date timestamp, compliment_count int",
    )
    checkins = spark.createDataFrame(
        [("b2", END, T(2024, 1, 31, 12, 0)), ("b2", D(2024, 1, 30), T(2024, 1, 31, 12, 0)), ("b2", END, T(2024, 2, 1))],
        "business_id string, day date, checkin_date timestamp",
    )
    return business, reviews, tips, checkins


def test_inputs(small):
    got = {r.business_id: r for r in pop.popularity_inputs(*small, ["2024-01-31"]).collect()}
    assert set(got) == {"b1", "b2", "b3"}  # open, in the month-end snapshot, one row each
    assert got["b1"].name == "One new"
    one, two, three = got["b1"], got["b2"], got["b3"]
    assert (one.review_count, one.avg_review_stars, one.last_review_date, one.tip_compliment_count) == (2, 4.0, END, 4)
    # Only the check-in copy of the month end counts, and only days of the month.
    assert (two.review_count, two.avg_review_stars, two.checkin_count, two.tip_compliment_count) == (1, 0.0, 1, 0)
    assert (three.review_count, three.last_review_date, three.checkin_count) == (0, None, 0)


def test_scores_and_ranks(small):
    got = {r.business_id: r for r in pop.business_popularity(*small, ["2024-01-31"]).collect()}
    assert got["b1"].popularity_score == pytest.approx(0.5 + 0.25 + 0.15 + 0.05)
    assert got["b2"].popularity_score == pytest.approx(0.25 * 0.5 + 0.15 * math.exp(-1) + 0.05)
    assert (got["b1"].city_rank, got["b2"].city_rank, got["b3"].city_rank) == (1, 2, 1)
    assert {(r.period_month, r.granularity, r.day) for r in got.values()} == {("2024-01", 2, END)}


def test_rank_partition_is_a_parameter(small):
    got = {r.business_id: r.city_rank for r in pop.business_popularity(*small, [END], rank_by=["city", "state"]).collect()}
    assert got == {"b1": 1, "b2": 1, "b3": 1}


@pytest.mark.parametrize("days", [[], ["2024-01-30"], ["2024-01-31", "2024-02-01"]])
def test_only_month_ends(small, days):
    with pytest.raises(ValueError, match="month-end"):
        pop.popularity_inputs(*small, days)


def test_no_open_business(small):
    business, *events = small
    none = business.filter(F.lit(False))
    assert pop.business_popularity(none, *events, [END]).collect() == []


def test_joint_activity_equals_the_three_statistics(spark):
    reviews, tips, checkins = (silver_table(spark, SF, t) for t in ("review", "tip", "checkin"))
    joint = pop.business_activity(reviews, tips, checkins)
    apart = (
        pop.review_stats(reviews)
        .join(pop.checkin_counts(checkins), "business_id", "full")
        .join(pop.compliment_sums(tips), "business_id", "full")
        .na.fill(0, ["review_count", "checkin_count"])
        .select(joint.columns)
    )
    assert rows(joint) == rows(apart)


def test_months_together_equal_months_alone(spark):
    sources = popularity_sources(spark, SF)
    together = pop.business_popularity(*sources, MONTHS, digits=9)
    alone = [r for m in MONTHS for r in rows(pop.business_popularity(*sources, [m], digits=9))]
    assert rows(together) == sorted(alone, key=lambda t: tuple((v is not None, str(v)) for v in t))


def test_invariants_on_the_given_tables(spark):
    got = pop.business_popularity(*popularity_sources(spark, SF), [MONTH_END]).collect()
    assert got and all(0 <= r.popularity_score <= 1 for r in got)
    assert len({r.business_id for r in got}) == len(got)
    assert {r.city for r in got if r.city_rank == 1} == {r.city for r in got}


def test_events_are_shuffled_once_and_stay_in_the_jvm(small):
    plan = plan_of(pop.popularity_inputs(*small, [END])).split("== Physical Plan ==")[1]
    assert "Python" not in plan and "BatchEval" not in plan
    # one exchange for all three event streams, one for the deduplicated snapshot
    assert plan.count("Exchange hashpartitioning") == 2
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
