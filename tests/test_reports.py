import datetime as dt

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from bizpulse.operators import quality, serving

DEC, JAN = dt.date(2023, 12, 31), dt.date(2024, 1, 31)


@pytest.fixture
def fact(spark):
    data = [
        (JAN, "2024-01", 2, "b1", 1, 10.0), (JAN, "2024-01", 2, "b1", 4, 4.0), (JAN, "2024-01", 2, "b1", 2, 3.0),
        (DEC, "2023-12", 2, "b1", 1, 6.0), (JAN, "2024-01", 2, "b2", 1, 1.0), (JAN, "2024-01", 0, "b1", 1, 2.0),
        (dt.date(2024, 1, 30), "2024-01", 0, "b2", 1, 5.0), (JAN, "2024-01", 0, "b3", 7, 1.0),
    ]
    return spark.createDataFrame(data, "day date, period_month string, granularity int, business_id string, measure int, units double")


@pytest.fixture
def scores(spark):
    data = [
        (JAN, "2024-01", 2, "b1", "One", "X", "PA", "c", 0.9, 1), (JAN, "2024-01", 2, "b2", "Two", "X", "PA", "c", 0.3, 2),
        (JAN, "2024-01", 2, "b3", "Three", "Y", "PA", "c", 0.5, 1), (DEC, "2023-12", 2, "b1", "One", "X", "PA", "c", 0.1, 1),
    ]
    return spark.createDataFrame(
        data,
        "day date, period_month string, granularity int, business_id string, name string, city string, state string,"
        "categories string, popularity_score double, city_rank int",
    )


def test_ties_may_exceed_the_top(spark, scores):
    tied = scores.withColumn("city_rank", F.lit(1))
    assert serving.top_businesses_by_city(tied, top=1).count() == 3
    assert {r.period_month for r in serving.top_businesses_by_city(scores).collect()} == {"2024-01"}


def test_latest_day_keeps_businesses_without_listed_measures(fact):
    got = {r.business_id: r for r in serving.latest_review_metrics(fact).collect()}
    assert set(got) == {"b1", "b3"}
    assert got["b1"].review_count == 2.0 and got["b3"].review_count is None


def test_summary_keeps_businesses_without_score(fact, scores):
    got = {(r.business_id, r.period_month): r for r in serving.monthly_business_summary(fact, scores.filter("business_id <> 'b2'")).collect()}
    assert got[("b1", "2024-01")].avg_stars == 4.0 and got[("b1", "2024-01")].city_rank == 1
    assert got[("b2", "2024-01")].total_reviews == 1.0 and got[("b2", "2024-01")].name is None


def test_growth_and_trend(fact):
    assert rows(serving.review_growth(fact, "b1")) == [("b1", "2023-12", 6.0, None), ("b1", "2024-01", 10.0, 6.0)]
    assert len(rows(serving.review_growth(fact))) == 3
    assert rows(serving.monthly_trend(fact, "b1"))[1][:5] == ("b1", "2024-01", 10.0, 4.0, 3.0)


def test_dashboard_counts_a_score_once_per_measure(fact, scores):
    got = {r.city: r for r in serving.city_dashboard(fact, scores).collect()}
    assert set(got) == {"X"}  # b3 has no monthly fact
    assert got["X"].businesses == 2 and got["X"].avg_rating == 4.0
    assert got["X"].avg_popularity == pytest.approx((3 * 0.9 + 0.3) / 4)
    exact = {r.city: r for r in serving.city_dashboard(fact, scores, digits=9).collect()}
    assert exact["X"].avg_popularity == 0.75


def test_small_reports(scores, fact):
    assert [r.business_id for r in serving.top_in_city(scores, "X", "2024-01").collect()] == ["b1", "b2"]
    assert serving.top_per_city(scores, "2024-01", top=1).count() == 2
    assert [r.review_count for r in serving.city_comparison(fact, scores, "X", "2024-01").collect()] == [10.0, 1.0]
    assert rows(serving.city_time_series(scores, "X")) == [("X", "2023-12", 1, 0.1), ("X", "2024-01", 2, 0.6)]
    assert [(r.city, r.business_count) for r in serving.top_cities(scores).collect()] == [("Y", 1), ("X", 2)]
    assert rows(serving.city_period_average(scores, "2024-01")) == [("X", 0.6, 2), ("Y", 0.5, 1)]
    assert serving.coverage_stats(scores).first()[:] == (2, DEC, JAN)
    stamped = scores.withColumn("_gold_ingest_ts", F.lit(None).cast("timestamp"))
    assert "last_update" in serving.coverage_stats(stamped).columns


def test_pivot_takes_one_shuffle(fact):
    plan = plan_of(serving.monthly_trend(fact, "b1").select("*")).split("== Physical Plan ==")[1]
    assert plan.count("Exchange hashpartitioning") == 1


def test_violations_are_counted_each(spark, scores, fact):
    bad = scores.unionByName(
        spark.createDataFrame(
            [(JAN, "2024-01", 1, "b8", "n", "X", "PA", "c", 0.5, 1), (JAN, "2024-01", 2, "b9", "n", "X", "PA", "c", 1.2, 0),
             (JAN, "2024-01", 2, "b1", "n", "X", "PA", "c", None, None)],
            scores.schema,
        )
    )
    keys = ["business_id", "day", "granularity"]
    got = {r.rule: r.violations for r in quality.constraint_violations("p", bad, quality.popularity_rules(), keys).collect()}
    assert got == {"granularity": 1, "popularity_score": 1, "city_rank": 1, "unique_key": 1}
    assert rows(quality.duplicate_keys(bad, keys)) == [("b1", JAN, 2, 2)]
    good, quarantined = quality.split_valid(bad, quality.popularity_rules())
    assert good.count() == 5  # a null breaks no range rule
    assert {r.business_id: r.broken_rules for r in quarantined.collect()} == {
        "b8": ["granularity"], "b9": ["popularity_score", "city_rank"],
    }
    wrong = fact.withColumn("measure", F.lit(10))
    assert {r.rule: r.violations for r in quality.constraint_violations("f", wrong, quality.fact_rules()).collect()} == {
        "granularity": 0, "measure": 8,
    }


def test_empty_table_has_no_violations(scores):
    none = scores.filter(F.lit(False))
    got = quality.constraint_violations("p", none, quality.popularity_rules(), ["business_id"])
    assert {r.violations for r in got.collect()} == {0}


def test_missing_fields_and_counts(scores, fact):
    got = quality.missing_fields({"p": (scores, ["business_id", "name"]), "f": (fact, ["units"])})
    assert rows(got) == [("f", 0, "units"), ("p", 0, "business_id"), ("p", 0, "name")]
    assert rows(quality.table_row_counts({"p": scores, "f": fact})) == [("f", 8), ("p", 4)]


def test_views_for_sql_users(spark, fact, scores):
    serving.create_views(fact, scores)
    assert spark.sql("SELECT * FROM v_dq_duplicate_business_popularity").count() == 0
    assert spark.sql("SELECT sum(null_count) AS n FROM v_dq_missing_fields").first().n == 0
    latest = spark.sql("SELECT business_id FROM v_top_businesses_by_city WHERE city = 'X' ORDER BY city_rank")
    assert [r.business_id for r in latest.collect()] == ["b1", "b2"]
    joined = spark.sql("SELECT name, total_reviews FROM v_monthly_business_summary WHERE city_rank = 1 AND period_month = '2024-01'")
    assert rows(joined) == [("One", 10.0)]
