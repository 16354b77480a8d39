import datetime as dt

import pytest
from conftest import SF, plan_of, rows

from bizpulse.operators import facts
from checks.catalog import silver_table

REVIEW = "review_id string, user_id string, business_id string, stars int, useful int, funny int, cool int, date date"
TIP = "user_id string, business_id string, date timestamp, compliment_count int"
D = dt.date


def review(i, b, day, user="u", stars=4, useful=1):
    return (f"r{i}", user, b, stars, useful, 0, 2, day)


@pytest.fixture
def small(spark):
    reviews = [
        review(1, "b1", D(2024, 1, 1), "u1", 5), review(2, "b1", D(2024, 1, 31), "u1", 4), review(2, "b1", D(2024, 1, 31), "u2", 2),
        review(3, "b2", D(2024, 1, 15), useful=None), review(4, "b1", D(2024, 2, 29)), review(5, "b1", D(2023, 12, 31)),
        review(6, "b4", D(2024, 1, 2), stars=None), ("r7", "u9", "b1", 3, 1, 1, 1, None),
    ]
    tips = [
        ("u1", "b1", dt.datetime(2024, 1, 1, 0, 0), 1), ("u1", "b1", dt.datetime(2024, 1, 31, 23, 59), None),
        ("u2", "b3", dt.datetime(2024, 1, 31, 12, 0), 3), ("u2", "b3", dt.datetime(2024, 2, 1, 0, 0), 5), ("u2", "b3", None, 5),
    ]
    return spark.createDataFrame(reviews, REVIEW), spark.createDataFrame(tips, TIP)


def test_one_month(small):
    got = {(r.business_id, r.measure): r.units for r in facts.fact_for_period(*small, "2024-01-31", 2).collect()}
    assert {m: got[("b1", m)] for m in range(1, 10)} == {
        1: 2.0, 2: 2.0, 3: 1.0, 4: pytest.approx(11 / 3), 5: 3.0, 6: 0.0, 7: 6.0, 8: 2.0, 9: 1.0,
    }
    assert sorted(m for b, m in got if b == "b2") == [1, 4, 5, 6, 7, 8]  # reviews only
    assert sorted(m for b, m in got if b == "b3") == [2, 3, 9]  # tips only
    assert got[("b2", 5)] is None and got[("b4", 4)] is None  # null units kept


def test_one_day_and_stamps(small):
    got = facts.fact_for_period(*small, "2024-01-31", 0)
    assert {(str(r.day), r.period_month, r.granularity) for r in got.collect()} == {("2024-01-31", "2024-01", 0)}
    assert {(r.business_id, r.measure): r.units for r in got.collect()}[("b3", 2)] == 1.0
    mid_month = facts.fact_for_period(*small, "2024-01-10", 2)
    assert {str(r.day) for r in mid_month.collect()} == {"2024-01-31"}
    with pytest.raises(ValueError, match="granularity"):
        facts.fact_for_period(*small, "2024-01-31", 1)


@pytest.mark.parametrize(
    ("start", "end", "daily", "months"),
    [
        ("2023-12-31", "2024-01-02", True, ["2023-12-31"]),
        ("2024-01-30", "2024-02-01", True, ["2024-01-31"]),
        ("2024-01-14", "2024-01-15", True, []),
        ("2024-01-15", "2024-02-29", False, ["2024-01-31", "2024-02-29"]),
    ],
)
def test_range_equals_single_runs(spark, small, start, end, daily, months):
    whole = facts.fact_for_range(*small, start, end, daily=daily)
    first, last = D.fromisoformat(start), D.fromisoformat(end)
    runs = [(m, 2) for m in months]
    if daily:
        runs += [(first + dt.timedelta(i), 0) for i in range((last - first).days + 1)]
    single = [r for day, g in runs for r in rows(facts.fact_for_period(*small, day, g))]
    assert rows(whole) == sorted(single, key=lambda t: tuple((v is not None, str(v)) for v in t))


def test_range_equals_single_runs_on_the_given_tables(spark):
    reviews, tips = silver_table(spark, SF, "review"), silver_table(spark, SF, "tip")
    whole = facts.fact_for_range(reviews, tips, "2024-01-30", "2024-02-01")
    parts = facts.fact_for_period(reviews, tips, "2024-01-31", 2)
    for day in ("2024-01-30", "2024-01-31", "2024-02-01"):
        parts = parts.unionByName(facts.fact_for_period(reviews, tips, day, 0))
    assert rows(whole) == rows(parts)


def test_forced_month_and_nothing_to_do(small):
    forced = facts.fact_for_range(*small, "2024-01-05", "2024-01-05", monthly=False, force_months=["2024-01-05"])
    assert {(str(r.day), r.granularity) for r in forced.collect()} == {("2024-01-31", 2)}
    with pytest.raises(ValueError, match="nothing to compute"):
        facts.fact_for_range(*small, "2024-01-05", "2024-01-06", daily=False)


def test_hot_business(spark):
    """One business with a third of all rows, the same users again and again."""
    data = [review(i % 500, "hot" if i % 3 == 0 else f"b{i % 40}", D(2024, 1, 1 + i % 31), f"u{i % 70}") for i in range(3000)]
    df = spark.createDataFrame(data, REVIEW)
    tips = spark.createDataFrame([], TIP)
    got = {(r.business_id, r.measure): r.units for r in facts.fact_for_range(df, tips, "2024-01-01", "2024-01-31", daily=False).collect()}
    hot = [r for r in data if r[2] == "hot"]
    assert got[("hot", 1)] == len({r[0] for r in hot}) and got[("hot", 8)] == len({r[1] for r in hot})


@pytest.mark.parametrize("from_events", [1, 20, 10**9])
def test_hot_and_other_businesses_take_the_same_steps(spark, small, monkeypatch, from_events):
    """All, some or no months of businesses are spread; a business without a key is a group too."""
    monkeypatch.setattr(facts, "HOT_EVENTS", from_events)
    data = [review(i % 50, "hot" if i % 3 == 0 else f"b{i % 7}", D(2024, 1, 1 + i % 31), f"u{i % 7}", None if i % 5 == 0 else i % 4) for i in range(90)]
    reviews = small[0].unionByName(spark.createDataFrame(data + [review(1, None, D(2024, 1, 31))], REVIEW))
    whole = facts.fact_for_range(reviews, small[1], "2024-01-30", "2024-01-31")
    runs = [facts.fact_for_period(reviews, small[1], day, g) for day, g in (("2024-01-31", 2), ("2024-01-30", 0), ("2024-01-31", 0))]
    assert rows(whole) == rows(runs[0].unionByName(runs[1]).unionByName(runs[2]))


def test_other_businesses_are_moved_once(spark, small):
    """Counts of ids follow where the events were dealt to, so the only other moves are those of the list of hot businesses and of
    what is hot."""
    plan = plan_of(facts.fact_for_range(*small, "2024-01-01", "2024-01-31")).split("== Physical Plan ==")[1]
    dealt = plan.split("REPARTITION_BY_NUM")[0]
    assert "Generate" in dealt and "Exchange hashpartitioning" not in dealt.rsplit("Exchange hashpartitioning", 1)[0]


def test_events_are_dealt_out_once_and_rows_are_gathered_wide(small):
    """Reviews and tips move together, with all their columns; the rows move on before measures unfold."""
    plain, gathered = (facts.fact_for_range(*small, "2024-01-01", "2024-01-31", balance=b) for b in (False, True))
    plan = plan_of(gathered).split("== Physical Plan ==")[1]
    assert plan.count("REPARTITION_BY_NUM") == 1 and plan.count("REBALANCE_PARTITIONS_BY_COL") == 1
    assert "Generate" in plan.split("REBALANCE_PARTITIONS_BY_COL")[0]
    assert rows(plain) == rows(gathered) and len(rows(plain)) > 0


def test_extra_measures(small):
    got = {r.business_id: r for r in facts.extra_measures(*small).collect()}
    assert got["b1"].stars_sum == 22.0
    assert got["b1"].positive_pct == pytest.approx(100 * 4 / 6) and got["b1"].negative_pct == pytest.approx(100 / 6)
    assert got["b4"].positive_pct is None and got["b3"].avg_tip_compliments == pytest.approx(13 / 3)


def test_events_do_not_unfold_by_their_ids(small):
    """Each part unfolds rows of a day by their slots, and measures unfold at the end: rows are sorted before that."""
    plan = plan_of(facts.fact_for_range(*small, "2024-01-01", "2024-01-31", balance=True)).split("== Physical Plan ==")[1]
    assert plan.count("Generate explode") == 3
    assert "Generate explode" in plan.split("Sort [day")[0] and plan.index("Sort [day") < plan.index("REBALANCE_PARTITIONS_BY_COL")


@pytest.mark.parametrize("from_events", [1, 10**9])
def test_ids_that_come_again(spark, monkeypatch, from_events):
    """The same review and user on one day, on other days and in other months, with and without stars."""
    monkeypatch.setattr(facts, "HOT_EVENTS", from_events)
    days = [D(2024, 1, 30), D(2024, 1, 30), D(2024, 1, 31), D(2024, 2, 1), D(2024, 2, 1)]
    reviews = spark.createDataFrame([review(i % 2, "b", d, f"u{j % 2}", None if i else 3) for i in range(4) for j, d in enumerate(days)], REVIEW)
    tips = spark.createDataFrame([(f"u{i % 2}", "b", dt.datetime(d.year, d.month, d.day, i), None if i else 2) for i in range(3) for d in days], TIP)
    whole = facts.fact_for_range(reviews, tips, "2024-01-30", "2024-02-29")
    runs = [(D(2024, 1, 31), 2), (D(2024, 2, 29), 2), *[(D(2024, 1, 30) + dt.timedelta(i), 0) for i in range(31)]]
    single = [r for day, g in runs for r in rows(facts.fact_for_period(reviews, tips, day, g))]
    assert rows(whole) == sorted(single, key=lambda t: tuple((v is not None, str(v)) for v in t))
