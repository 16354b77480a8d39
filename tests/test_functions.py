import datetime as dt
import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from bizpulse.functions import dates
from bizpulse.functions.scoring import min_max_normalize, popularity_score, recency_boost


def test_day_range_covers_whole_days(spark):
    stamps = ["2020-01-01 00:00:00", "2020-01-01 12:00:00", "2020-01-31 00:00:00", "2020-01-31 12:00:00", "2020-02-01 00:00:00"]
    df = spark.createDataFrame([(s,) for s in stamps], "s string").withColumn("ts", F.col("s").cast("timestamp"))
    kept = df.filter(dates.in_days("ts", "2020-01-01", "2020-01-31"))
    assert [r.s for r in kept.orderBy("s").collect()] == stamps[:4]


def test_months_join_into_one_range_when_adjacent(spark):
    assert "or(" not in str(dates.in_months("date", ["2024-01-31", "2023-12-31"])).lower()
    assert "or(" in str(dates.in_months("date", ["2024-01-31", "2023-11-30"])).lower()
    with pytest.raises(ValueError, match="at least one month"):
        dates.in_months("date", [])


def test_month_helpers():
    assert dates.month_end("2024-02-10") == dt.date(2024, 2, 29)
    assert dates.is_month_end("2023-02-28") and not dates.is_month_end("2024-02-28")
    assert dates.month_ends_between("2023-12-15", "2024-01-31") == [dt.date(2023, 12, 31), dt.date(2024, 1, 31)]
    assert dates.month_ends_between("2024-01-01", "2024-01-30") == []


def test_calendar(spark):
    bounds = spark.createDataFrame([("2024-02-28", "2024-03-01")], "start string, end string")
    got = [(str(r.day), r.period_month, str(r.month_start), str(r.month_end), r.is_month_end) for r in
           dates.calendar(bounds).orderBy("day").collect()]
    assert got == [
        ("2024-02-28", "2024-02", "2024-02-01", "2024-02-29", False),
        ("2024-02-29", "2024-02", "2024-02-01", "2024-02-29", True),
        ("2024-03-01", "2024-03", "2024-03-01", "2024-03-31", False),
    ]


@pytest.mark.parametrize("by", [(), ("g",)])
def test_normalize_edge_columns(spark, by):
    df = spark.createDataFrame([(1, 5, None, 10), (1, 5, None, 20), (1, 5, None, None)], "g int, same int, none int, x int")
    out = min_max_normalize(df, {"same": "n_same", "none": "n_none", "x": "n_x"}, by=by)
    got = rows(out.select("n_same", "n_none", "n_x"))
    assert got == [(0.0, 0.0, None), (0.0, 0.0, 0.0), (0.0, 0.0, 1.0)]


def test_normalize_each_group_on_its_own(spark):
    df = spark.createDataFrame([("a", 0), ("a", 10), ("b", 100), ("b", 300)], "g string, x int")
    out = min_max_normalize(df, {"x": "n"}, by=["g"])
    assert rows(out) == [("a", 0, 0.0), ("a", 10, 1.0), ("b", 100, 0.0), ("b", 300, 1.0)]


def test_recency(spark):
    df = spark.createDataFrame([(None,), ("2020-01-31",), ("2020-01-01",)], "d string").select(F.col("d").cast("date").alias("d"))
    got = [r.b for r in df.select("d", recency_boost(F.col("d"), F.lit("2020-01-31").cast("date")).alias("b")).orderBy("d").collect()]
    assert got == pytest.approx([math.exp(-3650 / 30), math.exp(-1), 1.0])


def test_score_weights(spark):
    one = F.lit(1.0)
    full = spark.range(1).select(popularity_score(one, one, one, one, one).alias("s")).first().s
    stars = spark.range(1).select(popularity_score(one, *[F.lit(0.0)] * 4).alias("s")).first().s
    assert full == pytest.approx(1.0) and stars == 0.5
