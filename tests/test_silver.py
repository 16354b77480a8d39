import datetime as dt

import pytest
from conftest import rows

from bizpulse.operators import silver
from bizpulse.schemas import RAW_DDL, raw_schema


def business_rows(spark, **changes):
    base = dict(business_id="b", name=" n ", city="c", state=" pa ", latitude=1.0, longitude=1.0, stars=3.0,
                review_count=2, is_open=1, categories=" x, y ")
    key, values = next(iter(changes.items()))
    data = [tuple({**base, "business_id": f"b{i}", key: v}.values()) for i, v in enumerate(values)]
    out = silver.clean_business(spark.createDataFrame(data, RAW_DDL["business"].replace(" NOT NULL", "")))
    return [r[key] for r in out.orderBy("business_id").collect()]


@pytest.mark.parametrize(
    ("column", "given", "expected"),
    [
        ("stars", [0.5, 1.0, 4.5, 5.0, 5.5, None, float("nan")], [None, 1, 4, 5, None, None, None]),
        ("latitude", [90.0, -90.0, 90.1, -90.1], [90.0, -90.0, None, None]),
        ("longitude", [180.0, -180.0, 180.1, -180.1], [180.0, -180.0, None, None]),
        ("review_count", [-1, 0, 3, None], [0, 0, 3, None]),
        ("is_open", [0, 1, None], [False, True, None]),
        ("city", ["  san FRANCISCO ", "PARIS"], ["San Francisco", "Paris"]),
        ("state", [" pa "], ["PA"]),
        ("categories", [" x, y "], ["x, y"]),
    ],
)
def test_business_rules(spark, column, given, expected):
    assert business_rows(spark, **{column: given}) == expected


def test_business_key_must_be_filled(spark):
    data = [(k, *[None] * 9) for k in ("b", "", None, " ")]
    raw = spark.createDataFrame(data, RAW_DDL["business"].replace(" NOT NULL", ""))
    assert rows(silver.clean_business(raw).select("business_id")) == [(" ",), ("b",)]


def test_user_rules(spark):
    friends = [None, "None", "", "a", "a, b,"]
    since = ["2015-03-01", "2015-03-01 10:00:00", " 2015-03-01", "junk", None]
    data = [(f"u{i}", " n", since[i], -1, -1, [0.9, 1.0, 5.0, 5.1, None][i], -1, 2, None, friends[i]) for i in range(5)]
    out = silver.clean_user(spark.createDataFrame(data, RAW_DDL["user"].replace(" NOT NULL", ""))).orderBy("user_id")
    got = out.collect()
    day = dt.date(2015, 3, 1)
    assert [r.friend_count for r in got] == [0, 0, 0, 1, 3]
    assert [r.yelping_since for r in got] == [day, day, None, None, None]
    assert [r.average_stars for r in got] == [None, 1.0, 5.0, None, None]
    assert {(r.review_count, r.fans, r.useful, r.funny, r.cool) for r in got} == {(0, 0, 0, 2, None)}
    assert "friends" not in out.columns


def test_review_rules(spark):
    day = dt.date(2020, 1, 31)
    cases = [
        ("r0", "u", "b", "2020-01-31 12:00:00", day), ("r1", "u", "b", "2020-01-31", day), ("r2", "u", "b", "junk", None),
        ("r3", "u", "b", "2020-02-30", None), ("r4", "u", "b", "2020-1-5", dt.date(2020, 1, 5)),
        ("r5", "u", "b", "2020-01-31 99:99:99", day), ("r6", "u", "b", None, None),
    ]
    dropped = [("", "u", "b", "2020-01-31", None), ("x", None, "b", "2020-01-31", None), ("y", "u", "", "2020-01-31", None)]
    data = [(r, u, b, 4.0, -1, None, 2, d, " t ") for r, u, b, d, _ in cases + dropped]
    raw = spark.createDataFrame(data, RAW_DDL["review"].replace(" NOT NULL", ""))
    got = silver.clean_review(raw).orderBy("review_id").collect()
    assert [(r.review_id, r.date) for r in got] == [(c[0], c[4]) for c in cases]
    assert {(r.stars, r.useful, r.funny, r.cool, r.text) for r in got} == {(4, 0, None, 2, "t")}


def test_checkin_is_unnested(spark):
    data = [("b1", "2020-01-31 12:00:00, 2020-02-01"), ("b2", ""), ("b3", None), ("b4", "bad"), ("", "2020-01-31"),
            ("b5", "2020-01-31 01:02:03,,  2020-02-30, 2020-02-01x")]
    out = silver.clean_checkin(spark.createDataFrame(data, "business_id string, date string"))
    assert rows(out) == [
        ("b1", dt.datetime(2020, 1, 31, 12)),
        ("b1", dt.datetime(2020, 2, 1)),
        ("b5", dt.datetime(2020, 1, 31, 1, 2, 3)),
    ]


def test_tip_rules(spark):
    data = [("u", "b", " t ", "2020-01-31 12:00:00", -2), ("u", "b", "t", "2020-01-31", None), (None, "b", "t", None, 1),
            ("u", "", "t", None, 1)]
    out = silver.clean_tip(spark.createDataFrame(data, RAW_DDL["tip"]))
    assert rows(out) == [("u", "b", "t", None, None), ("u", "b", "t", dt.datetime(2020, 1, 31, 12), 0)]


def test_event_slice_and_full_load(spark):
    texts = ["2020-01-30", "2020-01-31", "2020-01-31 23:59:59", "2020-01-31x", "2020-02-01", "2020-01-3", "n/a", None]
    data = [("u", f"b{i}", "t", d, 1) for i, d in enumerate(texts)]
    raw = spark.createDataFrame(data, RAW_DDL["tip"])
    kept = silver.silver_snapshot("tip", raw, ["2020-01-31"])
    assert [r.business_id for r in kept.orderBy("business_id").collect()] == ["b1", "b2", "b3"]
    assert {r.day for r in kept.collect()} == {dt.date(2020, 1, 31)}
    whole = silver.silver_snapshot("tip", raw, ["2020-01-31"], full_load=True)
    assert whole.count() == len(texts)
    assert [r.day and r.day.isoformat() for r in whole.orderBy("business_id").collect()] == [
        "2020-01-30", "2020-01-31", "2020-01-31", "2020-01-31", "2020-02-01", "2020-01-03", None, None,
    ]


def test_slices_of_a_range_equal_daily_slices(spark):
    data = [("u", f"b{i}", "t", f"2020-01-{i:02d} 10:00:00", 1) for i in range(1, 32)]
    raw = spark.createDataFrame(data, RAW_DDL["tip"])
    days = ["2020-01-05", "2020-01-06", "2020-01-09"]
    together = rows(silver.silver_snapshot("tip", raw, days))
    one_by_one = [r for d in days for r in rows(silver.silver_snapshot("tip", raw, [d]))]
    assert together == sorted(one_by_one, key=str)


def test_snapshot_tables_are_stamped_per_run_day(spark):
    raw = spark.createDataFrame([("b", "2020-01-01")], "business_id string, date string")
    out = silver.silver_snapshot("checkin", raw, ["2020-01-31", "2020-02-29"])
    assert [r.day.isoformat() for r in out.orderBy("day").collect()] == ["2020-01-31", "2020-02-29"]


def test_table_without_rule_passes_through(spark):
    df = spark.range(3)
    assert silver.clean("other", df) is df


def test_latest_per_key_takes_the_newest_row_whole(spark):
    data = [("b1", "old", None, 1), ("b1", None, "x", 2), ("b2", "only", "y", 1)]
    df = spark.createDataFrame(data, "business_id string, name string, city string, _ingest_ts int")
    assert rows(silver.latest_per_key(df, ["business_id"])) == [("b1", None, "x", 2), ("b2", "only", "y", 1)]


def test_schema_registry():
    assert raw_schema(" Review ").fieldNames()[0] == "review_id"
    with pytest.raises(ValueError, match="unknown raw table"):
        raw_schema("nope")
