import random

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from bizpulse.operators.ranking import rank_within

DDL = "id int, city string, score double"


def brute_force(data):
    out = []
    for i, city, score in data:
        ahead = sum(1 for _, c, s in data if c == city and s is not None and (score is None or s > score))
        out.append((i, city, score, ahead + 1))
    return out


def skewed(n=600, seed=3):
    """A third of all rows in one city, many ties, null cities and null scores."""
    rng = random.Random(seed)
    data = []
    for i in range(n):
        city = "hot" if i % 3 == 0 else rng.choice([None, "a", "b", "c", "d"])
        score = rng.choice([0.0, 0.0, None, round(rng.random(), 2), rng.random(), 0.123 + rng.random() / 1e6])
        data.append((i, city, score))
    return data


@pytest.mark.parametrize("slices", [1, 3, 7, 64])
def test_matches_brute_force(spark, slices):
    """Without coalescing there are as many slices as shuffle partitions."""
    data = skewed()
    names = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled"]
    before = [spark.conf.get(n) for n in names]
    try:
        for name, value in zip(names, [str(slices), "false"]):
            spark.conf.set(name, value)
        got = rank_within(spark.createDataFrame(data, DDL), ["city"], "score")
    finally:
        for name, value in zip(names, before):
            spark.conf.set(name, value)
    assert rows(got) == sorted(brute_force(data), key=lambda t: tuple((v is not None, str(v)) for v in t))


def test_ties_share_a_rank_and_leave_a_gap(spark):
    data = [(1, "x", 0.9), (2, "x", 0.9), (3, "x", 0.1), (4, None, 0.5)]
    assert [r[3] for r in rows(rank_within(spark.createDataFrame(data, DDL), ["city"], "score"))] == [1, 1, 3, 1]


def test_all_rows_tied_or_null(spark):
    for score in (0.0, None):
        data = [(i, "x", score) for i in range(50)]
        assert {r[3] for r in rows(rank_within(spark.createDataFrame(data, DDL), ["city"], "score"))} == {1}


def test_empty(spark):
    assert rank_within(spark.createDataFrame([], DDL), ["city"], "score").collect() == []


def test_no_frame_sorts_a_city_in_one_window(spark):
    plan = plan_of(rank_within(spark.createDataFrame(skewed(50), DDL), ["city"], "score"))
    assert "rank(" not in plan and "_slice" in plan


def test_a_hot_tie_is_split_at_run_time(spark, folder):
    """A third of all rows share one city and one score; thresholds are lowered to the size of the test."""
    lowered = {
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    }
    before = {k: spark.conf.get(k, None) for k in lowered}
    hot = F.col("id") % 3 == 0
    path = f"{folder}/rows"
    spark.range(0, 150_000, 1, 8).select(
        F.col("id").cast("int").alias("id"),
        F.when(hot, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 500)).alias("city"),
        F.when(hot, 0.0).otherwise(F.rand(1)).alias("score"),
    ).write.parquet(path)
    try:
        for k, v in lowered.items():
            spark.conf.set(k, v)
        ranked = rank_within(spark.read.parquet(path), ["city"], "score")
        assert len(ranked.collect()) == 150_000
        assert "SortMergeJoin(skew=true)" in plan_of(ranked)
        assert rows(ranked.filter("city = 'hot'").select("rank").distinct()) == [(1,)]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
