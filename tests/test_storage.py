"""How tables are stored: by event day, in versions, in buckets; what footers answer; what jobs report."""

import datetime as dt
import os

import pytest
from conftest import SF, plan_of, rows
from pyspark.sql import functions as F

from bizpulse import session
from bizpulse.functions.cleaning import DAY_SHAPE, SECOND_SHAPE, parse_day, parse_second
from bizpulse.operators import popularity, serving, silver
from bizpulse.operators.ranking import rank_within
from bizpulse.plans import gold, ingest
from bizpulse.schemas import GOLD_PARTITIONS, RAW_TABLES
from bizpulse.sources import bucketed, footers, history, lake, versions
from checks import catalog
from checks.projections import raw


def physical(df) -> str:
    return plan_of(df).split("== Physical Plan ==")[1]


def rows_scanned(df) -> int:
    """Rows that the plan's only scan hands on, before any filter."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().get("numOutputRows").get().value()


@pytest.fixture(scope="module")
def landing(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("landing"))
    for table in RAW_TABLES:
        raw(spark, SF, table).write.json(f"{root}/{table}.json")
    return root


@pytest.fixture
def database(spark, tmp_path):
    name = f"db_{abs(hash(str(tmp_path)))}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/db'")
    return name


# -- bronze in order of the event's day


def test_one_day_reads_the_row_groups_of_that_day(spark, landing, tmp_path):
    # Row groups are as small as the writer makes them, as a day of these tables has few rows.
    small = {"parquet.block.size": "1024", "parquet.page.size": "512", "parquet.block.row.count.limit": "50"}
    ingest.ingest_bronze(spark, str(tmp_path), "files", ["review", "tip"], landing, options=small)
    for table, day in (("review", dt.date(2024, 1, 5)), ("tip", dt.date(2024, 1, 9))):
        bronze = spark.read.parquet(f"{tmp_path}/{table}")
        cut = silver.slice_raw_events(bronze, day).select("text", "_event_day")
        assert "PushedFilters: [IsNotNull(_event_day), GreaterThanOrEqual(_event_day" in physical(cut)
        own = cut.count()
        assert own == raw(spark, SF, table).filter(parse_day(F.col("date")) == F.lit(day)).count() > 0
        assert own <= rows_scanned(cut) <= own + 2 * 50 < bronze.count() / 4
        one = silver.silver_snapshot(table, bronze, [day])
        assert rows(one.drop("_ingest_ts")) == rows(silver.silver_snapshot(table, raw(spark, SF, table), [day]))
    # Rows without a date are kept in bronze and fall to no day.
    assert spark.read.parquet(f"{tmp_path}/review").filter("_event_day IS NULL").count() > 0


def test_bronze_without_the_day_is_read_as_before(spark, landing, tmp_path):
    old = ingest.stamp_ingest(raw(spark, SF, "review"))
    new = silver.by_event_day(old)
    for days, full in ((["2024-01-05"], False), (["2024-01-05", "2024-01-07"], False), (["2024-01-05"], True)):
        a, b = (silver.silver_snapshot("review", df, days, full).drop("_ingest_ts") for df in (old, new))
        assert a.columns == b.columns and rows(a) == rows(b)


DATES = [
    "2024-01-05", "2024-1-5", "2024-10-5", "2024-10-5x", "2024-10-05T10:00", "2024-01-05 01:02:03", "2024-01-05 1:2:3", "2024-1-5 01:02:03", "2024-01-05 01:02:0Z", "2024-01-05 01:02:03Z",
    "2024-01-05 01:02:03.5", "2024-13-05", "2024-02-30", "24-01-05", "n/a", "", " 2024-01-05", "2024-01-0a", "2024-01- 5", "20240-01-05", "2024-1--05", "2024-01-05 25:00:00", "2024-01-05 01:02", "2024-01-05 01:02:+9", None,
]


def test_padded_dates_take_the_short_way_to_the_same_result(spark):
    df = spark.createDataFrame([(d,) for d in DATES], "t string")
    t = F.col("t")
    got = df.select("t", parse_day(t), parse_second(t), F.regexp_extract(t, DAY_SHAPE, 0).try_cast("date"), F.regexp_extract(t, SECOND_SHAPE, 0).try_cast("timestamp"))
    for text, day, second, plain_day, plain_second in got.collect():
        assert (day, second) == (plain_day, plain_second), text
    assert sum(r[1] is not None for r in got.collect()) >= 10


# -- versions


def test_a_load_that_dies_before_the_swap_leaves_the_old_table(spark, database, tmp_path, monkeypatch):
    table, root = f"{database}.t", str(tmp_path / "t")
    old = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    first = versions.publish(old, table, root)
    point = versions._point

    def die(*_):
        raise OSError("lost")

    monkeypatch.setattr(versions, "_point", die)
    change = spark.createDataFrame([(2, "B"), (3, "c")], "id int, v string")
    with pytest.raises(OSError, match="lost"):
        versions.upsert_published(spark, change, table, root, ["id"])
    assert rows(spark.table(table)) == [(1, "a"), (2, "b")] and versions.location(spark, table).endswith(first)
    assert len(os.listdir(root)) == 2
    monkeypatch.setattr(versions, "_point", point)
    held = spark.table(table)
    versions.upsert_published(spark, change, table, root, ["id"])
    assert rows(spark.table(table)) == [(1, "a"), (2, "B"), (3, "c")]
    assert rows(spark.read.parquet(first)) == [(1, "a"), (2, "b")]  # for those who still read it
    assert len(versions.drop_old_versions(spark, table, root, keep=[first])) == 1 and len(os.listdir(root)) == 2
    assert held.columns == ["id", "v"] and len(versions.drop_old_versions(spark, table, root)) == 1
    assert rows(spark.table(table)) == [(1, "a"), (2, "B"), (3, "c")]


def test_a_job_that_dies_while_it_writes_leaves_the_old_table(spark, database, tmp_path):
    table, root = f"{database}.t", str(tmp_path / "t")
    versions.publish(spark.range(3), table, root)
    with pytest.raises(Exception, match="on purpose"):
        versions.publish(spark.range(9).filter(F.when(F.col("id") < 5, True).otherwise(F.raise_error(F.lit("on purpose")).cast("boolean"))), table, root)
    assert spark.table(table).count() == 3


def test_versions_refuse_bad_keys_and_partitions_and_take_new_columns(spark, database, tmp_path):
    table, root = f"{database}.t", str(tmp_path / "t")
    good = spark.createDataFrame([(1, "a")], "id int, v string")
    versions.upsert_published(spark, good, table, root, ["id"])
    for bad in ([(1, "a"), (1, "b")], [(None, "a")]):
        with pytest.raises(ValueError, match="source key"):
            versions.upsert_published(spark, spark.createDataFrame(bad, "id int, v string"), table, root, ["id"])
    versions.publish(spark.createDataFrame([(1, "a", 2.5)], "id int, v string, w double"), table, root)
    assert rows(spark.table(table)) == [(1, "a", 2.5)]
    spark.sql(f"CREATE TABLE {database}.p (id int, day date) USING parquet PARTITIONED BY (day) LOCATION '{tmp_path}/p'")
    with pytest.raises(ValueError, match="partition columns"):
        versions.publish(good, f"{database}.p", str(tmp_path / "p2"))


def test_published_bronze_feeds_silver(spark, landing, database, tmp_path):
    report = ingest.ingest_bronze(spark, f"{tmp_path}/b", "files", ["tip"], landing, publish_in=database)
    assert report["tip"]["rows"] == spark.table(f"{database}.tip").count() > 0
    got = ingest.ingest_silver(spark, f"{tmp_path}/b", f"{tmp_path}/s", ["2024-01-09"], ["tip", "user"], bronze_in=database)
    assert got["user"]["status"] == "skipped" and got["tip"]["rows"] > 0


# -- buckets


def test_reports_on_buckets_do_not_shuffle(spark):
    """Also where both sides are too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("monthly_business_summary", "review_growth"):
            plan = physical(catalog.queries()[name](spark, SF))
            assert "Exchange" not in plan and "Bucketed: true" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    fact, scores = catalog.gold(spark, SF)
    assert rows(serving.monthly_business_summary(fact, scores)) == rows(catalog.queries()["monthly_business_summary"](spark, SF))


def test_buckets_hold_whole_keys_in_order(spark, database, tmp_path):
    df = spark.range(1000).select((F.col("id") % 37).alias("k"), F.col("id").alias("v"), F.lit("x").alias("s"))
    got = bucketed.save_bucketed(df.repartition(13), f"{database}.b", f"{tmp_path}/b", ["k"], 5, ["k", "v"])
    assert rows(got) == rows(df)
    files = got.select("k", F.input_file_name().alias("f")).distinct().groupBy("k").count()
    assert files.filter("count > 1").isEmpty()
    assert "Exchange" not in physical(got.groupBy("k").count())
    other = bucketed.save_bucketed(df.limit(10), f"{database}.c", f"{tmp_path}/c", ["k"], 5)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange" not in physical(got.join(other, "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    with pytest.raises(ValueError):
        bucketed.save_bucketed(df, f"{database}.d", f"{tmp_path}/d", ["nope"], 5)
    again = bucketed.save_bucketed(df.limit(0), f"{database}.b", f"{tmp_path}/b", ["k"], 5)
    assert again.count() == 0


# -- footers


def test_counts_and_bounds_come_from_footers(spark, tmp_path):
    for name in ("table_row_counts", "coverage_stats", "latest_slice_rows"):
        plan = physical(catalog.queries()[name](spark, SF))
        scans = [line for line in plan.splitlines() if "BatchScan" in line]
        assert scans and all("PushedAggregation: [COUNT(*)]" in s or "PushedAggregation: [MIN(measure), MAX(measure)]" in s for s in scans)
        assert "FileScan" not in plan
    path = str(tmp_path / "t")
    df = spark.range(100).select(F.col("id").alias("v"), (F.col("id") % 3).alias("a"), F.lit(2).alias("b"))
    lake.write_table(df, path, partition_by=["a", "b"])
    lake.write_table(df.limit(0).withColumn("a", F.lit(9).cast("long")), f"{path}/a=9/b=2")  # a partition without rows
    assert rows(footers.slice_counts(spark, path, ["a", "b"])) == [(0, 2, 34), (1, 2, 33), (2, 2, 33)]
    assert rows(footers.column_bounds(spark, path, ["v"])) == [(0, 99)]
    assert "FileScan" in physical(spark.read.parquet(path))  # other tables are opened as before


# -- lazy popularity, reports of jobs


def test_popularity_runs_and_writes_nothing_until_it_is_used(spark, landing, tmp_path, monkeypatch):
    ingest.ingest_bronze(spark, f"{tmp_path}/bronze", "files", files=landing)
    ingest.ingest_silver(spark, f"{tmp_path}/bronze", f"{tmp_path}/silver", ["2024-01-31"], full_load=True)
    sources = catalog.popularity_sources(spark, SF)
    tracker = spark.sparkContext.statusTracker()
    with monkeypatch.context() as m:
        m.setattr(session, "scratch_path", lambda *_: pytest.fail("wrote to scratch"))
        spark.sparkContext.setJobGroup("lazy", "lazy frame")
        popularity.business_popularity(*sources, ["2024-01-31"], digits=9, by_event_day=True)
        assert len(tracker.getJobIdsForGroup("lazy")) == 0
        dry = gold.build_popularity(spark, f"{tmp_path}/silver", f"{tmp_path}/gold", "2024-01-31", dry_run=True)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert not os.path.exists(f"{tmp_path}/gold")
    metrics = {}
    built = gold.build_popularity(spark, f"{tmp_path}/silver", f"{tmp_path}/gold", "2024-01-31", metrics=metrics)
    assert rows(dry) == rows(built.select(dry.columns))
    assert metrics[gold.POPULARITY_TABLE]["rows"] == built.count() and metrics[gold.POPULARITY_TABLE]["null_business_id"] == 0
    assert metrics[gold.POPULARITY_TABLE]["seconds"] > 0


@pytest.mark.parametrize("width", [1, 7, 4096])
def test_ranks_by_given_slices(spark, width):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 5)).alias("city"),
        F.when(F.col("id") % 11 > 0, (F.hash("id") % 50) / 50.0).alias("score"), "id",
    )
    got = rank_within(df, ["city"], "score", slices=-F.floor(F.col("score") * width))
    assert rows(got) == rows(rank_within(df, ["city"], "score"))


def test_history_keeps_every_run(spark, landing, tmp_path):
    path = f"{tmp_path}/history"
    for _ in range(2):
        ingest.ingest_bronze(spark, f"{tmp_path}/bronze", "files", ["tip", "user"], landing, history=path)
    with pytest.raises(RuntimeError):
        ingest.ingest_bronze(spark, f"{tmp_path}/bronze", "files", ["tip", "nothing"], landing, history=path)
    told = history.read_history(spark, path)
    assert told.count() == 6 and told.select("run_ts").distinct().count() == 3
    assert {(r.table_name, r.status) for r in told.collect()} == {("tip", "ok"), ("user", "ok"), ("nothing", "failed")}
    failed = told.filter("status = 'failed'").first()
    assert "nothing" in failed.error and failed.rows is None
    ingest.ingest_silver(spark, f"{tmp_path}/bronze", f"{tmp_path}/silver", ["2024-01-09"], ["tip"], history=path)
    row = history.read_history(spark, path).filter("layer = 'silver'").first()
    assert row["rows"] > 0 and set(row.nulls) == {"date"}
    assert set(GOLD_PARTITIONS) == {"day", "granularity"}
