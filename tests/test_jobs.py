import datetime as dt

import pytest
from conftest import SF, plan_of, rows
from pyspark.sql import functions as F

from bizpulse.plans import gold, ingest
from bizpulse.schemas import DAILY, FACT_KEY, MONTHLY, POPULARITY_KEY, RAW_TABLES
from bizpulse.sources.readers import read_table
from checks import catalog
from checks.projections import raw


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """JSON files of the given tables through bronze and silver: two full-load run days."""
    root = str(tmp_path_factory.mktemp("lake"))
    for table in RAW_TABLES:
        raw(spark, SF, table).write.json(f"{root}/raw/{table}.json")
    bronze = ingest.ingest_bronze(spark, f"{root}/bronze", "files", files=f"{root}/raw")
    silver = ingest.ingest_silver(
        spark, f"{root}/bronze", f"{root}/silver", ["2023-12-31", "2024-01-31"], full_load=True
    )
    return root, bronze, silver


def test_bronze_reports_rows_and_stamps_them(spark, lake):
    root, report, _ = lake
    assert {t: r["status"] for t, r in report.items()} == dict.fromkeys(RAW_TABLES, "ok")
    assert {t: r["rows"] for t, r in report.items()} == {t: raw(spark, SF, t).count() for t in RAW_TABLES}
    tip = spark.read.parquet(f"{root}/bronze/tip")
    assert tip.filter(F.to_date("_ingest_ts") != F.col("_ingest_date")).count() == 0
    assert tip.select("_ingest_ts").distinct().count() == 1


def test_silver_snapshots(spark, lake):
    root, _, report = lake
    assert all(r["status"] == "ok" and r["rows"] for r in report.values())
    business = spark.read.parquet(f"{root}/silver/business_snapshot")
    one_day = catalog.cleaned(spark, SF, "business").count()
    assert rows(business.groupBy("day").count()) == [(dt.date(2023, 12, 31), one_day), (dt.date(2024, 1, 31), one_day)]
    review = spark.read.parquet(f"{root}/silver/review_snapshot")
    assert review.filter(~F.col("day").eqNullSafe(F.col("date"))).count() == 0
    assert "_silver_ingest_ts" in review.columns


def test_silver_run_again_replaces_only_its_days(spark, lake, tmp_path):
    root = lake[0]
    target = str(tmp_path / "silver")
    for days in (["2024-01-29", "2024-01-30"], ["2024-01-30"]):
        ingest.ingest_silver(spark, f"{root}/bronze", target, days, ["tip", "checkin"])
    tips = spark.read.parquet(f"{target}/tip_snapshot")
    bronze = spark.read.parquet(f"{root}/bronze/tip").filter("user_id <> '' AND business_id <> ''")
    expected = bronze.filter(F.col("date").startswith("2024-01-29") | F.col("date").startswith("2024-01-30"))
    assert tips.count() == expected.count()


def test_silver_skips_missing_tables_and_writes_nothing_for_empty_days(spark, lake, tmp_path):
    target = str(tmp_path / "silver")
    report = ingest.ingest_silver(spark, f"{lake[0]}/bronze", target, ["1999-01-01"], ["tip", "nothing"])
    assert report["nothing"]["status"] == "skipped" and report["tip"]["rows"] == 0


@pytest.mark.parametrize(("policy", "raises"), [("fail_fast", True), ("skip", False), ("fail_at_end", True)])
def test_outcome_policies(spark, lake, tmp_path, policy, raises):
    arguments = (spark, str(tmp_path / "bronze"), "files", ["missing_table", "tip"])
    options = {"files": f"{lake[0]}/raw", "on_error": policy}
    if raises:
        with pytest.raises((RuntimeError, ValueError), match="missing_table"):
            ingest.ingest_bronze(*arguments, **options)
    else:
        report = ingest.ingest_bronze(*arguments, **options)
        assert report["missing_table"]["status"] == "failed" and report["tip"]["status"] == "ok"
    # Stopping at once leaves the later table unread; the other policies still load it.
    assert (tmp_path / "bronze" / "tip").exists() == (policy != "fail_fast")


def test_unknown_policy_is_refused(spark):
    with pytest.raises(ValueError, match="on_error"):
        ingest.ingest_bronze(spark, "b", "files", on_error="whatever")


def test_fact_job_matches_the_operator_and_repeats(spark, lake, tmp_path):
    root, target = lake[0], str(tmp_path)
    for _ in range(2):
        built = gold.build_fact(spark, f"{root}/silver", target, "2024-01-30", "2024-01-31")
    assert built.groupBy(*FACT_KEY).count().filter("count > 1").count() == 0
    expected = catalog.fact_of(spark, SF).filter(
        F.col("day").isin([dt.date(2024, 1, 30), dt.date(2024, 1, 31)])
    )
    assert rows(built.select(expected.columns)) == rows(expected)
    assert rows(built.select("day", "granularity").distinct()) == [
        (dt.date(2024, 1, 30), DAILY), (dt.date(2024, 1, 31), DAILY), (dt.date(2024, 1, 31), MONTHLY),
    ]


def test_fact_job_options(spark, lake, tmp_path):
    silver = f"{lake[0]}/silver"
    assert gold.build_fact(spark, silver, str(tmp_path), "2024-01-15", skip_daily=True) is None
    dry = gold.build_fact(spark, silver, str(tmp_path), "2024-01-15", skip_daily=True, force_month="2024-01-01", dry_run=True)
    assert {(str(r.day), r.granularity) for r in dry.select("day", "granularity").distinct().collect()} == {("2024-01-31", 2)}
    assert not (tmp_path / gold.FACT_TABLE).exists()


def test_popularity_job_replaces_a_slice(spark, lake, tmp_path):
    root, target = lake[0], str(tmp_path)
    assert gold.build_popularity(spark, f"{root}/silver", target, "2024-01-30") is None
    for _ in range(2):
        built = gold.build_popularity(spark, f"{root}/silver", target, "2023-12-31", "2024-01-31")
    assert built.groupBy(*POPULARITY_KEY).count().filter("count > 1").count() == 0
    score = F.round("popularity_score", 9)
    mine = built.filter(F.col("day") == dt.date(2024, 1, 31)).select("business_id", score)
    direct = catalog.business_popularity(spark, SF).select("business_id", score)
    assert rows(mine) == rows(direct)
    # The slice of a run without open businesses is emptied, the other month stays.
    empty_root = str(tmp_path / "silver")
    for table in ("review", "tip", "checkin"):
        spark.read.parquet(f"{root}/silver/{table}_snapshot").write.partitionBy("day").parquet(f"{empty_root}/{table}_snapshot")
    closed = spark.read.parquet(f"{root}/silver/business_snapshot").withColumn("is_open", F.lit(False))
    closed.write.partitionBy("day").parquet(f"{empty_root}/business_snapshot")
    again = gold.build_popularity(spark, empty_root, target, "2024-01-31")
    assert rows(again.select("day").distinct()) == [(dt.date(2023, 12, 31),)]


def test_upsert_mode_and_unknown_mode(spark, lake, tmp_path):
    root = lake[0]
    for _ in range(2):
        built = gold.build_popularity(spark, f"{root}/silver", str(tmp_path), "2024-01-31", mode="upsert")
    assert built.count() == catalog.business_popularity(spark, SF).count()
    with pytest.raises(ValueError, match="mode"):
        gold.build_popularity(spark, f"{root}/silver", str(tmp_path), "2024-01-31", mode="truncate")


def test_gold_jobs_prune_silver_partitions(spark, lake):
    read = gold._silver(spark, f"{lake[0]}/silver", "review", ["business_id"], dt.date(2024, 1, 1), dt.date(2024, 1, 31), "parquet")
    plan = read._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "ReadSchema: struct<business_id:string>" in plan
    assert read.count() < read_table(spark, f"{lake[0]}/silver/review_snapshot").count()


def test_events_lie_by_day_and_are_not_moved_into_silver(spark, lake, tmp_path, monkeypatch):
    """Bronze has them in order of their days already; snapshots are still gathered."""
    plans = {}
    write = ingest.overwrite_partitions

    def seen(df, path, partition_by, **kwargs):
        plans[path.rsplit("/", 1)[1]] = (kwargs["balance"], "Exchange" in plan_of(df).split("== Physical Plan ==")[1])
        write(df, path, partition_by, **kwargs)

    monkeypatch.setattr(ingest, "overwrite_partitions", seen)
    ingest.ingest_silver(spark, f"{lake[0]}/bronze", str(tmp_path / "silver"), ["2024-01-31"], ["review", "tip", "user"], full_load=True)
    assert plans == {"review_snapshot": (False, False), "tip_snapshot": (False, False), "user_snapshot": (True, False)}


def test_fact_job_moves_rows_while_they_are_wide(spark, lake, tmp_path, monkeypatch):
    seen = []
    write = gold.replace_slice
    monkeypatch.setattr(gold, "replace_slice", lambda s, df, *a, **k: seen.append((plan_of(df), k["balance"])) or write(s, df, *a, **k))
    gold.build_fact(spark, f"{lake[0]}/silver", str(tmp_path / "gold"), "2024-01-01", "2024-01-31")
    plan, balance = seen[0]
    assert not balance and plan.split("== Physical Plan ==")[1].count("REBALANCE_PARTITIONS_BY_COL") == 1
