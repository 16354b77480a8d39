"""Every registered query against its SQL in DuckDB, and the plans of the heavy ones."""

import duckdb
import pytest
from conftest import SF, plan_of

import __spark_entry__ as driver
from checks import catalog, oracle
from checks.compare import compare, duck


@pytest.fixture(scope="module")
def connection():
    return duck(SF)


def test_every_query_has_its_sql():
    own = set(catalog.queries())
    assert own == set(oracle.oracle_sql())
    assert own <= set(driver.queries()) and set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_agrees_with_sql(spark, connection, name):
    assert compare(spark, connection, name, SF) == ""


def test_entry(spark):
    df = driver.entry(spark)
    assert df.count() > 0
    assert df.columns[:4] == ["day", "period_month", "granularity", "business_id"]


@pytest.mark.parametrize("name", ["silver_business", "silver_user", "silver_checkin", "silver_tip"])
def test_cleaning_does_not_shuffle(spark, name):
    plan = plan_of(driver.queries()[name](spark, SF)).split("== Physical Plan ==")[1]
    # The projections count `part` in a scalar subquery; apart from that one-row aggregate nothing moves.
    assert "hashpartitioning" not in plan and "rangepartitioning" not in plan


HEAVY = ["business_popularity", "fact_all_days", "city_rank", "city_dashboard", "dq_constraint_violations"]


@pytest.mark.parametrize("name", HEAVY)
def test_heavy_plans_stay_in_the_jvm(spark, name):
    plan = plan_of(driver.queries()[name](spark, SF))
    for word in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "MapInPandas"):
        assert word not in plan


def test_latest_period_prunes_partitions_of_the_stored_table(spark):
    plan = plan_of(driver.queries()["latest_review_metrics"](spark, SF)).split("== Physical Plan ==")[1]
    assert "PartitionFilters: [isnotnull(granularity" in plan


@pytest.mark.parametrize("name", ["top_businesses_by_city", "top10_city", "top5_per_city", "city_comparison", "city_dashboard", "city_period_average"])
def test_reports_of_a_month_prune_every_scan(spark, name):
    """Each scan of a gold table filters its partition column `day`; none reads the whole history."""
    plan = plan_of(catalog.queries()[name](spark, SF)).split("== Physical Plan ==")[1]
    scans = [line for line in plan.splitlines() if "FileScan" in line and "PartitionFilters" in line]
    with_columns = [line for line in scans if "ReadSchema: struct<>" not in line]
    assert with_columns and all("day#" in line.split("PartitionFilters:")[1].split("PushedFilters")[0] for line in with_columns)


@pytest.mark.parametrize("name", ["monthly_trend", "review_growth", "city_time_series", "top_businesses_by_city", "top5_per_city"])
def test_whole_reports_are_not_sorted(spark, name):
    assert "rangepartitioning" not in plan_of(catalog.queries()[name](spark, SF))


def test_sums_are_equal_on_every_run(spark):
    runs = [catalog.queries()["city_dashboard"](spark, SF).collect() for _ in range(2)]
    assert runs[0] == runs[1]


@pytest.mark.parametrize(("name", "own"), [("latest_review_metrics", "fact"), ("rows_per_file", "fact"), ("add_column_catalog_default", "popularity")])
def test_queries_build_only_the_gold_table_they_read(spark, monkeypatch, name, own):
    asked, stored = [], catalog.stored
    monkeypatch.setattr(catalog, "stored", lambda s, sf, table: asked.append(table) or stored(s, sf, table))
    catalog.queries()[name](spark, SF)
    assert own in asked and not {"fact", "popularity"} - {own} & set(asked)


def test_raw_files_of_the_jobs_are_compressed(spark):
    root = catalog.job_lake(spark, SF)[0]
    files = spark.read.text(f"{root}/raw/review.json").inputFiles()
    assert files and all(f.endswith(".json.gz") for f in files)


def write_given(folder, parts, brands):
    """Small given tables, rows made here: parts of so many brands, their reviews, tips and check-ins over three months."""
    tables = {
        "part": f"SELECT i AS p_partkey, 'n' || i AS p_name, 'Brand#' || (i % {brands}) AS p_brand, 'TYPE' AS p_type FROM range({parts}) r(i)",
        "orders": "SELECT i AS o_orderkey, i % 9 AS o_custkey FROM range(400) r(i)",
        "lineitem": f"""SELECT i // 3 AS l_orderkey, CAST(i % 3 + 1 AS INT) AS l_linenumber, i % {parts} AS l_partkey,
            CAST(i % 7 AS DOUBLE) AS l_quantity, 'A' AS l_returnflag, 'F' AS l_linestatus FROM range(1200) r(i)""",
        "events": """SELECT i AS event_id, i % 9 AS user_id, ['view', 'signup', 'tip', 'tap'][i % 4 + 1] AS event_type,
            TIMESTAMP '2023-12-01 08:00:00' + INTERVAL (i * 3) HOUR AS ts, CAST(i % 11 AS DOUBLE) AS value FROM range(600) r(i)""",
    }
    connection = duckdb.connect()
    for name, text in tables.items():
        connection.execute(f"COPY ({text}) TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return duck(folder)


def test_maintained_reports_follow_the_given_tables(spark, tmp_path):
    """A call does the whole job, whatever ran before in the session: after the given tables change, it answers from the new ones, and
    the tables that the session keeps for other queries stay."""
    folder = str(tmp_path)
    connection = write_given(folder, parts=60, brands=4)
    kept = catalog.stored(spark, folder, "popularity")
    assert compare(spark, connection, "city_dashboard_maintained", folder) == ""
    connection = write_given(folder, parts=40, brands=7)
    assert compare(spark, connection, "city_dashboard_maintained", folder) == ""
    assert catalog.stored(spark, folder, "popularity") == kept
