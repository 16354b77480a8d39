"""Every registered query: a function of (spark, sf_dir) over the given tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator
from contextlib import contextmanager, nullcontext
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bizpulse.functions.dates import as_date, calendar
from bizpulse.functions.scoring import min_max_normalize, recency_boost
from bizpulse.operators import facts, popularity, quality, serving, silver, summaries
from bizpulse.operators.merging import slice_keys, with_default_column
from bizpulse.operators.ranking import rank_within
from bizpulse.plans.gold import FACT_TABLE, POPULARITY_TABLE, build_fact, build_popularity, store_monthly
from bizpulse.plans.ingest import ingest_bronze, ingest_silver
from bizpulse.schemas import (
    FACT_KEY,
    GOLD_PARTITIONS,
    MEASURE_CODES,
    MEASURE_CODES_DDL,
    MONTHLY,
    POPULARITY_KEY,
    RAW_TABLES,
    raw_schema,
)
from bizpulse.session import materialize, scratch_path, small_tasks
from bizpulse.plans.state import month_from_state, read_city_sums, update_city_sums, update_state
from bizpulse.sources import checked, dumps, footers, history, lake, readers, versions
from checks.projections import raw

# Parameters of the checks: the months and days the given tables cover (see FIXTURES.md), one city, score digits.
MONTHS = ["2023-12-31", "2024-01-31", "2024-02-29"]
FIRST_DAY, LAST_DAY = "2023-12-01", "2024-02-29"
MONTH_END, PERIOD, CITY, DIGITS = "2024-01-31", "2024-01", "Brand#11", 9

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def cleaned(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return silver.clean(table, raw(spark, sf, table))


_stored: dict[tuple[str, str], str] = {}


def stored(spark: SparkSession, sf: str, table: str) -> str:
    """Path of a silver or gold lake table, built once per session and data folder from the given tables."""
    key = (spark.sparkContext.applicationId, f"{sf}/{table}")
    if key not in _stored:
        path = scratch_path(spark, table)
        if table in RAW_TABLES:
            rows, by = silver.silver_snapshot(table, raw(spark, sf, table), MONTHS, full_load=True), ["day"]
        else:
            rows = fact_of(spark, sf, balance=True) if table == "fact" else popularity_of(spark, sf, MONTHS)
            by = list(GOLD_PARTITIONS)
        clustered = ["business_id"] * ("business_id" in rows.columns and table != "fact")
        # The fact's rows are gathered and sorted wide and unfold before they are written, so its tasks are half as large.
        with small_tasks(spark, "8m") if table == "fact" else nullcontext():
            lake.write_table(rows, path, "overwrite", by, {"compression": "zstd"}, cluster_by=clustered, balance=table != "fact")
        _stored[key] = path
    return _stored[key]


@contextmanager
def built_anew() -> Iterator[None]:
    """Within it no table that the session stored is found, so what is read is built from the given tables as they are now. After
    it those of the session count again."""
    global _stored
    kept, _stored = _stored, {}
    try:
        yield
    finally:
        _stored = kept


def silver_table(spark: SparkSession, sf: str, table: str) -> DataFrame:
    """One stored silver or gold table; nothing else is built for it."""
    return readers.read_table(spark, stored(spark, sf, table))


def snapshot(spark: SparkSession, sf: str, table: str) -> DataFrame:
    """One run day's copy of a snapshot table."""
    return silver_table(spark, sf, table).filter(F.col("day") == F.lit(MONTH_END).cast("date")).drop("day")


def gold(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The stored fact and popularity tables."""
    return silver_table(spark, sf, "fact"), silver_table(spark, sf, "popularity")


def database(spark: SparkSession, sf: str) -> str:
    """A catalog database of this session and data folder."""
    name = f"checks_{spark.sparkContext.applicationId}_{abs(hash(sf))}".replace("-", "_")
    if not spark.catalog.databaseExists(name):
        spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, 'database')}'")
    return name


_monthly: dict[tuple[str, str], tuple[str, str]] = {}


def monthly_gold(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The monthly rows of both gold tables in buckets of businesses, stored once per session and data folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _monthly:
        name, root = database(spark, sf), scratch_path(spark, "monthly")
        store_monthly(spark, *gold(spark, sf), name, root, buckets=8)
        _monthly[key] = (f"{name}.{FACT_TABLE}_monthly", f"{name}.{POPULARITY_TABLE}_monthly")
    fact, scores = map(spark.table, _monthly[key])
    return fact, scores


def popularity_sources(spark: SparkSession, sf: str) -> list[DataFrame]:
    return [silver_table(spark, sf, t) for t in ("business", "review", "tip", "checkin")]


def popularity_of(spark: SparkSession, sf: str, months: list[str]) -> DataFrame:
    """As the job does it: the inputs are stored, as bounds, scores and ranks read them."""
    inputs = popularity.popularity_inputs(*popularity_sources(spark, sf), months, by_event_day=True)
    return popularity.ranked_popularity(materialize(inputs, "popularity-inputs"), digits=DIGITS)


def fact_of(spark: SparkSession, sf: str, balance: bool = False) -> DataFrame:
    events = [silver_table(spark, sf, t) for t in ("review", "tip")]
    return facts.fact_for_range(*events, FIRST_DAY, LAST_DAY, by_event_day=True, balance=balance)


# -- flagship and popularity parts


@query
def business_popularity(spark, sf):
    return popularity_of(spark, sf, [MONTH_END])


@query
def business_popularity_all_months(spark, sf):
    return popularity_of(spark, sf, MONTHS)


@query
def popularity_inputs(spark, sf):
    return popularity.popularity_inputs(*popularity_sources(spark, sf), [MONTH_END], by_event_day=True)


@query
def popularity_score(spark, sf):
    inputs = popularity.popularity_inputs(*popularity_sources(spark, sf), MONTHS, by_event_day=True)
    parts = ["norm_stars", "norm_review_count", "norm_checkin_count", "norm_tip_compliments", "recency_boost"]
    scored = popularity.score_inputs(inputs, digits=DIGITS)
    return scored.select("business_id", "day", *[F.round(p, DIGITS).alias(p) for p in parts], "popularity_score")


@query
def recency_boost_(spark, sf):
    last = silver_table(spark, sf, "review").groupBy("business_id").agg(F.max("date").alias("last_review_date"))
    boost = recency_boost(F.col("last_review_date"), F.lit(LAST_DAY).cast("date"))
    return last.withColumn("recency_boost", F.round(boost, DIGITS))


@query
def review_stats(spark, sf):
    return popularity.review_stats(silver_table(spark, sf, "review"))


@query
def checkin_counts(spark, sf):
    return popularity.checkin_counts(snapshot(spark, sf, "checkin"))


@query
def compliment_sums(spark, sf):
    return popularity.compliment_sums(silver_table(spark, sf, "tip"))


@query
def business_activity(spark, sf):
    return popularity.business_activity(
        silver_table(spark, sf, "review"), silver_table(spark, sf, "tip"), snapshot(spark, sf, "checkin")
    )


@query
def min_max_normalize_(spark, sf):
    users = snapshot(spark, sf, "user").select("user_id", "fans", "average_stars", F.lit(7).alias("constant"))
    columns = {"fans": "norm_fans", "average_stars": "norm_stars", "constant": "norm_constant"}
    return min_max_normalize(users, columns).select("user_id", *columns.values())


@query
def city_rank(spark, sf):
    stars = snapshot(spark, sf, "business").select("business_id", "city", "stars")
    return rank_within(stars, ["city"], "stars", "city_rank")


# -- sources and cleaning


def listed(tables: dict[str, DataFrame]) -> DataFrame:
    """All rows of some tables, each as one text."""
    parts = [
        df.select(
            F.lit(name).alias("table_name"),
            F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in df.columns]).alias("row_text"),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, parts)


@query
def bronze_json_roundtrip(spark, sf):
    path = scratch_path(spark, "json")
    for table in RAW_TABLES:
        raw(spark, sf, table).withColumn("not_in_schema", F.lit(1)).write.json(f"{path}/{table}")
    return listed({t: readers.read_json(spark, f"{path}/{t}", raw_schema(t)) for t in RAW_TABLES})


@query
def json_inferred_schema(spark, sf):
    path = scratch_path(spark, "json")
    for table in RAW_TABLES:
        raw(spark, sf, table).write.json(f"{path}/{table}")
    return listed({t: readers.read_json(spark, f"{path}/{t}").select(*raw_schema(t).names) for t in RAW_TABLES})


@query
def bronze_from_dump(spark, sf):
    """Bronze tables loaded from dumps of a document store, large files cut into ranges."""
    dump, target = scratch_path(spark, "dump"), scratch_path(spark, "bronze")
    for table in RAW_TABLES:
        dumps.write_dump(raw(spark, sf, table).withColumn("not_in_schema", F.lit(1)), f"{dump}/{table}")
    ingest_bronze(spark, target, "store", store={"dump": dump, "range_bytes": 1 << 20})
    return listed({t: readers.read_table(spark, f"{target}/{t}").select(*raw_schema(t).names) for t in RAW_TABLES})


@query
def silver_pass_through(spark, sf):
    """A table without a cleaning rule: its rows as they are, stamped with the run day."""
    other = spark.read.parquet(f"{sf}/nation.parquet")
    return silver.silver_snapshot("nation", other, [MONTH_END])


@query
def silver_business(spark, sf):
    return cleaned(spark, sf, "business")


@query
def silver_user(spark, sf):
    return cleaned(spark, sf, "user")


@query
def silver_review(spark, sf):
    return cleaned(spark, sf, "review")


@query
def silver_checkin(spark, sf):
    return cleaned(spark, sf, "checkin")


@query
def silver_tip(spark, sf):
    return cleaned(spark, sf, "tip")


@query
def silver_date_slice(spark, sf):
    return silver.silver_snapshot("review", raw(spark, sf, "review"), ["2024-01-05"])


@query
def silver_full_load(spark, sf):
    return silver.silver_snapshot("tip", raw(spark, sf, "tip"), [LAST_DAY], full_load=True)


@query
def silver_run_days(spark, sf):
    return silver.silver_snapshot("checkin", raw(spark, sf, "checkin"), ["2024-01-30", MONTH_END])


_job_lakes: dict[tuple[str, str], tuple[str, dict, dict]] = {}


def job_lake(spark: SparkSession, sf: str) -> tuple[str, dict, dict]:
    """JSON files of all raw tables -> bronze -> silver for three run days, and both jobs' reports; once per session."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _job_lakes:
        root = scratch_path(spark, "job-lake")
        for table in RAW_TABLES:
            raw(spark, sf, table).write.json(f"{root}/raw/{table}.json", compression="gzip")
        bronze = ingest_bronze(spark, f"{root}/bronze", "files", files=f"{root}/raw", history=f"{root}/history")
        silver_report = ingest_silver(spark, f"{root}/bronze", f"{root}/silver", MONTHS, full_load=True, history=f"{root}/history")
        _job_lakes[key] = (root, bronze, silver_report)
    return _job_lakes[key]


@query
def silver_job(spark, sf):
    """All rows of the stored silver tables, the loads' time stamps aside."""
    root = job_lake(spark, sf)[0]
    tables = {t: readers.read_table(spark, f"{root}/silver/{t}_snapshot") for t in RAW_TABLES}
    return listed({t: df.drop("_ingest_ts", "_silver_ingest_ts") for t, df in tables.items()})


@query
def job_metrics(spark, sf):
    """What the jobs of all layers count while they write, from the history that they keep. Of each table the newest run."""
    root, target = job_lake(spark, sf)[0], scratch_path(spark, "gold")
    build_fact(spark, f"{root}/silver", target, FIRST_DAY, LAST_DAY, history=f"{root}/history")
    build_popularity(spark, f"{root}/silver", target, FIRST_DAY, LAST_DAY, digits=DIGITS, history=f"{root}/history")
    newest = silver.latest_per_key(history.read_history(spark, f"{root}/history").drop("nulls"), ["layer", "table_name"], newest="run_ts")
    nulls = history.read_history(spark, f"{root}/history").select("run_ts", "layer", "table_name", "nulls")
    dated = [F.col("nulls")[c] for c in ("date", "checkin_date", "yelping_since")]
    both = newest.join(nulls, ["run_ts", "layer", "table_name"])
    return both.select("layer", "table_name", "rows", "rejected", F.coalesce(*dated).alias("null_dates"))


@query
def silver_one_day_job(spark, sf):
    """The stored silver rows of a job for one day over bronze that lies in order of the events' days."""
    root, target = job_lake(spark, sf)[0], scratch_path(spark, "one-day")
    ingest_silver(spark, f"{root}/bronze", target, ["2024-01-05"], ["review", "tip"])
    tables = {t: readers.read_table(spark, f"{target}/{t}_snapshot") for t in ("review", "tip")}
    return listed({t: df.drop("_ingest_ts", "_silver_ingest_ts") for t, df in tables.items()})


@query
def bronze_published(spark, sf):
    """Bronze tables after a second load under another folder; the tables moved to it and the first one was dropped."""
    root, name, target = job_lake(spark, sf)[0], database(spark, sf), scratch_path(spark, "published")
    for _ in range(2):
        ingest_bronze(spark, target, "files", files=f"{root}/raw", publish_in=name)
    for table in RAW_TABLES:
        versions.drop_old_versions(spark, f"{name}.{table}", f"{target}/{table}")
    return listed({t: spark.table(f"{name}.{t}").select(*raw_schema(t).names) for t in RAW_TABLES})


@query
def fact_job(spark, sf):
    """The stored fact table after a load of all days, a second load of January in upsert mode with the month forced, and a run
    of a day without events over a slice that holds stale rows."""
    root, target = job_lake(spark, sf)[0], scratch_path(spark, "gold")
    build_fact(spark, f"{root}/silver", target, FIRST_DAY, LAST_DAY)
    path, stale = f"{target}/{FACT_TABLE}", F.lit("2024-03-05").cast("date")
    old = readers.read_table(spark, path, conditions=[F.col("day") == F.lit(LAST_DAY).cast("date"), F.col("granularity") == 0])
    lake.write_table(old.withColumn("day", stale), path, "append", GOLD_PARTITIONS)
    build_fact(spark, f"{root}/silver", target, "2024-01-10", "2024-01-20", force_month=MONTH_END, mode="upsert")
    return build_fact(spark, f"{root}/silver", target, "2024-03-05").drop("_gold_ingest_ts")


@query
def popularity_job(spark, sf):
    """The stored popularity table after a load of all months and a second one of January in upsert mode."""
    root, target = job_lake(spark, sf)[0], scratch_path(spark, "gold")
    build_popularity(spark, f"{root}/silver", target, FIRST_DAY, LAST_DAY, digits=DIGITS)
    again = build_popularity(spark, f"{root}/silver", target, MONTH_END, mode="upsert", digits=DIGITS)
    return again.drop("_gold_ingest_ts")


@query
def latest_per_key(spark, sf):
    tips = silver_table(spark, sf, "tip").filter(F.col("date").isNotNull()).select("business_id", "user_id", "date")
    return silver.latest_per_key(tips, ["business_id"], newest="date")


@query
def range_filter_tip(spark, sf):
    return silver.date_range_filter(silver_table(spark, sf, "tip").drop("day"), "date", "2024-01-10", "2024-01-20")


@query
def calendar_(spark, sf):
    bounds = silver_table(spark, sf, "review").agg(F.min("date").alias("start"), F.max("date").alias("end"))
    return calendar(bounds)


@query
def scan_filter_project(spark, sf):
    path = stored(spark, sf, "popularity")
    conditions = [F.col("day") == F.lit(MONTH_END).cast("date"), F.col("city_rank") <= 3]
    return readers.read_table(spark, path, ["business_id", "name", "popularity_score"], conditions)


# -- facts


@query
def review_metrics(spark, sf):
    return facts.review_metrics(silver_table(spark, sf, "review"))


@query
def tip_metrics(spark, sf):
    return facts.tip_metrics(silver_table(spark, sf, "tip"))


@query
def metrics_narrow(spark, sf):
    return facts.to_narrow(facts.tip_metrics(silver_table(spark, sf, "tip")), ["business_id"], facts.TIP_MEASURES)


@query
def extra_measures(spark, sf):
    wide = facts.extra_measures(silver_table(spark, sf, "review"), silver_table(spark, sf, "tip"))
    return wide.withColumns({c: F.round(c, DIGITS) for c in ("positive_pct", "negative_pct")})


@query
def fact_review_tip_daily(spark, sf):
    return facts.fact_for_period(silver_table(spark, sf, "review"), silver_table(spark, sf, "tip"), "2024-01-15", 0, by_event_day=True)


@query
def fact_review_tip_monthly(spark, sf):
    return facts.fact_for_period(silver_table(spark, sf, "review"), silver_table(spark, sf, "tip"), MONTH_END, 2, by_event_day=True)


@query
def fact_all_days(spark, sf):
    return fact_of(spark, sf)


@query
def fact_from_state(spark, sf):
    """Monthly rows merged from daily state that was loaded in two runs, the second over days that were there before."""
    root, target = job_lake(spark, sf)[0], scratch_path(spark, "state")
    days = [as_date(FIRST_DAY) + dt.timedelta(days=i) for i in range((as_date(LAST_DAY) - as_date(FIRST_DAY)).days + 1)]
    for own in (days, days[58:63]):
        update_state(spark, f"{root}/silver", target, own)
    return reduce(DataFrame.unionAll, [month_from_state(spark, target, m) for m in MONTHS])


def city_sums(spark: SparkSession, sf: str) -> DataFrame:
    """City sums of all months, then January replaced by the scores up to rank 5 and February emptied. Every call does the whole
    job, from the given tables as they are then; what the session has stored is neither used nor changed."""
    path = scratch_path(spark, "city-sums")
    with built_anew():
        fact, scores = gold(spark, sf)
    update_city_sums(spark, scores, fact, path, MONTHS, DIGITS)
    kept = scores.filter((F.col("day") != F.lit(as_date(MONTHS[1]))) | (F.col("city_rank") <= 5))
    update_city_sums(spark, kept.filter(F.col("day") != F.lit(as_date(MONTHS[2]))), fact, path, MONTHS[1:], DIGITS)
    return read_city_sums(spark, path)


@query
def top_cities_maintained(spark, sf):
    return summaries.top_cities(city_sums(spark, sf))


@query
def city_dashboard_maintained(spark, sf):
    return summaries.city_dashboard(city_sums(spark, sf))


@query
def city_time_series_maintained(spark, sf):
    return summaries.city_time_series(city_sums(spark, sf))


@query
def city_period_average_maintained(spark, sf):
    return summaries.city_period_average(city_sums(spark, sf), PERIOD)


@query
def slice_keys_(spark, sf):
    return slice_keys(silver_table(spark, sf, "fact"), GOLD_PARTITIONS)


# -- table maintenance: write, change, read back


@query
def partition_overwrite(spark, sf):
    path = scratch_path(spark, "partitions")
    tips = cleaned(spark, sf, "tip").filter(F.col("date").isNotNull()).withColumn("day", F.to_date("date"))
    lake.write_table(tips, path, "overwrite", ["day"], balance=True)
    changed = silver.date_range_filter(tips, "date", "2024-01-10", "2024-01-12").withColumn(
        "compliment_count", F.col("compliment_count") + 100
    )
    lake.overwrite_partitions(changed, path, ["day"], balance=True)
    return readers.read_table(spark, path)


@query
def upsert_by_key(spark, sf):
    path, fact = scratch_path(spark, "upsert"), silver_table(spark, sf, "fact")
    january = F.lit(MONTH_END).cast("date")
    old = fact.filter((F.col("day") <= january) & (F.col("measure") != 4))
    lake.write_table(old, path, "overwrite", GOLD_PARTITIONS, balance=True)
    new = fact.filter(F.col("day") >= january).withColumn("units", F.col("units") + 1000)
    lake.upsert(spark, new, path, FACT_KEY, GOLD_PARTITIONS)
    return readers.read_table(spark, path)


@query
def upsert_unpartitioned(spark, sf):
    """The same change to a table without partitions, published as a new version of it."""
    table, root, fact = f"{database(spark, sf)}.upserted", scratch_path(spark, "versions"), silver_table(spark, sf, "fact")
    january = F.lit(MONTH_END).cast("date")
    versions.publish(fact.filter((F.col("day") <= january) & (F.col("measure") != 4)), table, root)
    new = fact.filter(F.col("day") >= january).withColumn("units", F.col("units") + 1000)
    versions.upsert_published(spark, new, table, root, FACT_KEY, cluster_by=["business_id"])
    return spark.table(table)


@query
def replace_slice(spark, sf):
    """January's months shrink to one measure and February's, in the slices but not in the source, are emptied."""
    path, fact = scratch_path(spark, "slice"), silver_table(spark, sf, "fact")
    lake.write_table(fact, path, "overwrite", GOLD_PARTITIONS, balance=True)
    january, february = (as_date(m) for m in MONTHS[1:])
    source = fact.filter((F.col("day") == F.lit(january)) & (F.col("granularity") == MONTHLY) & (F.col("measure") == 1))
    slices = [{"day": d, "granularity": MONTHLY} for d in (january, february)]
    lake.replace_slice(spark, source, path, GOLD_PARTITIONS, slices, GOLD_PARTITIONS)
    return readers.read_table(spark, path)


@query
def replace_slice_by_month(spark, sf):
    """The slice column is not the partition column, so rows are matched instead of directories."""
    path, fact = scratch_path(spark, "slice"), silver_table(spark, sf, "fact")
    lake.write_table(fact, path, "overwrite", GOLD_PARTITIONS, balance=True)
    source = fact.filter((F.col("period_month") == "2024-02") & (F.col("measure") == 1))
    lake.replace_slice(spark, source, path, ["period_month"], partition_by=GOLD_PARTITIONS)
    return readers.read_table(spark, path)


@query
def replace_slice_timestamp(spark, sf):
    """Partitions named by a time of day; January's is emptied."""
    path, slot = scratch_path(spark, "slice"), F.date_trunc("month", "date") + F.expr("INTERVAL 330 MINUTE")
    tips = silver_table(spark, sf, "tip").filter("date IS NOT NULL").select("user_id", "business_id", "date", slot.alias("slot"))
    lake.write_table(tips, path, "overwrite", ["slot"], balance=True)
    january = [{"slot": dt.datetime(2024, 1, 1, 5, 30)}]
    lake.replace_slice(spark, tips.limit(0), path, ["slot"], january, ["slot"])
    return readers.read_table(spark, path)


@query
def measure_codes_seed(spark, sf):
    path = scratch_path(spark, "codes")
    used = silver_table(spark, sf, "fact").filter(F.col("measure") < 4).select(F.col("measure").alias("measure_id")).distinct()
    lake.write_table(used.withColumn("measure_name", F.lit("kept")), path)
    codes = spark.createDataFrame(MEASURE_CODES, MEASURE_CODES_DDL).select("measure_id", "measure_name")
    lake.seed_rows(spark, codes, path, ["measure_id"])
    return readers.read_table(spark, path)


@query
def add_column_default(spark, sf):
    """Files written before the column existed read as null and take the default."""
    path, table = scratch_path(spark, "region"), silver_table(spark, sf, "popularity").select("business_id", "day", "popularity_score", "state")
    newest = F.col("day") == F.to_date(F.lit(LAST_DAY))
    lake.write_table(table.filter(~newest).drop("state"), path)
    lake.write_table(table.filter(newest).withColumnRenamed("state", "region"), path)
    merged = spark.read.option("mergeSchema", "true").parquet(path)
    return with_default_column(merged, "region", F.lit("Unknown"))


@query
def add_column_catalog_default(spark, sf):
    """The same with the default in the catalog: no schema is merged and old files answer with it."""
    name, scores = f"{database(spark, sf)}.regions", silver_table(spark, sf, "popularity").select("business_id", "day", "popularity_score", "state")
    newest = F.col("day") == F.to_date(F.lit(LAST_DAY))
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    scores.filter(~newest).drop("state").write.option("path", scratch_path(spark, "region")).saveAsTable(name)
    lake.add_column(spark, name, "region", "string", "'Unknown'")
    scores.filter(newest).withColumnRenamed("state", "region").write.insertInto(name)
    return spark.table(name)


@query
def rows_per_file(spark, sf):
    """Files of the fact table with and without a limit of rows: all rows, and whether the largest file keeps the limit."""
    reports = []
    for limit, options in ((5000, {"maxRecordsPerFile": "5000"}), (None, {})):
        path = scratch_path(spark, "files")
        lake.write_table(silver_table(spark, sf, "fact"), path, "overwrite", ["granularity"], options, balance=True)
        files = lake.rows_per_file(readers.read_table(spark, path))
        reports.append(files.agg(F.lit(limit).cast("int").alias("row_limit"), F.sum("row_count").alias("rows"), (F.max("row_count") <= 5000).alias("kept")))
    return reduce(DataFrame.unionAll, reports)


@query
def checked_write(spark, sf):
    """Scores with planted errors: what was published and what went to quarantine, with the rules it breaks."""
    name, root = f"{database(spark, sf)}.checked", scratch_path(spark, "checked")
    checked.checked_write(dirty(spark, sf)[1], quality.popularity_rules(), name, root, most_bad=0.9)
    columns = [*POPULARITY_KEY, "popularity_score", "city_rank"]
    good = spark.table(name).select(*columns, F.lit("").alias("broken_rules"))
    bad = spark.table(f"{name}_quarantine").select(*columns, F.array_join(F.array_sort("broken_rules"), ",").alias("broken_rules"))
    return good.unionAll(bad)


@query
def register_table(spark, sf):
    app = spark.sparkContext.applicationId.replace("-", "_")
    table = f"popularity_{app}_{abs(hash(sf))}"
    lake.register_table(spark, stored(spark, sf, "popularity"), table, view=f"v_{table}")
    return spark.sql(f"SELECT period_month, count(*) AS row_count FROM v_{table} GROUP BY period_month")


# -- reports


@query
def top_businesses_by_city(spark, sf):
    return serving.top_businesses_by_city(silver_table(spark, sf, "popularity"))


@query
def top10_city(spark, sf):
    return serving.top_in_city(silver_table(spark, sf, "popularity"), CITY, PERIOD)


@query
def top5_per_city(spark, sf):
    return serving.top_per_city(silver_table(spark, sf, "popularity"), PERIOD)


@query
def latest_review_metrics(spark, sf):
    return serving.latest_review_metrics(silver_table(spark, sf, "fact"))


@query
def monthly_business_summary(spark, sf):
    return serving.monthly_business_summary(*monthly_gold(spark, sf))


@query
def monthly_trend(spark, sf):
    return serving.monthly_trend(silver_table(spark, sf, "fact"))


@query
def review_growth(spark, sf):
    return serving.review_growth(monthly_gold(spark, sf)[0])


@query
def top_cities(spark, sf):
    return serving.top_cities(silver_table(spark, sf, "popularity"), digits=DIGITS)


@query
def city_comparison(spark, sf):
    return serving.city_comparison(*gold(spark, sf), CITY, PERIOD)


@query
def city_dashboard(spark, sf):
    return serving.city_dashboard(*gold(spark, sf), digits=DIGITS)


@query
def city_time_series(spark, sf):
    return serving.city_time_series(silver_table(spark, sf, "popularity"), digits=DIGITS)


@query
def city_period_average(spark, sf):
    return serving.city_period_average(silver_table(spark, sf, "popularity"), PERIOD, digits=DIGITS)


@query
def coverage_stats(spark, sf):
    """From file footers: the days of the slices that have rows."""
    return serving.coverage_of_slices(footers.slice_counts(spark, stored(spark, sf, "popularity"), GOLD_PARTITIONS))


@query
def coverage_of_rows(spark, sf):
    return serving.coverage_stats(silver_table(spark, sf, "popularity"))


@query
def latest_slice_rows(spark, sf):
    """Rows of the latest daily slice, found and counted in file footers; and the bounds of its table's measures."""
    path = stored(spark, sf, "fact")
    daily = footers.slice_counts(spark, path, GOLD_PARTITIONS).filter(F.col("granularity") == 0)
    newest = daily.agg(F.max_by(F.struct("day", "row_count"), "day").alias("s")).select("s.*")
    return newest.crossJoin(footers.column_bounds(spark, path, ["measure"]))


@query
def reports_as_views(spark, sf):
    """Every report, queried as SQL through its view."""
    views = [v for v in serving.create_views(*gold(spark, sf)) if v.startswith("v_")]
    return spark.sql(" UNION ALL ".join(f"SELECT '{v}' AS view_name, count(*) AS row_count FROM {v}" for v in views))


# -- quality, on gold tables with planted errors


def dirty(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    fact, scores = gold(spark, sf)
    rank, measure, units = F.col("city_rank"), F.col("measure"), F.col("units")
    columns = ["day", "period_month", "granularity", "business_id", "popularity_score", "city_rank"]
    dirty_scores = scores.select(
        "day",
        "period_month",
        F.when(rank == 4, 1).otherwise(F.col("granularity")).alias("granularity"),
        F.when(rank != 6, F.col("business_id")).alias("business_id"),
        F.when(rank == 2, F.col("popularity_score") + 1).otherwise(F.col("popularity_score")).alias("popularity_score"),
        F.when(rank == 3, 0).otherwise(rank).alias("city_rank"),
    ).unionByName(scores.filter(rank == 1).select(*columns))
    dirty_fact = fact.withColumns(
        {
            "measure": F.when((measure == 7) & (units > 9), 10).otherwise(measure),
            "units": F.when((measure == 5) & (units > 9), None).otherwise(units),
        }
    )
    return dirty_fact, dirty_scores


@query
def table_row_counts(spark, sf):
    """From file footers."""
    counts = {n: footers.slice_counts(spark, stored(spark, sf, t), GOLD_PARTITIONS) for n, t in (("business_popularity", "popularity"), ("fact_review_tip_metrics", "fact"))}
    return quality.slices_to_row_counts(counts)


@query
def table_row_counts_scanned(spark, sf):
    fact, scores = gold(spark, sf)
    return quality.table_row_counts({"business_popularity": scores, "fact_review_tip_metrics": fact})


@query
def dq_duplicate_keys(spark, sf):
    return quality.duplicate_keys(dirty(spark, sf)[1], POPULARITY_KEY)


@query
def dq_missing_fields(spark, sf):
    fact, scores = dirty(spark, sf)
    return quality.missing_fields(
        {"business_popularity": (scores, ["business_id"]), "fact_review_tip_metrics": (fact, ["units"])}
    )


@query
def dq_constraint_violations(spark, sf):
    fact, scores = dirty(spark, sf)
    return quality.constraint_violations(
        "business_popularity", scores, quality.popularity_rules(), POPULARITY_KEY
    ).unionByName(quality.constraint_violations("fact_review_tip_metrics", fact, quality.fact_rules(), FACT_KEY))


@query
def dq_quarantine(spark, sf):
    return quality.split_valid(dirty(spark, sf)[1], quality.popularity_rules())[1].select(
        *POPULARITY_KEY, "popularity_score", "city_rank"
    )


def queries() -> dict[str, Query]:
    """Names end where the function name adds `_` to step around an imported one."""
    return {name.rstrip("_"): function for name, function in QUERIES.items()}
