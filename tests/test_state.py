"""Monthly state, maintained summaries, checked writes, defaults in the catalog and dumps of a document store."""

import datetime as dt
import gzip
import io
import json
import os

import pytest
from conftest import SF, plan_of, rows
from pyspark.sql import functions as F

from bizpulse.operators import quality, serving, state, summaries
from bizpulse.plans import state as jobs
from bizpulse.session import materialize
from bizpulse.sources import checked, dumps, lake, readers, versions
from checks import catalog

REVIEW = "business_id string, review_id string, user_id string, date date, stars int, useful int, funny int, cool int, day date"
TIP = "business_id string, user_id string, date timestamp, compliment_count int, day date"
JAN = [dt.date(2024, 1, d) for d in range(1, 32)]


@pytest.fixture
def database(spark, tmp_path):
    name = f"db_{abs(hash(str(tmp_path)))}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/db'")
    return name


def write_silver(spark, root, reviews, tips):
    """reviews: (business, review, user, day, stars); tips: (business, user, day, compliments)."""
    of_reviews = [(b, r, u, d, s, 1, None, 2, d) for b, r, u, d, s in reviews]
    of_tips = [(b, u, dt.datetime(d.year, d.month, d.day, 9), c, d) for b, u, d, c in tips]
    lake.write_table(spark.createDataFrame(of_reviews, REVIEW), f"{root}/review_snapshot", "overwrite", ["day"])
    lake.write_table(spark.createDataFrame(of_tips, TIP), f"{root}/tip_snapshot", "overwrite", ["day"])


def direct(spark, root):
    from bizpulse.operators.facts import fact_for_period

    events = [readers.read_table(spark, f"{root}/{t}_snapshot") for t in ("review", "tip")]
    return rows(fact_for_period(*events, "2024-01-31", 2, by_event_day=True))


def test_month_from_state(spark, tmp_path):
    """Repeated ids on one day and over days, null stars, a hot business, days loaded again with fewer events, an emptied day."""
    root, target = str(tmp_path / "silver"), str(tmp_path / "state")
    reviews = [("b1", f"r{i % 40}", f"u{i % 7}", JAN[i % 5], None if i % 4 == 0 else i % 5) for i in range(200)]
    reviews += [("b2", "r900", "u1", JAN[30], None), ("b3", "r1", "u1", JAN[0], 4)]
    tips = [("b1", f"u{i % 9}", JAN[i % 6], i % 3 or None) for i in range(50)] + [("b4", "u1", JAN[2], None)]
    write_silver(spark, root, reviews, tips)
    for days in (JAN[:4], JAN[4:], [JAN[1]]):
        jobs.update_state(spark, root, target, days)
    assert rows(jobs.month_from_state(spark, target, "2024-01-10")) == direct(spark, root)
    reviews = [r for r in reviews if r[3] != JAN[0]][10:] + [("b1", "new", "unew", JAN[3], 5)]
    write_silver(spark, root, reviews, [t for t in tips if t[2] != JAN[0]])
    jobs.update_state(spark, root, target, [JAN[0], JAN[1], JAN[2], JAN[3], JAN[4]])
    assert rows(jobs.month_from_state(spark, target, "2024-01-31")) == direct(spark, root)
    numbers = spark.read.parquet(f"{target}/{jobs.NUMBERS}")
    for kind in (state.REVIEW, state.USER):
        own = sorted(r.number for r in numbers.filter(F.col("kind") == kind).collect())
        assert own == list(range(1, len(own) + 1))
    assert numbers.groupBy("kind", "id").count().filter("count > 1").isEmpty()


def test_a_day_reads_that_day_and_a_month_reads_state_only(spark, tmp_path):
    root, target = str(tmp_path / "silver"), str(tmp_path / "state")
    write_silver(spark, root, [("b", f"r{i}", "u", JAN[i], 3) for i in range(31)], [("b", "u", JAN[i], 1) for i in range(31)])
    jobs.update_state(spark, root, target, JAN)
    plan = plan_of(jobs.month_from_state(spark, target, "2024-01-31"))
    assert "silver" not in plan and plan.count("PartitionFilters: [isnotnull(day") >= 2
    with pytest.raises(ValueError):
        jobs.update_state(spark, root, target, [])


def test_bitmaps_over_many_buckets(spark):
    ids = spark.range(100_000).select(F.lit("b").alias("business_id"), F.lit(JAN[0]).alias("day"), F.lit(1).alias("measure"), F.lit("review").alias("kind"), F.col("id").cast("string").alias("id"))
    numbers = state.new_numbers(ids.repartition(13), None)
    got = numbers.agg(F.min("number"), F.max("number"), F.count_distinct("number")).first()
    assert tuple(got) == (1, 100_000, 100_000)
    maps = state.day_bitmaps(ids.unionAll(ids.limit(10)), numbers)
    assert maps.count() == 4 and maps.agg(F.sum(F.bitmap_count("bits"))).first()[0] == 100_000


def test_bitmaps_of_few_ids_are_small(spark):
    """Ids far apart, the first and last bit of a word and of a bucket, and repeated ids."""
    at = [1, 2, 64, 65, 128, 32767, 32768, 32769, 5 * 32768, 900_000]
    ids = spark.createDataFrame([("b", JAN[i % 2], 1, "review", f"r{n}") for i in (0, 1, 1) for n in at[i * 3 :]], "business_id string, day date, measure int, kind string, id string")
    numbers = spark.createDataFrame([("review", f"r{n}", n) for n in at], "kind string, id string, number long")
    maps = state.day_bitmaps(ids, numbers)
    sizes = maps.groupBy("day").agg(F.sum(F.length("bits")), F.sum(F.bitmap_count("bits"))).collect()
    assert {r.day: r[2] for r in sizes} == {JAN[0]: 10, JAN[1]: 7} and all(r[1] <= 8 * 10 for r in sizes)
    back = state.bitmap_words(maps).filter(F.col("day") == JAN[0]).collect()
    found = [(r.bucket - 1) * 32768 + r.word * 64 + b + 1 for r in back for b in range(64) if (r.own >> b) & 1]
    assert sorted(found) == at


def test_city_sums_follow_the_tables(spark, tmp_path):
    fact, scores = catalog.gold(spark, SF)
    months = [dt.date.fromisoformat(m) for m in catalog.MONTHS]
    target = str(tmp_path)
    jobs.update_city_sums(spark, scores, fact, target, months)

    def same(scores, fact):
        sums = jobs.read_city_sums(spark, target)
        period = "2024-01"
        assert rows(summaries.top_cities(sums)) == rows(serving.top_cities(scores, digits=9))
        assert rows(summaries.city_dashboard(sums)) == rows(serving.city_dashboard(fact, scores, digits=9))
        assert rows(summaries.city_time_series(sums)) == rows(serving.city_time_series(scores, digits=9))
        assert rows(summaries.city_period_average(sums, period)) == rows(serving.city_period_average(scores, period, digits=9))

    same(scores, fact)
    # December loses a city and gains nulls; February is emptied. Only those months are handed in.
    december, february = F.col("day") == F.lit(months[0]), F.col("day") == F.lit(months[2])
    city = scores.select(F.min("city")).first()[0]
    changed = scores.filter(~february & (~december | (F.col("city") != city))).withColumn(
        "popularity_score", F.when(december & (F.col("city_rank") == 1), None).otherwise(F.col("popularity_score"))
    )
    jobs.update_city_sums(spark, changed.filter(december), fact, target, [months[0], months[2]])
    same(changed, fact)


def test_checked_write_is_one_scan_and_publishes_within_its_limit(spark, database, tmp_path):
    df = spark.range(100).select("id", F.when(F.col("id") % 10 == 0, None).otherwise(F.col("id") % 7).alias("v"))
    rules = {"small": F.col("v") < 1, "odd": (F.col("id") % 2 == 1) & (F.col("v") == 2)}
    table, root = f"{database}.t", str(tmp_path / "t")
    jobs_before = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("checked", "checked")
    counts = checked.checked_write(df, rules, table, root, most_bad=0.5)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs_before.getJobIdsForGroup("checked")) <= 2  # the write, and nothing that reads the rows again
    small, odd = df.filter(rules["small"]).count(), df.filter(rules["odd"]).count()
    bad = df.filter(F.coalesce(rules["small"] | rules["odd"], F.lit(False))).count()
    assert counts == {"rows": 100, "bad": bad, "small": small, "odd": odd}
    assert spark.table(table).columns == ["id", "v"] and spark.table(table).count() == 100 - bad
    assert rows(spark.table(f"{table}_quarantine").groupBy(F.array_join("broken_rules", ",")).count()) == [("odd", odd), ("small", small)]
    with pytest.raises(checked.TooManyBadRows) as refused:
        checked.checked_write(df, rules, table, root, most_bad=0.1)
    assert refused.value.counts["bad"] == bad and spark.table(table).count() == 100 - bad
    assert spark.read.parquet(refused.value.path).count() == 100
    assert checked.checked_write(df.filter("id = 1"), rules, table, root) == {"rows": 1, "bad": 0, "small": 0, "odd": 0}
    assert spark.table(table).count() == 1 and spark.table(f"{table}_quarantine").count() == 0
    assert checked.checked_write(df.limit(0), rules, table, root)["rows"] == 0 and spark.table(table).count() == 0
    assert len(versions.drop_old_versions(spark, table, root, keep=[versions.location(spark, f"{table}_quarantine")])) >= 3
    with pytest.raises(ValueError, match="taken"):
        checked.checked_write(df.withColumn("Broken_Rules", F.lit(1)), rules, table, root)
    with pytest.raises(ValueError, match="no rules"):
        checked.checked_write(df, {}, table, root)


def test_all_rows_bad(spark, database, tmp_path):
    rules = quality.popularity_rules()
    df = spark.createDataFrame([(7, 2.0, 0)], "granularity int, popularity_score double, city_rank int")
    counts = checked.checked_write(df, rules, f"{database}.t", str(tmp_path / "t"), most_bad=1.0, quarantine=f"{database}.bad")
    assert counts == {"rows": 1, "bad": 1, "granularity": 1, "popularity_score": 1, "city_rank": 1}
    assert spark.table(f"{database}.t").count() == 0 and spark.table(f"{database}.bad").first().broken_rules == list(rules)


def test_defaults_of_the_catalog_answer_for_old_files(spark, database, tmp_path):
    name = f"{database}.t"
    spark.range(3).write.option("path", f"{tmp_path}/t").saveAsTable(name)
    assert lake.add_column(spark, name, "region", "string", "'Unknown'") and not lake.add_column(spark, name, "Region", "string", "'x'")
    spark.sql(f"INSERT INTO {name} VALUES (3, 'north'), (4, NULL)")
    spark.sql(f"INSERT INTO {name} (id) VALUES (5)")
    assert rows(spark.table(name)) == [(0, "Unknown"), (1, "Unknown"), (2, "Unknown"), (3, "north"), (4, None), (5, "Unknown")]
    assert spark.table(name).filter("region = 'Unknown'").count() == 4
    plan = plan_of(spark.table(name))
    assert "mergeSchema" not in plan


def test_rows_per_file(spark, tmp_path):
    for limit, most in ((7, 7), (0, 25)):
        path = f"{tmp_path}/{limit}"
        lake.write_table(spark.range(100).repartition(4), path, options={"maxRecordsPerFile": str(limit)})
        files = lake.rows_per_file(spark.read.parquet(path))
        assert files.agg(F.sum("row_count"), F.max("row_count")).first()[:] == (100, most)
        assert "ReadSchema: struct<>" in plan_of(files)


# -- dumps


def test_every_line_belongs_to_one_range():
    data = b"".join(b'{"i":%d,"t":"%s"}\n' % (i, b"x" * (i % 9)) for i in range(50)) + b"\n  \n" + b'{"i":50}'
    for size in (1, 2, 5, 13, 64, 4096):
        found = []
        for start in range(0, len(data), size):
            found += list(dumps.lines_of(io.BytesIO(data), start, min(start + size, len(data))))
        assert b"".join(line for _, line in found) == data and [at for at, _ in found] == sorted({at for at, _ in found})


SCHEMA = "id string not null, n int, big bigint, x double, ok boolean, date string"
DOCUMENTS = [
    ({"id": "a", "n": 1, "big": 2**40, "x": 1.5, "ok": True, "date": "2024-01-05"}, ("a", 1, 2**40, 1.5, True, "2024-01-05")),
    ({"id": {"$oid": "5f"}, "n": {"$numberInt": "7"}, "big": {"$numberLong": "-9"}, "x": {"$numberDouble": "-0.5"}, "date": {"$date": "2024-01-05T00:00:00Z"}}, ("5f", 7, -9, -0.5, None, "2024-01-05T00:00:00Z")),
    ({"id": None, "n": 2**31, "big": 2**63, "x": "abc", "ok": "yes", "extra": {"deep": [1]}}, (None, None, None, None, None, None)),
    ({"x": {"$numberDouble": "NaN"}, "n": 3.0, "big": 3.5, "date": {"$date": {"$numberLong": "5"}}, "id": ["é", {"k": 1}]}, ('["é",{"k":1}]', 3, None, float("nan"), None, "5")),
    ({}, (None,) * 6),
    ({"id": "long" * 50_000, "ok": False, "n": True}, ("long" * 50_000, None, None, None, False, None)),
]


@pytest.mark.parametrize("size", [37, 1000, 1 << 26])
def test_dump_types_and_ranges(spark, tmp_path, size):
    lines = [json.dumps(d, ensure_ascii=False) for d, _ in DOCUMENTS]
    (tmp_path / "one.json").write_text("\n".join(lines))
    folder = tmp_path / "many"
    folder.mkdir()
    for i, line in enumerate(lines):
        (folder / f"p{i}.json").write_text(line + "\n\n")
    (folder / "_SUCCESS").write_text("")
    (folder / ".hidden").write_text("not json")
    wanted = sorted(repr(t) for _, t in DOCUMENTS)
    if size == 37:
        size = 4001  # so long a document lies in many ranges
    for path in (tmp_path / "one.json", folder):
        df = dumps.read_dump(spark, str(path), SCHEMA, size)
        assert sorted(repr(tuple(r)) for r in df.collect()) == wanted
    few = dumps.read_dump(spark, str(folder), "n int", size)
    assert few.columns == ["n"] and sorted((r.n is not None, r.n or 0) for r in few.collect()) == [(False, 0)] * 3 + [(True, 1), (True, 3), (True, 7)]


def test_dump_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("é\n\"", 1, 2**50, 0.1, True), (None, None, None, None, None), ("\\$", -5, -1, 1e300, False)], "s string, i int, l bigint, d double, b boolean")
    dumps.write_dump(df, f"{tmp_path}/d")
    assert rows(dumps.read_dump(spark, f"{tmp_path}/d", "s string, i int, l bigint, d double, b boolean", 16)) == rows(df)
    dumps.write_dump(df.limit(0), f"{tmp_path}/e")
    assert dumps.read_dump(spark, f"{tmp_path}/e", "s string").count() == 0


@pytest.mark.parametrize("size", [1, 700, 1 << 20])
def test_compressed_dumps_are_cut_too(spark, tmp_path, size):
    """A file of one part and one of several, of which only the last part's size is known beforehand; and an empty one."""
    lines = [b'{"n": {"$numberInt": "%d"}, "s": "%s"}\n' % (i, b"x" * (i % 50)) for i in range(500)]
    (tmp_path / "a.json.gz").write_bytes(gzip.compress(b"".join(lines[:300])))
    (tmp_path / "b.json.gz").write_bytes(b"".join(gzip.compress(b"".join(lines[i : i + 50])) for i in range(300, 500, 50)))
    (tmp_path / "c.json.gz").write_bytes(gzip.compress(b""))
    df = dumps.read_dump(spark, str(tmp_path), "n int, s string", size)
    assert rows(df) == rows(spark.createDataFrame([(i, "x" * (i % 50)) for i in range(500)], "n int, s string"))
    if size < 1 << 20:
        assert 3 < df.rdd.getNumPartitions() <= 2 * dumps.PACKED_RANGES + 1


def test_dumps_are_written_compressed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(dumps, "FILE_ROWS", 100)
    df = spark.range(0, 250, 1, 1).selectExpr("id", "'the same words again' AS s")
    dumps.write_dump(df, f"{tmp_path}/d")
    files = list((tmp_path / "d").glob("part-*"))
    assert len(files) == 3 and sum(f.stat().st_size for f in files) < 250 * 20 / 2
    assert rows(dumps.read_dump(spark, f"{tmp_path}/d", "id bigint, s string", 500)) == rows(df)


def test_broken_dumps_are_refused(spark, tmp_path):
    (tmp_path / "bad.json").write_text('{"a": 1}\n{"a": \n')
    with pytest.raises(Exception, match="byte 9"):
        dumps.read_dump(spark, str(tmp_path / "bad.json"), "a int").collect()
    with pytest.raises(Exception, match="no dump"):
        dumps.read_dump(spark, str(tmp_path / "none"), "a int").collect()
    with pytest.raises(Exception, match="no way to read"):
        dumps.read_dump(spark, str(tmp_path / "bad.json"), "a array<int>").collect()
    with pytest.raises(ValueError, match="blank"):
        readers.read_raw(spark, "tip", "store", readers.T.StructType.fromDDL("a int"), store={"dump": " "})


def test_state_is_moved_to_its_days_once_and_ids_are_stored_once(spark, tmp_path, monkeypatch):
    root, target, stored, kept = str(tmp_path / "silver"), str(tmp_path / "state"), [], []
    write_silver(spark, root, [(f"b{i % 3}", f"r{i}", f"u{i % 5}", JAN[i % 31], 3) for i in range(62)], [("b", "u", JAN[i], 1) for i in range(31)])
    for module in (state, jobs):
        monkeypatch.setattr(module, "materialize", lambda df, label: stored.append(label) or materialize(df, label))
    write = jobs.replace_slice

    def seen(spark, df, *args, **kwargs):
        kept.append((plan_of(df).split("== Physical Plan ==")[1].count("REPARTITION_BY_COL"), kwargs["balance"]))
        write(spark, df, *args, **kwargs)

    monkeypatch.setattr(jobs, "replace_slice", seen)
    monkeypatch.setattr(state, "DAY_PART", 3)
    for days in (JAN[:20], JAN[10:]):
        jobs.update_state(spark, root, target, days)
    assert stored == ["met-ids"] * 2 and kept == [(1, False)] * 4
    assert rows(jobs.month_from_state(spark, target, "2024-01-10")) == direct(spark, root)


def test_shuffle_files_go_with_the_write(spark, tmp_path):
    folders = [d.getPath() for d in spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirs()]

    def files():
        return {f for top in folders for _, _, names in os.walk(top) for f in names if f.startswith("shuffle_")}

    before = files()
    lake.write_table(spark.range(1000).repartition(4, "id"), str(tmp_path / "t"))
    stored = materialize(spark.range(1000).repartition(4, "id"), "t")
    assert not files() - before
    assert stored.count() == 1000
