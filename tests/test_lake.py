import datetime as dt
import os

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from bizpulse.operators import merging
from bizpulse.sources import lake, readers

DDL = "id string, day date, v int"
A, B, C = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)


@pytest.fixture
def make(spark):
    return lambda data, ddl=DDL: spark.createDataFrame(data, ddl)


@pytest.fixture
def table(spark, make, folder):
    path = f"{folder}/t"
    lake.write_table(make([("x", A, 1), ("y", A, 2), ("x", B, 3)]), path, "overwrite", ["day"])
    return path


def read(spark, path):
    return rows(readers.read_table(spark, path, ["id", "day", "v"]))


def test_partition_overwrite_touches_only_its_partitions(spark, make, table):
    lake.overwrite_partitions(make([("z", A, 9)]), table, ["day"], balance=True, cluster_by=["id"])
    assert read(spark, table) == [("x", B, 3), ("z", A, 9)]
    lake.overwrite_partitions(make([]), table, ["day"])
    assert read(spark, table) == [("x", B, 3), ("z", A, 9)]


def test_upsert_updates_inserts_and_repeats(spark, make, table):
    source = make([("x", A, 10), ("new", B, 20), ("only", C, 30)])
    for _ in range(2):
        lake.upsert(spark, source, table, ["id", "day"], ["day"])
        assert read(spark, table) == [("new", B, 20), ("only", C, 30), ("x", A, 10), ("x", B, 3), ("y", A, 2)]


def test_upsert_leaves_other_partitions_alone(spark, make, table):
    before = sorted(os.listdir(f"{table}/day=2024-01-02"))
    lake.upsert(spark, make([("x", A, 10)]), table, ["id", "day"], ["day"])
    assert sorted(os.listdir(f"{table}/day=2024-01-02")) == before


def test_upsert_keeps_stale_rows_when_the_source_shrinks(spark, make, table):
    lake.upsert(spark, make([("x", A, 1)]), table, ["id", "day"], ["day"])
    assert ("y", A, 2) in read(spark, table)


def test_upsert_moves_rows_between_partitions(spark, make, folder):
    path = f"{folder}/t"
    lake.upsert(spark, make([("x", A, 1), ("y", A, 2)]), path, ["id"], ["day"])
    lake.upsert(spark, make([("x", B, 5)]), path, ["id"], ["day"])
    assert read(spark, path) == [("x", B, 5), ("y", A, 2)]


def test_upsert_without_partitions_creates_then_updates(spark, make, folder, caplog):
    path = f"{folder}/t"
    lake.upsert(spark, make([("x", A, 1)]), path, ["id"], ["nope"])
    assert "absent columns" in caplog.text
    lake.upsert(spark, make([("x", A, 2), ("y", A, 1)]), path, ["id"])
    assert read(spark, path) == [("x", A, 2), ("y", A, 1)]


def test_upsert_of_nothing_changes_nothing(spark, make, table):
    before = read(spark, table)
    lake.upsert(spark, make([]), table, ["id", "day"], ["day"])
    assert read(spark, table) == before


@pytest.mark.parametrize(
    ("data", "message"), [([("x", A, 1), ("x", A, 2)], "duplicate source key: x"), ([(None, A, 1)], "null in source key")]
)
def test_upsert_rejects_bad_keys_and_leaves_the_table(spark, make, table, data, message):
    before = read(spark, table)
    with pytest.raises(Exception, match=message):
        lake.upsert(spark, make(data), table, ["id", "day"], ["day"])
    assert read(spark, table) == before


def test_upsert_needs_its_key_columns(spark, make, table):
    with pytest.raises(ValueError, match="key columns missing"):
        lake.upsert(spark, make([]), table, ["nope"])


SLICES = [{"day": A}, {"day": B}]


@pytest.mark.parametrize("partition_by", [["day"], []])
def test_replace_slice_drops_stale_rows(spark, make, folder, partition_by):
    path = f"{folder}/t"
    first = make([("x", A, 1), ("y", A, 2), ("x", B, 3), ("x", C, 4)])
    lake.replace_slice(spark, first, path, ["day"], partition_by=partition_by)
    for _ in range(2):
        lake.replace_slice(spark, make([("x", A, 7)]), path, ["day"], partition_by=partition_by)
        assert read(spark, path) == [("x", A, 7), ("x", B, 3), ("x", C, 4)]
    # a slice that is named but has no rows is emptied
    lake.replace_slice(spark, make([("z", A, 8)]), path, ["day"], SLICES, partition_by)
    assert read(spark, path) == [("x", C, 4), ("z", A, 8)]
    lake.replace_slice(spark, make([]), path, ["day"], [{"day": C}], partition_by)
    assert read(spark, path) == [("z", A, 8)]


def test_replace_slice_checks_its_arguments(spark, make, table):
    with pytest.raises(ValueError, match="exactly the columns"):
        lake.replace_slice(spark, make([]), table, ["day"], [{"id": 1}], ["day"])
    before = read(spark, table)
    for partition_by in (["day"], []):
        with pytest.raises(Exception, match="outside the given slices"):
            lake.replace_slice(spark, make([("x", C, 1)]), table, ["day"], SLICES, partition_by)
    assert read(spark, table) == before


def test_replace_slice_with_text_partitions_and_null(spark, folder):
    path, ddl = f"{folder}/t", "id string, p string"
    odd = [("1", "a b"), ("2", "50%/x=1"), ("3", None), ("4", "plain")]
    lake.replace_slice(spark, spark.createDataFrame(odd, ddl), path, ["p"], partition_by=["p"])
    gone = [{"p": "50%/x=1"}, {"p": None}, {"p": "a b"}]
    lake.replace_slice(spark, spark.createDataFrame([], ddl), path, ["p"], gone, ["p"])
    assert rows(readers.read_table(spark, path)) == [("4", "plain")]


@pytest.mark.parametrize(
    ("ddl", "values"),
    [
        ("timestamp", [dt.datetime(2024, 1, 1, 5), dt.datetime(2024, 1, 1, 6, 30, 1), None]),
        ("boolean", [True, False, None]),
        ("string", ["a=b c", "x/y%20", "é", None]),
    ],
)
def test_partitions_of_any_type_are_cleared(spark, folder, ddl, values):
    """Listed slices without rows are emptied, the others stay, and the column keeps its type."""
    for k, gone in enumerate(values):
        path = f"{folder}/{k}"
        data = spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], f"id string, p {ddl}")
        lake.replace_slice(spark, data, path, ["p"], partition_by=["p"])
        before = dict(readers.read_table(spark, path).dtypes)
        lake.replace_slice(spark, data.limit(0), path, ["p"], [{"p": gone}], ["p"])
        after = readers.read_table(spark, path)
        assert [r[0] for r in rows(after.select("id"))] == [str(i) for i in range(len(values)) if i != k]
        assert dict(after.dtypes) == before or None in values and gone is not None and dict(after.dtypes)["p"] == ddl


def test_only_directories_of_files_are_cleared(spark, make, table):
    with pytest.raises(ValueError, match="not plain directories"):
        lake._empty_partitions(readers.read_table(spark, table), [{"day": A}], "delta")


def test_key_check_reads_and_hashes_keys_only(spark, table):
    seen = readers.read_table(spark, table)
    plan = plan_of(seen.groupBy("id", "day").count())
    assert "SortAggregate" not in plan
    assert merging.one_per_key(seen, ["id", "day"]) is seen


def test_slice_that_is_no_partition_rewrites_only_where_it_lies(spark, make, folder):
    path = f"{folder}/t"
    lake.replace_slice(spark, make([("x", A, 1), ("y", A, 2), ("x", B, 3), ("y", C, 4)]), path, ["id"], partition_by=["day"])
    untouched = sorted(os.listdir(f"{path}/day=2024-01-03"))
    lake.replace_slice(spark, make([("x", A, 9)]), path, ["id"], partition_by=["day"])
    assert read(spark, path) == [("x", A, 9), ("y", A, 2), ("y", C, 4)]
    assert sorted(os.listdir(f"{path}/day=2024-01-03")) == untouched
    lake.replace_slice(spark, make([]), path, ["id"], [{"id": "y"}], ["day"])
    assert read(spark, path) == [("x", A, 9)]


def test_seed_keeps_existing_rows(spark, folder):
    path, ddl = f"{folder}/t", "id int, name string"
    lake.seed_rows(spark, spark.createDataFrame([(1, "mine")], ddl), path, ["id"])
    for _ in range(2):
        lake.seed_rows(spark, spark.createDataFrame([(1, "other"), (2, "two")], ddl), path, ["id"])
    assert rows(readers.read_table(spark, path)) == [(1, "mine"), (2, "two")]


def test_default_column(spark):
    df = spark.createDataFrame([(1, None), (2, "set")], "id int, region string")
    assert rows(merging.with_default_column(df, "region", F.lit("Unknown"))) == [(1, "Unknown"), (2, "set")]
    assert rows(merging.with_default_column(df.drop("region"), "region", F.lit("U"))) == [(1, "U"), (2, "U")]


def test_counts_come_with_the_write(spark, make, folder):
    data = make([("x", A, 1), (None, A, -1), ("y", B, None)])
    counts = lake.write_counted(data, lambda df: lake.write_table(df, f"{folder}/t"), ["id", "v"], F.col("v") < 0)
    assert counts == {"rows": 3, "null_id": 1, "null_v": 1, "rejected": 1}


def test_registered_table_and_view(spark, table):
    lake.register_table(spark, table, "registered_t", "registered_v")
    assert spark.table("registered_v").count() == 3
    assert spark.sql("SELECT v FROM registered_v WHERE day = DATE '2024-01-02'").first().v == 3
    lake.register_table(spark, table, "registered_t")
    with pytest.raises(ValueError, match="registered over"):
        lake.register_table(spark, f"{table}-other", "registered_t")


def test_files_are_capped_and_balanced(spark, folder):
    df = spark.range(1000).repartition(8).select(F.col("id").cast("string").alias("id"), F.lit(A).alias("day"))
    lake.write_table(df, f"{folder}/one", "overwrite", ["day"], balance=True)
    assert len([f for f in os.listdir(f"{folder}/one/day=2024-01-01") if f.endswith(".parquet")]) == 1
    lake.write_table(df, f"{folder}/many", "overwrite", ["day"], {"maxRecordsPerFile": "300"}, balance=True)
    assert len([f for f in os.listdir(f"{folder}/many/day=2024-01-01") if f.endswith(".parquet")]) == 4


def test_scan_prunes_partitions_and_pushes_filters(spark, table):
    df = readers.read_table(spark, table, ["id"], [F.col("day") == F.lit(A), F.col("v") > 1])
    assert rows(df) == [("y",)]
    plan = plan_of(df)
    assert "PartitionFilters: [isnotnull(day" in plan and "GreaterThan(v,1)" in plan
    assert "ReadSchema: struct<id:string,v:int>" in plan


def test_read_json_with_and_without_schema(spark, folder):
    path = f"{folder}/j"
    spark.createDataFrame([("x", 1)], "id string, extra int").write.json(path)
    assert readers.read_json(spark, path, "id string").columns == ["id"]
    assert set(readers.read_json(spark, path).columns) == {"id", "extra"}
    with pytest.raises(ValueError, match="path"):
        readers.read_json(spark, " ")


def test_missing_table_reads_as_none(spark, folder):
    assert readers.read_table_if_exists(spark, f"{folder}/none") is None
    os.mkdir(f"{folder}/empty")
    assert readers.read_table_if_exists(spark, f"{folder}/empty") is None


def test_document_store_options(spark):
    got = readers.document_store_options("mongodb://h", "db", "review", {"x": "1"})
    assert got == {"connection.uri": "mongodb://h", "database": "db", "collection": "review", "x": "1"}
    with pytest.raises(ValueError, match="uri, collection"):
        readers.document_store_options("", "db", " ")
    with pytest.raises(ValueError, match="source must be"):
        readers.read_raw(spark, "tip", "queue", None)


def test_merge_into_needs_a_row_level_table(spark, table, make):
    lake.register_table(spark, table, "plain_t")
    with pytest.raises(Exception, match="(?i)merge"):
        lake.merge_into(make([("x", A, 1)]), "plain_t", ["id", "day"])


def test_a_run_that_dies_before_it_clears_is_mended_by_the_same_run(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    lake.write_table(spark.createDataFrame([("a", A, 1), ("b", B, 2), ("c", C, 3)], DDL), path, partition_by=["day"])
    source, slices = spark.createDataFrame([("n", A, 9)], DDL), [{"day": A}, {"day": B}]
    with monkeypatch.context() as m:
        m.setattr(lake, "_empty_partitions", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            lake.replace_slice(spark, source, path, ["day"], slices, ["day"])
    assert rows(spark.read.parquet(path).select("id")) == [("b",), ("c",), ("n",)]
    lake.replace_slice(spark, source, path, ["day"], slices, ["day"])
    assert rows(spark.read.parquet(path).select("id")) == [("c",), ("n",)]


def test_too_many_partitions_are_refused_before_anything_is_written(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    lake.write_table(spark.createDataFrame([("a", A, 1)], DDL), path, partition_by=["day"])
    monkeypatch.setattr(lake, "MOST_PARTITIONS", 1)
    with pytest.raises(ValueError, match="more than 1 partitions"):
        lake.upsert(spark, spark.createDataFrame([("a", A, 2), ("b", B, 2)], DDL), path, ["id", "day"], ["day"])
    assert rows(spark.read.parquet(path).select("id", "v")) == [("a", 1)]


@pytest.mark.parametrize("listed", [0, 1000])
def test_few_slices_are_filtered_and_not_joined(spark, tmp_path, monkeypatch, listed):
    """A slice of the target is not moved to one task; more slices than the limit are joined. Null is a slice of its own."""
    monkeypatch.setattr(lake, "MOST_LISTED_SLICES", listed)
    joins, merged = [], merging.replace_slice_rows
    monkeypatch.setattr(lake, "replace_slice_rows", lambda *a: joins.append(1) or merged(*a))
    path, ddl = str(tmp_path / "t"), "k int, part string, month string"
    lake.write_table(spark.createDataFrame([(1, "a", "m1"), (2, "a", "m2"), (3, "b", None), (4, "b", "m3"), (5, "c", "m3")], ddl), path, partition_by=["part"])
    source = spark.createDataFrame([(10, "a", "m1"), (11, "d", None)], ddl)
    lake.replace_slice(spark, source, path, ["month"], partition_by=["part"])
    after = [(2, "m2", "a"), (4, "m3", "b"), (5, "m3", "c"), (10, "m1", "a"), (11, None, "d")]
    assert rows(spark.read.parquet(path)) == sorted(after, key=lambda t: tuple((v is not None, str(v)) for v in t))
    lake.replace_slice(spark, source.limit(0), path, ["month"], [{"month": "m3"}, {"month": "m1"}], ["part"])
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == [2, 11]
    assert len(joins) == (0 if listed else 2)


def test_sorted_writes_have_small_tasks(spark, tmp_path):
    """Sorted rows must fit a task's memory, so a run-time balanced write makes more tasks; the session's own size wins."""
    key, own = "spark.sql.adaptive.advisoryPartitionSizeInBytes", spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None)
    seen = []

    class Seen(type(spark.range(1).write)):
        def save(self, *args, **kwargs):
            seen.append(spark.conf.get(key, None))
            return super().save(*args, **kwargs)

    df = spark.range(10).withColumn("day", F.col("id") % 2)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(type(df), "write", property(lambda d: Seen(d)))
        lake.write_table(df, f"{tmp_path}/a", partition_by=["day"], cluster_by=["id"], balance=True)
        lake.write_table(df, f"{tmp_path}/b", partition_by=["day"], balance=True)
        spark.conf.set(key, "3m")
        lake.write_table(df, f"{tmp_path}/c", partition_by=["day"], cluster_by=["id"], balance=True)
    spark.conf.set(key, own) if own else spark.conf.unset(key)
    assert seen == [own or "16m", own, "3m"] and spark.conf.get(key, None) == own
    assert spark.read.parquet(f"{tmp_path}/a").count() == 10
