"""Reading raw files, document-store collections and lake tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from bizpulse.sources.dumps import RANGE_BYTES, read_dump

DEFAULT_FORMAT = "parquet"


def _required(**values: str) -> None:
    blank = [name for name, value in values.items() if not value or not value.strip()]
    if blank:
        raise ValueError(f"must not be blank: {', '.join(blank)}")


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """JSON lines. With a schema nothing is scanned up front and fields outside it are dropped; without one Spark
    infers it, which costs an extra pass over the files."""
    _required(path=path)
    return (spark.read.schema(schema) if schema is not None else spark.read).json(path)


def document_store_options(
    uri: str, database: str, collection: str, extra: Mapping[str, str] | None = None
) -> dict[str, str]:
    """Reader options of the document-store connector."""
    _required(uri=uri, database=database, collection=collection)
    return {"connection.uri": uri, "database": database, "collection": collection, **(extra or {})}


def read_document_store(
    spark: SparkSession,
    uri: str,
    database: str,
    collection: str,
    schema: T.StructType | str | None = None,
    extra: Mapping[str, str] | None = None,
    fmt: str = "mongodb",
) -> DataFrame:
    """A collection through its Spark connector, which must be on the class path."""
    reader = spark.read.format(fmt).options(**document_store_options(uri, database, collection, extra))
    return (reader.schema(schema) if schema is not None else reader).load()


def read_raw(
    spark: SparkSession, table: str, source: str, schema: T.StructType, files: str = "", store: Mapping | None = None
) -> DataFrame:
    """One raw table from the run's chosen source: `files` (JSON under `<files>/<table>.json`) or `store`.

    A store is reached through its connector (uri, database and options), or read from its dump: `store["dump"]` names the folder
    that holds a file or folder per collection.
    """
    if source == "files":
        _required(files=files)
        return read_json(spark, f"{files.rstrip('/')}/{table}.json", schema)
    if source == "store":
        store = dict(store or {})
        if "dump" in store:
            _required(dump=store["dump"])
            return read_dump(spark, f"{store['dump'].rstrip('/')}/{table}", schema, int(store.get("range_bytes", RANGE_BYTES)))
        return read_document_store(
            spark, store.pop("uri", ""), store.pop("database", ""), table, schema=schema, extra=store
        )
    raise ValueError(f"source must be 'files' or 'store', not {source!r}")


def read_table(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] = (),
    conditions: Sequence[Column] = (),
    fmt: str = DEFAULT_FORMAT,
) -> DataFrame:
    """A lake table: conditions are AND-ed, then columns projected; an empty list means all.

    Conditions come first because they may use columns that are not projected. On partition columns they prune
    directories, on others they reach the scan as pushed filters.
    """
    df = spark.read.format(fmt).load(path)
    if conditions:
        df = df.filter(reduce(lambda a, b: a & b, conditions))
    return df.select(*columns) if columns else df


def read_table_if_exists(spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT) -> DataFrame | None:
    """The table, or None when nothing was ever written there."""
    try:
        return spark.read.format(fmt).load(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "DELTA_TABLE_NOT_FOUND"):
            return None
        raise
