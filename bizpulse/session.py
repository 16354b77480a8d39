"""Session defaults and the shared scratch area."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown.string.predicate": "true",
}

_local_scratch: str | None = None


def build_session(app_name: str = "bizpulse", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's defaults; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the folder that `spark.checkpoint.dir` names.

    The folder must be one every executor sees. Only a local-mode session, where driver and executors share one
    machine, may leave the setting out.
    """
    global _local_scratch
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder before running on a cluster")
        _local_scratch = _local_scratch or tempfile.mkdtemp(prefix="bizpulse-")
        base = _local_scratch
    return f"{base.rstrip('/')}/bizpulse/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once to shared scratch and return a scan of it.

    Used where an expensive frame feeds several later steps: the source is then read a single time, lineage is cut,
    and a lost executor only costs a re-read.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with brief_shuffles(spark):
        df.write.options(**codec(spark)).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def codec(spark: SparkSession, fmt: str = "parquet") -> dict[str, str]:
    """Option of a writer that compresses Parquet by zstd, which takes a third less than Spark's own choice, unless the session names
    a codec itself."""
    named = spark.conf.get("spark.sql.parquet.compression.codec", None) is not None
    return {} if named or fmt != "parquet" else {"compression": "zstd"}


def small_tasks(spark: SparkSession, size: str = "16m") -> AbstractContextManager[None]:
    """Within it, tasks that Spark sizes at run time take about `size` of shuffled bytes, unless the session names a size itself.

    Rows take ten times the room when they are sorted, so at Spark's 64 MB a sort spills on every core of a usual executor.
    """
    return _setting(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", size)


def small_scans(spark: SparkSession, size: str = "32m") -> AbstractContextManager[None]:
    """Within it, tasks read about `size` of files, unless the session names a size itself: what a write sorts without a shuffle
    before it fits a task's memory."""
    return _setting(spark, "spark.sql.files.maxPartitionBytes", size)


def brief_shuffles(spark: SparkSession) -> AbstractContextManager[None]:
    """Within it, the shuffle files of a write go when it has ended, unless the session says otherwise itself; else they stay on disk
    until the driver happens to collect its garbage."""
    return _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    if spark.conf.get(key, None) is not None:
        yield
        return
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key)


def observed(seen: Observation) -> dict:
    """Metrics of a finished write. Empty when the optimizer saw that the frame has no rows and dropped the plan,
    metrics included; reading them then fails inside Spark."""
    try:
        return dict(seen.get)
    except Py4JJavaError as error:
        if "toPyRow" in str(error):
            return {}
        raise
