"""Exact line deduplication over documents that arrive in batches.

The hashes of all lines seen so far live in sorted runs, bucketed tables in the shared folder. A batch reduces its
lines to one row per key, merge-joins that with the runs, and adds the keys not found as a run of its own. Runs have
levels: `fanout` runs of one level are compacted into one of the next, so each key is rewritten a logarithmic number of
times and a batch meets few runs.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bizpulse.llm.common import binary_texts, free_name, text_batches
from bizpulse.session import materialize, scratch_path

MIN_CHARS = 10
KEY = ["h1", "h2"]
NO_ID = -(2**63)


def line_key(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """16-byte hash of the stripped, A-Z lower-cased line; None if that has fewer than `min_chars` code points."""
    key = line.strip().lower()  # of bytes: both know ASCII only
    if len(key) < min_chars or len(key) < 4 * min_chars and sum(b & 0xC0 != 0x80 for b in key) < min_chars:
        return None
    return hashlib.blake2b(key, digest_size=16).digest()


class LineRuns:
    """Levelled sorted runs of line hashes. `buckets` is fixed for the life of the runs."""

    def __init__(self, spark: SparkSession, fanout: int = 3, buckets: int | None = None):
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []

    def _write(self, keys: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        path = scratch_path(self.spark, name)
        writer = keys.repartition(self.buckets, *KEY).write.option("path", path)
        writer.bucketBy(self.buckets, *KEY).sortBy(*KEY).saveAsTable(name)
        return name

    def add(self, keys: DataFrame) -> None:
        """Add keys that no run holds, then compact every level that is full."""
        runs, level = [self._write(keys)], 0
        while runs:
            self.levels += [[]] * (level == len(self.levels))
            self.levels[level] = self.levels[level] + runs
            runs = []
            if len(self.levels[level]) >= self.fanout:
                old, self.levels[level] = self.levels[level], []
                parts = [self.spark.table(t) for t in old]
                whole = parts[0]
                for part in parts[1:]:
                    whole = whole.unionAll(part)
                runs = [self._write(whole)]
                for table in old:
                    self.spark.sql(f"DROP TABLE {table}")
                level += 1

    def flag(self, keys: DataFrame) -> DataFrame:
        """`keys` with a column `known`: whether a run holds the key. One merge join per run, in which neither the
        run nor, after its first exchange, the batch is shuffled again."""
        known = F.lit(False)
        for i, table in enumerate(t for level in self.levels for t in level):
            keys = keys.join(self.spark.table(table).withColumn(f"_in{i}", F.lit(True)).hint("merge"), KEY, "left")
            known = known | F.coalesce(F.col(f"_in{i}"), F.lit(False))
        return keys.select("*", known.alias("_known")).drop(*(c for c in keys.columns if c.startswith("_in"))).withColumnRenamed("_known", "known")

    def drop(self) -> None:
        for table in (t for level in self.levels for t in level):
            self.spark.sql(f"DROP TABLE {table}")
        self.levels = []


def _pairs(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, counts, keys = batch.column(0), [], []
            for text in binary_texts(batch.column(1)):
                own = {line_key(line, min_chars) for line in text.split(b"\n")}
                own.discard(None)
                keys += own
                counts.append(len(own))
            halves = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)
            repeated = ids.take(pa.array(np.repeat(np.arange(len(ids)), counts)))
            yield pa.RecordBatch.from_arrays([repeated, pa.array(halves[:, 0]), pa.array(halves[:, 1])], ["id", *KEY])

    return run


def _kept(min_chars: int):
    @F.arrow_udf("struct<text: string, n_lines: bigint, n_dropped: bigint>")
    def kept(texts: pa.Array, drops: pa.Array) -> pa.Array:
        out, lines, dropped = [], [], []
        for text, drop in zip(binary_texts(texts), drops.to_pylist()):
            if drop:
                gone, own = set(drop), text.split(b"\n")
                left = [line for line in own if line_key(line, min_chars) not in gone]
                lines.append(len(own))
                dropped.append(len(own) - len(left))
                text = b"\n".join(left)
            else:
                lines.append(text.count(b"\n") + 1)
                dropped.append(0)
            out.append(text)
        arrays = [pa.array(out, pa.binary()).cast(pa.string()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())]
        return pa.StructArray.from_arrays(arrays, ["text", "n_lines", "n_dropped"])

    return kept


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, batches: int = 3, runs: LineRuns | None = None
) -> DataFrame:
    """Drop every line whose key (stripped, A-Z lower-cased, at least `min_chars` code points) another document with a
    smaller id holds.

    Returns the columns of `docs` with `text_col` cut to the kept lines, then `n_lines` and `n_dropped`; input columns of
    those two names are replaced. The documents are cut into `batches` ranges of ids that arrive in order; pass `runs`
    to go on from earlier arrivals, whose documents count as having smaller ids.

    Null or empty text: one empty line, the text comes back empty. Rows of equal id are one document and drop nothing from
    each other. A null id sorts before all others. A document may lose all its lines; its row stays. Hashes have 128 bits.
    """
    spark = docs.sparkSession
    text_batches(spark)
    own = runs is None
    runs = runs or LineRuns(spark)
    key_id = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))
    pairs = docs.select(key_id.alias("id"), F.col(text_col).alias("text"))
    pairs = materialize(pairs.mapInArrow(_pairs(min_chars), "id long, h1 long, h2 long"), "line-pairs")

    shares = [i / batches for i in range(1, batches)]
    cuts = pairs.agg(F.percentile_approx("id", shares, 1000).alias("c")).first()["c"] if shares else []
    number = F.lit(0)
    for cut in sorted(set(cuts or [])):
        number = number + F.when(F.col("id") > cut, 1).otherwise(0)
    pairs = pairs.withColumn("batch", number)
    shared = []
    for batch in range(len(set(cuts or [])) + 1):
        keys = pairs.filter(F.col("batch") == batch).groupBy(*KEY).agg(F.min("id").alias("first"), F.max("id").alias("last"))
        flagged = materialize(runs.flag(keys), "line-keys")
        runs.add(flagged.filter("NOT known").select(*KEY))
        # A key that runs hold belongs to an earlier document, so no document of this batch keeps it.
        owner = F.when(~F.col("known"), F.col("first"))
        shared.append(flagged.filter("known OR first < last").select(*KEY, F.lit(batch).alias("batch"), owner.alias("owner")))
    owners = shared[0]
    for part in shared[1:]:
        owners = owners.unionAll(part)
    drop_name, id_name = free_name(docs, "drop_keys"), free_name(docs, "drop_id")
    drops = (
        pairs.join(owners.hint("merge"), [*KEY, "batch"])
        .filter(F.col("owner").isNull() | (F.col("owner") != F.col("id")))
        .groupBy(F.col("id").alias(id_name))
        .agg(F.collect_set(F.unhex(F.concat(_hex16("h1"), _hex16("h2")))).alias(drop_name))
    )
    if own:
        drops = materialize(drops, "line-drops")
        runs.drop()
    result = free_name(docs, "line_result")
    marked = docs.withColumn(id_name, key_id).join(drops.hint("merge"), id_name, "left")
    marked = marked.withColumn(result, _kept(min_chars)(F.col(text_col), F.col(drop_name)))
    columns = [F.col(f"{result}.text").alias(c) if c == text_col else F.col(c) for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return marked.select(*columns, f"{result}.n_lines", f"{result}.n_dropped")


def _hex16(column: str):
    """Hex of a long's 8 bytes, lowest byte first, as in the hash it was cut from."""
    big = F.lpad(F.hex(F.col(column)), 16, "0")
    return F.concat(*(F.substring(big, 15 - 2 * i, 2) for i in range(8)))
