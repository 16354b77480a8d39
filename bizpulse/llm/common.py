"""Helpers that several operators of this package share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bizpulse.session import materialize

#: Rows of text that go to Python at once: bounds a worker's memory by the longest texts, not by their number.
TEXT_ROWS = 1024


def text_batches(spark: SparkSession, rows: int = TEXT_ROWS) -> None:
    """Hand texts to Python in batches of `rows` rows in this session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with underscores in front until no column of `df` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def binary_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null counts as empty."""
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def binaries(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())


def hash_sample(df: DataFrame, columns: list[str], most: int) -> DataFrame:
    """About `most` rows, never more: those with the smallest hashes of `columns`.

    The table is counted first and all but a share of it filtered out where it is read, so what tasks hand on to the final
    cut does not grow with their number.
    """
    count, key = df.count(), F.xxhash64(*columns)
    share = (1.2 * most + 50) / max(count, 1)
    if share < 1:
        df = df.filter(key <= int(-(2**63) + share * 2**64))
    return df.orderBy(key, *columns).limit(most)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers with well-spread bits (the finaliser of the splitmix generator)."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64, copy=True)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables made of whole groups of a partition sorted by `keys` (integers), each with its groups' bounds.

    A group that goes on in the next batch is held back, so no more than a batch and one group is in memory.
    """
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([held, table]) if held is not None else table
        new = np.zeros(table.num_rows - 1, dtype=bool)
        for key in keys:
            values = table[key].to_numpy()
            new |= values[1:] != values[:-1]
        bounds = np.concatenate([[0], np.flatnonzero(new) + 1])
        held = table.slice(int(bounds[-1])).combine_chunks()
        if len(bounds) > 1:
            yield table.slice(0, int(bounds[-1])).combine_chunks(), bounds
    if held is not None:
        yield held, np.array([0, held.num_rows])


def roots(linked, size: int) -> np.ndarray:
    """For each of `size` nodes, the first node of its connected part. linked(i, others) tells which of the nodes
    `others` are linked with node i; each node is asked once, about nodes not reached yet."""
    root = np.full(size, -1)
    rest = np.arange(size)
    while len(rest):
        first, rest = rest[0], rest[1:]
        root[first], queue = first, [first]
        while queue and len(rest):
            hit = linked(queue.pop(), rest)
            reached, rest = rest[hit], rest[~hit]
            root[reached] = first
            queue += reached.tolist()
    return root


def block_pairs(df: DataFrame, member: str, blocks: str) -> DataFrame:
    """Split groups of a known size into blocks: each row goes to every pair of blocks that has its own.

    `blocks` holds the number of blocks of the row's group. The pair is in columns `block_i` <= `block_j`, the row's
    own block in `block`; a group of n rows makes n * blocks rows, and each task holds two blocks at most.
    """
    own = F.pmod(F.xxhash64(member), F.col(blocks)).cast("int")
    return (
        df.withColumn("block", own)
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col(blocks).cast("int") - 1)))
        .withColumns({"block_i": F.least("block", "_other"), "block_j": F.greatest("block", "_other")})
        .drop("_other", blocks)
    )


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Connected components of undirected edges (a, b): rows (node, component), the smallest node naming each.

    Every round takes the smallest label among neighbours, then the label of that label, so long chains halve. Each
    round's labels are written to the shared scratch folder: lineage stays short and a lost executor costs a re-read.
    A hub's edges are read by joins that adaptive execution can split. Nodes without edges do not appear; null ends
    and loops are left out.
    """
    edges = edges.select("a", "b").filter("a <> b")
    both = materialize(edges.union(edges.select("b", "a")).distinct(), "edges")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("component"))
    labels = materialize(labels, "labels")
    for _ in range(most_rounds):
        near = (
            both.join(labels.withColumnsRenamed({"node": "b"}), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("_near"))
        )
        stepped = labels.join(near, "node").select(
            "node", F.col("component").alias("_was"), F.least("component", "_near").alias("_label")
        )
        further = labels.select(F.col("node").alias("_label"), F.col("component").alias("_further"))
        stepped = materialize(
            stepped.join(further, "_label").select("node", "_was", F.least("_label", "_further").alias("component")),
            "labels",
        )
        labels = stepped.select("node", "component")
        if stepped.filter("_was <> component").isEmpty():
            return labels
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
