"""Tables stored in buckets of a key, sorted by it, so that joins and aggregates on that key need no shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bizpulse.sources.readers import DEFAULT_FORMAT


def save_bucketed(
    df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int, sort_by: Sequence[str] = (), fmt: str = DEFAULT_FORMAT
) -> DataFrame:
    """Store `df` as the catalog table `table` at `path`: `buckets` files, each holding its share of the keys in order.

    Rows are shuffled once, by the same hash that places them in buckets, so each task writes one file. Tables with equal keys
    and numbers of buckets join bucket by bucket. A bucket holds whole keys: take as many buckets as make one fit a task, and
    keys of which none is hot. What is stored under the name and the path before is replaced.
    """
    if buckets < 1 or not keys:
        raise ValueError("at least one bucket and one key are needed")
    absent = [c for c in (*keys, *sort_by) if c not in df.columns]
    if absent:
        raise ValueError(f"no columns {absent}")
    placed = df.repartition(buckets, *[F.col(k) for k in keys])
    writer = placed.write.format(fmt).mode("overwrite").option("path", path).bucketBy(buckets, *keys)
    writer.sortBy(*(sort_by or keys)).saveAsTable(table)
    return df.sparkSession.table(table)
