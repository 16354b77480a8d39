"""Self-join of documents on the Jaccard similarity of their word n-grams, with Bayesian pruning.

Banded MinHash values propose pairs. A pair's MinHash values are then compared a few at a time; after each step the
number of agreements so far gives a posterior for the similarity, and the pair is dropped once the probability that it
reaches the threshold falls below a tolerance. Pairs that stay are verified on the n-grams themselves.

Large groups never become pairs of rows: a bucket yields links to the first member of each connected part (candidate
components), and pairs are compared, pruned and counted inside tasks that hold two blocks of one component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bizpulse.llm.common import binary_texts, block_pairs, components, mix64, roots, text_batches, whole_groups
from bizpulse.session import materialize

WORDS = 5
THRESHOLD = 0.8
HASHES = 128
#: 32 bands of 4: at a similarity of 0.8 a pair shares no band with a probability of 5e-8.
BAND = 4
#: Hashes compared between two looks at the posterior.
STEP = 16
TOLERANCE = 1e-6
BLOCK_ROWS = 512
REMEMBERED = 500_000
_CHUNK = 8192


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def shingles(text: bytes, known: dict, width: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word n-grams; of all its words if it has fewer than `width`."""
    words = text.split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = max(len(words) - width + 1, 1)
    total = np.full(n, len(words) if len(words) < width else width, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(min(width, len(words))):
            total = mix64(total * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n])
    return np.unique(total)


def digest(own: np.ndarray) -> bytes:
    """128-bit hash of a set of n-grams."""
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest()


def halves(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)


@cache
def _permutations(count: int = HASHES) -> tuple[np.ndarray, np.ndarray]:
    seeds = mix64(np.arange(1, 2 * count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (seeds[:count].astype(np.uint32) | np.uint32(1))[:, None], seeds[count:].astype(np.uint32)[:, None]


def minhashes(own: np.ndarray) -> np.ndarray:
    """MinHash values of a set of shingles: 32-bit, one for each of HASHES multiply-add permutations."""
    a, b = _permutations()
    low = (own ^ (own >> np.uint64(32))).astype(np.uint32)
    least = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), _CHUNK):
        part = a * low[None, at : at + _CHUNK]
        part += b
        np.minimum(least, mixed(part).min(axis=1), out=least)
    return least


def mixed(x: np.ndarray) -> np.ndarray:
    """One more round of mixing, in place: the order of multiply-add values alone is too regular."""
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x2C1B3C6D)
    return x


def band_keys(values: np.ndarray) -> np.ndarray:
    pairs = values.reshape(-1, BAND).astype(np.uint64)
    key = np.arange(1, len(pairs) + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(BAND):
            key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + pairs[:, k])
    return key.view(np.int64)


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[int]:
    """For each look after STEP, 2 * STEP, ... hashes, the fewest agreements m of n that keep a pair: those for which the
    posterior probability of a similarity of at least `threshold`, under a uniform prior, is at least `tolerance`.

    The posterior is beta(m + 1, n - m + 1); its upper tail at t is the probability of at most m successes in n + 1 trials.
    """
    table = []
    for n in range(STEP, HASHES + 1, STEP):
        tail = 0.0
        for m in range(n + 1):
            tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if tail >= tolerance:
                break
        table.append(m)
    return table


def surviving(own: np.ndarray, others: np.ndarray, least: list[int]) -> np.ndarray:
    """Which rows of `others` (MinHash values) are not pruned against `own`, looking at STEP values at a time."""
    left, agreed = np.arange(len(others)), np.zeros(len(others), np.int64)
    for look, needed in enumerate(least):
        part = slice(look * STEP, (look + 1) * STEP)
        agreed = agreed + (others[left, part] == own[part]).sum(axis=1)
        stay = agreed >= needed
        left, agreed = left[stay], agreed[stay]
    out = np.zeros(len(others), dtype=bool)
    out[left] = True
    return out


def _featured(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHashes()
        for batch in batches:
            rows, digests, values, bands = [], [], [], []
            for i, text in enumerate(binary_texts(batch.column(1))):
                own = shingles(text, known, width)
                if len(known) > REMEMBERED:
                    known.clear()
                if len(own):
                    least = minhashes(own)
                    rows.append(i)
                    digests.append(digest(own))
                    values.append(least.tobytes())
                    bands.append(band_keys(least))
            both = halves(digests)
            per = HASHES // BAND
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(rows) + 1, dtype=np.int32) * per), pa.array(np.concatenate(bands) if bands else np.zeros(0, np.int64))
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(values, pa.binary()), lists],
                ["id", "d1", "d2", "values", "bands"],
            )

    return run


def _values(table: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(table["values"].to_pylist()), np.uint32).reshape(-1, HASHES)


def _candidates(least: list[int]):
    """Links from each member of a bucket to the first of those that pruning leaves connected with it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in whole_groups(batches, ["bucket", "block_i", "block_j"]):
            values, ids = _values(table), table["rep"].to_numpy()
            a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            sizes = np.diff(bounds)
            twos = bounds[:-1][sizes == 2]  # most buckets; compared all together
            left, agreed = twos, np.zeros(len(twos), np.int64)
            for look, needed in enumerate(least):
                part = slice(look * STEP, (look + 1) * STEP)
                agreed = agreed + (values[left, part] == values[left + 1, part]).sum(axis=1)
                left, agreed = left[agreed >= needed], agreed[agreed >= needed]
            a.append(ids[left + 1])
            b.append(ids[left])
            for low, high in zip(bounds[:-1][sizes > 2], bounds[1:][sizes > 2]):
                own = values[low:high]
                root = roots(lambda i, rest, own=own: surviving(own[i], own[rest], least), high - low)
                other = root != np.arange(high - low)
                a.append(ids[low:high][other])
                b.append(ids[low:high][root[other]])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

    return run


def _prepared(width: int):
    """Values and n-grams of the texts that are candidates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHashes()
        for batch in batches:
            grams, values, digests = [], [], []
            for text in binary_texts(batch.column(batch.num_columns - 1)):
                own = shingles(text, known, width)
                if len(known) > REMEMBERED:
                    known.clear()
                grams.append(own.tobytes())
                digests.append(digest(own))
                values.append(minhashes(own).tobytes())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(halves(digests)[:, 0]), pa.array(values, pa.binary()), pa.array(grams, pa.binary())],
                [*batch.schema.names[:-1], "own", "values", "grams"],
            )

    return run


def shared_counts(grams: list[np.ndarray]) -> np.ndarray:
    """Numbers of common n-grams of all pairs of one task's documents: a product of 0/1 rows over the n-grams that at least
    two of them have, some columns at a time."""
    n = len(grams)
    rows = np.repeat(np.arange(n), [len(g) for g in grams])
    _, column, times = np.unique(np.concatenate(grams), return_inverse=True, return_counts=True)
    common = np.flatnonzero(times > 1)
    number = np.full(len(times), -1)
    number[common] = np.arange(len(common))
    column = number[column]
    rows, column = rows[column >= 0], column[column >= 0]
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    counts = np.zeros((n, n), np.float32)
    for low in range(0, len(common), 4096):
        part = slice(np.searchsorted(column, low), np.searchsorted(column, low + 4096))
        there = np.zeros((n, min(4096, len(common) - low)), np.float32)
        there[rows[part], column[part] - low] = 1
        counts += there @ there.T
    return counts


def _verified(threshold: float, least: list[int]):
    """For each document of a pair of blocks: its verified links, copies counted, and the first document of its part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in whole_groups(batches, ["component", "block_i", "block_j"]):
            reps, copies = table["rep"].to_numpy(), table["copies"].to_numpy()
            block, bi, bj = (table[c].to_numpy() for c in ("block", "block_i", "block_j"))
            values = _values(table)
            grams = [np.frombuffer(g, np.uint64) for g in table["grams"].to_pylist()]
            out: list[tuple[np.ndarray, ...]] = []
            for low, high in zip(bounds[:-1], bounds[1:]):
                # Repeated rows of one document are in one block; the first stands for all.
                take = low + np.unique(reps[low:high], return_index=True)[1]
                if len(take) < 2:
                    continue
                own, sizes = values[take], np.array([len(grams[i]) for i in take])
                alive = np.zeros((len(take), len(take)), dtype=bool)
                for i in range(len(take) - 1):
                    fits = np.minimum(sizes[i + 1 :], sizes[i]) >= threshold * np.maximum(sizes[i + 1 :], sizes[i]) - 1e-9
                    if bi[low] != bj[low]:
                        fits &= block[take[i + 1 :]] != block[take[i]]
                    alive[i, i + 1 + np.flatnonzero(fits)] = surviving(own[i], own[i + 1 :][fits], least)
                if not alive.any():
                    continue
                both = shared_counts([grams[i] for i in take]).astype(np.float64)
                union = sizes[:, None] + sizes[None, :] - both
                linked = alive & (both >= threshold * union - 1e-9)
                linked |= linked.T
                root = roots(lambda i, rest, linked=linked: linked[i, rest], len(take))
                out.append((reps[take], linked @ copies[take], reps[take][root]))
            if out:
                arrays = [pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*out)]
                yield pa.RecordBatch.from_arrays(arrays, ["rep", "links", "root"])

    return run


def similar_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, width: int = WORDS, tolerance: float = TOLERANCE
) -> DataFrame:
    """`id_col`, `class_id`, `copy_id` and `n_links`: one row per distinct id.

    Words are runs of anything but ASCII white space, as they stand. Two documents are linked when the Jaccard similarity of
    their sets of `width`-word n-grams is at least `threshold`; a text of fewer words is one n-gram of all its words. n_links
    counts the other documents linked directly, class_id is the smallest id reachable by links, copy_id the smallest id with the
    same set of n-grams. Null texts and texts without words link with nothing. Rows of equal id count once; of an id
    that has several different texts, the one whose set has the smallest hash counts. Rows whose id is null are left out.
    """
    spark = docs.sparkSession
    text_batches(spark)
    least = least_matches(threshold, tolerance)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).filter("id IS NOT NULL")
    schema = "id long, d1 long, d2 long, values binary, bands array<long>"
    features = materialize(texts.mapInArrow(_featured(width), schema), "minhashes")
    distinct = features.groupBy("id").agg(F.min(F.struct("d1", "d2")).alias("d")).select("id", "d.*")
    # Stored, so that the join meets two exchanges and adaptive execution can split a group of very many copies.
    copies = distinct.groupBy("d1", "d2").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    copies = materialize(copies, "copies")
    members = materialize(distinct.join(copies.hint("merge"), ["d1", "d2"]), "members")
    first = members.filter("id = rep").select("id", "d1", "d2", "copies")
    reps = features.join(first, ["id", "d1", "d2"]).withColumnRenamed("id", "rep")

    buckets = materialize(reps.select("rep", F.explode("bands").alias("bucket")), "buckets")
    sizes = buckets.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    sizes = sizes.select("bucket", F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("blocks"))
    met = buckets.join(sizes.hint("merge"), "bucket")
    values = features.join(first.select("id", "d1", "d2"), ["id", "d1", "d2"]).select(F.col("id").alias("rep"), "values")
    met = block_pairs(met.join(values.hint("merge"), "rep"), "rep", "blocks")
    group = ["bucket", "block_i", "block_j"]
    # In order of ids, so that the first member of a part is the same one in most of a family's buckets.
    met = met.select(*group, "rep", "values").repartition(*group).sortWithinPartitions(*group, "rep")
    candidates = components(met.mapInArrow(_candidates(least), "a long, b long").distinct())
    candidates = materialize(candidates, "candidates")

    sizes = candidates.groupBy("component").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks"))
    chosen = candidates.join(sizes, "component").join(first.select(F.col("id").alias("node"), "d1", "copies"), "node")
    chosen = texts.withColumnRenamed("id", "node").join(chosen.hint("merge"), "node")
    chosen = chosen.select("component", "blocks", F.col("node").alias("rep"), "copies", "d1", "text")
    schema = "component long, blocks int, rep long, copies long, d1 long, own long, values binary, grams binary"
    prepared = chosen.mapInArrow(_prepared(width), schema).filter("d1 = own").drop("d1", "own")
    prepared = block_pairs(prepared, "rep", "blocks")
    group = ["component", "block_i", "block_j"]
    prepared = prepared.repartition(*group).sortWithinPartitions(*group)
    checked = materialize(prepared.mapInArrow(_verified(threshold, least), "rep long, links long, root long"), "links")

    links = checked.groupBy("rep").agg(F.sum("links").alias("links"))
    classes = components(checked.select(F.col("rep").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "rep")
    per_rep = materialize(links.join(classes, "rep", "left"), "per-set")
    per_id = members.join(per_rep.hint("merge"), "rep", "left").select(
        "id", F.coalesce("component", "rep").alias("class_id"), F.col("rep").alias("copy_id"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
    )
    return texts.select("id").distinct().join(per_id, "id", "left").select(
        F.col("id").alias(id_col), F.coalesce("class_id", "id").alias("class_id"), F.coalesce("copy_id", "id").alias("copy_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )
