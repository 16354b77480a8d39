"""Near-duplicate vectors by spherical-cap filters.

Filter directions are a random product code: a direction is the concatenation of one unit codeword for each block of
coordinates, so a vector's inner products with all directions are sums of one small table entry per block. Each vector
is list-decoded to every direction whose inner product exceeds the cap's height. Vectors with a small angle fall into
many common caps; unlike ones share hardly any. Vectors that share a cap are compared in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bizpulse.llm.common import block_pairs, components, roots, text_batches, whole_groups
from bizpulse.session import materialize

THRESHOLD = 0.93
#: Independent codes: what one misses by the way its blocks cut a vector, another finds.
CODES = 4
#: Caps per vector and code on average, and at least. At a cosine of 0.93 vectors in 64 dimensions share about four in ten.
CAPS, LEAST_CAPS = 24, 16
BLOCKS = 4
#: Sums of half directions that a task holds at once.
SUMS = 1 << 22
#: Vectors of one group that a task compares at once.
BLOCK_ROWS = 1024
#: Products of matrices round by their shape; cosines so near the threshold are summed again exactly.
DOUBT = 1e-9


class CapCode:
    """A random product code of `words` ** BLOCKS directions in `dim` dimensions, turned at random, and the height at which a
    uniformly random vector exceeds `caps` of them on average."""

    def __init__(self, dim: int, words: int, caps: float = CAPS, least: int = LEAST_CAPS, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.dim, self.width, self.words = dim, -(-dim // BLOCKS), words
        self.turn = np.linalg.qr(rng.standard_normal((self.width * BLOCKS, self.width * BLOCKS)))[0][:, :dim]
        books = rng.standard_normal((BLOCKS, words, self.width))
        self.books = books / np.linalg.norm(books, axis=2, keepdims=True) / math.sqrt(BLOCKS)
        # Among two sorted halves, the `least` largest sums are at places i, j with (i + 1) * (j + 1) <= least.
        side = min(least, words**2)
        i, j = np.divmod(np.arange(side * side), side)
        near = (i + 1) * (j + 1) <= least
        self.top, self.least = (-1 - i[near], -1 - j[near]), min(least, side * side)
        # A cap's share of random vectors falls with its height; bisection finds the height for the wanted share.
        trial = rng.standard_normal((200, dim))
        halves = self._halves(trial / np.linalg.norm(trial, axis=1, keepdims=True))
        low, high = 0.0, 1.0
        for _ in range(30):
            self.height = (low + high) / 2
            mean = sum(self._count(a, b) for a, b in zip(*halves)) / len(trial)
            low, high = (self.height, high) if mean > caps else (low, self.height)

    def _halves(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Inner products with the first two blocks' words, all pairs of them, and with the last two blocks'."""
        parts = (vectors @ self.turn.T).reshape(len(vectors), BLOCKS, self.width).transpose(1, 0, 2) @ self.books.transpose(0, 2, 1)
        flat = (len(vectors), self.words**2)
        return (parts[0][:, :, None] + parts[1][:, None]).reshape(flat), (parts[2][:, :, None] + parts[3][:, None]).reshape(flat)

    def _count(self, a: np.ndarray, b: np.ndarray) -> int:
        a = a[a > self.height - b.max()]
        return int((len(b) - np.searchsorted(np.sort(b), self.height - a, side="right")).sum())

    def decode(self, vectors: np.ndarray) -> list[np.ndarray]:
        """For each vector the numbers of all directions that exceed the height, or the height of its `least` nearest directions
        if that is lower, so that a vector far from most directions is in caps too. A half that no other half can lift is
        never expanded."""
        out = []
        for a, b in zip(*self._halves(vectors)):
            order = np.argsort(b)
            b = b[order]
            sums = np.partition(np.sort(a)[self.top[0]] + b[self.top[1]], -self.least)
            height = min(self.height, sums[-self.least] - 1e-12)
            left = np.flatnonzero(a > height - b[-1])
            first = np.searchsorted(b, height - a[left], side="right")
            counts = len(b) - first
            inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(first, counts)
            out.append(np.repeat(left, counts) * len(b) + order[inner])
        return out


def code_words(count: int, caps: float = CAPS) -> int:
    """Words for `count` vectors: there are twice as many directions as caps that vectors fall into, so the vectors that share a
    cap by chance stay as few however many vectors there are. Decoding a vector takes the square of the words."""
    return max(12, math.ceil((count * caps * 2) ** (1 / BLOCKS)))


def cap_codes(dim: int, words: int, caps: float = CAPS) -> list[CapCode]:
    return [CapCode(dim, words, caps, seed=7 + k) for k in range(CODES)]


def _decoded(codes: dict[int, list[CapCode]], sums: int):
    """Caps of each vector by the codes of its dimension. Caps are numbered one code after the other, dimensions apart, so that
    no cap is shared by two of them."""
    first, at = {}, 0
    for dim, own in sorted(codes.items()):
        first[dim], at = at, at + CODES * own[0].words**BLOCKS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, at = _flat(batch.column(2))
            for dim in np.unique(np.diff(at)):
                whole = np.flatnonzero(np.diff(at) == dim)
                for k, code in enumerate(codes[int(dim)]):
                    step = max(1, sums // code.words**2)
                    for own in (whole[i : i + step] for i in range(0, len(whole), step)):
                        lists = code.decode(values[at[own][:, None] + np.arange(dim)])
                        rows = pa.array(np.repeat(own, [len(x) for x in lists]))
                        caps = np.concatenate(lists) + k * code.words**BLOCKS + first[int(dim)]
                        yield pa.RecordBatch.from_arrays(
                            [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(caps.astype(np.int64))], ["rep", "label", "cap"]
                        )

    return run


def _flat(vectors: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """All vectors' parts one after the other, and where each vector begins; the last place is the end."""
    at = vectors.offsets.to_numpy().astype(np.int64)
    return vectors.flatten().to_numpy(zero_copy_only=False), at - at[0]


def _matrices(table: pa.Table, bounds: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """Bounds and vectors of each group, which are of one dimension within it."""
    values, at = _flat(table["unit"].combine_chunks())
    for low, high in zip(bounds[:-1], bounds[1:]):
        yield low, high, values[at[low] : at[high]].reshape(high - low, -1)


def alike(own: np.ndarray, i: int, others: np.ndarray, threshold: float) -> np.ndarray:
    """Which of the rows `others` have a cosine with row `i` of at least the threshold. Near it the products are added up exactly,
    in which neither the order of two rows nor what else is compared matters, so every step of the join decides alike."""
    cosines = own[others] @ own[i]
    for k in np.flatnonzero(np.abs(cosines - threshold) <= DOUBT):
        cosines[k] = math.fsum(own[others[k]] * own[i])
    return cosines >= threshold


def _stars(threshold: float):
    """Within each group, links from every vector to the first of its connected part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in whole_groups(batches, ["label", "cap", "block_i", "block_j"]):
            reps = table["rep"].to_numpy()
            a, b = [], []
            for low, high, own in _matrices(table, bounds):
                if high - low > 1:
                    root = roots(lambda i, rest, own=own: alike(own, i, rest, threshold), high - low)
                    other = root != np.arange(high - low)
                    a.append(reps[low:high][other])
                    b.append(reps[low:high][root[other]])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

    return run


def _counted(threshold: float):
    """Links of each vector with the others of its component, copies counted, from one pair of blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in whole_groups(batches, ["component", "block_i", "block_j"]):
            copies = table["copies"].to_numpy().astype(np.float64)
            block, bi, bj = (table[c].to_numpy() for c in ("block", "block_i", "block_j"))
            links = np.zeros(table.num_rows, np.int64)
            for low, high, own in _matrices(table, bounds):
                times = copies[low:high]
                cosines = own @ own.T
                linked = cosines >= threshold
                for i, k in np.argwhere(np.abs(cosines - threshold) <= DOUBT):
                    linked[i, k] = alike(own, i, np.array([k]), threshold)[0]
                if bi[low] != bj[low]:
                    linked &= block[low:high, None] != block[None, low:high]
                else:
                    np.fill_diagonal(linked, False)
                links[low:high] = linked @ times
            yield pa.RecordBatch.from_arrays([table["rep"].combine_chunks(), pa.array(links)], ["rep", "links"])

    return run


def near_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD, caps: float = CAPS
) -> DataFrame:
    """`id_col`, `n_links`, `component_id` and `kept`, one row per distinct id and one per row whose id is null.

    Vectors with equal, non-null labels are linked when their cosine in double precision is at least `threshold` and caps
    bring them together; each dimension is joined within itself. n_links counts the other vectors linked directly, exact copies included; component_id is the
    smallest id reachable; kept marks the one that names its component. A vector that is null, empty, zero or has null or
    non-finite parts links with nothing. Rows of equal id and vector count once; a null id links with nothing and names no component (n_links 0, component_id null, kept true).

    Exact copies are reduced to one representative first. Large groups are compared in blocks of bounded size; links
    are counted in components, so each pair is met once.
    """
    spark = vectors.sparkSession
    text_batches(spark, 4096)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), F.col(label_col).cast("string").alias("label"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    largest = F.array_max(F.transform("v", F.abs))
    usable = F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("v") > 0) & finite
    good = rows.filter(usable).filter(largest > 0)
    # Scaled by the largest part first, so that squares neither overflow nor vanish.
    scaled = good.withColumn("s", F.transform("v", lambda x: x / F.array_max(F.transform("v", F.abs))))
    norm = F.sqrt(F.aggregate("s", F.lit(0.0), lambda t, x: t + x * x))
    unit = scaled.withColumn("norm", norm).select("id", "label", F.transform("s", lambda x: x / F.col("norm")).alias("unit"))
    label = F.xxhash64("label")
    key = F.sha2(F.concat_ws(",", "label", F.transform("unit", lambda x: x.cast("string"))), 256)
    keyed = materialize(unit.withColumn("key", key).dropDuplicates(["id", "key"]), "vectors")
    # Stored, so that the join meets two exchanges and adaptive execution can split a group of very many copies.
    copies = materialize(keyed.groupBy("key").agg(F.min("id").alias("rep"), F.count("*").alias("copies")), "copies")
    members = materialize(keyed.select("id", "key").join(copies.hint("merge"), "key"), "members")
    reps = keyed.join(members.filter("id = rep").select("id", "key", "rep", "copies"), ["id", "key"])
    reps = materialize(reps.select("rep", "copies", label.alias("label"), "unit"), "reps")

    # A dimension that one representative has alone cannot be near another, so it needs no codes.
    found = {r["dim"]: r["count"] for r in reps.groupBy(F.size("unit").alias("dim")).count().filter("count > 1").collect()}
    codes = {
        dim: cap_codes(dim, code_words(count, caps), caps) for dim, count in sorted(found.items())
    }
    reps = reps.filter(F.size("unit").isin(list(codes)))

    lists = materialize(reps.select("rep", "label", "unit").mapInArrow(_decoded(codes, SUMS), "rep long, label long, cap long"), "caps")
    sizes = lists.groupBy("label", "cap").agg(F.count("*").alias("n")).filter("n > 1")
    sizes = sizes.select("label", "cap", F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("blocks"))
    together = lists.join(sizes.hint("merge"), ["label", "cap"]).join(reps.select("rep", "unit").hint("merge"), "rep")
    group = ["label", "cap", "block_i", "block_j"]
    met = block_pairs(together, "rep", "blocks").select(*group, "rep", "unit").repartition(*group).sortWithinPartitions(*group, "rep")
    parts = components(met.mapInArrow(_stars(threshold), "a long, b long").distinct())
    parts = materialize(parts, "parts")

    sizes = parts.groupBy("component").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks"))
    inside = parts.join(sizes, "component").withColumnRenamed("node", "rep").join(reps, "rep")
    group = ["component", "block_i", "block_j"]
    inside = block_pairs(inside, "rep", "blocks").select(*group, "block", "rep", "copies", "unit").repartition(*group).sortWithinPartitions(*group)
    links = inside.mapInArrow(_counted(threshold), "rep long, links long").groupBy("rep").agg(F.sum("links").alias("links"))
    per_rep = materialize(links.join(parts.withColumnRenamed("node", "rep"), "rep"), "per-vector")
    per_id = (
        members.join(per_rep.hint("merge"), "rep", "left")
        .groupBy("id")
        .agg(F.sum(F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n"), F.min(F.coalesce("component", "rep")).alias("c"))
    )
    known = rows.select("id").filter("id IS NOT NULL").distinct().join(per_id, "id", "left")
    return _result(known.unionByName(rows.filter("id IS NULL").select("id"), allowMissingColumns=True), id_col)


def _result(ids: DataFrame, id_col: str) -> DataFrame:
    for name, kind in (("n", "long"), ("c", "long")):
        ids = ids if name in ids.columns else ids.withColumn(name, F.lit(None).cast(kind))
    component = F.coalesce("c", "id")
    return ids.select(
        F.col("id").alias(id_col), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        (component.isNull() | (component == F.col("id"))).alias("kept"),
    )
