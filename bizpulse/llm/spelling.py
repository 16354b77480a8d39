"""Spelling variants: words that differ by one edit, and the common form each rare one leads to.

Two words at one edit first differ at one position p: they share the p characters before it and all after the edit. So
words are dealt into buckets by a window of positions, the characters before the window and those after it; each pair meets
in the one bucket of its longer length whose window holds p. Buckets with too many words are dealt again by halves of their
window, down to windows of one position, where few words fit. Within a bucket the words are sorted, and the rows of the edit
matrix are carried along what neighbours in the list have in common.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bizpulse.llm.common import text_batches, whole_groups
from bizpulse.session import materialize

#: Letters that make up words: ASCII and the Latin-1 range from U+00C0 to U+00FF.
RUN = re.compile("[a-zÀ-ÿ]+")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
#: One run in so many, chosen by a hash of the document's id and the run, loses one code point.
DAMAGE = 199
LEAST_LENGTH, LEAST_COUNT, FORM_TIMES = 6, 5, 5
#: Buckets with more words are dealt anew; distinct words of a task are handed on once there are so many.
MOST_BUCKET, HELD_WORDS = 2048, 300_000
#: Words that are looked up at once, and cells of the table of characters.
QUERIES, CELLS = 4096, 1 << 22
#: Forms are at least twice as common as what leads to them, so counts of 64 bits allow fewer than 2 ** 6 steps.
JUMPS = 6


def damaged(prefix: bytes, run: str, every: int = DAMAGE) -> str:
    """The run, without one code point if the hash of `prefix` and the run says so."""
    h = zlib.crc32(run.encode(), zlib.crc32(prefix))
    if every and h % every == 0:
        at = h % len(run)
        return run[:at] + run[at + 1 :]
    return run


def _counted(least_length: int, every: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def packed() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"])
            total.clear()
            return out

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                prefix = f"{'' if doc is None else doc}:".encode()
                for word, n in Counter(RUN.findall((text or "").translate(_LOWER))).items():
                    if len(word) >= least_length:  # losing a code point makes no word longer
                        word = damaged(prefix, word, every)
                        if len(word) >= least_length:
                            total[word] += n
                if len(total) >= HELD_WORDS:
                    yield packed()
        yield packed()

    return run


def vocabulary(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, every: int = DAMAGE
) -> DataFrame:
    """Rows (word, n): maximal runs of letters, ASCII capitals lower-cased, of at least `least_length` code points that occur
    at least `least_count` times. Every run whose hash with its document's id is divisible by `every` has lost one code point
    (0: none has). Null texts have no words; a null id counts as empty. Repeated rows count each time."""
    text_batches(docs.sparkSession)
    told = docs.select(F.col(id_col).cast("string").alias("doc"), F.col(text_col).alias("told"))
    counts = told.mapInArrow(_counted(least_length, every), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def _dealt(rows: DataFrame) -> DataFrame:
    """Give each row the bucket of its window: the length of the longer words, the window, and a hash of what surrounds it.

    `lo` and `hi` bound the window in a word of `m` code points; in a word of m - 1 what follows it begins one earlier.
    """
    rest = F.expr("substring(word, hi + 1 - (m - length(word)))")
    return rows.withColumn("bucket", F.xxhash64("m", "lo", "hi", F.expr("left(word, lo)"), rest))


def _halved(rows: DataFrame) -> DataFrame:
    """Each row twice: with the left and the right half of its window."""
    middle = F.expr("lo + (hi - lo) div 2")
    sides = F.array(F.struct(F.col("lo").alias("l"), middle.alias("h")), F.struct(middle.alias("l"), F.col("hi").alias("h")))
    halves = rows.withColumn("_side", F.explode(sides))
    return _dealt(halves.withColumns({"lo": F.col("_side.l"), "hi": F.col("_side.h")}).drop("_side"))


def buckets(words: DataFrame, most: int = MOST_BUCKET) -> DataFrame:
    """Rows (word, n, m, lo, hi, bucket), in which every pair of words at one edit meets exactly once with its window.

    A bucket that has more than `most` rows is dealt into the halves of its window until none has, or the window is one
    position wide: then its words differ in that position only, so there are few more than there are letters.
    """
    rows = words.select("word", "n", F.explode(F.expr("array(length(word), length(word) + 1)")).alias("m"))
    rows = _halved(rows.withColumns({"lo": F.lit(0), "hi": F.col("m")}))
    done = None
    while True:
        rows = materialize(rows, "spelling-buckets")
        large = rows.filter("hi - lo > 1").groupBy("bucket").count().filter(F.col("count") > most).select("bucket")
        large = materialize(large, "spelling-large")
        if large.isEmpty():
            return rows if done is None else done.unionByName(rows)
        wide = F.col("hi") - F.col("lo") > 1
        small = rows.filter(~wide).unionByName(rows.filter(wide).join(large, "bucket", "left_anti").select(rows.columns))
        done = small if done is None else done.unionByName(small)
        rows = _halved(rows.filter(wide).join(large, "bucket", "left_semi").select(rows.columns))


def _points(words: list[str], width: int) -> np.ndarray:
    """Code points of the words, one row each, with zeros behind."""
    return np.array(words, dtype=f"U{width}").view(np.uint32).reshape(len(words), width)


def near_pairs(points: np.ndarray, lengths: np.ndarray, firsts: np.ndarray, lo: np.ndarray, hi: np.ndarray, queries: slice):
    """Pairs (query row, other row) at exactly one edit that belong to their bucket.

    Rows are words of m or m - 1 code points, m being the width of `points`, sorted within buckets; `firsts` marks the first
    row of each. A stretch of the list whose words share d code points is a node. What is alive is a query, a node and three
    cells of row d of their edit matrix, those at query lengths d - 1, d and d + 1; a node's row is computed once for all its
    words. Stretches whose cells all exceed one edit are left whole, as are those that part from the query outside the window.
    """
    n, m = points.shape
    same = np.zeros((n, m), dtype=bool)
    same[1:] = points[1:] == points[:-1]
    common = np.where(firsts, -1, np.where(same.all(axis=1), m, same.argmin(axis=1)))  # code points shared with the row above
    padded = np.concatenate([points, np.zeros((n, 2), np.uint32)], axis=1)
    ask = np.arange(n)[queries]
    begins = np.flatnonzero(firsts)
    which = np.searchsorted(begins, ask, side="right") - 1
    ends_of = np.append(begins[1:], n)
    query, low, high = ask, begins[which], ends_of[which]
    left, mid, right = np.full(len(ask), 2, np.int8), np.zeros(len(ask), np.int8), np.ones(len(ask), np.int8)
    parted = np.full(len(ask), -1, np.int32)  # where query and node first differ; -1 while they do not
    found_a, found_b = [], []
    for d in range(m + 1):
        if d >= m - 1:  # words that end here come first in their stretch
            over = lengths[low] == d
            gap = lengths[query] - d
            cell = np.where(gap == 0, mid, np.where(gap == 1, right, np.where(gap == -1, left, 2)))
            at = np.where(parted < 0, np.minimum(d, lengths[query]), parted)
            hit = over & (cell == 1) & (np.maximum(lengths[query], d) == m) & (at >= lo[query]) & (at < hi[query])
            found_a.append(query[hit])
            found_b.append(low[hit])
        if d == m:
            break
        starts = np.flatnonzero(common <= d)  # where stretches that share d + 1 code points begin
        first, last = np.searchsorted(starts, low), np.searchsorted(starts, high)
        many = last - first
        state = np.repeat(np.arange(len(query)), many)
        child = starts[np.arange(len(state)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)]
        stop = np.append(starts[1:], n)[np.searchsorted(starts, child)]
        on = lengths[child] > d
        state, child, stop = state[on], child[on], stop[on]
        who, letter = query[state], points[child, d]
        was, was_left, was_right = mid[state], left[state], right[state]
        differs = lambda k: (padded[who, k] != letter).astype(np.int8)
        new_left = np.minimum(was_left + differs(d - 1), was + 1) if d else np.ones(len(who), np.int8)
        new_mid = np.minimum(np.minimum(was + differs(d), was_right + 1), new_left + 1)
        new_right = np.minimum(was_right + differs(d + 1), new_mid + 1)
        part = np.where((parted[state] < 0) & (new_mid > 0), d, parted[state])
        alive = np.minimum(np.minimum(new_left, new_mid), new_right) <= 1
        alive &= np.where(part < 0, d + 1 <= hi[who], (part >= lo[who]) & (part < hi[who]))
        query, low, high, parted = who[alive], child[alive], stop[alive], part[alive]
        left, mid, right = (np.minimum(x[alive], 2).astype(np.int8) for x in (new_left, new_mid, new_right))
    return np.concatenate(found_a), np.concatenate(found_b)


def _neighbours(queries: int, cells: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, edges in whole_groups(batches, ["m", "bucket"]):
            widths = table["m"].to_numpy()[edges[:-1]]
            begin = 0
            while begin < len(widths):  # buckets of one length, as many as fit
                end = begin + 1
                while end < len(widths) and widths[end] == widths[begin] and (edges[end + 1] - edges[begin]) * widths[begin] <= cells:
                    end += 1
                part = table.slice(int(edges[begin]), int(edges[end] - edges[begin]))
                yield from _bucket_pairs(part, edges[begin:end] - edges[begin], int(widths[begin]), queries)
                begin = end

    return run


def _bucket_pairs(part: pa.Table, bounds: np.ndarray, m: int, queries: int) -> Iterator[pa.RecordBatch]:
    if part.num_rows == len(bounds):
        return
    words, n = part["word"].to_pylist(), part["n"].to_numpy()
    points = _points(words, m)
    lengths = (points > 0).sum(axis=1)
    firsts = np.zeros(len(words), dtype=bool)
    firsts[bounds] = True
    lo, hi = part["lo"].to_numpy(), part["hi"].to_numpy()
    for begin in range(0, len(words), queries):
        a, b = near_pairs(points, lengths, firsts, lo, hi, slice(begin, begin + queries))
        order = np.lexsort((b, -n[b], a))  # the list is sorted by code points, so rows stand for them
        a, b = a[order], b[order]
        rows, first, many = np.unique(a, return_index=True, return_counts=True)
        best = b[first]
        yield pa.RecordBatch.from_arrays(
            [pa.array([words[i] for i in rows], pa.string()), pa.array(many, pa.int64()), pa.array(n[best]), pa.array([words[i] for i in best], pa.string())],
            ["word", "n_near", "best_n", "best"],
        )


def near_words(words: DataFrame, most: int = MOST_BUCKET) -> DataFrame:
    """Rows (word, n_near, best_n, best) for the words (word, n) that have another at exactly one inserted, deleted or replaced
    code point: how many, and the most common of them, of equally common ones the first in code-point order."""
    told = buckets(words, most)
    parts = int(told.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = told.repartition(parts, "m", "bucket").sortWithinPartitions("m", "bucket", "word")
    found = placed.mapInArrow(_neighbours(QUERIES, CELLS), "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))).alias("best")
    each = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return each.select("word", "n_near", (-F.col("best.n")).alias("best_n"), F.col("best.word").alias("best"))


def variants(words: DataFrame, times: int = FORM_TIMES, most: int = MOST_BUCKET) -> DataFrame:
    """Rows (word, form, root, n, n_near, form_n), one per row of `words` (word, n), whose words must differ.

    `form` is the most common near word if it is at least `times` as common as the word, else null; `root` is the last of the
    forms of forms, the word itself without one. Roots are found by jumps that double, so long chains take few joins.
    """
    if times < 2:
        raise ValueError("a form must be at least twice as common")
    words = materialize(words.select("word", "n"), "vocabulary")
    judged = words.join(near_words(words, most), "word", "left")
    is_form = F.col("best_n") >= times * F.col("n")
    judged = judged.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n"),
    )
    judged = materialize(judged, "variants")
    to = judged.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(JUMPS):
        further = to.select(F.col("word").alias("root"), F.col("root").alias("_further"))
        to = to.join(further, "root", "left").select("word", F.coalesce("_further", "root").alias("root"), F.col("_further").isNotNull().alias("_moved"))
        to = materialize(to, "roots")
        if to.filter("_moved").isEmpty():
            break
        to = to.drop("_moved")
    found = judged.join(to.select("word", "root"), "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
