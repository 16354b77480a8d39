"""Pack tokenised documents into sequences of a fixed window with next to no padding and few cuts.

Every document is cut into full windows, which are sequences of their own, and one remainder shorter than the window. The
remainders' lengths make a histogram of at most `window` - 1 counts, whatever the size of the corpus. Combinations of up
to five lengths that fill a window exactly are the columns of a non-negative least squares problem whose right-hand side is
that histogram; the solution, rounded, says how often each combination is used. What rounding leaves is packed by best fit,
longest first, into windows that stay short by less than a hundredth. Remainders are dealt to the combinations by their rank
among those of their length. Only what fits nowhere, as when all are longer than half a window, is laid end to end and cut.
"""

from __future__ import annotations

import bisect
import re
import struct
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bizpulse.llm.common import text_batches
from bizpulse.session import materialize

WINDOW = 2048
EOS = 1
#: Distinct words whose ids a worker remembers.
REMEMBERED = 1_000_000
_CHUNKS = re.compile(r"[^\x20\x09-\x0D]+")
# How the tokenizer cuts lower-case ASCII, and the letters that stand for bytes in its vocabulary.
_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^ a-z0-9]+")
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_OTHERS = {b: chr(0x100 + k) for k, b in enumerate(b for b in range(256) if b not in _PRINTED)}
_BYTE_LETTERS = [_OTHERS.get(b, chr(b)) for b in range(256)]


@cache
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


#: Letters that every version of Unicode knows as letters, composed and with a plain lower case, and marks that stand alone.
LETTERS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ") | frozenset(map(chr, range(0xC0, 0x130))) - {"\xd7", "\xf7"}
PLAIN = LETTERS | frozenset(" \n.,")


class WordIds:
    """Ids of texts by way of their words, each encoded once and remembered, as unsigned 32-bit little-endian bytes.

    The tokenizer lower-cases, drops white space and never lets a token span it, so a text's ids are those of its chunks
    between ASCII white space, in order. In a text of letters, spaces and single full stops and commas, the marks are
    tokens of their own too; there the words are lower-cased and the marks set apart first, so that fewer differ. A chunk of
    plain ASCII is cut as the tokenizer cuts it, and each part goes straight to the tokenizer's model. All else is left
    to the whole tokenizer.
    """

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        self.model = self.tokenizer.model
        self.known: dict[str, bytes] = {}

    def split(self, text: str) -> list[str]:
        if PLAIN.issuperset(text) and not any(two in text for two in ("..", ",,", ".,", ",.")):
            return text.lower().replace(".", " . ").replace(",", " , ").split()
        return _CHUNKS.findall(text)

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [self.split(t) for t in texts]
        words = [w for own in split for w in own]
        ids = list(map(self.known.get, words))
        gaps = [i for i, x in enumerate(ids) if x is None]
        if gaps:
            if len(self.known) > REMEMBERED:
                self.known.clear()
            new = self._new({words[i] for i in gaps})
            self.known.update(new)
            for i in gaps:
                ids[i] = new[words[i]]
        out, low = [], 0
        for own in split:
            out.append(b"".join(ids[low : low + len(own)]))
            low += len(own)
        return out

    def _new(self, words: set[str]) -> dict[str, bytes]:
        found: dict[str, bytes] = {}
        rest = []
        for word in words:
            if word.isascii() and word.isprintable() and "<|" not in word:
                lower = word.lower()
                parts = [lower] if lower.isalpha() else _PARTS.findall(lower)
                found[word] = b"".join(map(self._part, parts))
            elif LETTERS.issuperset(word):
                found[word] = self._part("".join(map(_BYTE_LETTERS.__getitem__, word.lower().encode())))
            else:
                rest.append(word)
        for word, coded in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)):
            found[word] = np.array(coded.ids, "<u4").tobytes()
        return found

    def _part(self, part: str) -> bytes:
        found = [t.id for t in self.model.tokenize(part)]
        return struct.pack(f"<{len(found)}I", *found)


@cache
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def _tokenised(path: str, window: int, eos: int):
    end = np.array([eos], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = word_ids(path)
        uid = TaskContext.get().partitionId() << 40
        for batch in batches:
            rows, starts, lengths, totals, crcs, ids = [], [], [], [], [], []
            for i, whole in enumerate(coder.encode([t or "" for t in batch.column(1).to_pylist()])):
                whole += end
                total = len(whole) // 4
                for start in range(0, total, window):
                    rows.append(i)
                    starts.append(start)
                    piece = whole[4 * start : 4 * (start + window)]
                    ids.append(piece)
                    crcs.append(zlib.crc32(piece))
                    lengths.append(len(piece) // 4)
                    totals.append(total)
            uids = pa.array(np.arange(uid, uid + len(rows)))
            uid += len(rows)
            yield pa.RecordBatch.from_arrays(
                [uids, batch.column(0).take(pa.array(rows, pa.int64())), pa.array(starts, pa.int64()), pa.array(lengths, pa.int32()), pa.array(totals, pa.int64()), pa.array(crcs, pa.int64()), pa.array(ids, pa.binary())],
                ["uid", "id", "start", "length", "doc_tokens", "crc", "ids"],
            )

    return run


#: Lengths in a combination at most, and how many combinations of three or more are sought for each length that occurs.
PARTS, EACH = 5, 3
#: A window may stay short by this share of it, padded, when documents then stay whole.
SLACK = 1 / 128


def combinations(counts: np.ndarray, window: int) -> list[tuple[int, ...]]:
    """Shallow combinations of lengths that fill the window: every pair, and for every length that occurs up to EACH each of
    three, four and five lengths, the longer ones for short lengths only.

    A combination is sought from its first length: the others but the last are common ones near their even share of what is
    missing, the last is what then fills the window. So their number is bounded by the window, not by the corpus.
    """
    there = np.flatnonzero(counts)
    present = set(there.tolist())
    out = {(window - a, a) for a in there.tolist() if 2 * a <= window and window - a in present}
    for a in there.tolist():
        for parts in range(3, PARTS + 1):
            if a * (parts - 1) > window and parts > 3:
                break  # longer than its share by far
            share = (window - a) / (parts - 1)
            order = there[np.argsort(np.abs(there - share) / window - counts[there] / counts.max(), kind="stable")]
            found = 0
            for b in order.tolist():
                last = window - a - b * (parts - 2)
                if last in present:
                    out.add(tuple(sorted((a, *[b] * (parts - 2), last), reverse=True)))
                    found += 1
                    if found == EACH:
                        break
    return sorted(out, key=lambda c: (len(c), c))


def nnls(columns: list[tuple[int, ...]], target: np.ndarray, rounds: int = 300) -> np.ndarray:
    """x >= 0 that nearly minimises |A x - target|^2, where column k of A counts the lengths in combination k.

    Projected gradient with momentum; A is sparse (a few entries a column) and is applied by index.
    """
    if not columns:
        return np.zeros(0)
    most = max(map(len, columns))
    index = np.array([c + (0,) * (most - len(c)) for c in columns])
    weight = (index > 0).astype(float)
    share = np.bincount(index.ravel(), weight.ravel(), len(target))
    # Scaled gradient: the most entries of a column times the columns that share a length bound the curvature.
    step = weight.sum(1) / (most * (weight * share[index]).sum(1))
    x = momentum = np.zeros(len(columns))
    t = 1.0
    for _ in range(rounds):
        made = np.bincount(index.ravel(), (weight * momentum[:, None]).ravel(), len(target))
        gradient = (weight * (made - target)[index]).sum(1)
        new, s = np.maximum(0.0, momentum - step * gradient), (1 + (1 + 4 * t * t) ** 0.5) / 2
        momentum, x, t = new + (t - 1) / s * (new - x), new, s
    return x


def rounded(columns: list[tuple[int, ...]], x: np.ndarray, left: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Repeat counts near `x`, never more of a length than `left` has; `left` is reduced. The solution is rounded down, then
    up, each time in order of what it asks for, so combinations that it wants most are not robbed by others."""
    used: dict[int, int] = {}
    for wish in (np.floor(x + 1e-9), np.ceil(x - 1e-3) - np.floor(x + 1e-9)):
        for k in np.argsort(-x, kind="stable").tolist():
            if wish[k] <= 0:
                continue
            need = [(a, columns[k].count(a)) for a in set(columns[k])]
            times = min(int(wish[k]), *(int(left[a]) // n for a, n in need))
            if times > 0:
                used[k] = used.get(k, 0) + times
                for a, n in need:
                    left[a] -= n * times
    return [(columns[k], times) for k, times in used.items()]


def best_fit(left: np.ndarray, window: int, slack: int) -> list[tuple[tuple[int, ...], int]]:
    """Windows for what is left: the longest remainder first, then each time the longest that still fits. A pattern is used as
    often as its lengths last, so there are at most as many as lengths. Those that stay short by more than `slack` are not used.
    `left` is reduced by what is used."""
    free, used = left.copy(), []
    while free.any():
        pattern, room, there = [], window, free.copy()
        while room > 0:
            fits = np.flatnonzero(there[: room + 1])
            if not len(fits):
                break
            a = int(fits[-1])
            n = min(room // a, int(there[a]))
            pattern += [a] * n
            there[a] -= n
            room -= a * n
        need = {a: pattern.count(a) for a in set(pattern)}
        times = min(int(free[a]) // n for a, n in need.items())
        for a, n in need.items():
            free[a] -= n * times
            if room <= slack:
                left[a] -= n * times
        if room <= slack:
            used.append((tuple(pattern), times))
    return used


def allot(
    counts: np.ndarray, window: int
) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, list[tuple[int, int, int, int]]], np.ndarray]:
    """How often each combination is used; for each length its slots: (first rank, past the last rank, number of the first
    sequence, offset in it), by rank; and how many of each length have no slot. No length is used more often than it occurs."""
    left = counts.copy()
    columns = combinations(counts, window) if counts.any() else []
    used = rounded(columns, nnls(columns, counts.astype(float)), left)
    used += best_fit(left, window, int(window * SLACK))
    slots: dict[int, list[tuple[int, int, int, int]]] = {}
    first = 0
    for combination, times in used:
        offset = 0
        for a in combination:
            rank = slots[a][-1][1] if a in slots else 0
            slots.setdefault(a, []).append((rank, rank + times, first, offset))
            offset += a
        first += times
    return used, slots, left


def _dealt(slots, base: int, window: int):
    """Remainders with ranks to places: (sequence, offset), or null where no combination takes the rank."""
    lows = {a: [s[0] for s in own] for a, own in slots.items()}

    @F.arrow_udf("struct<seq: bigint, at: bigint>")
    def dealt(lengths: pa.Array, ranks: pa.Array) -> pa.Array:
        seqs, ats = [], []
        for length, rank in zip(lengths.to_pylist(), ranks.to_pylist()):
            k = bisect.bisect_right(lows[length], rank) - 1 if length in lows else -1
            low, high, first, offset = slots[length][k] if k >= 0 else (0, 0, 0, 0)
            inside = k >= 0 and rank < high
            seqs.append(base + first + rank - low if inside else None)
            ats.append(offset if inside else None)
        return pa.StructArray.from_arrays([pa.array(seqs, pa.int64()), pa.array(ats, pa.int64())], ["seq", "at"])

    return dealt


def numbered(df: DataFrame, order: list[str], weight: str, by: list[str], name: str, label: str, salt: int) -> DataFrame:
    """Running sums of `weight` before each row, within each group `by`, in a reproducible order.

    Groups may be hot: rows are split into `salt` parts by hash, summed in windows within (group, part), and the parts'
    totals, one small row each, give each part its offset.
    """
    part = F.pmod(F.xxhash64(*order), F.lit(salt)).cast("int")
    df = df.withColumn("_part", part)
    totals = df.groupBy(*by, "_part").agg(F.sum(weight).alias("_sum"))
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = materialize(totals.select(*by, "_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before")), label)
    inside = Window.partitionBy(*by, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("_inside", F.coalesce(F.sum(weight).over(inside), F.lit(0)))
    # A merge join: the rows lie in order of these keys already, and the totals are a row for each group and part.
    return df.join(totals.hint("merge"), [*by, "_part"]).withColumn(name, F.col("_before") + F.col("_inside")).drop("_part", "_inside", "_before")


def pack(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, eos: int = EOS
) -> DataFrame:
    """Pack all documents: one row per piece with `id_col`, `start` (the document's ids before it), `length`,
    `doc_tokens` (the document's ids with the end id), `sequence_id`, `offset` (in the sequence, gapless from 0) and `ids`
    (unsigned 32-bit little-endian).

    Each id of each document lies in exactly one piece and no sequence holds more than `window`. All sequences but one at most
    are short by SLACK of the window or less. Null or empty text: the end id alone. Rows of equal id are packed each on
    its own; a null id stays null. `tokenizer` is the path of a tokenizer file, the same on every machine.
    """
    spark = docs.sparkSession
    text_batches(spark, 512)
    salt = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    # The number that a piece gets while it is written names it from then on.
    schema = "uid long, id long, start long, length int, doc_tokens long, crc long, ids binary"
    pieces = materialize(texts.mapInArrow(_tokenised(tokenizer, window, eos), schema), "pieces")
    tails = pieces.filter(F.col("length") < window)

    counts = np.zeros(window, dtype=np.int64)
    for row in tails.groupBy("length").count().collect():  # at most window - 1 rows
        counts[row["length"]] = row["count"]
    used, slots, left = allot(counts, window)
    combined = sum(times for _, times in used)

    order = ["id", "start", "crc", "uid"]
    ranked = tails.select(*order, "length", F.lit(1).alias("one"))
    ranked = numbered(ranked, order, "one", ["length"], "rank", "ranks", salt).drop("one")
    placed = materialize(ranked.withColumn("place", _dealt(slots, 0, window)("length", "rank")), "placed")
    dealt = placed.filter("place IS NOT NULL AND place.seq IS NOT NULL").select("uid", F.lit(0).alias("from"), "length", "place.seq", "place.at")
    rest = placed.filter("place.seq IS NULL").drop("place", "rank").withColumn("all", F.lit(0))
    laid = numbered(rest, order, "length", ["all"], "pos", "laid", salt)
    # Shorter than a window, a remainder meets one boundary at most.
    room = F.lit(window) - F.col("pos") % window
    cut = F.when(
        F.col("length") <= room, F.array(F.struct(F.lit(0).alias("from"), F.col("length").cast("long").alias("n")))
    ).otherwise(
        F.array(
            F.struct(F.lit(0).alias("from"), room.cast("long").alias("n")),
            F.struct(room.cast("int").alias("from"), (F.col("length") - room).cast("long").alias("n")),
        )
    )
    laid = laid.select("uid", "pos", F.explode(cut).alias("c")).select(
        "uid", "c.from", F.col("c.n").cast("int").alias("length"),
        (F.lit(combined) + F.floor((F.col("pos") + F.col("c.from")) / window)).cast("long").alias("seq"),
        ((F.col("pos") + F.col("c.from")) % window).cast("long").alias("at"),
    )
    places = dealt.unionByName(laid)

    tail_pieces = (
        tails.select("uid", "id", "start", "doc_tokens", "ids").alias("t")
        .join(places.alias("p").hint("merge"), "uid")
        .select(
            F.col("t.id").alias(id_col), (F.col("t.start") + F.col("p.from")).alias("start"), F.col("p.length").cast("long").alias("length"), "doc_tokens",
            F.col("p.seq").alias("sequence_id"), F.col("p.at").alias("offset"),
            F.expr("substring(t.ids, 4 * p.`from` + 1, 4 * p.length)").alias("ids"),
        )
    )
    # Full windows: sequences of their own, numbered after the others.
    after = combined + int((left * np.arange(window)).sum() + window - 1) // window
    full = pieces.filter(F.col("length") == window)
    full_pieces = full.select(
        F.col("id").alias(id_col), "start", F.col("length").cast("long").alias("length"), "doc_tokens",
        (F.lit(after) + F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), "ids",
    )
    return tail_pieces.unionByName(full_pieces)
