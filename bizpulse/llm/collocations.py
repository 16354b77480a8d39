"""Phrases whose words come together more often than chance has it, counted with a partitioned suffix tree.

The tree of all suffixes of all pieces, cut at a depth of a few words, is never built whole. Its branches are divided
vertically: a branch begins with a prefix, and prefixes that hold more suffixes than their share of a group are extended by a
word until they do not. Prefixes are dealt into groups, as many as a budget of suffixes for each asks for. A task that reads
texts sums the suffixes it has seen and hands each group its part as one packed block; a group sorts its suffixes, which puts
its subtrees in order, and reads the count of every node from the totals of the leaves below it.

Words are numbered by a 64-bit hash of language and word; a seed is taken at which no two words share a number.
"""

from __future__ import annotations

import struct
from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from bizpulse.llm.common import binary_texts, mix64, text_batches
from bizpulse.session import materialize

DEPTH, LEAST, MOST = 5, 100, 2000
#: Suffixes that a group may have, and how many extended prefixes a partition may cause at each length.
GROUP, SHARE = 2_000_000, 4
#: Words that a task sums at once: numbers within them take 20 bits.
CHUNK = 1 << 20
UNKNOWN = "und"
#: ASCII capitals become small, marks that end pieces become line feeds, tabs blanks.
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz\n\n\n\n\n\n\n\n\n ")


def _number(lang: str, word: bytes, seed: int) -> int:
    """A word's number, never 0."""
    return xxhash.xxh64_intdigest(b"%d:" % len(lang) + lang.encode() + word, seed) or 1


def _tokens(text: bytes) -> list[bytes]:
    """Words in order, a line feed where a piece ends, and empty strings where blanks follow each other."""
    return text.translate(_FOLD).replace(b"\n", b" \n ").split(b" ")


def _chunks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[str, list[bytes], np.ndarray]]:
    """Per language, the different words of some whole texts, from 1 on, and the words' numbers in order; 0 ends a piece. A
    language is handed on once it has `most` words, and all are once they have four times as many."""
    known: dict[str, dict[bytes, int]] = {}
    read: dict[str, list[np.ndarray]] = defaultdict(list)
    held: dict[str, int] = defaultdict(int)

    def closed(lang: str):
        numbers = np.concatenate(read.pop(lang))
        numbers = numbers[numbers != 1]
        del held[lang]
        return lang, list(known.pop(lang))[1:], numbers - (numbers > 1)

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), binary_texts(batch.column(1))):
            if lang not in known:
                known[lang] = number = defaultdict()
                number.default_factory = number.__len__
                number[b"\n"], number[b""] = 0, 1
            tokens = _tokens(text)
            tokens.append(b"\n")
            read[lang].append(np.fromiter(map(known[lang].__getitem__, tokens), np.int32, len(tokens)))
            held[lang] += len(tokens)
            if held[lang] >= most:
                yield closed(lang)
            elif sum(held.values()) >= 4 * most:
                yield from map(closed, list(held))
    yield from map(closed, list(held))


def _slices(numbers: np.ndarray, depth: int, most: int) -> Iterator[np.ndarray]:
    """Suffixes of two words or more, `depth` numbers wide, zeros behind the end of a piece; `most` places at once."""
    padded = np.concatenate([numbers, np.zeros(depth, numbers.dtype)])
    for begin in range(0, len(numbers), most):
        end = min(begin + most, len(numbers))
        at = begin + np.flatnonzero((padded[begin:end] > 0) & (padded[begin + 1 : end + 1] > 0))
        out = np.empty((len(at), depth), numbers.dtype)
        out[:, 0], out[:, 1] = padded[at], padded[at + 1]
        for k in range(2, depth):
            out[:, k] = np.where(out[:, k - 1] > 0, padded[at + k], 0)
        yield out


def _summed(rows: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Different rows in order, and how often each occurs, or the sum of its `counts`. Columns are numbered anew two by two, so
    all stays exact in 64 bits."""
    if not len(rows):
        return rows, np.zeros(0, np.int64)
    code, size = rows[:, 0].astype(np.int64), int(rows.max()) + 1
    for k in range(1, rows.shape[1]):
        code = code * size + rows[:, k]
        if k + 1 < rows.shape[1] and (k % 2 == 0 or size > 1 << 20):
            code = np.unique(code, return_inverse=True)[1]
    if counts is None:
        _, first, totals = np.unique(code, return_index=True, return_counts=True)
        return rows[first], totals
    _, first, at = np.unique(code, return_index=True, return_inverse=True)
    totals = np.zeros(len(first), np.int64)
    np.add.at(totals, at, counts)
    return rows[first], totals


def _word_counts(seed: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, numbers in _chunks(batches, most):
            counts = np.bincount(numbers, minlength=len(words))[1:]
            ids = np.array([_number(lang, w, seed) for w in words[1:]], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(ids), pa.string()), pa.array(words[1:], pa.binary()).cast(pa.string()), pa.array(ids), pa.array(counts, pa.int64())],
                ["lang", "word", "id", "f"],
            )

    return run


def _key(prefixes: np.ndarray) -> np.ndarray:
    """A hash of each row."""
    key = np.ascontiguousarray(prefixes[:, 0]).view(np.uint64)
    for k in range(1, prefixes.shape[1]):
        with np.errstate(over="ignore"):
            key = mix64(key) + np.ascontiguousarray(prefixes[:, k]).view(np.uint64)
    return key.view(np.int64)


def _common_prefixes(common: dict[str, dict[bytes, int]], width: int, most: int):
    """Keys of prefixes of `width` words, all of them common, with how many suffixes begin so. `common` has the words by language.
    A prefix is no more frequent than its words, so no other can hold too many suffixes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, int] = defaultdict(int)

        def packed() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.int64()), pa.array(total.values(), pa.int64())], ["part", "f"])
            total.clear()
            return out

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), binary_texts(batch.column(1))):
                if lang not in common:
                    continue
                tokens = [t for t in _tokens(text) if t]
                ids = np.fromiter(map(common[lang].get, tokens, repeat(0)), np.int64, len(tokens))
                windows = np.lib.stride_tricks.sliding_window_view(ids, width) if len(ids) >= width else ids[:0].reshape(0, width)
                keys, n = np.unique(_key(windows[(windows != 0).all(axis=1)]), return_counts=True) if len(windows) else ([], [])
                for key, times in zip(keys, n):
                    total[int(key)] += int(times)
            if len(total) >= most:
                yield packed()
        yield packed()

    return run


def _pack(ids: np.ndarray, rows: np.ndarray, counts: np.ndarray) -> bytes:
    """Suffixes as a compressed block: the words' ids once, then the columns of their numbers, in as few bytes as they take."""
    if rows.size > len(ids) // 16:  # marking the words is cheaper than sorting their places
        there = np.zeros(len(ids), dtype=bool)
        there[rows] = True
        used, place = np.flatnonzero(there), np.cumsum(there) - 1
        own = place[rows]
    else:
        used, own = np.unique(rows, return_inverse=True)
    width = np.uint8 if len(used) <= 1 << 8 else np.uint16 if len(used) <= 1 << 16 else np.uint32
    tall = np.uint8 if counts.max() < 1 << 8 else np.int64
    body = ids[used].tobytes() + own.reshape(rows.shape).T.astype(width).tobytes() + counts.astype(tall).tobytes()
    head = struct.pack("<IIBBB", len(used), len(rows), rows.shape[1], np.dtype(width).itemsize, np.dtype(tall).itemsize)
    return head + zstandard.compress(body, 3)


def _unpack(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ids of a block's words, its suffixes as numbers of them, and their counts."""
    used, n, depth, width, tall = struct.unpack_from("<IIBBB", block)
    body = zstandard.decompress(block[struct.calcsize("<IIBBB") :])
    ids = np.frombuffer(body, np.int64, used)
    own = np.frombuffer(body, f"<u{width}", n * depth, 8 * used).reshape(depth, n)
    return ids, own.T, np.frombuffer(body, np.uint8 if tall == 1 else np.int64, n, 8 * used + width * n * depth).astype(np.int64)


def _suffixes(seed: int, depth: int, wide: list[np.ndarray], groups: int, most: int):
    """Summed suffixes of two to `depth` words in blocks, one for each group that a chunk has some for. A suffix goes to the group
    of its shortest prefix that is not among `wide`, sorted keys of prefixes of 1, 2, ... words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, numbers in _chunks(batches, most):
            ids = np.array([0, *(_number(lang, w, seed) for w in words[1:])], dtype=np.uint64).view(np.int64)
            for rows in _slices(numbers, depth, most):
                if not len(rows):
                    continue
                rows, counts = _summed(rows)
                part, more = _key(ids[rows[:, :1]]), np.ones(len(rows), dtype=bool)
                for k, keys in enumerate(wide):
                    if k + 1 == depth or not len(keys):
                        break
                    more[more] = np.isin(_key(ids[rows[more, : k + 1]]), keys)
                    part[more] = _key(ids[rows[more, : k + 2]])
                group = (mix64(part.view(np.uint64)) % np.uint64(groups)).astype(np.int64)
                order = np.argsort(group, kind="stable")
                edges = np.flatnonzero(np.diff(group[order], prepend=-1, append=groups))
                blocks = [_pack(ids, rows[own], counts[own]) for own in map(order.__getitem__, map(slice, edges[:-1], edges[1:]))]
                yield pa.RecordBatch.from_arrays([pa.array(group[order[edges[:-1]]]), pa.array(blocks, pa.binary())], ["part", "block"])

    return run


def _nodes(ids: np.ndarray, rows: np.ndarray, counts: np.ndarray, least: int, wide: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Nodes of two words or more of the subtrees whose leaves are `rows`, in order: (phrase, f). Words are numbers of `ids`, of
    which 0 is no word. A node's count is the sum of the leaves below it. Nodes above the group's prefixes have a part of their leaves here and are passed on with what there is;
    others need `least`."""
    new = np.ones(len(rows), dtype=bool)
    new[1:] = rows[1:, 0] != rows[:-1, 0]
    for d in range(2, rows.shape[1] + 1):
        new[1:] |= rows[1:, d - 1] != rows[:-1, d - 1]
        firsts = np.flatnonzero(new)
        totals = np.add.reduceat(counts, firsts)
        whole = ids[rows[firsts, d - 1]] != 0
        nodes, totals = rows[firsts[whole], :d], totals[whole]
        taken = totals >= least
        if d <= len(wide) and len(wide[d - 1]):
            taken |= np.isin(_key(ids[nodes]), wide[d - 1])
        if taken.any():
            flat = pa.array(ids[nodes[taken]].reshape(-1))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, (taken.sum() + 1) * d, d), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([lists, pa.array(totals[taken])], ["phrase", "f"])


def _subtrees(least: int, wide: list[np.ndarray], most: int):
    """The nodes of each group, from its blocks, which come one after another. Blocks are summed whenever `most` suffixes are
    held, so a group takes the memory of its different suffixes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, size = None, [], 0

        def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            every = np.unique(np.concatenate([ids for ids, _, _ in held]))
            rows = np.concatenate([np.searchsorted(every, ids).astype(np.int32)[own] for ids, own, _ in held])
            return every, *_summed(rows, np.concatenate([counts for _, _, counts in held]))

        for batch in batches:
            for part, block in zip(batch.column(0).to_pylist(), batch.column(1)):
                if part != at and held:
                    yield from _nodes(*merged(), least, wide)
                    held, size = [], 0
                at = part
                held.append(_unpack(block.as_py()))
                size += len(held[-1][2])
                if size >= 2 * most:
                    held = [merged()]
                    size = len(held[0][2]) if len(held[0][2]) < most else 0
        if held:
            yield from _nodes(*merged(), least, wide)

    return run


def _told(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("told"))


def count_words(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, int]:
    """Stored rows (lang, word, id, f) of all words, and the seed at which their ids differ."""
    text_batches(docs.sparkSession)
    for seed in range(100):
        counts = _told(docs, text_col, lang_col).mapInArrow(_word_counts(seed, CHUNK), "lang string, word string, id long, f long")
        words = materialize(counts.groupBy("lang", "word", "id").agg(F.sum("f").alias("f")), "words")
        if words.groupBy("id").count().filter("count > 1").isEmpty():
            return words, seed
    raise RuntimeError("no seed gives all words different numbers")


def wide_prefixes(told: DataFrame, words: DataFrame, depth: int, budget: int) -> list[np.ndarray]:
    """Sorted keys of the prefixes of 1, 2, ... words that begin more than `budget` suffixes, each list but the last one reason to
    read the texts again. There are at most as many of a length as the corpus has words for each `budget`."""
    rows = words.filter(F.col("f") > budget).select("lang", "word", "id").collect()
    common: dict[str, dict[bytes, int]] = defaultdict(dict)
    for row in rows:
        common[row.lang][row.word.encode()] = row.id
    wide = [np.sort(_key(np.array([r.id for r in rows], dtype=np.int64)[:, None]))] if rows else []
    while wide and len(wide) + 1 < depth:
        counts = told.mapInArrow(_common_prefixes(dict(common), len(wide) + 1, CHUNK), "part long, f long")
        more = [r.part for r in counts.groupBy("part").agg(F.sum("f").alias("f")).filter(F.col("f") > budget).collect()]
        if not more:
            break
        wide.append(np.sort(np.array(more, dtype=np.int64)))
    return wide


def count_phrases(docs: DataFrame, words: DataFrame, seed: int, text_col: str = "text", lang_col: str = "lang", depth: int = DEPTH, least: int = LEAST) -> DataFrame:
    """Stored rows (phrase, f): arrays of ids of two to `depth` words that occur at least `least` times within pieces.

    There are as many groups as GROUP suffixes for each ask for, and as partitions at least. Prefixes that hold more than a
    partition's share by SHARE are extended, so there are at most SHARE of them for a partition and length; their keys are all
    that goes to every task. What depends on this division is where suffixes meet, never a count.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    told = _told(docs, text_col, lang_col)
    total = words.agg(F.sum("f")).first()[0] or 0
    groups = parts * max(1, -(-total // (GROUP * parts)))
    wide = wide_prefixes(told, words, depth, max(total // (SHARE * parts), least))
    blocks = told.mapInArrow(_suffixes(seed, depth, wide, groups, CHUNK), "part long, block binary")
    dealt = blocks.repartitionById(parts, (F.col("part") % parts).cast("int")).sortWithinPartitions("part")
    nodes = dealt.mapInArrow(_subtrees(least, wide, GROUP), "phrase array<long>, f long")
    return materialize(nodes.groupBy("phrase").agg(F.sum("f").alias("f")).filter(F.col("f") >= least), "phrases")


def _decimal(name: str, digits: int) -> Column:
    return F.col(name).cast(f"decimal({digits}, 0)")


def score_phrases(phrases: DataFrame, words: DataFrame, least: int = LEAST) -> DataFrame:
    """Rows (phrase, lang, a, l, r, n, score, dropped) of phrases of two words or more.

    A cut after k words divides a phrase into parts that occur l and r times; its score is floor(1000 * a * n / (l * r)), n
    being the words of the language. The lowest score counts, of equal ones that of the smallest k. `dropped` marks phrases
    that lie in a longer one as frequent: then they lie in one that is a word longer and as frequent too. Products are
    decimals of 38 digits, exact while a is below 10 ** 15 and n below 10 ** 17.

    Stored phrases are many times smaller than their rows in memory, and Spark goes by the files when it picks a table to
    broadcast; what grows with the texts is therefore joined by merging, and only the words of each language pass the driver.
    """
    known = words.filter(F.col("f") >= least)  # parts of a phrase occur at least as often
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    counted = phrases.select("phrase", "f").unionByName(known.select(F.array("id").alias("phrase"), "f"))
    cuts = phrases.select("phrase", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.size("phrase") - 1)).alias("k"))
    cuts = cuts.withColumns({"head": F.expr("slice(phrase, 1, k)"), "tail": F.expr("slice(phrase, k + 1, size(phrase) - k)")})
    heads = counted.select(F.col("phrase").alias("head"), F.col("f").alias("l")).hint("merge")
    tails = counted.select(F.col("phrase").alias("tail"), F.col("f").alias("r")).hint("merge")
    cuts = materialize(cuts.join(heads, "head").join(tails, "tail"), "cuts")
    within = cuts.filter("k = 1 AND r = a").select(F.col("tail").alias("phrase")).union(
        cuts.filter("k = size(phrase) - 1 AND l = a").select(F.col("head").alias("phrase"))
    )
    within = within.filter("size(phrase) > 1").distinct().withColumn("dropped", F.lit(True))
    firsts = cuts.filter("k = 1").select("phrase", F.element_at("phrase", 1).alias("id"))
    owners = firsts.join(known.select("id", "lang").hint("merge"), "id").join(totals, "lang")
    scored = cuts.join(owners.select("phrase", "lang", "n").hint("merge"), "phrase")
    over = F.lit(1000).cast("decimal(4, 0)") * _decimal("a", 15) * _decimal("n", 17)
    scored = scored.withColumn("over", over).withColumn("under", _decimal("l", 15) * _decimal("r", 15)).withColumn("score", F.expr("over div under"))
    least = scored.groupBy("phrase").agg(F.min(F.struct("score", "k", "lang", "a", "l", "r", "n")).alias("cut"))
    least = least.select("phrase", "cut.*").drop("k")
    return least.join(within.hint("merge"), "phrase", "left").withColumn("dropped", F.coalesce("dropped", F.lit(False)))


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, most: int | None = MOST, depth: int = DEPTH
) -> DataFrame:
    """Rows (lang, rank, phrase, a, l, r, n, score): the first `most` phrases of each language, or all with None.

    Texts are lower-cased in ASCII and split at `.,;:!?` and line ends into pieces, these at blanks and tabs into words. Phrases
    have 2 to `depth` words, occur at least `least` times within pieces and do not lie in a longer phrase that is as frequent.
    They are ordered by score and count, both descending, then by phrase in order of UTF-8 bytes. Null language: `und`; null
    text: empty. Repeated rows count each time; other columns are not read.
    """
    words, seed = count_words(docs, text_col, lang_col)
    phrases = count_phrases(docs, words, seed, text_col, lang_col, depth, least)
    scored = materialize(score_phrases(phrases, words, least).filter("NOT dropped").drop("dropped"), "scored")
    spelled = (
        scored.select("phrase", F.posexplode("phrase").alias("at", "id"))
        .join(words.filter(F.col("f") >= least).select("id", "word").hint("merge"), "id")
        .groupBy("phrase")
        .agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("spelled"))
        .select("phrase", F.array_join("spelled.word", " ").alias("spelled"))
    )
    named = scored.join(spelled.hint("merge"), "phrase").drop("phrase").withColumnRenamed("spelled", "phrase")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = named.withColumn("rank", F.row_number().over(order).cast("long"))
    ranked = ranked.filter(F.col("rank") <= most) if most is not None else ranked
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
