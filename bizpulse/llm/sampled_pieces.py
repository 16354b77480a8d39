"""Sampled SentencePiece segmentations, reproducible by row key, and lossless decoding.

A text's segmentations are the paths of a lattice of vocabulary pieces. A piece's weight falls with its rank in the
vocabulary; forward filtering sums the weights of all paths to each position, and backward sampling draws a path from
the end, each step in proportion to the weight of what it leads to. No piece has white space but at its start, so the
lattice falls apart into chunks; the different chunks of a few hundred texts are filtered together, a position of all of
them at a time, and each occurrence is then sampled, again all at once.

Random numbers are hashes of the seed, the row key and the position, so a row's sample depends on nothing else.
"""

from __future__ import annotations

import math
import re
from array import array
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bizpulse.llm.common import mix64, text_batches

SPACE = "▁"
#: Texts are sampled this many code points at a time, and longer texts alone.
SLICE = 1 << 19
#: Chunks longer than this are sampled one by one.
LONG = 200
_BASE = 0xD1342543DE82EF95
#: Sharpness: a piece of rank r weighs (r + 1) ** -ALPHA.
ALPHA = 1.0
_CHUNK = re.compile(" +[^ ]*|[^ ]+")


class Pieces:
    """A model's vocabulary: pieces with ranks, byte pieces, and the longest piece's length."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(count)]
        self.bytes = {int(n[3:5], 16): i for i, n in enumerate(names) if model.is_byte(i)}
        plain = [i for i in range(count) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        best = max(model.get_score(i) for i in plain)
        # Text here has plain spaces. A piece that holds the mark of a space itself would be ambiguous and is read as such.
        self.ids = {names[i].replace(SPACE, " "): i for i in plain}
        self.ranks = {i: best - model.get_score(i) for i in plain}
        self.longest = max(map(len, self.ids))
        self.texts: list[bytes] = [b""] * count
        for text, i in self.ids.items():
            self.texts[i] = text.encode()
        for byte, i in self.bytes.items():
            self.texts[i] = bytes([byte])
        if len(self.bytes) != 256 or any(" " in t.lstrip(" ") for t in self.ids):
            raise ValueError("the vocabulary needs all byte pieces, and pieces with white space at their start only")


@cache
def pieces(path: str) -> Pieces:
    return Pieces(path)


class Lattices:
    """Builds the forward-filtered lattices of many chunks at once.

    Pieces are found by 64-bit polynomial hashes of the last 1, 2, ... characters before each position, which grow by one
    term for each length; two small tables, the second for the pieces that the first has no room for, hold the hashes.
    """

    def __init__(self, vocabulary: Pieces, alpha: float):
        self.vocabulary = vocabulary
        self.weights = {text: (vocabulary.ranks[i] + 1.0) ** -alpha for text, i in vocabulary.ids.items()}
        # A character that no piece covers is spelled in bytes; it weighs as the least likely piece, for each byte.
        self.rare = min(self.weights.values())
        texts = sorted(vocabulary.ids)
        self.ids = np.array([vocabulary.ids[t] for t in texts], np.int32)
        self.piece_weights = np.array([self.weights[t] for t in texts])
        self.sizes = np.array([len(t) for t in texts], np.int8)
        with np.errstate(over="ignore"):
            self.powers = np.cumprod(np.full(vocabulary.longest, _BASE, np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            hashes = []
            for text in texts:
                codes = np.array([ord(c) for c in reversed(text)], np.uint64)
                hashes.append(int((codes * self.powers[: len(codes)]).sum()))
        self.hashes = np.array(hashes, np.uint64)
        self.tables, left = [], np.arange(len(texts))
        for shift in (np.uint64(46), np.uint64(20)):
            table = np.full(1 << 18, -1, np.int32)
            slots = self._slots(self.hashes[left], shift)
            table[slots] = left
            self.tables.append((table, shift))
            left = left[table[slots] != left]
        self.extra = left  # next to none: what neither table has room for

    @staticmethod
    def _slots(hashes: np.ndarray, shift: np.uint64) -> np.ndarray:
        return ((hashes >> shift) & np.uint64((1 << 18) - 1)).astype(np.int64)

    def find(self, hashes: np.ndarray, size: int) -> np.ndarray:
        """Numbers of the pieces of `size` characters with these hashes, -1 where there is none."""
        found = np.full(len(hashes), -1, np.int32)
        for table, shift in self.tables:
            number = table[self._slots(hashes, shift)]
            hit = np.flatnonzero(number >= 0)
            number = number[hit]
            same = (self.hashes[number] == hashes[hit]) & (self.sizes[number] == size)
            found[hit[same]] = number[same]
        for number in self.extra.tolist():
            if self.sizes[number] == size:
                found[hashes == self.hashes[number]] = number
        return found

    def build(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Lattices of chunks sorted by length, longest first: (offsets, running, labels).

        The node of chunk k and position p (1 and up) is offsets[p - 1] + k: all chunks' first positions, then all second
        ones of the chunks that have one, and so on, so that each step works on whole arrays. running[node, n - 1] is
        the probability that the piece ending there has at most n characters, labels[node, n - 1] its id, -1 for spelling.
        """
        lengths = np.fromiter(map(len, chunks), np.int64, len(chunks))
        most, wide = int(lengths[0]), self.vocabulary.longest
        alive = np.searchsorted(-lengths, -np.arange(1, most + 1), side="right")  # chunks that have the position
        offsets = np.concatenate([[0], np.cumsum(alive)])
        flat = np.frombuffer("".join(chunks).encode("utf-32-le"), "<u4").astype(np.uint64)
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        codes = [flat[starts[:m] + p] for p, m in enumerate(alive.tolist())]
        running = np.empty((int(offsets[-1]), wide), np.float32)
        labels = np.empty((int(offsets[-1]), wide), np.int32)
        forward = [np.ones(len(chunks))]
        for p, m in enumerate(alive.tolist()):
            rows = slice(int(offsets[p]), int(offsets[p]) + m)
            total, hashes = np.zeros(m), np.zeros(m, np.uint64)
            sums, own = np.empty((wide, m), np.float32), np.full((wide, m), -1, np.int32)
            steps = []
            for n in range(1, min(p + 1, wide) + 1):
                with np.errstate(over="ignore"):
                    hashes = hashes + codes[p + 1 - n][:m] * self.powers[n - 1]
                number = self.find(hashes, n)
                hit = np.flatnonzero(number >= 0)
                total[hit] += forward[p + 1 - n][hit] * self.piece_weights[number[hit]]
                own[n - 1][hit] = self.ids[number[hit]]
                if n == 1 and len(hit) < m:
                    odd = np.flatnonzero(number < 0)
                    spelled = 1 + (codes[p][odd] > 0x7F) + (codes[p][odd] > 0x7FF) + (codes[p][odd] > 0xFFFF)
                    total[odd] += forward[p][odd] * self.rare ** spelled.astype(float)
                steps.append(total.copy())
            for n in range(wide):
                np.divide(steps[min(n, len(steps) - 1)], total, out=sums[n], casting="same_kind")
            running[rows], labels[rows] = sums.T, own.T
            forward.append(total)
            small = np.flatnonzero(total < 1e-150)
            for q in range(max(0, p + 2 - wide), p + 2) if len(small) else ():  # only ratios matter
                forward[q][small] *= 1e140
        return offsets, running, labels


def _draws(row: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Uniform numbers in [0, 1) for positions `at` of rows."""
    with np.errstate(over="ignore"):
        bits = mix64(row + at.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (bits >> np.uint64(11)).astype(np.float64) * 2.0**-53


def _sample_long(chunk: str, row: np.uint64, start: int, lattices: Lattices) -> list[tuple[int, int]]:
    """(end, label) of the pieces of one long chunk that begins at `start` of its text: the same, a step at a time.

    Of the forward sums the last few are kept as they are, and of all others the logarithm, so a chunk takes a few bytes a
    character; the way back weighs the pieces that end where it comes to anew.
    """
    find, ids, longest = lattices.weights.get, lattices.vocabulary.ids, lattices.vocabulary.longest

    def ending(end: int) -> list[tuple[int, float]]:
        """Lengths and weights of the pieces that end here."""
        found = [(n, weight) for n in range(1, min(end, longest) + 1) if (weight := find(chunk[end - n : end])) is not None]
        if not found or found[0][0] > 1:
            found.insert(0, (1, lattices.rare ** len(chunk[end - 1].encode())))
        return found

    recent, logs, lifted = [1.0], array("d", [0.0]), 0.0
    for end in range(1, len(chunk) + 1):
        total = sum([recent[-n] * weight for n, weight in ending(end)])
        recent.append(total)
        logs.append(math.log(total) - lifted)
        if total < 1e-150:  # only ratios matter
            recent, lifted = [f * 1e140 for f in recent[-longest:]], lifted + math.log(1e140)
        elif len(recent) > 64 * longest:
            recent = recent[-longest:]
    out, end = [], len(chunk)
    while end:
        u, running, taken = float(_draws(np.array([row]), np.array([start + end]))[0]), 0.0, 1
        for n, weight in ending(end):
            running, taken = running + math.exp(logs[end - n] - logs[end]) * weight, n
            if running > u:
                break
        out.append((end, ids.get(chunk[end - taken : end], -1)))
        end -= taken
    return out


def sample(texts: list[str], keys: np.ndarray, lattices: Lattices, seed: int) -> list[np.ndarray]:
    """One segmentation of each text: arrays of piece ids. A space is put in front of each text that is not empty."""
    chunks: list[str] = []
    counts = []
    for text in texts:
        own = _CHUNK.findall(" " + text) if text else []
        chunks += own
        counts.append(len(own))
    if not chunks:
        return [np.zeros(0, np.int32) for _ in texts]
    sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
    kinds = set(chunks)
    long = {c for c in kinds if len(c) > LONG} if sizes.max() > LONG else set()
    kinds = sorted(kinds - long, key=len, reverse=True)
    number = dict(zip(kinds, range(len(kinds)))) | dict.fromkeys(long, -1)
    kind = np.fromiter(map(number.__getitem__, chunks), np.int64, len(chunks))

    ends = np.cumsum(sizes)
    first = ends - sizes
    text_of = np.repeat(np.arange(len(texts)), counts)
    text_end = np.cumsum(np.bincount(text_of, sizes, len(texts)).astype(np.int64))
    text_start = np.concatenate([[0], text_end[:-1]])
    row = mix64(keys.astype(np.int64).view(np.uint64) ^ mix64(np.array([seed], np.uint64)))
    label_at = np.full(int(ends[-1]) + 1, -2, np.int32)
    active = np.flatnonzero(kind >= 0)
    if len(active):
        offsets, running, labels = lattices.build(kinds)
        at = sizes[active]  # position in the chunk that each sample has come back to
        kind, begin, row_of = kind[active], first[active], row[text_of[active]]
        inside = begin - text_start[text_of[active]]
        while len(at):
            u = np.minimum(_draws(row_of, inside + at), 1 - 2.0**-24).astype(np.float32)
            node = offsets[at - 1] + kind
            taken = (running[node] <= u[:, None]).sum(axis=1, dtype=np.int64)
            label_at[begin + at] = labels[node, taken]
            at = at - taken - 1
            going = at > 0
            if not going.all():
                at, kind, begin, row_of, inside = at[going], kind[going], begin[going], row_of[going], inside[going]
    for i in np.flatnonzero(sizes > LONG).tolist():
        own = text_of[i]
        for end, label in _sample_long(chunks[i], row[own], int(first[i] - text_start[own]), lattices):
            label_at[first[i] + end] = label

    out = []
    joined = "".join(chunks)
    for start, end in zip(text_start.tolist(), text_end.tolist()):
        own = label_at[start + 1 : end + 1]
        found = np.flatnonzero(own > -2)
        ids = own[found]
        spelled = np.flatnonzero(ids == -1)
        if len(spelled):
            parts, before = [], 0
            for k in spelled.tolist():
                char = joined[start + int(found[k])]
                parts += [ids[before:k], np.array([lattices.vocabulary.bytes[b] for b in char.encode()], np.int32)]
                before = k + 1
            ids = np.concatenate([*parts, ids[before:]])
        out.append(ids)
    return out


def decode(ids: np.ndarray, vocabulary: Pieces) -> str:
    """The text that the pieces spell, without the space put in front."""
    return b"".join(map(vocabulary.texts.__getitem__, ids.tolist())).decode()[1:]


def _encoded(path: str, seed: int, alpha: float):
    @F.arrow_udf("array<int>")
    def encoded(texts: pa.Array, keys: pa.Array) -> pa.Array:
        lattices = _lattices(path, alpha)
        texts, keys = [t or "" for t in texts.to_pylist()], keys.to_numpy(zero_copy_only=False)
        out: list[np.ndarray] = []
        low = 0
        while low < len(texts):
            high, size = low, 0
            while high < len(texts) and (high == low or size + len(texts[high]) <= SLICE):
                size += len(texts[high])
                high += 1
            out += sample(texts[low:high], keys[low:high], lattices, seed)
            low = high
        bounds = np.concatenate([[0], np.cumsum([len(x) for x in out])]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(out) if out else np.zeros(0, np.int32)))

    return encoded


@cache
def _lattices(path: str, alpha: float) -> Lattices:
    return Lattices(pieces(path), alpha)


def _decoded(path: str):
    @F.arrow_udf("string")
    def decoded(ids: pa.Array) -> pa.Array:
        vocabulary, flat, bounds, at = pieces(path), ids.flatten().to_numpy(), [], 0
        for length in pc.list_value_length(ids).to_pylist():
            bounds.append(None if length is None else (at, at + length))
            at += length or 0
        return pa.array([None if b is None else decode(flat[b[0] : b[1]], vocabulary) for b in bounds], pa.string())

    return decoded


def encode_texts(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", seed: int = 0, alpha: float = ALPHA) -> DataFrame:
    """Add `pieces`, a sampled segmentation of `text_col` as an array of piece ids.

    The same key, text, seed and model give the same ids wherever the row lies; rows of equal key and text get equal ids. Null
    or empty text: no ids. A null key counts as 0. Every text, however odd its characters, decodes to itself: characters
    outside the vocabulary are spelled in byte pieces. Repeated rows are each coded, alike; a column named `pieces` is replaced.
    `model` is the path of a model file, the same on every machine.
    """
    text_batches(docs.sparkSession, 512)
    return docs.drop("pieces").withColumn("pieces", _encoded(model, seed, alpha)(F.col(text_col), F.coalesce(F.col(id_col).cast("long"), F.lit(0))))


def decode_pieces(encoded: DataFrame, model: str, ids_col: str = "pieces", to: str = "decoded") -> DataFrame:
    """Add `to`, the text that the ids in `ids_col` spell; a column of that name is replaced. Null ids: null; no ids: empty."""
    # The condition keeps two Python functions from being chained, which would run the first of them once for each use.
    return encoded.withColumn(to, _decoded(model)(F.when(F.col(ids_col).isNotNull(), F.col(ids_col))))
