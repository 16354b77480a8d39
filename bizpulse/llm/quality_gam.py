"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature of a text falls into one of a few bins and has a table of one value per bin. Shallow trees over the bins,
boosted cyclically feature by feature with a small step, make up the tables; then the pairs of features whose grids
explain most of what is left get tables of two dimensions in the same way. A score is the sum of table entries, so
scoring is a handful of vectorised look-ups.

The model is fitted on a bounded sample of labelled texts, on the driver; everything else runs over all rows in tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bizpulse.llm.common import binary_texts, hash_sample, text_batches

#: Most labelled texts that the fit uses, chosen by a hash of the id.
SAMPLE = 20_000
FEATURES = [
    "log_words", "word_chars", "long_words", "distinct_words", "top_word", "repeats", "upper", "digits", "symbols",
    "bangs", "bars", "stops", "lines_per_word", "dup_lines", "non_ascii", "log_longest",
]
BINS, GRID, ROUNDS, PAIRS, PAIR_ROUNDS, STEP, LEAVES = 48, 8, 250, 6, 80, 0.08, 3
LEAST_IN_LEAF = 5
THRESHOLD = 0.3

_UPPER = bytes(range(65, 91))
_DIGITS = b"0123456789"
_SYMBOLS = b"#*$%&<>@^~=_\\/{}[]"
_HIGH = bytes(range(128, 256))


def features(text: bytes) -> list[float]:
    """Numbers about a whole text, all 0 for one without words. Nothing but the text goes in."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    size = len(text)
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    gone = lambda letters: size - len(text.translate(None, letters))
    lines = text.split(b"\n")
    repeats = sum(map(bytes.__eq__, words, words[1:]))
    chars = sum(map(len, words))
    return [
        float(np.log1p(n)),
        chars / n,
        sum(len(w) > 12 for w in counts) / len(counts),
        len(counts) / n,
        max(counts.values()) / n,
        repeats / n,
        gone(_UPPER) / size,
        gone(_DIGITS) / size,
        gone(_SYMBOLS) / size,
        text.count(b"!") / n,
        text.count(b"|") / n,
        text.count(b".") / n,
        len(lines) / n,
        1 - len(set(lines)) / len(lines),
        gone(_HIGH) / size,
        float(np.log1p(max(map(len, counts)))),
    ]


@dataclass
class Model:
    """Bin edges and tables; `score` adds up table entries."""

    edges: list[np.ndarray]
    start: float
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    grids: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(self.edges)]

    def logit(self, x: np.ndarray) -> np.ndarray:
        bins = self.bins(x)
        total = np.full(len(x), self.start)
        for table, own in zip(self.tables, bins):
            total += table[own]
        for (i, j), grid in zip(self.pairs, self.grids):
            total += grid[self.coarse[i][bins[i]], self.coarse[j][bins[j]]]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -40, 40)))


def _best_cut(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, int]:
    """Where to cut a row of bins in two for the largest gain, and the gain; (0, 0) without one."""
    gl, hl, nl = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(n)[:-1]
    gr, hr, nr = g.sum() - gl, h.sum() - hl, n.sum() - nl
    gain = gl**2 / (hl + 1) + gr**2 / (hr + 1) - g.sum() ** 2 / (h.sum() + 1)
    gain[(nl < LEAST_IN_LEAF) | (nr < LEAST_IN_LEAF)] = 0
    best = int(np.argmax(gain)) if len(gain) else 0
    return (float(gain[best]), best + 1) if len(gain) and gain[best] > 1e-9 else (0.0, 0)


def _tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, leaves: int = LEAVES) -> np.ndarray:
    """Leaf values over a row of bins: the leaf with the best cut is cut until there are `leaves`."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        cuts = [(*_best_cut(g[a:b], h[a:b], n[a:b]), a, b) for a, b in parts]
        gain, at, a, b = max(cuts)
        if not at:
            break
        parts.remove((a, b))
        parts += [(a, a + at), (a + at, b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + 1)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Leaf values over a grid: one cut along the first feature and one along the second on either side of it, the first
    chosen with the second ones in view, as features may matter together and neither alone."""

    def gain(side: slice) -> float:
        own = [x[side].sum(0) for x in (g, h, n)]
        return _best_cut(*own)[0] + own[0].sum() ** 2 / (own[1].sum() + 1)

    at = max(range(1, len(g)), key=lambda at: gain(slice(0, at)) + gain(slice(at, None)))
    out = np.zeros(g.shape)
    for side in (slice(0, at), slice(at, None)):
        out[side] = _tree(g[side].sum(0), h[side].sum(0), n[side].sum(0), 2)[None, :]
    return out


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Fit on features (rows, FEATURES) and labels 0/1. Without rows of both labels the model is their shrunk share."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    start = float(np.log(share / (1 - share)))
    edges = []
    for k in range(x.shape[1]):
        cuts = np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1])) if len(x) else np.zeros(0)
        edges.append(cuts)
    model = Model(edges, start, [np.zeros(len(e) + 1) for e in edges])
    model.coarse = [np.minimum(np.arange(len(e) + 1) * GRID // (len(e) + 1), GRID - 1) for e in edges]
    if len(np.unique(y)) < 2:
        return model
    bins = model.bins(x)
    total = np.full(len(x), start)
    rates = lambda: 1 / (1 + np.exp(-total))
    ones = [np.bincount(b, minlength=len(t)) for b, t in zip(bins, model.tables)]
    for _ in range(ROUNDS):
        for k, own in enumerate(bins):
            p = rates()
            size = len(model.tables[k])
            g, h = np.bincount(own, y - p, size), np.bincount(own, p * (1 - p), size)
            step = STEP * _tree(g, h, ones[k])
            model.tables[k] += step
            total += step[own]

    flat = lambda i, j: model.coarse[i][bins[i]] * GRID + model.coarse[j][bins[j]]
    p = rates()
    gains = []
    for i in range(len(bins)):
        for j in range(i + 1, len(bins)):
            own = flat(i, j)
            g, h = np.bincount(own, y - p, GRID * GRID), np.bincount(own, p * (1 - p), GRID * GRID)
            gains.append((float((g**2 / (h + 1)).sum()), i, j))
    model.pairs = [(i, j) for _, i, j in sorted(gains, reverse=True)[:PAIRS]]
    model.grids = [np.zeros((GRID, GRID)) for _ in model.pairs]
    cells = [flat(i, j) for i, j in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for k, own in enumerate(cells):
            p = rates()
            g, h, n = (np.bincount(own, w, GRID * GRID).reshape(GRID, GRID) for w in (y - p, p * (1 - p), np.ones(len(y))))
            step = STEP * _pair_tree(g, h, n)
            model.grids[k] += step
            total += step.ravel()[own]
    return model


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = np.array([features(t) for t in binary_texts(batch.column(2))], dtype=np.float64).reshape(-1, len(FEATURES))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(FEATURES)), pa.array(x.ravel()))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], ["id", "label", "x"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> Model:
    """Fit on at most `sample` texts of `labels` (id, label 0/1), those whose ids have the smallest hashes.

    Null labels and ids are left out; an id labelled more than once counts once, with its smallest label. The ids of the
    sample are broadcast: their number is bounded by the parameter, not by the data. No row matches: a constant model.
    """
    text_batches(docs.sparkSession)
    chosen = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label")).dropna()
    chosen = hash_sample(chosen.groupBy("id").agg(F.min("label").alias("label")), ["id"], sample)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = texts.join(F.broadcast(chosen), "id").select("id", "label", "text")
    found = rows.mapInArrow(_featured, "id long, label int, x array<double>").groupBy("id", "label").agg(F.min("x").alias("x"))
    table = found.toArrow().sort_by("id")
    x = np.array(table["x"].to_pylist(), dtype=np.float64).reshape(-1, len(FEATURES))
    return fit(x, table["label"].to_numpy().astype(np.float64))


def quality_score(model: Model, text: Column) -> Column:
    """The probability of label 1 for a whole text. Null counts as empty; an empty text has a score like any other."""

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        x = np.array([features(t) for t in binary_texts(texts)], dtype=np.float64).reshape(-1, len(FEATURES))
        return pa.array(model.score(x))

    return scored(text)


def classify(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Add `score` and `predicted` (1 from `threshold` on); columns of those names are replaced. One row per row."""
    text_batches(docs.sparkSession)
    scored = docs.withColumn("score", quality_score(model, F.col(text_col)))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
