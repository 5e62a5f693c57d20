"""Quality classifier: a generalised additive model with pairwise interactions, boosted cyclically into lookup tables."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.llm.fertility import SPACES, SYMBOLS, repeated_lines, repeated_words
from tenura.llm.sampling import labelled_sample
from tenura.llm.texts import by_slice, held_out
from tenura.session import checkpointed

DIGITS = b"0123456789"
SENTENCE_MARKS = b".,;:?!"
OTHER_MARKS = b"#*$%&|<>=@_^~{}[]\\/+"
FEATURES = [
    "log_words", "word_chars", "distinct_words", "repeated_words", "repeated_lines", "symbols", "capitals", "digits",
    "marks", "bangs", "lone_marks", "top_word", "entropy", "line_words",
]


@dataclass(frozen=True)
class Additive:
    """``sample_rows`` bounds the labelled rows; ``rounds`` passes over all features, then over ``pairs`` chosen pairs.

    Each step adds a shallow tree of at most ``leaves`` leaves over the bins of one feature, times ``rate``.
    """

    sample_rows: int = 20_000
    bins: int = 32
    pair_bins: int = 8
    pairs: int = 8
    rounds: int = 60
    pair_rounds: int = 20
    leaves: int = 4
    rate: float = 0.15
    ridge: float = 2.0
    threshold: float = 0.3


def text_features(text: str | None) -> list[float]:
    """Numbers that describe a text's form; all zero without words."""
    raw = (text or "").encode("utf-8", "replace")
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    chars = len(text) - len(raw) + len(raw.translate(None, SPACES))
    letters = len(raw.translate(None, SPACES + DIGITS + SENTENCE_MARKS + OTHER_MARKS)) or 1
    counts: dict[bytes, int] = {}
    for word in words:
        counts[word] = counts.get(word, 0) + 1
    shares = np.fromiter(counts.values(), float, len(counts)) / n
    lines = raw.count(b"\n") + 1
    marks = sum(counts.get(bytes([c]), 0) for c in SENTENCE_MARKS + OTHER_MARKS)
    return [
        float(np.log1p(n)), chars / n, len(counts) / n, repeated_words(words) / n, repeated_lines(raw) / lines,
        (len(raw) - len(raw.translate(None, SYMBOLS))) / chars, sum(map(str.isupper, text)) / letters,
        (len(raw) - len(raw.translate(None, DIGITS))) / chars, (len(raw) - len(raw.translate(None, SENTENCE_MARKS))) / n,
        raw.count(b"!") / n, marks / n, float(shares.max()), float(-(shares * np.log2(shares)).sum()), float(np.log1p(n / lines)),
    ]


def edges_of(values: np.ndarray, bins: int) -> np.ndarray:
    """Inner bin edges at quantiles; a value equal to an edge falls above it."""
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1], method="higher"))


@dataclass(frozen=True)
class Model:
    """Tables of additive terms. ``edges`` cut single features, ``pair_edges`` the coarser cells of pairs."""

    intercept: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pair_edges: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def score(self, x: np.ndarray) -> np.ndarray:
        """Binning, lookups and additions for all rows at once."""
        total = np.full(len(x), self.intercept)
        for j, (edge, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edge, x[:, j], "right")]
        cells = {j: np.searchsorted(self.pair_edges[j], x[:, j], "right") for j in {j for p in self.pairs for j in p}}
        for (a, b), table in zip(self.pairs, self.pair_tables):
            total += table[cells[a], cells[b]]
        return 1.0 / (1.0 + np.exp(-np.clip(total, -35, 35)))


def shallow_tree(gradient: np.ndarray, hessian: np.ndarray, leaves: int, ridge: float) -> np.ndarray:
    """Values by bin of the best tree over ordered bins, grown leaf by leaf; each leaf takes a Newton step."""

    def gain(lo: int, hi: int) -> float:
        return gradient[lo:hi].sum() ** 2 / (hessian[lo:hi].sum() + ridge)

    def best(lo: int, hi: int) -> tuple[float, int]:
        if hi - lo < 2:
            return 0.0, lo
        g, h = np.cumsum(gradient[lo:hi])[:-1], np.cumsum(hessian[lo:hi])[:-1]
        total_g, total_h = gradient[lo:hi].sum(), hessian[lo:hi].sum()
        gains = g**2 / (h + ridge) + (total_g - g) ** 2 / (total_h - h + ridge)
        gains[(h < 1e-3) | (total_h - h < 1e-3)] = -np.inf
        at = int(np.argmax(gains))
        return float(gains[at] - gain(lo, hi)), lo + at + 1

    parts = [(0, len(gradient))]
    while len(parts) < leaves:
        options = [(*best(*p), p) for p in parts]
        value, cut, part = max(options, key=lambda o: o[0])
        if value <= 1e-9:
            break
        parts.remove(part)
        parts += [(part[0], cut), (cut, part[1])]
    out = np.zeros(len(gradient))
    for lo, hi in parts:
        out[lo:hi] = gradient[lo:hi].sum() / (hessian[lo:hi].sum() + ridge)
    return out


def _grid_tree(gradient: np.ndarray, hessian: np.ndarray, ridge: float) -> tuple[np.ndarray, float]:
    """Values of the best four-quadrant tree over a grid of cells, and its gain over one leaf."""
    g, h = gradient.cumsum(0).cumsum(1), hessian.cumsum(0).cumsum(1)
    best, at = -np.inf, (0, 0)
    rows, cols = g.shape
    for i in range(rows - 1):
        for j in range(cols - 1):
            gs = np.array([g[i, j], g[i, -1] - g[i, j], g[-1, j] - g[i, j], g[-1, -1] - g[i, -1] - g[-1, j] + g[i, j]])
            hs = np.array([h[i, j], h[i, -1] - h[i, j], h[-1, j] - h[i, j], h[-1, -1] - h[i, -1] - h[-1, j] + h[i, j]])
            value = float((gs**2 / (hs + ridge)).sum())
            if value > best:
                best, at = value, (i, j)
    if best == -np.inf:
        return np.zeros_like(gradient), 0.0
    out = np.zeros_like(gradient)
    i, j = at
    for a in (slice(0, i + 1), slice(i + 1, None)):
        for b in (slice(0, j + 1), slice(j + 1, None)):
            out[a, b] = gradient[a, b].sum() / (hessian[a, b].sum() + ridge)
    return out, best - float(g[-1, -1] ** 2 / (h[-1, -1] + ridge))


def boosted(x: np.ndarray, y: np.ndarray, how: Additive) -> Model:
    """Cyclic boosting of the logistic loss: features in turn, then the pairs with the largest gain on what is left."""
    share = min(max(y.mean() if len(y) else 0.5, 1e-3), 1 - 1e-3)
    intercept = float(np.log(share / (1 - share)))
    edges = [edges_of(x[:, j], how.bins) if len(x) else np.empty(0) for j in range(x.shape[1])]
    bins = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(edges)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    total = np.full(len(x), intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(how.rounds):
        for j, at in enumerate(bins):
            g, h = slopes()
            size = len(tables[j])
            step = how.rate * shallow_tree(np.bincount(at, g, size), np.bincount(at, h, size), how.leaves, how.ridge)
            tables[j] += step
            total += step[at]
    pair_edges = [edges_of(x[:, j], how.pair_bins) if len(x) else np.empty(0) for j in range(x.shape[1])]
    cells = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(pair_edges)]
    shape = [len(e) + 1 for e in pair_edges]

    def grid(a: int, b: int) -> tuple[np.ndarray, float]:
        g, h = slopes()
        at, size = cells[a] * shape[b] + cells[b], shape[a] * shape[b]
        return _grid_tree(np.bincount(at, g, size).reshape(shape[a], shape[b]), np.bincount(at, h, size).reshape(shape[a], shape[b]), how.ridge)

    gains = sorted(((grid(a, b)[1], (a, b)) for a, b in combinations(range(x.shape[1]), 2)), reverse=True)
    pairs = [p for gain, p in gains[: how.pairs] if gain > 0]
    pair_tables = [np.zeros((shape[a], shape[b])) for a, b in pairs]
    for _ in range(how.pair_rounds):
        for table, (a, b) in zip(pair_tables, pairs):
            step = how.rate * grid(a, b)[0]
            table += step
            total += step[cells[a], cells[b]]
    return Model(intercept, edges, tables, pair_edges, pairs, pair_tables)


def _features(docs: DataFrame) -> DataFrame:
    schema = pa.schema([("label", pa.int32()), ("features", pa.list_(pa.float64()))])

    def work(piece: pa.RecordBatch) -> dict[str, object]:
        return {"label": piece.column("label"), "features": [text_features(t) for t in piece.column("text").to_pylist()]}

    return docs.select("text", F.col("label").cast("int").alias("label")).mapInArrow(by_slice(work, schema), "label int, features array<double>")


def fit(docs: DataFrame, labels: DataFrame, how: Additive) -> Model:
    """Tables learned from the bounded sample; without labelled rows every text scores one half."""
    rows = _features(checkpointed(labelled_sample(docs, labels, "quality", how.sample_rows))).toPandas()
    x = np.array(rows["features"].tolist(), float).reshape(-1, len(FEATURES))
    return boosted(x, (rows["label"] > 0).to_numpy(float), how)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of whole texts."""
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def work(piece: pa.RecordBatch) -> dict[str, object]:
        x = np.array([text_features(t) for t in piece.column("text").to_pylist()], float).reshape(-1, len(FEATURES))
        return {"doc_id": piece.column("doc_id"), "score": pa.array(model.score(x))}

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(by_slice(work, schema), "doc_id bigint, score double")


def quality(docs: DataFrame, labels: DataFrame, how: Additive | None = None) -> DataFrame:
    """One row per input row: doc_id, held_out, score and predicted.

    Texts alone are scored; NULL, empty and blank texts score as a text whose features are all zero. Repeated rows and
    NULL ids are scored like any other; an empty table gives no rows; other columns are ignored.
    """
    how = how or Additive()
    return scored(docs, fit(docs, labels, how)).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= how.threshold).cast("int").alias("predicted")
    )
