"""A generalised additive model with pairwise interactions as quality classifier.

Each feature of a text falls into one of a few bins. The model is a lookup table per feature and one per chosen pair of
features; a score is the logistic function of the sum of the looked-up values, so scoring is a few array additions. The
tables are learnt by boosting in cycles: one feature after the other, a tree of depth two is fitted to the residuals over its
bins and added with a small rate; then pairs are ranked by how much a tree with a cut on each explains of what remains, and
the best are boosted in the same way.

Learnt are at most ``FIT_ROWS`` labelled rows, chosen by a hash of key and label and, where keys repeat, of what the rows hold.
Keys, labels and other columns are never features. Null text counts as empty and gets a score like any text. Without labels of both classes every score is the mean of
the labels there are, or 0.5. Repeated rows get equal scores; different labels of a key each count, and of rows that agree in
key, label and features one. Null labels are ignored. A null key is in no fold: its held_out is null, and nothing is learnt
from it. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tradeloom.llm.shared import bounded_sample

THRESHOLD = 0.3
FIT_ROWS = 20_000  # rows that the model is learnt from
BINS, CYCLES, PAIR_CYCLES, PAIRS, RATE, PENALTY = 24, 120, 40, 8, 0.15, 1.0
SYMBOL = re.compile(r"[#*$%&|<>{}\[\]\\^~=_]")
CAPITALS = re.compile(r"[A-ZÀ-Þ]{2}")

FEATURES = ["log_words", "word_length", "symbols", "capitals", "exclamations", "digits", "different_words", "adjacent_repeats",
            "repeated_windows", "repeated_lines", "sentence_ends", "single_characters", "longest_word", "commas"]


def features(text: str | None) -> list[float]:
    words = (text or "").split()
    n, chars = max(len(words), 1), max(len(text or ""), 1)
    if not words:
        return [0.0] * len(FEATURES)
    triples = list(zip(words, words[1:], words[2:]))
    lines = [line for line in text.split("\n") if line.strip()]
    lengths = list(map(len, words))
    counts = Counter(triples)
    return [float(np.log1p(len(words))), sum(lengths) / n, len(SYMBOL.findall(text)) / n, 2 * len(CAPITALS.findall(text)) / chars,
            text.count("!") / n, sum(map(text.count, "0123456789")) / chars, len(set(words)) / n ** 0.9,
            sum(map(str.__eq__, words, words[1:])) / n, 1 - len(counts) / max(len(triples), 1),
            1 - len(set(lines)) / max(len(lines), 1), (text.count(".") + text.count("?")) / n,
            lengths.count(1) / n, float(max(lengths)), text.count(",") / n]


@dataclass
class Model:
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]
    base: float

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], axis=1)

    def logits(self, bins: np.ndarray) -> np.ndarray:
        total = np.full(len(bins), self.base)
        for j, values in enumerate(self.tables):
            total += values[bins[:, j]]
        for i, j, values in self.pairs:
            total += values[bins[:, i], bins[:, j]]
        return total

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.logits(self.bins(x))))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + PENALTY)


def _cut(g: np.ndarray, h: np.ndarray) -> int:
    """The best place to cut a row of bins in two; 0 if none helps."""
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gains = _gain(left_g, left_h) + _gain(g.sum() - left_g, h.sum() - left_h) - _gain(g.sum(), h.sum())
    return int(np.argmax(gains)) + 1 if len(gains) and gains.max() > 1e-9 else 0


def _shallow_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Values of a tree of depth two over the bins of one feature."""
    values, middle = np.zeros(len(g)), _cut(g, h)
    for a, b in ((0, middle), (middle, len(g))):
        if a < b:
            inner = a + _cut(g[a:b], h[a:b])
            for c, d in ((a, inner), (inner, b)):
                if c < d:
                    values[c:d] = g[c:d].sum() / (h[c:d].sum() + PENALTY)
    return values


def _crossed_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of the best tree with one cut on each of two features."""
    cum_g, cum_h = np.pad(g.cumsum(0).cumsum(1), ((1, 0), (1, 0))), np.pad(h.cumsum(0).cumsum(1), ((1, 0), (1, 0)))

    def quarters(c: np.ndarray) -> list[np.ndarray]:
        inner, right, below, whole = c[1:-1, 1:-1], c[1:-1, -1:], c[-1:, 1:-1], c[-1, -1]
        return [inner, right - inner, below - inner, whole - right - below + inner]

    parts_g, parts_h = quarters(cum_g), quarters(cum_h)
    gains = sum(_gain(a, b) for a, b in zip(parts_g, parts_h)) if parts_g[0].size else np.zeros((0, 0))
    values = np.zeros(g.shape)
    if not gains.size:
        return 0.0, values
    i, j = np.unravel_index(np.argmax(gains), gains.shape)
    leaf = [float(a[i, j] / (b[i, j] + PENALTY)) for a, b in zip(parts_g, parts_h)]
    values[:i + 1, :j + 1], values[:i + 1, j + 1:], values[i + 1:, :j + 1], values[i + 1:, j + 1:] = leaf
    return float(gains.max()), values


def learn(x: np.ndarray, y: np.ndarray) -> Model:
    """Deterministic: depends on the rows only, in the given order."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) if len(x) else np.empty(0) for j in range(len(FEATURES))]
    tables = [np.zeros(len(e) + 1) for e in edges]
    mean = float(y.mean()) if len(y) else 0.5
    if mean in (0.0, 1.0) or not len(y):
        clipped = min(max(mean, 1e-6), 1 - 1e-6)
        return Model(edges, tables, [], float(np.log(clipped / (1 - clipped))))
    model = Model(edges, tables, [], float(np.log(mean / (1 - mean))))
    bins, logits = model.bins(x), np.full(len(y), model.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-logits))
        return y - p, p * (1 - p)

    for _ in range(CYCLES):
        for j, table in enumerate(tables):
            g, h = slopes()
            step = RATE * _shallow_tree(np.bincount(bins[:, j], g, len(table)), np.bincount(bins[:, j], h, len(table)))
            table += step
            logits += step[bins[:, j]]

    def grid(i: int, j: int) -> tuple[float, np.ndarray]:
        g, h = slopes()
        shape = (len(tables[i]), len(tables[j]))
        flat = bins[:, i] * shape[1] + bins[:, j]
        return _crossed_tree(np.bincount(flat, g, shape[0] * shape[1]).reshape(shape), np.bincount(flat, h, shape[0] * shape[1]).reshape(shape))

    ranked = sorted(combinations(range(len(FEATURES)), 2), key=lambda p: -grid(*p)[0])[:PAIRS]
    model.pairs = [(i, j, np.zeros((len(tables[i]), len(tables[j])))) for i, j in ranked]
    for _ in range(PAIR_CYCLES):
        for i, j, table in model.pairs:
            step = RATE * grid(i, j)[1]
            table += step
            logits += step[bins[:, i], bins[:, j]]
    return model


def in_held_out_fold(key: str | Column) -> Column:
    return F.crc32(F.col(key).cast("string") if isinstance(key, str) else key.cast("string")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality",
        rows: int = FIT_ROWS) -> Model:
    """Learn from at most ``rows`` labelled documents outside the held-out fold."""
    known = labels.select(F.col(key), F.col(label).cast("double").alias("_label")).where(
        F.col(key).isNotNull() & F.col("_label").isNotNull() & ~in_held_out_fold(key))
    sample = bounded_sample(known.distinct(), rows, key, "_label")  # bounded, so it may be broadcast

    def rows_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc": batch[key], "label": batch["_label"], "x": [features(t) for t in batch["text"]]})

    joined = docs.select(F.col(key), F.col(text).alias("text")).join(F.broadcast(sample), key)
    made = joined.mapInPandas(rows_of, "doc string, label double, x array<double>" if dict(docs.dtypes)[key] == "string"
                              else "doc bigint, label double, x array<double>").distinct()
    # a key may have any number of documents; the features of those beyond the bound are left where they are
    found = made.orderBy(F.xxhash64("doc", "label", "x"), "doc", "label").limit(rows).toPandas()
    x = np.array(found.x.tolist(), dtype=float).reshape(len(found), len(FEATURES))
    order = np.lexsort((*x.T, found.label, found.doc))
    return learn(x[order], found.label.to_numpy()[order])


def score_of(model: Model, text: str | Column) -> Column:
    """The score of a text column, 0 to 1."""
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(np.array([features(t) for t in texts], dtype=float).reshape(len(texts), len(FEATURES))))

    return score(F.col(text) if isinstance(text, str) else text)


def classify(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """Key, ``held_out``, ``score`` and ``predicted`` of every document."""
    scored = docs.select(F.col(key), score_of(fit(docs, labels, text, key), text).alias("score"))
    return scored.select(key, in_held_out_fold(key).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def of_good_quality(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """The documents predicted to be good, with all their columns."""
    return docs.where(score_of(fit(docs, labels, text, key), text) >= threshold)
