"""Quality classifier: a generalised additive model with pairwise interactions.

Every feature is cut into bins by its quantiles. Boosting goes round the features, and
each step fits one shallow tree to the gradients summed by bin; what the trees of a
feature add up to is its lookup table. Then pairs of features are ranked by how much a
shallow tree over both of them would still gain, and the best pairs get tables over
their grid of bins in the same way. A score is the sum of one entry of each table.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.llm.labelled import training_rows

PER_CLASS = 4_000  # labelled rows of each class that are fitted on, at most
BINS, GRID, PAIRS = 32, 8, 6
ROUNDS, PAIR_ROUNDS, RATE = 120, 40, 0.1

FEATURES = (
    "log_words", "word_length", "upper_words", "marked_words", "bars", "repeated_next", "top_word", "distinct", "distinct_lines",
    "digits", "symbols", "long_words", "line_words", "stops",
)
_AT_ONCE = 200  # words of a stretch, within which distinct words are counted


def features(text: str | None) -> list[float]:
    """The features of a whole text, in the order of FEATURES; zeros without words."""
    words = (text or "").split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    chars = sum(map(len, words))
    distinct = sum(len(set(words[i : i + _AT_ONCE])) for i in range(0, n, _AT_ONCE))
    lines = [line for line in text.split("\n") if line.strip()]
    ends = Counter(w[-1] for w in words)
    letters = sum(map(text.count, "0123456789"))
    symbols = sum(map(text.count, "!*$#&%@|<>{}[]=_~^\\/+"))
    return [
        float(np.log1p(n)),
        chars / n,
        sum(map(str.isupper, words)) / n,
        sum(k for c, k in ends.items() if not c.isalnum() and c not in ".,;:?'\"()-") / n,
        words.count("|") / n,
        sum(map(str.__eq__, words, words[1:])) / n,
        Counter(words).most_common(1)[0][1] / n,
        distinct / n,
        len(set(lines)) / len(lines),
        letters / chars,
        symbols / chars,
        sum(1 for w in words if len(w) > 12) / n,
        float(np.log1p(n / len(lines))),
        (ends["."] + ends[","]) / n,
    ]


def matrix(texts: list[str | None]) -> np.ndarray:
    return np.array([features(t) for t in texts], float).reshape(len(texts), len(FEATURES))


@dataclass(frozen=True)
class Model:
    intercept: float
    edges: tuple[np.ndarray, ...]  # per feature: upper ends of all bins but the last
    tables: tuple[np.ndarray, ...]
    pairs: tuple[tuple[int, int, np.ndarray], ...]  # two features and the table over their bins

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for rows of features."""
        bins = [np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)]
        total = np.full(len(x), self.intercept)
        for table, b in zip(self.tables, bins):
            total += table[b]
        for i, j, table in self.pairs:
            total += table[bins[i], bins[j]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _split(g: np.ndarray, h: np.ndarray, ridge: float = 1.0, least: float = 1.0) -> tuple[float, int]:
    """The best cut of bins with gradient and curvature sums: its gain and place (0: none)."""
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    right_g, right_h = g.sum() - left_g, h.sum() - left_h
    gain = left_g**2 / (left_h + ridge) + right_g**2 / (right_h + ridge) - g.sum() ** 2 / (h.sum() + ridge)
    gain = np.where((left_h < least) | (right_h < least), 0, gain)
    best = int(np.argmax(gain)) if len(gain) else 0
    return (float(gain[best]), best + 1) if len(gain) and gain[best] > 1e-9 else (0.0, 0)


def _tree(g: np.ndarray, h: np.ndarray, depth: int = 2, ridge: float = 1.0) -> np.ndarray:
    """A shallow tree over the bins of one feature: its value in every bin."""
    _, cut = _split(g, h) if depth else (0.0, 0)
    if not cut:
        return np.full(len(g), g.sum() / (h.sum() + ridge))
    return np.concatenate((_tree(g[:cut], h[:cut], depth - 1), _tree(g[cut:], h[cut:], depth - 1)))


def _pair_tree(g: np.ndarray, h: np.ndarray, ridge: float = 1.0) -> tuple[float, np.ndarray]:
    """A tree over a grid that cuts one feature and then the other on each side: its gain and values."""
    best = (0.0, np.zeros_like(g))
    for turned in (False, True):
        a, b = (g.T, h.T) if turned else (g, h)
        for cut in range(1, len(a)):
            values, gain = np.zeros_like(a), 0.0
            for side in (slice(0, cut), slice(cut, None)):
                sums, curves = a[side].sum(axis=0), b[side].sum(axis=0)
                values[side] = _tree(sums, curves, 1)
                gain += _split(sums, curves)[0]
            if gain > best[0]:
                best = gain, values.T if turned else values
    return best


def fit(x: np.ndarray, y: np.ndarray, share: float | None = None) -> Model | None:
    """Fitted on rows of features and labels; None unless both labels occur.

    ``share`` is the share of label 1 in the population, where the rows are not a plain
    sample of it.
    """
    if len(set(y.tolist())) < 2:
        return None
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in x.T]
    bins = [np.searchsorted(e, column, side="left") for e, column in zip(edges, x.T)]
    sizes = [len(e) + 1 for e in edges]
    start = float(np.log(y.mean() / (1 - y.mean())))
    total = np.full(len(y), start)

    def sums(index: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
        return np.bincount(index, y - p, size), np.bincount(index, p * (1 - p), size)

    tables = [np.zeros(size) for size in sizes]
    for _ in range(ROUNDS):
        for j, b in enumerate(bins):
            step = RATE * _tree(*sums(b, sizes[j]))
            tables[j] += step
            total += step[b]
    # Pairs stand on a coarser grid: every bin belongs to one of GRID steps.
    coarse = [np.minimum(np.arange(size) * GRID // size, GRID - 1) for size in sizes]
    cells = {(i, j): coarse[i][bins[i]] * GRID + coarse[j][bins[j]] for i, j in combinations(range(len(bins)), 2)}

    def grids(pair):
        return [s.reshape(GRID, GRID) for s in sums(cells[pair], GRID * GRID)]

    gains = {pair: _pair_tree(*grids(pair))[0] for pair in cells}
    chosen = sorted(gains, key=lambda pair: (-gains[pair], pair))[:PAIRS]
    found = {pair: np.zeros((GRID, GRID)) for pair in chosen}
    for _ in range(PAIR_ROUNDS):
        for pair in chosen:
            step = RATE * _pair_tree(*grids(pair))[1]
            found[pair] += step
            total += step.reshape(-1)[cells[pair]]
    pairs = tuple((i, j, table[np.ix_(coarse[i], coarse[j])]) for (i, j), table in found.items())
    if share is not None and 0 < share < 1:
        start += float(np.log(share / (1 - share)) - np.log(y.mean() / (1 - y.mean())))
    return Model(start, tuple(edges), tuple(tables), pairs)


def quality(text: Column, model: Model | None) -> Column:
    """Score from 0 to 1, higher: likelier good. Null and wordless texts score as the row of zeros.

    Without a model (labels of one kind only) every score is 1.
    """
    if model is None:
        return F.lit(1.0)

    @F.arrow_udf("double")
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array(model.score(matrix([t.as_py() for t in batch])), pa.float64())

    return score(text)


def _features(text: Column) -> Column:
    @F.arrow_udf("array<double>")
    def build(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array([features(t.as_py()) for t in batch], pa.list_(pa.float64()))

    return build(text)


def trained(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model | None:
    """A model of the labelled rows outside the held-out fold, ``per_class`` of each label at most.

    Features are taken of whole texts, in tasks; only they come to the fit. Null ids and
    texts and doubtful labels are left out (see ``training_rows``), empty texts count as rows of
    zeros, repeated rows once, and no columns but doc_id, text and the label are read.
    """
    rows, share = training_rows(docs, labels, "quality", per_class)
    found = rows.select("doc_id", "label", _features(F.col("text")).alias("x")).toPandas().sort_values("doc_id")
    x = np.array(found["x"].tolist(), float).reshape(len(found), len(FEATURES))
    return fit(x, found["label"].to_numpy(), share)
