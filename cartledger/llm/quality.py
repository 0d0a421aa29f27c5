"""Text quality by a generalised additive model with pairwise interactions.

Each text is measured by a few features. For every feature, and for the pairs that explain
most of what single features leave, a lookup table over its bins is learned: shallow trees
are boosted in turn, one feature at a time, with a small step each, and a tree over bins is
a table. A score is the sum of the tables' entries, so scoring is a vectorised lookup and
each feature's effect can be read off its table.
"""

from __future__ import annotations

import itertools
import operator
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cartledger.llm.common import free_name, quoted, stored
from cartledger.llm.labelled import fold, training_labels, with_labels

FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7
BINS, PAIR_BINS = 32, 8
ROUNDS, PAIR_ROUNDS = 120, 40
STEP = 0.15
#: Leaves of a tree over one feature; a tree over a pair has as many in each direction.
LEAVES = 4
PAIRS = 8
RIDGE = 1.0
FEATURES = (
    "log_words", "word_length", "upper", "digits", "punctuation", "symbols", "lone_symbols",
    "double_marks", "repeated_next", "distinct", "top_word", "repeated_lines", "line_words",
)

_SPACE, _LOWER, _UPPER, _DIGIT, _MARK, _SYMBOL = range(6)


def _classes() -> np.ndarray:
    """Class of each ASCII character; all others count as lower-case letters."""
    table = np.full(129, _SYMBOL, np.uint8)
    for c in range(128):
        ch = chr(c)
        if ch.isspace() or c < 32:
            table[c] = _SPACE
        elif ch.isalpha():
            table[c] = _UPPER if ch.isupper() else _LOWER
        elif ch.isdigit():
            table[c] = _DIGIT
        elif ch in ".,;:!?'\"()-":
            table[c] = _MARK
    table[128] = _LOWER
    return table


def features(text: str | None, classes: np.ndarray) -> list[float]:
    """The values of ``FEATURES``; an empty text has zeros."""
    words = (text or "").split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = classes[np.minimum(points, 128)]
    counts = np.bincount(kind, minlength=6)
    chars = len(kind) - counts[_SPACE]
    letters = max(1, counts[_LOWER] + counts[_UPPER])
    mark = kind >= _MARK
    space = np.concatenate([[True], kind == _SPACE, [True]])
    lone = (mark & space[:-2] & space[2:]).sum()
    double = (mark[:-1] & mark[1:] & space[3:]).sum() if len(mark) > 1 else 0
    lines = [line for line in text.split("\n") if line.strip()]
    tally = Counter(words)
    return [
        float(np.log1p(n)),
        chars / n,
        counts[_UPPER] / letters,
        counts[_DIGIT] / chars,
        counts[_MARK] / n,
        counts[_SYMBOL] / chars,
        lone / n,
        double / n,
        sum(map(operator.eq, words, words[1:])) / n,
        float(np.log(len(tally) + 1) / np.log(n + 1)),
        max(tally.values()) / n,
        1 - len(set(lines)) / len(lines),
        float(np.log1p(n / len(lines))),
    ]


@dataclass(frozen=True)
class Model:
    """Cuts of each feature's bins; tables of log-odds by bin, and by bins of pairs."""

    intercept: float
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_cuts: list[np.ndarray]
    pair_tables: list[np.ndarray]

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for j, table in enumerate(self.tables):
            total += table[np.searchsorted(self.cuts[j], x[:, j], "right")]
        for (i, j), table in zip(self.pairs, self.pair_tables):
            a, b = (np.searchsorted(self.pair_cuts[k], x[:, k], "right") for k in (i, j))
            total += table[a, b]
        return total

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(x), -30, 30)))


def _cuts(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.empty(0)


def _sigmoid(f: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(f, -30, 30)))


def _tree(g: np.ndarray, h: np.ndarray, leaves: int) -> np.ndarray:
    """Leaf number of each bin: the splits of a row of bins that gain most, one at a time."""
    borders = [0, len(g)]
    G, H = np.concatenate([[0], g.cumsum()]), np.concatenate([[0], h.cumsum()])

    def worth(a, b):
        return (G[b] - G[a]) ** 2 / (H[b] - H[a] + RIDGE)

    for _ in range(leaves - 1):
        best, at = 1e-9, None
        for a, b in itertools.pairwise(borders):
            if b - a < 2:
                continue
            m = np.arange(a + 1, b)
            gain = worth(a, m) + worth(m, b) - worth(a, b)
            if gain.max() > best:
                best, at = float(gain.max()), int(m[gain.argmax()])
        if at is None:
            break
        borders = sorted([*borders, at])
    return np.repeat(np.arange(len(borders) - 1), np.diff(borders))


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """A model of rows of features and labels 0 and 1; one kind of label gives a constant."""
    k = x.shape[1]
    cuts = [_cuts(x[:, j], BINS) for j in range(k)]
    pair_cuts = [_cuts(x[:, j], PAIR_BINS) for j in range(k)]
    tables = [np.zeros(len(c) + 1) for c in cuts]
    rate = (y.sum() + 1) / (len(y) + 2)
    intercept = float(np.log(rate / (1 - rate)))
    if len(set(y.tolist())) < 2:
        return Model(intercept, cuts, tables, [], pair_cuts, [])
    bins = [np.searchsorted(cuts[j], x[:, j], "right") for j in range(k)]
    total = np.full(len(y), intercept)
    for _ in range(ROUNDS):
        for j in range(k):
            p = _sigmoid(total)
            g = np.bincount(bins[j], y - p, len(tables[j]))
            h = np.bincount(bins[j], p * (1 - p), len(tables[j]))
            leaf = _tree(g, h, LEAVES)
            value = np.bincount(leaf, g) / (np.bincount(leaf, h) + RIDGE)
            step = STEP * value[leaf]
            tables[j] += step
            total += step[bins[j]]

    coarse = [np.searchsorted(pair_cuts[j], x[:, j], "right") for j in range(k)]
    width = [len(c) + 1 for c in pair_cuts]

    def grid(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        p = _sigmoid(total)
        cell = coarse[i] * width[j] + coarse[j]
        shape = (width[i], width[j])
        size = shape[0] * shape[1]
        return (
            np.bincount(cell, y - p, size).reshape(shape),
            np.bincount(cell, p * (1 - p), size).reshape(shape),
        )

    def gain(pair: tuple[int, int]) -> float:
        g, h = grid(*pair)
        return float((g**2 / (h + RIDGE)).sum())

    pairs = sorted(sorted(itertools.combinations(range(k), 2), key=gain, reverse=True)[:PAIRS])
    pair_tables = [np.zeros((width[i], width[j])) for i, j in pairs]
    for _ in range(PAIR_ROUNDS):
        for (i, j), table in zip(pairs, pair_tables):
            g, h = grid(i, j)
            rows, cols = _tree(g.sum(1), h.sum(1), LEAVES), _tree(g.sum(0), h.sum(0), LEAVES)
            shape = (rows.max() + 1, cols.max() + 1)
            block = (rows[:, None] * shape[1] + cols[None, :]).ravel()
            size = shape[0] * shape[1]
            value = np.bincount(block, g.ravel(), size) / (np.bincount(block, h.ravel(), size) + RIDGE)
            step = STEP * value[block].reshape(table.shape)
            table += step
            total += step[coarse[i], coarse[j]]
    return Model(intercept, cuts, tables, pairs, pair_cuts, pair_tables)


def _measured(labelled: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = _classes()
        for batch in batches:
            x = [features(t.as_py(), classes) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(x, pa.list_(pa.float64()))], names=["label", "x"]
            )

    return labelled.select("label", "text").mapInArrow(run, "label int, x array<double>")


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> Model:
    """A model from a bounded sample of the labels outside the held-out fold."""
    sample = stored(training_labels(labels, "quality", FOLDS, HELD_OUT, key), "labels")
    rows = _measured(with_labels(docs, sample, key, text)).toPandas()
    # The order in which rows arrive must not matter to the sums.
    x = np.array(rows["x"].tolist(), float).reshape(-1, len(FEATURES))
    y = rows["label"].to_numpy(float)
    order = np.lexsort([y, *x.T])
    return fit(x[order], y[order])


def with_scores(df: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """The text replaced by ``out``, its probability to be of quality; null texts are empty."""
    kept = [c for c in df.columns if c != text]
    inner = [f"k{i}" for i in range(len(kept))]
    source = df.select(*[quoted(c).alias(i) for c, i in zip(kept, inner)], quoted(text).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = _classes()
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            x = np.array([features(t.as_py(), classes) for t in texts], float)
            p = model.scores(x.reshape(-1, len(FEATURES)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(p)], names=[*inner, "s"])

    return source.mapInArrow(run, source.drop("t").schema.add("s", "double")).toDF(*kept, out)


def scored(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, score, predicted) of every row, from a model fitted on ``labels``.

    Null texts count as empty, which have all features 0. Every row is scored by itself:
    repeated rows get equal scores. A null key is not held out.
    """
    model = train(docs, labels, key, text)
    rows = docs.select(quoted(key).alias("id"), quoted(text).alias("text"))
    return with_scores(rows, model).select(
        F.col("id").alias(key),
        F.coalesce(fold(F.col("id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def good_rows(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are predicted to be of quality; columns stay as they are."""
    model = train(docs, labels, key, text)
    copy, score = free_name(docs.columns, "_text"), free_name(docs.columns, "_score")
    return (
        with_scores(docs.withColumn(copy, quoted(text)), model, copy, score)
        .where(F.col(score) >= THRESHOLD)
        .drop(score)
    )
