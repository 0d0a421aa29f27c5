"""Toxic passages as maximum-scoring segments of token log-odds.

Every word has the log-odds of toxic against clean documents under a Dirichlet prior; a
word never labelled falls back to its beginning, whose log-odds count how many different
words with that beginning are toxic. Words without evidence cost a little, so a text is a
walk that falls except in toxic passages. One linear scan finds all its maximal segments.
What a segment is worth follows from the extreme-value law of such walks: with the scale
found from the clean documents, a segment of score s in a text of n words is expected
n * exp(-scale * s) times by chance. The significant segments' exponents are added up and
turned into a probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from cartledger.llm.common import free_name, quoted, stored
from cartledger.llm.labelled import fold, training_labels, with_labels

FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.7
#: Pseudo-documents of the Dirichlet prior, spread over classes as all documents are.
PRIOR = 2.0
#: Words and beginnings enter the lexicon above this many standard deviations.
SIGNIFICANT = 4.0
#: Words whose log-odds are lower count as words without evidence, or against.
LEAST = 2.0
BEGINNINGS = (4, 5, 6)
#: What a word without evidence costs.
DRIFT = 0.5
MOST = 8.0
_WORD = r"\p{L}+"


@dataclass(frozen=True)
class Model:
    words: dict[str, float]
    beginnings: dict[str, float]
    scale: float
    weights: tuple[float, float]


def _log_odds(toxic, clean, n_toxic: float, n_clean: float):
    """Dirichlet log-odds of two counts of documents, and their standard deviations from 0."""
    total = n_toxic + n_clean
    prior_toxic = F.lit(PRIOR * n_toxic / total)
    prior_clean = F.lit(PRIOR * n_clean / total)
    odds = F.log((toxic + prior_toxic) / n_toxic) - F.log((clean + prior_clean) / n_clean)
    deviation = F.sqrt(1 / (toxic + prior_toxic) + 1 / (clean + prior_clean))
    return odds, odds / deviation


def _lexicon(labelled: DataFrame) -> tuple[dict[str, float], dict[str, float]]:
    """Log-odds of the significant words and beginnings of (text, label) rows."""
    n = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    n_toxic, n_clean = float(n.get(1, 0)), float(n.get(0, 0))
    if not n_toxic or not n_clean:
        return {}, {}
    tokens = labelled.select(
        "label",
        F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(_WORD), 0))).alias("w"),
    )
    words = stored(
        tokens.groupBy("w").agg(
            F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean")
        ),
        "words",
    )
    odds, z = _log_odds(F.col("toxic"), F.col("clean"), n_toxic, n_clean)
    found = words.select("w", odds.alias("odds"), z.alias("z")).where(F.abs("z") >= SIGNIFICANT)
    # A beginning counts its different words, each once, on the side where it was seen.
    starts = words.select(
        F.explode(F.array(*[F.when(F.length("w") > k, F.substring("w", 1, k)) for k in BEGINNINGS])).alias("w"),
        (F.col("clean") == 0).cast("int").alias("toxic"),
    ).where("w is not null")
    sides = words.select(
        F.sum((F.col("clean") == 0).cast("int")).alias("t"),
        F.sum((F.col("clean") > 0).cast("int")).alias("c"),
    ).first()
    types = starts.groupBy("w").agg(
        F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean")
    )
    odds, z = _log_odds(F.col("toxic"), F.col("clean"), float(sides["t"] or 1), float(sides["c"] or 1))
    begun = types.select("w", odds.alias("odds"), z.alias("z")).where(F.col("z") >= SIGNIFICANT)

    def top(df: DataFrame) -> dict[str, float]:
        rows = df.collect()  # words of a bounded sample of texts
        return {r["w"]: float(np.clip(r["odds"], -MOST, MOST)) for r in rows}

    return top(found), top(begun)


def token_scores(words: list[str], known: dict[str, float], begun: dict[str, float]) -> list[float]:
    def score(w: str) -> float:
        if (s := known.get(w)) is not None:
            return s
        best = [begun[w[:k]] for k in BEGINNINGS if len(w) > k and w[:k] in begun]
        return max(best) if best else -DRIFT

    # A word said again at once is no new evidence.
    return [
        -DRIFT if w == last else min(s, -DRIFT) if (s := score(w)) < LEAST else s
        for w, last in zip(words, ["", *words])
    ]


def maximal_segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), in order, in linear time."""
    starts, lefts, rights, ends = [], [], [], []
    total = 0.0
    for i, s in enumerate(scores):
        if s <= 0:
            total += s
            continue
        start, left, total = i, total, total + s
        right = total
        # Join with earlier segments while one of them began lower and ended lower.
        while True:
            j = len(starts) - 1
            while j >= 0 and lefts[j] >= left:
                j -= 1
            if j < 0 or rights[j] >= right:
                break
            start, left = starts[j], lefts[j]
            del starts[j:], lefts[j:], rights[j:], ends[j:]
        starts.append(start)
        lefts.append(left)
        rights.append(right)
        ends.append(i + 1)
    return [(a, b, r - l) for a, b, l, r in zip(starts, ends, lefts, rights)]


def _sums(scores: list[float], scale: float) -> float:
    """Exponents of all significant segments, added up; 0 when chance explains each."""
    n = np.log(max(len(scores), 1))
    return float(sum(max(0.0, scale * s - n) for _, _, s in maximal_segments(scores)))


def _chance_scale(values: np.ndarray, share: np.ndarray) -> float:
    """The positive root x of sum(share * exp(x * value)) = 1: how fast chance scores die out."""
    if not (values > 0).any() or (values * share).sum() >= 0:
        return 1.0
    low, high = 1e-6, 1e-3
    while (share * np.exp(high * values)).sum() < 1:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if (share * np.exp(mid * values)).sum() < 1 else (low, mid)
    return high


def _statistics(labelled: DataFrame, lexicon, scale: float) -> DataFrame:
    """(label, x) of (text, label) rows."""
    known, begun = lexicon

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _splitter()
        for batch in batches:
            x = [_sums(token_scores(words(t.as_py()), known, begun), scale) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.float64())], names=["label", "x"])

    return labelled.select("label", "text").mapInArrow(run, "label int, x double")


def _splitter():
    """The runs of letters of a text, in lower case."""
    pattern = regex.compile(_WORD)
    return lambda text: pattern.findall((text or "").lower())


def _chance(labelled: DataFrame, lexicon) -> float:
    """The scale of chance scores from the clean rows' words."""
    known, begun = lexicon

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _splitter()
        for batch in batches:
            tally: dict[float, int] = {}
            for t in batch.column(0):
                for s in token_scores(words(t.as_py()), known, begun):
                    tally[s] = tally.get(s, 0) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(tally.keys(), pa.float64()), pa.array(tally.values(), pa.int64())], names=["s", "n"]
            )

    # A row for each entry of the lexicon at most.
    rows = (
        labelled.where("label = 0").select("text").mapInArrow(run, "s double, n long")
        .groupBy("s").agg(F.sum("n").alias("n")).collect()
    )
    if not rows:
        return 1.0
    # Each value of the lexicon is taken to occur once at least, so the walk can rise.
    counts = dict.fromkeys([-DRIFT, *known.values(), *begun.values()], 0.0)
    counts |= {r["s"]: float(r["n"]) for r in rows}
    values = np.array(list(counts))
    share = np.maximum(np.array(list(counts.values())), 1.0)
    positive = values > 0
    if positive.any():  # one pseudo-count in all for what clean texts never hold
        share[positive] = np.array(list(counts.values()))[positive] + 1.0 / positive.sum()
    return _chance_scale(values, share / share.sum())


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Intercept and slope, by Newton steps with a small ridge; the slope is not negative."""
    a, b = 0.0, 0.0
    design = np.column_stack([np.ones_like(x), x])
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        grad = design.T @ (p - y) + 1e-2 * w
        hess = (design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    a, b = w
    return float(a), float(max(b, 0.0))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> Model:
    """A model from the labels outside the held-out fold.

    Three quarters of the sample give the lexicon, the last the calibration, so that words
    seen once do not make the segments look surer than they are. Without labels of both
    kinds every text scores alike.
    """
    sample = stored(training_labels(labels, "toxic", FOLDS, HELD_OUT, key), "labels")
    labelled = with_labels(docs, sample, key, text).withColumn(
        "part", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(4))
    )
    lexicon = _lexicon(labelled.where("part <> 0"))
    scale = _chance(labelled.where("part = 0"), lexicon)
    rows = _statistics(labelled.where("part = 0"), lexicon, scale).collect()  # a bounded sample
    y = np.array([r["label"] for r in rows], float)
    x = np.log1p(np.array([r["x"] for r in rows], float))
    weights = _logistic(x, y) if len(set(y)) == 2 else (-3.0, 1.0)
    return Model(*lexicon, scale, weights)


def with_scores(df: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """The text replaced by ``out``, its probability to be toxic; null texts are empty."""
    kept = [c for c in df.columns if c != text]
    inner = [f"k{i}" for i in range(len(kept))]
    source = df.select(*[quoted(c).alias(i) for c, i in zip(kept, inner)], quoted(text).alias("t"))
    known, begun, scale, (a, b) = model.words, model.beginnings, model.scale, model.weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _splitter()
        for batch in batches:
            x = [
                _sums(token_scores(words(t.as_py()), known, begun), scale)
                for t in batch.column(batch.num_columns - 1)
            ]
            p = 1 / (1 + np.exp(-(a + b * np.log1p(np.array(x, float)))))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(p)], names=[*inner, "s"])

    return source.mapInArrow(run, source.drop("t").schema.add("s", "double")).toDF(*kept, out)


def passages(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, start, end, passage, exponent) of every significant passage, in characters."""
    source = docs.select(quoted(key).alias("k"), quoted(text).alias("t"))
    known, begun, scale = model.words, model.beginnings, model.scale
    schema = source.drop("t").schema
    for name, kind in (("start", "long"), ("end", "long"), ("passage", "string"), ("exponent", "double")):
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = regex.compile(_WORD)
        for batch in batches:
            rows, found = [], []
            for i, t in enumerate(batch.column(1)):
                value = t.as_py() or ""
                spans = list(pattern.finditer(value))
                scores = token_scores([m[0].lower() for m in spans], known, begun)
                for a, b, s in maximal_segments(scores):
                    if (e := scale * s - np.log(len(scores))) > 0:
                        rows.append(i)
                        start, end = spans[a].start(), spans[b - 1].end()
                        found.append((start, end, value[start:end], float(e)))
            columns = list(zip(*found)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    pa.array(columns[0], pa.int64()),
                    pa.array(columns[1], pa.int64()),
                    pa.array(columns[2], pa.string()),
                    pa.array(columns[3], pa.float64()),
                ],
                names=schema.names,
            )

    return source.mapInArrow(run, schema).withColumnRenamed("k", key)


def scored(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, score, predicted) of every row, from a model fitted on ``labels``.

    Empty and null texts have no segment and get the score of that. Every row is scored
    by itself: repeated rows get equal scores. A null key is not held out.
    """
    model = fit(docs, labels, key, text)
    rows = docs.select(quoted(key).alias("id"), quoted(text).alias("text"))
    return with_scores(rows, model).select(
        F.col("id").alias(key),
        F.coalesce(fold(F.col("id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def clean_rows(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic; columns stay as they are."""
    model = fit(docs, labels, key, text)
    copy, score = free_name(docs.columns, "_text"), free_name(docs.columns, "_score")
    return (
        with_scores(docs.withColumn(copy, quoted(text)), model, copy, score)
        .where(F.col(score) < THRESHOLD)
        .drop(score)
    )
