"""Periodic runs: stretches of words that go on repeating what stood a few words before.

A run of period q is a diagonal of a document against itself: words q apart are equal along
it. Lags are taken in classes from L to 2 L. A run that is long enough, with a lag of the
class, holds two copies of every one of its k-grams, k being the least overlap that any
such run guarantees. The k-grams of a class are indexed, and of the occurrences of one in the
same document each is paired with the next only: a k-gram is no shorter than its lag, so
inside a run of smallest period q its next occurrence lies exactly q words on, and the
number of pairs stays in proportion to the words. A pair is a seed, extended both ways along
its diagonal; a table of how far each lag is covered spares the seeds of a stretch that is
known already.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from cartledger.llm.common import quoted

#: Words of a run at least, and repeats of its period.
LEAST, REPEATS = 6, 4
RUNS = ArrayType(StructType([StructField(c, LongType()) for c in ("start", "length", "period")]))
#: Words compared at once when a seed is extended; each further step takes twice as many.
STRIDE = 64


def guaranteed(low: int, least: int = LEAST, repeats: int = REPEATS) -> int:
    """The overlap with itself that any run guarantees whose period is ``low`` to 2 ``low`` - 1."""
    # From ``least`` on the overlap grows with the period.
    return min(max(least, repeats * q) - q for q in range(low, min(2 * low, max(low + 1, least))))


class _Grams:
    """Numbers for the k-grams of a document, equal where the words are, by doubling."""

    def __init__(self, words: np.ndarray):
        self.powers = [words]

    def of(self, k: int) -> np.ndarray:
        level = k.bit_length() - 1
        while len(self.powers) <= level:
            half = 1 << (len(self.powers) - 1)
            self.powers.append(self._paired(self.powers[-1], half))
        rank, width = self.powers[level], 1 << level
        return rank if width == k else self._paired(rank, k - width)

    @staticmethod
    def _paired(rank: np.ndarray, on: int) -> np.ndarray:
        both = rank[:-on] * (int(rank.max()) + 1 if len(rank) else 1) + rank[on:]
        return np.unique(both, return_inverse=True)[1]


def _equal_ahead(words: np.ndarray, a: int, b: int, step: int) -> int:
    """Words equal from ``a`` and from ``b`` on, forwards (``step`` 1) or backwards (-1); a < b."""
    most = len(words) - b if step > 0 else a + 1
    found, stride = 0, STRIDE
    while found < most:
        n = min(stride, most - found)
        at = np.arange(found, found + n) * step
        differ = words[a + at] != words[b + at]
        if differ.any():
            return found + int(differ.argmax())
        found, stride = found + n, 2 * stride
    return found


def runs(words: np.ndarray, least: int = LEAST, repeats: int = REPEATS) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs in an array of word numbers, by start, then period."""
    if repeats < 3:
        raise ValueError("with fewer than three repeats a k-gram may be shorter than its lag")
    n, low, found = len(words), 1, []
    grams = _Grams(words)
    while max(least, repeats * low) <= n:
        k = guaranteed(low, least, repeats)
        rank = grams.of(k)
        order = np.argsort(rank, kind="stable")
        again = rank[order[1:]] == rank[order[:-1]]
        if not again.any():
            break  # longer k-grams repeat no more
        at, lag = order[:-1][again], np.diff(order)[again]
        own = (lag >= low) & (lag < 2 * low)
        at, lag = at[own], lag[own]
        order = np.lexsort((at, lag))
        at, lag = at[order], lag[order]
        covered, i = {}, 0
        while i < len(at):
            q, start = int(lag[i]), int(at[i])
            if start >= covered.get(q, 0):
                before = _equal_ahead(words, start - 1, start - 1 + q, -1) if start else 0
                end = start + k + _equal_ahead(words, start + k, start + k + q, 1)
                covered[q] = end
                length = end + q - (start - before)
                if length >= max(least, repeats * q):
                    found.append((start - before, length, q))
            # On to the first seed of this lag that is not covered, or to the next lag.
            last = i + int(np.searchsorted(lag[i:], q, "right"))
            i += int(np.searchsorted(at[i:last], covered[q]))
        low *= 2
    return sorted(found, key=lambda r: (r[0], r[2]))


def numbered(words: list[bytes]) -> np.ndarray:
    """A number for each word, equal for equal words."""
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))


def collapsed(words: list, found: list[tuple[int, int, int]]) -> list:
    """The words without those that a run contains after its first period."""
    keep = np.ones(len(words), bool)
    for start, length, period in found:
        keep[start + period : start + length] = False
    return [w for w, kept in zip(words, keep.tolist()) if kept] if found else words


def detect(docs: DataFrame, text: str | Column = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(kept columns, n_words, runs, collapsed) of every row.

    ``runs`` are all stretches (start, length, period) of at least 6 words and 4 periods that no
    neighbouring word extends, by start, then period; ``period`` is the smallest there is.
    ``collapsed`` is the text with each run cut down to its first period, single spaces
    between words. Every row is read by itself and whole: repeated rows give equal rows, null
    and wordless texts no runs and an empty text; other columns are not read.
    """
    inner = [f"k{i}" for i in range(len(keep))]
    source = docs.select(
        *[quoted(c).alias(i) for c, i in zip(keep, inner)],
        F.coalesce(quoted(text) if isinstance(text, str) else text, F.lit("")).cast("binary").alias("t"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
        for batch in batches:
            n, spans, texts = [], [], []
            for value in batch.column(batch.num_columns - 1):
                # Splitting bytes breaks at just the white space of the word rule.
                words = value.as_py().split()
                found = runs(numbered(words))
                n.append(len(words))
                spans.append([{"start": s, "length": m, "period": q} for s, m, q in found])
                texts.append(b" ".join(collapsed(words, found)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(n, pa.int64()), pa.array(spans, kind), pa.array(texts, pa.binary()).cast(pa.string())],
                names=[*inner, "n_words", "runs", "collapsed"],
            )

    schema = source.drop("t").schema.add("n_words", "long").add("runs", RUNS).add("collapsed", "string")
    return source.mapInArrow(run, schema).toDF(*keep, "n_words", "runs", "collapsed")


def longest(runs: Column) -> Column:
    """The longest of an array of runs, ties by smaller start, then period; null without any."""
    ordered = F.transform(
        runs, lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))
    )
    best = F.array_min(ordered)
    return F.when(best.isNotNull(), F.struct(
        best["start"].alias("start"), (-best["less"]).alias("length"), best["period"].alias("period")
    ))
