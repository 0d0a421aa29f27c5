"""Training rows for the classifiers: which labels may be learned from, and how many."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cartledger.llm.common import quoted

#: Labelled rows that a classifier is fitted on, about; the table may hold any number.
MAX_LABELLED = 50_000


def fold(key: Column, folds: int) -> Column:
    return F.crc32(key.cast("string").cast("binary")) % folds


def training_labels(
    labels: DataFrame, target: str, folds: int, held_out: int, key: str = "doc_id",
    most: int = MAX_LABELLED,
) -> DataFrame:
    """(id, label) of about ``most`` labelled rows outside the held-out fold, one a key.

    The sample is by a hash of the key, so it is the same in every run. A key labelled
    twice has its largest label; null keys and labels are left out.
    """
    rows = (
        labels.where(quoted(key).isNotNull() & quoted(target).isNotNull())
        .where(fold(quoted(key), folds) != held_out)
        .groupBy(quoted(key).alias("id"))
        .agg(F.max(quoted(target)).cast("int").alias("label"))
    )
    n = rows.count()
    if n > most:
        rows = rows.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(1_000_000 * most / n))
    return rows


def with_labels(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text"):
    """(id, text, label) of the labelled documents, one a key; the labels are a bounded sample.

    Of a key that occurs more than once the text with the least hash counts, so what comes of
    the sample is bounded by the number of labels, however often its keys are repeated.
    """
    found = docs.select(quoted(key).alias("id"), quoted(text).alias("text")).join(F.broadcast(labels), "id")
    return found.groupBy("id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("id", "text", "label")
