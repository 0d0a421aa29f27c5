"""Tokenised documents packed into sequences of fixed length: best-two-fit on a histogram.

Only how many pieces there are of each length matters to the packing, so it is planned on
the histogram of lengths, which never has more entries than a sequence has tokens. A bin
found once stands for as many equal bins as the counts allow. Pieces then find their place
by their length and their number among the pieces of that length.
"""

from __future__ import annotations

import base64
import json
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from cartledger.llm.common import quoted, stored

CAPACITY = 2048
END = 0
#: Characters encoded at once, so that a very long text needs no more memory than this.
_SEGMENT = 1 << 20


def _encoder(ranks_path: str, json_path: str):
    """Encodes text as ``tokenizers`` does with the JSON file.

    tiktoken reads the same vocabulary several times faster and gives the same ids; a
    text that spells out the vocabulary's special token goes to ``tokenizers``, which
    maps it to one id.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    with open(json_path, encoding="utf-8") as f:
        special = [t["content"] for t in json.load(f)["added_tokens"]]
    exact: list[Tokenizer] = []
    # Between two letters a space always begins a new token, so a text may be cut there.
    cut = re.compile(r"(?<=[a-z]) (?=[a-z])")

    def encode(text: str) -> np.ndarray:
        if any(s in text for s in special):
            if not exact:
                exact.append(Tokenizer.from_file(json_path))
            return np.array(exact[0].encode(text, add_special_tokens=False).ids, np.uint32)
        parts, start = [], 0
        while len(text) - start > _SEGMENT:
            at = cut.search(text, start + _SEGMENT)
            if not at:
                break
            parts.append(text[start : at.start()])
            start = at.start()
        parts.append(text[start:])
        return np.concatenate([fast.encode_to_numpy(p, disallowed_special=()) for p in parts])

    return encode


def tokenizer_paths() -> tuple[str, str]:
    """The byte-level vocabulary as ranks and as JSON; other paths may be given instead."""
    import public_tokenizers

    return tuple(map(public_tokenizers.path, ("byte_bpe_50k.tiktoken", "byte_bpe_50k.json")))


def pieces(
    docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
    paths: tuple[str, str] | None = None,
) -> DataFrame:
    """(key, piece, start, length, ids) of every document: its ids, then id 0.

    ``ids`` are little-endian unsigned 32-bit numbers in one binary value. A document
    longer than ``capacity`` is cut into pieces of that length, of which the first may be
    shorter. A null text is empty and still ends with id 0. Keys are carried as they are,
    also null and repeated ones.
    """
    ranks_path, json_path = paths or tokenizer_paths()
    source = docs.select(quoted(key).alias("k"), F.coalesce(quoted(text), F.lit("")).alias("t"))
    schema = (
        source.drop("t").schema.add("piece", "integer").add("start", "long").add("length", "long")
        .add("ids", "binary")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(ranks_path, json_path)
        for batch in batches:
            rows, piece, start, length, ids = [], [], [], [], []
            for row, value in enumerate(batch.column(1)):
                tokens = np.append(encode(value.as_py()), np.uint32(END)).astype("<u4")
                first = len(tokens) % capacity or capacity
                cuts = [0, *range(min(first, len(tokens)), len(tokens) + 1, capacity)]
                for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    rows.append(row)
                    piece.append(i)
                    start.append(a)
                    length.append(b - a)
                    ids.append(tokens[a:b].tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(ids, pa.binary()),
                ],
                names=["k", "piece", "start", "length", "ids"],
            )

    return source.mapInArrow(run, schema).withColumnRenamed("k", key)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Bins as (lengths, largest first; how many such bins) that use up the counts.

    Each bin is filled greedily from the largest piece down. Then, while it has room, its
    smallest piece gives way to the two unplaced pieces that fill the widened gap best.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    bins = []
    lengths = np.flatnonzero(left)
    while lengths.size:
        free = left.copy()
        content: list[int] = []
        gap = capacity

        def largest(upto: int) -> int:
            i = np.searchsorted(lengths, upto, "right")
            while i and not free[lengths[i - 1]]:
                i -= 1
            return int(lengths[i - 1]) if i else 0

        while gap and (piece := largest(gap)):
            times = min(gap // piece, int(free[piece]))
            content += [piece] * times
            free[piece] -= times
            gap -= piece * times
        while gap:
            smallest = content[-1]
            room = gap + smallest
            ready = lengths[(free[lengths] > 0) & (lengths < room)]
            if not ready.size:
                break
            # The best partner of each piece is the largest that still fits beside it.
            at = np.searchsorted(ready, room - ready, "right") - 1
            padded = np.concatenate([[0, 0], ready])
            partner = padded[at + 2]
            alone = (partner == ready) & (free[ready] < 2)
            partner = np.where(alone, padded[at + 1], partner)
            total = np.where(partner > 0, ready + partner, 0)
            best = int(total.argmax())
            if total[best] <= smallest:
                break
            free[smallest] += 1
            pair = (int(ready[best]), int(partner[best]))
            for p in pair:
                free[p] -= 1
            content = sorted([*content[:-1], *pair], reverse=True)
            gap = capacity - sum(content)
        need = Counter(content)
        times = min(int(left[p]) // n for p, n in need.items())
        for p, n in need.items():
            left[p] -= n * times
        bins.append((content, times))
        lengths = lengths[left[lengths] > 0]
    return bins


def _slots(bins: list[tuple[list[int], int]]) -> np.ndarray:
    """Rows (length, first number, first sequence, offset): where runs of pieces go."""
    used: Counter[int] = Counter()
    sequence, rows = 0, []
    for content, times in bins:
        offset = 0
        for length in content:
            rows.append((length, used[length], sequence, offset))
            used[length] += times
            offset += length
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def pack(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with a ``length`` of 1 to ``capacity``.

    Sequences are filled without gaps from offset 0. Which of several pieces of one length
    goes where is free. An empty table gives no rows.
    """
    rows = stored(rows.withColumn("_pid", F.spark_partition_id()), "pieces")
    tally = stored(rows.groupBy("length", "_pid").agg(F.count("*").alias("_n")), "tally")
    # At most one row for each length that a sequence can hold.
    counts = {
        r["length"]: r["n"] for r in tally.groupBy("length").agg(F.sum("_n").alias("n")).collect()
    }
    if any(not 1 <= n <= capacity for n in counts):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    slots = _slots(plan(counts, capacity))
    shift = 1 << 48
    starts = slots[:, 0] * shift + slots[:, 1]

    # Numbers within a length: rows of earlier partitions first, so no length meets in one task.
    earlier = Window.partitionBy("length").orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = tally.select(
        "length", "_pid", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    inside = Window.partitionBy("length", "_pid").orderBy(F.lit(0))
    numbered = rows.join(before, ["length", "_pid"]).withColumn(
        "_number", F.col("_before") + F.row_number().over(inside) - 1
    )
    kept = [c for c in rows.columns if c != "_pid"]
    schema = numbered.select(*kept).schema.add("sequence_id", "long").add("offset", "long")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = batch.column(len(kept)).to_numpy()
            length = batch.column(kept.index("length")).to_numpy()
            at = np.searchsorted(starts, length * shift + number, "right") - 1
            found = slots[at] if len(at) else np.zeros((0, 4), np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[: len(kept)],
                    pa.array(found[:, 2] + number - found[:, 1]),
                    pa.array(found[:, 3]),
                ],
                names=[*kept, "sequence_id", "offset"],
            )

    return numbered.select(*kept, "_number").mapInArrow(place, schema)


def packed_documents(docs: DataFrame, key: str = "doc_id", text: str = "text",
                     capacity: int = CAPACITY, paths: tuple[str, str] | None = None) -> DataFrame:
    """Every piece of every document with its digest and its place in a sequence."""
    cut = pieces(docs, key, text, capacity, paths)
    return pack(cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), capacity)


def sequences(docs: DataFrame, key: str = "doc_id", text: str = "text",
              capacity: int = CAPACITY, paths: tuple[str, str] | None = None) -> DataFrame:
    """(sequence_id, length, ids) of every sequence, ids as in ``pieces``."""
    placed = pack(pieces(docs, key, text, capacity, paths).select("length", "ids"), capacity)
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))  # no more than a sequence
    joined = F.aggregate(parts, F.lit(b""), lambda all_, p: F.concat(all_, p["ids"]))
    return placed.groupBy("sequence_id").agg(
        F.sum("length").alias("length"), joined.alias("ids")
    )
