"""Near copies by SimHash: multi-index hashing over 64-bit fingerprints.

Two fingerprints within 3 bits agree in one half up to 1 bit. So each fingerprint is
looked up, half by half, under every value of a small Hamming ball around its half, and
whole distances are verified. A ball is walked downwards only (bits cleared): of two
halves that differ in one bit, the one with the bit set finds the other. A half shared
by many fingerprints is split on the other half in the same way, so no group grows
past what fits 8 free bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from cartledger.llm.common import free_name, quoted, stored
from cartledger.llm.graph import components

DISTANCE = 3
SHINGLE = 3
SEED = 42
#: Fingerprints under one key from which the key is split further; results do not depend on it.
SPLIT_ABOVE = 64
_CHUNK = 1 << 16


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Unsigned SimHash of UTF-8 text; 0 without a word."""
    words = (text or b"").lower().split()  # bytes: ASCII case and ASCII white space only
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for start in range(0, n, _CHUNK):
        part = words[start : start + _CHUNK + shingle - 1]
        rows = zip(*(part[i:] for i in range(shingle))) if len(words) > shingle else [words]
        hashed = np.array(
            [xxhash.xxh64_intdigest(b" ".join(row), SEED) for row in rows], np.uint64
        )
        bits = np.unpackbits(hashed.view(np.uint8), bitorder="little").reshape(-1, 64)
        ones += bits.sum(0, dtype=np.uint32)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def with_fingerprints(df: DataFrame, text: str, out: str = "fp", shingle: int = SHINGLE):
    """All columns but the text, and ``out``: the fingerprint as a signed long.

    A null text has no words and so fingerprint 0.
    """
    kept = [c for c in df.columns if c != text]
    # Positional names: the columns kept may clash with each other's case or with ``out``.
    inner = [f"k{i}" for i in range(len(kept))]
    source = df.select(
        *[quoted(c).alias(i) for c, i in zip(kept, inner)],
        quoted(text).cast("binary").alias("t"),
    )
    schema = source.drop("t").schema.add("fp", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            fps = np.fromiter(
                (fingerprint(t.as_py(), shingle) for t in texts), np.uint64, len(texts)
            )
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(fps.view(np.int64))], names=[*inner, "fp"]
            )

    return source.mapInArrow(run, schema).toDF(*kept, out)


def hex_digits(fp: Column | str) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _bits(value: Column, width: int, half: int) -> Column:
    """Half 0 or 1 (the upper) of a value of ``width`` bits."""
    return F.shiftright(value, half * width // 2).bitwiseAND(F.lit((1 << width // 2) - 1))


def _halves(df: DataFrame, width: int, keys) -> DataFrame:
    """A row for each key of each half of ``rest``; the other half is the new rest."""
    def of(half: int) -> Column:
        own, other = (_bits(F.col("rest"), width, h) for h in (half, 1 - half))
        return F.transform(
            keys(own, width // 2),
            lambda k: F.struct(
                F.xxhash64("key", F.lit(half), k).alias("key"),
                other.alias("rest"),
                (k == own).alias("same"),
            ),
        )

    rows = [of(0), of(1)]
    kept = [c for c in df.columns if c not in ("key", "rest")]
    return df.select(*kept, F.explode(F.concat(*rows)).alias("x")).select(*kept, "x.*")


def _itself(value: Column, width: int) -> Column:
    return F.array(value)


def _cleared(value: Column, width: int) -> Column:
    """The value, and it with each of its set bits cleared."""
    powers = F.array(*[F.lit(1 << i).cast("long") for i in range(width)])
    ones = F.filter(powers, lambda p: value.bitwiseAND(p) != 0)
    return F.concat(F.array(value), F.transform(ones, lambda p: value.bitwiseXOR(p)))


def _flipped(value: Column, width: int) -> Column:
    """The value, and it with each of its bits flipped."""
    powers = F.array(*[F.lit(1 << i).cast("long") for i in range(width)])
    return F.concat(F.array(value), F.transform(powers, lambda p: value.bitwiseXOR(p)))


def _verified(probes: DataFrame, table: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b, within the distance; ``first``: an exact half, so seen from both ends.

    Both sides are shuffled, whatever Spark takes their sizes for: it does not count the rows that
    an explode adds, and would broadcast balls of many times the size of what they are made from.
    """
    p, t = probes.alias("p").hint("merge"), table.alias("t").hint("merge")
    near = F.bit_count(F.col("p.fp").bitwiseXOR(F.col("t.fp"))) <= DISTANCE
    once = ~F.col("p.first") | (F.col("p.fp") < F.col("t.fp"))
    return (
        p.join(t, F.col("p.key") == F.col("t.key"))
        .where(once & (F.col("p.fp") != F.col("t.fp")) & near)
        .select(
            F.least("p.fp", "t.fp").alias("a"),
            F.greatest("p.fp", "t.fp").alias("b"),
        )
    )


def near_pairs(fps: DataFrame) -> DataFrame:
    """All pairs (a, b) of the distinct fingerprints ``fp`` within ``DISTANCE`` bits."""
    root = fps.select("fp", F.lit(0).cast("long").alias("key"), F.col("fp").alias("rest"))
    table = stored(_halves(root, 64, _itself).drop("same"), "table")
    probes = _halves(root, 64, _cleared).withColumn("first", F.col("same")).drop("same")
    found = []
    for width in (32, 16, 0):
        crowded = None
        if width:
            crowded = stored(
                table.groupBy("key").count().where(F.col("count") > SPLIT_ABOVE).select("key"),
                "crowded",
            )
            if crowded.isEmpty():
                crowded = None
        if crowded is None:
            found.append(_verified(probes, table))
            break
        found.append(
            _verified(probes.join(crowded, "key", "left_anti"), table)
        )
        probes = _halves(probes.join(crowded, "key", "left_semi"), width, _flipped).drop("same")
        table = stored(
            _halves(table.join(crowded, "key", "left_semi"), width, _itself).drop("same"), "table"
        )
        probes = stored(probes, "probes")
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.union(more)
    return pairs.distinct()


def fingerprint_components(fps: DataFrame) -> DataFrame:
    """(fp, root): the component of each distinct fingerprint that links with another."""
    return components(near_pairs(fps)).toDF("fp", "root")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fingerprint, component_id) of every row; component_id is the least key reachable.

    Null and wordless texts have fingerprint 0 and link like any other. Rows with a null
    key take part; a component of such rows only has a null id. Copies, also of the whole
    row, share a fingerprint and each get their row. An empty table gives no rows. Other
    columns of ``docs`` are not read.
    """
    signed = stored(
        with_fingerprints(docs.select(quoted(key).alias("id"), quoted(text).alias("text")), "text"),
        "fingerprints",
    )
    fps = stored(signed.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    roots = fingerprint_components(fps)
    linked = stored(fps.join(roots, "fp"), "linked")
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    named = linked.join(least, "root").select("fp", "component_id")
    ids = fps.join(named, "fp", "left").select(
        "fp", F.when(F.col("component_id").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id")
    )
    return signed.join(ids, "fp").select(
        F.col("id").alias(key), hex_digits("fp").alias("fingerprint"), "component_id"
    )


def _without(df: DataFrame, rows: DataFrame, key: str, mark: str, how: str = "left_anti"):
    """Rows of ``df`` whose (key, hash) is not among ``rows``; a null key equals a null key."""
    id_, h = free_name(df.columns, "_id"), free_name(df.columns, "_hash")
    other = rows.select(F.col("id").alias(id_), F.col("h").alias(h))
    return df.join(other, quoted(key).eqNullSafe(F.col(id_)) & (quoted(mark) == F.col(h)), how)


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the row with the least key.

    Ties of the key go to the least row hash; whole-row copies leave one row. Rows with
    null keys come after all others. Columns stay as they are, whatever their names.
    """
    mark = free_name(docs.columns, "row_hash")
    marked = docs.withColumn(mark, F.xxhash64(*[quoted(c) for c in docs.columns]))
    signed = stored(
        with_fingerprints(
            marked.select(quoted(key).alias("id"), quoted(mark).alias("h"), quoted(text).alias("text")),
            "text",
        ),
        "fingerprints",
    )
    rows = F.struct(F.col("id").isNull().alias("none"), "id", "h")
    fps = stored(
        signed.groupBy("fp").agg(F.min(rows).alias("least"), F.count("*").alias("n")), "distinct"
    )
    roots = fingerprint_components(fps)
    grouped = fps.join(roots, "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    best = grouped.groupBy("root").agg(F.min("least").alias("best"))
    winners = stored(
        grouped.join(best, "root").where(F.col("least") == F.col("best"))
        .select(F.col("least.id").alias("id"), F.col("least.h").alias("h")),
        "winners",
    )
    # Those that go are the fewer: match them, not the rows that stay.
    lost = stored(
        _without(signed.select("id", "h"), winners, "id", "h").distinct(), "lost"
    )
    stay = _without(marked, lost, key, mark)
    copies = stored(
        signed.groupBy("id", "h").count().where("count > 1").select("id", "h"),
        "copies",
    )
    if copies.isEmpty():
        return stay.drop(mark)
    once = _without(stay, copies, key, mark)
    repeated = _without(stay, copies, key, mark, "left_semi").dropDuplicates([key, mark])
    return once.union(repeated).drop(mark)
