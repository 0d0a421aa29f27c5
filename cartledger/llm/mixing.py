"""Mix sources to target weights with hash thresholds found from nested histograms.

A source's budget becomes a threshold on a hash of the document: sizes are summed by
source and hash bucket, the bucket in which the budget ends is found from the running
sum, and only that bucket's rows are summed again by finer buckets. Rows are then kept by
comparing their hash, without a sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from cartledger.llm.common import WORD, free_name, quoted, ranked, stored

#: Weights by a source's place in code point order, repeating.
WEIGHTS = (3, 1, 2)
#: All targets together, as a share of all sizes.
SHARE = 1.5
#: A source's target, and a document's copies, at most.
REPEATS = 2
BITS = 60
STEP = 10


def words(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _hash(key: Column, text: Column) -> Column:
    """60 bits of a row: 36 of its key, then 24 of its text, so only rows that are equal in both
    have one hash. A null key leaves it all to the text."""
    text = F.coalesce(text, F.lit(""))
    of_key = F.substring(F.md5(F.coalesce(key.cast("string"), text)), 1, 9)
    return F.conv(F.concat(of_key, F.substring(F.md5(text), 1, 6)), 16, 10).cast("long")


def _copies_numbered(rows: DataFrame, group: Sequence[str], part: str, place: str, number: str) -> DataFrame:
    """Add ``number``, from 1, to the rows of each group, in the order of ``part`` and ``place``.

    A group may hold any share of the rows: the rows of each part are numbered by themselves,
    and then moved by the group's rows in the parts before.
    """
    names = [free_name(rows.columns, f"_g{i}") for i in range(len(group))]
    other, before = free_name(rows.columns, "_other"), free_name(rows.columns, "_before")
    held = rows.groupBy(*[quoted(c).alias(n) for c, n in zip(group, names)], F.col(part).alias(other)).agg(
        F.count("*").alias(before)
    )
    # A row for each part that holds some of a group.
    upto = Window.partitionBy(*names).orderBy(other).rowsBetween(Window.unboundedPreceding, -1)
    moved = held.withColumn(before, F.coalesce(F.sum(before).over(upto), F.lit(0)))
    inside = Window.partitionBy(*[quoted(c) for c in group], part).orderBy(place)
    same = [quoted(c).eqNullSafe(F.col(n)) for c, n in zip(group, names)]
    return (
        rows.withColumn(number, F.row_number().over(inside))
        .join(moved, [*same, F.col(part) == F.col(other)])
        .withColumn(number, F.col(number) + F.col(before))
        .drop(before, other, *names)
    )


def targets(
    sizes: DataFrame, weights: Sequence[float], share: float, repeats: int
) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    A target stops at ``repeats`` times the size; what is over goes to the others by
    weight until none is above. The loop reads one row of sums a round.
    """
    place = ranked(sizes, "source", "place")
    index = F.pmod("place", F.lit(len(weights))).cast("int")
    table = stored(
        place.select(
            "source",
            "source_size",
            F.element_at(F.array(*map(F.lit, map(float, weights))), index + 1).alias("weight"),
            (F.col("source_size") * repeats).cast("double").alias("most"),
        ),
        "sources",
    )
    total, weight = table.agg(F.sum("source_size"), F.sum("weight")).first()
    budget = share * (total or 0)
    level = budget / weight if weight else 0.0
    while True:
        full = F.col("weight") * level >= F.col("most")
        held, free = table.agg(
            F.sum(F.when(full, F.col("most"))), F.sum(F.when(~full, F.col("weight")))
        ).first()
        higher = (budget - (held or 0.0)) / free if free else level
        if higher <= level:
            break
        level = higher
    return table.select(
        "source", "source_size", F.least("most", F.col("weight") * level).alias("target")
    )


def _thresholds(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """(source, below, some): the rows of a source with a hash under ``below``, and ``some`` of those
    with that hash, make its ``budget``.

    Rows of one hash are copies, and as many are taken as bring the sum nearest to the budget.
    """
    open_goals = goals.where("budget > 0").select("source", "budget")
    todo, at, found = rows, 0, []
    while True:
        at = min(at + STEP, BITS)
        cell = F.shiftright("h", BITS - at)
        sums = todo.groupBy("source", cell.alias("cell")).agg(
            F.sum("size").alias("size"), F.count("*").alias("n"), F.min("h").alias("low"), F.max("h").alias("high")
        )
        running = Window.partitionBy("source").orderBy("cell")  # at most 2^STEP rows a source
        upto = sums.withColumn("upto", F.sum("size").over(running))
        budgets = open_goals.select(F.col("source").alias("s"), "budget")
        bucket = F.struct("cell", "size", "n", "upto", "low", "high", "budget")
        ends = stored(
            upto.join(budgets, F.col("source").eqNullSafe(F.col("s")))
            .where("upto >= budget")
            .groupBy("source")
            .agg(F.min_by(bucket, "cell").alias("end"))
            .select("source", "end.*"),
            "ends",
        )
        left = F.col("budget") - (F.col("upto") - F.col("size"))
        single = (F.col("low") == F.col("high")) | F.lit(at == BITS)
        some = F.floor(left * F.col("n") / F.col("size") + 0.5)
        found.append(ends.where(single).select("source", F.col("low").alias("below"), some.alias("some")))
        open_goals = stored(
            ends.where(~single).select("source", left.alias("budget"), "cell"), "open"
        )
        if open_goals.isEmpty():
            break
        boundary = open_goals.select(F.col("source").alias("s"), F.col("cell").alias("c"))
        inside = F.col("source").eqNullSafe(F.col("s")) & (cell == F.col("c"))
        todo = stored(todo.join(boundary, inside, "left_semi"), "boundary")
    whole = found[0]
    for part in found[1:]:
        whole = whole.union(part)
    return whole


def plan(sized: DataFrame, weights=WEIGHTS, share=SHARE, repeats=REPEATS) -> DataFrame:
    """(source, source_size, target, base, below, some) from stored rows (source, size, h).

    Each row is taken ``base`` times, and once more if its hash is under ``below`` or it is one of
    ``some`` rows with that hash.
    """
    sizes = stored(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "sizes")
    whole = F.floor(F.col("target") / F.col("source_size"))
    goals = targets(sizes, weights, share, repeats).withColumn(
        "base", F.when(F.col("source_size") > 0, whole).otherwise(0)
    )
    rest = F.col("target") - F.col("base") * F.col("source_size")
    goals = stored(goals.withColumn("budget", rest), "goals")
    below = _thresholds(sized, goals).withColumnRenamed("source", "s")
    return goals.join(below, F.col("source").eqNullSafe(F.col("s")), "left").select(
        "source", "source_size", "target", F.col("base").cast("long").alias("base"),
        F.coalesce("below", F.lit(0)).alias("below"), F.coalesce("some", F.lit(0)).cast("long").alias("some"),
    )


def _counted(rows: DataFrame, source: str, h: str, goals: DataFrame, copies: str) -> DataFrame:
    """Add ``copies``, how often a row is taken, and the columns of ``goals`` but its source.

    Only rows of the hash at which a budget ends are numbered.
    """
    own = F.col("s_source")
    # Where a row is read tells equal rows apart; both are taken before anything is joined.
    read = rows.withColumn("_part", F.spark_partition_id()).withColumn("_place", F.monotonically_increasing_id())
    met = read.join(goals.withColumnRenamed("source", "s_source"), quoted(source).eqNullSafe(own))
    edge = F.col(h) == F.col("below")
    clear = met.where(~edge).withColumn(copies, F.col("base") + (F.col(h) < F.col("below")).cast("long"))
    at_edge = _copies_numbered(met.where(edge), [source, h], "_part", "_place", "_number")
    counted = at_edge.withColumn(copies, F.col("base") + (F.col("_number") <= F.col("some")).cast("long"))
    return clear.unionByName(counted.drop("_number")).drop("s_source", "_part", "_place")


def mix(
    docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text",
    weights: Sequence[float] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS,
) -> DataFrame:
    """(key, size, source_size, target, taken) of every row.

    A null source is a source, after all others; null texts have size 0. Rows of one key stand
    together, ordered by their text; of equal rows at the end of a budget as many are taken as
    it has room for, so results do not depend on the order of rows. An empty table gives
    no rows; a source without words has target 0 and nothing taken.
    """
    sized = stored(
        docs.select(
            quoted(key).alias("id"),
            quoted(source).alias("source"),
            words(quoted(text)).alias("size"),
            _hash(quoted(key), quoted(text)).alias("h"),
        ),
        "sized",
    )
    goals = stored(plan(sized, weights, share, repeats), "plan")
    return _counted(sized, "source", "h", goals, "copies").select(
        F.col("id").alias(key), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def mixed_rows(
    docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text",
    weights: Sequence[float] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS,
) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; columns stay as they are."""
    # The names of the frame give way to those of the plan.
    inner = [f"c{i}" for i in range(len(docs.columns))]
    named = dict(zip(docs.columns, inner))
    rows = docs.toDF(*inner).withColumn("h", _hash(F.col(named[key]), F.col(named[text])))
    sized = stored(
        rows.select(F.col(named[source]).alias("source"), words(F.col(named[text])).alias("size"), "h"), "sized"
    )
    goals = stored(plan(sized, weights, share, repeats), "plan").select("source", "base", "below", "some")
    counted = _counted(rows, named[source], "h", goals, "copies")
    each = counted.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(repeats)))).where("copy <= copies")
    return each.select(*inner).toDF(*docs.columns)


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, text, '')), 1, 9) || substr(md5(coalesce(text, '')), 1, 6))::BIGINT AS h
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
  FROM sized GROUP BY source),
-- Sources fill up in the order of size by weight; with the first k full, the level is that of the rest.
filled AS (
  SELECT *, 2.0::DOUBLE * source_size / weight AS full_at, row_number() OVER w AS k,
    coalesce(sum(2 * source_size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
    sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free,
    sum(source_size) OVER () AS total
  FROM sources WINDOW w AS (ORDER BY 2.0::DOUBLE * source_size / weight, source)),
level AS (
  SELECT (1.5::DOUBLE * total - held::DOUBLE) / free AS level FROM filled
  WHERE (1.5::DOUBLE * total - held::DOUBLE) / free < full_at ORDER BY k LIMIT 1),
goals AS (
  SELECT source, source_size, least(2.0::DOUBLE * source_size, weight * coalesce((SELECT level FROM level), 0)) AS target
  FROM sources),
based AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS base FROM goals),
hashes AS (SELECT source, h, sum(size) AS size, count(*) AS n FROM sized GROUP BY source, h),
upto AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY h) AS upto FROM hashes),
ends AS (
  SELECT u.source, min(u.h) AS below,
    arg_min(floor((b.target - b.base * b.source_size - (u.upto - u.size)) * u.n / u.size + 0.5), u.h)::BIGINT AS some
  FROM upto u JOIN based b ON u.source IS NOT DISTINCT FROM b.source
  WHERE b.target - b.base * b.source_size > 0 AND u.upto >= b.target - b.base * b.source_size GROUP BY u.source),
numbered AS (SELECT *, row_number() OVER (PARTITION BY source, h) AS copy FROM sized)
SELECT s.doc_id, s.size, b.source_size, b.target,
  (b.base + CASE WHEN s.h < coalesce(e.below, 0) OR s.h = e.below AND s.copy <= e.some THEN 1 ELSE 0 END) * s.size AS taken
FROM numbered s JOIN based b ON s.source IS NOT DISTINCT FROM b.source
LEFT JOIN ends e ON s.source IS NOT DISTINCT FROM e.source
"""
