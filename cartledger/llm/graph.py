"""Connected components of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cartledger.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each node's larger neighbours to the least node of its neighbourhood."""
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (
        both.where("v > u")
        .join(least, "u")
        .select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u")
    return (
        joined.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        .where("u <> v")
        .distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (two columns of longs), root the least node reached.

    Alternates large and small stars until nothing changes; a chain of n links takes
    about log n rounds. Only minima travel, so a node with very many links is a
    partial aggregate and a join that adaptive execution can split. Loops, repeated
    links and null ends are ignored; no links give no rows.
    """
    a, b = links.columns
    edges = (
        links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    edges, seen = stored(edges, "edges"), None
    while True:
        state = edges.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if not state[0] or state == seen:
            break
        seen = state
        edges = stored(_small_star(_large_star(edges)), "edges")
    roots = edges.select("v").distinct()
    return edges.toDF("node", "root").union(roots.select("v", "v"))
