"""Connected components by alternating large-star and small-star steps.

Edges stay a distributed table. In a large-star step each node links its larger
neighbours to its smallest one, in a small-star step its smaller neighbours; both take
the smallest neighbour by a partial aggregate and a join, so that a node with a third
of all edges never gathers them in one place. Each round is written to the shared
folder; when a round changes nothing, every node points at the smallest of its
component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardvigil.llm.tables import staged


def _stamp(edges: DataFrame) -> tuple:
    """Equal for equal edge sets, and by 64 bits of hash for no others."""
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.expr("sum(cast(xxhash64(v, u) as decimal(38, 0)))")).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    linked = both.join(least, "u").where(F.col("v") > F.col("u"))
    return linked.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    linked = edges.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node that is not the smallest of its component.

    ``links`` has two columns of ids in either order; nulls, loops and repeated links
    say nothing. No links give no rows.
    """
    a, b = links.columns
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))
    )
    edges = staged(edges.distinct(), "links")
    before = _stamp(edges)
    while before[0]:
        edges = staged(_small_star(_large_star(edges)), "links")
        after = _stamp(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
