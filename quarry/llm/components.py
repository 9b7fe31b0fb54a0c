"""Connected components over an edge table, with DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.store import forget, saved


def _signature(edges: DataFrame):
    """Row count and an order-free checksum: equal edge sets have equal signatures."""
    return edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")),
                     F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()


#: Edge tables of up to so many rows (a few MB) are worked off by one task, without shuffles.
FEW_EDGES = 100_000


def _minima(edges: DataFrame) -> DataFrame:
    return saved(edges.groupBy("u").agg(F.min("v").alias("m")), "cc-min")


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(u, v)``; component = smallest node.

    Alternating large-star and small-star steps until the edge set stands still;
    each step hangs neighbours on their smallest neighbour, so chains shorten
    geometrically and a star of any size is done at once. The minima are
    partially aggregated and written before they are joined back, so AQE can
    split the join of a hub that has a large part of all edges. Only a few numbers
    per round reach the driver; the edges' count decides whether the next round
    needs more than one task. Rows with a null end and loops are ignored; an
    empty edge table gives an empty result.
    """
    e = (edges.select("u", "v").where("u is not null and v is not null and u <> v")
         .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    e = saved(e, "cc-edges")
    before = _signature(e)
    while before[0]:
        few = before[0] <= FEW_EDGES
        together = (lambda t: t.coalesce(1)) if few else (lambda t: t)
        e = together(e)
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        both = together(both)
        low = together(_minima(both))
        large = saved(
            both.join(low, "u").where("v > u")
            .select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct(), "cc-large")
        large = together(large)
        low2 = together(_minima(large))
        small = saved(
            large.join(low2, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(low2.select("u", F.col("m").alias("v"))).transform(together).distinct(), "cc-edges")
        after = _signature(small)
        forget(e, low, large, low2)
        e = small
        if after == before:
            break
        before = after
    roots = e.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
