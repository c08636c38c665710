"""Connected components of an undirected graph given as edges, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import store


HUB_DEGREE = 256
HUBS = 1024
SALTS = 64


def with_least(edges: DataFrame, total: int) -> DataFrame:
    """Add to each edge (u, v) the smallest v of its u as ``m``.

    A node with more than a thousandth of all edges is a hub: there are at most HUBS of
    them, and their edges are dealt over SALTS tasks.
    """
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("degree"))
    hubs = [r["u"] for r in least.filter(F.col("degree") > max(HUB_DEGREE, total // HUBS)).select("u").collect()]
    if not hubs:
        return edges.join(least.select("u", "m"), "u")
    is_hub, salts = F.col("u").isin(hubs), F.array(*map(F.lit, range(SALTS)))
    salted = edges.withColumn("salt", F.when(is_hub, F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")).otherwise(0))
    spread = least.select("u", "m", F.explode(F.when(is_hub, salts).otherwise(F.array(F.lit(0)))).alias("salt"))
    return salted.join(spread, ["u", "salt"]).drop("salt")


def large_star(edges: DataFrame, total: int) -> DataFrame:
    """Every node hands its larger neighbours the smallest node it knows."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    handed = with_least(both, 2 * total).filter("v > u")
    return handed.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).filter("u <> v").distinct()


def small_star(edges: DataFrame, total: int) -> DataFrame:
    """Every node ties its smaller neighbours and itself to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    tied = with_least(down, total).select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
    return tied.filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for all nodes of ``edges`` (u, v); the component is its smallest node.

    Minima are aggregated in the map tasks, and a node with very many neighbours is salted.
    Each round is written, and the rounds end when the stars no longer change.
    """

    def digest(e: DataFrame):
        return tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())

    edges = edges.filter("u <> v")
    now, seen = edges, (edges.count(), None)
    while True:
        larger = store(large_star(now, seen[0]), "components")
        now = store(small_star(larger, seen[0]), "components")
        if (then := digest(now)) == seen:
            break
        seen = then
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.union(roots)
