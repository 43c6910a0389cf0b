"""Graph operators on edge tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.plans.lineage import cut, discard


def least_reachable(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Within one task: the smallest index that each of n nodes reaches over the links (i, j)."""
    label = np.arange(n)
    while True:
        least, new = np.minimum(label[i], label[j]), label.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        np.minimum.at(new, label[i], least)
        np.minimum.at(new, label[j], least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows (node, component) for every node of an edge; component = smallest node reachable.

    Alternates large-star and small-star rounds. Each is a minimum per node (combined before
    the shuffle) and a join, so a node with very many edges never gathers in one place.
    Null ends and loops are ignored; no edges give no rows. Nodes are of any type with an order.
    """
    e = edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
    e = cut(e.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("hi") > F.col("lo"))).distinct(), "edges")
    before = None
    while True:
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(e.select("lo", "hi"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        lows = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(lows, "hi").where("lo > m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        new = cut(small.union(lows.select("hi", "m")).distinct(), "edges")
        now = new.agg(F.count("*"), F.expr("bit_xor(xxhash64(hi, lo))"), F.expr("sum(cast(xxhash64(lo, hi) AS decimal(38, 0)))")).first()
        discard(e)
        e = new
        if now == before or now[0] == 0:
            break
        before = now
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(
        e.select("lo", "lo").distinct()
    )
