"""Connected components by alternating large-star and small-star rounds.

Links stay distributed: each round is two min-aggregations and two joins on the node id, and only a
count and a checksum reach the driver, gathered while the round is written. The number of rounds is
logarithmic in the longest chain. A node with very many links (the centre of one large component) is dealt
out over many tasks.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import cut

_HUB = 10_000  # links of a node that is dealt out; there are at most two in so many links


def spanning_forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Label of every one of n nodes: the smallest index that it reaches over the links (a[i], b[i])."""
    label = np.arange(n)
    while True:
        la, lb = label[a], label[b]
        open_ = la != lb
        if not open_.any():
            return label
        a, b, la, lb = a[open_], b[open_], la[open_], lb[open_]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label = jumped


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Map every node of ``edges(a, b)`` to the smallest node it reaches: columns ``node``, ``root``.

    Nulls and self links are ignored; repeated links count once; no links give an empty table.
    Nodes that are their own root are included.
    """
    e = edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    e, before = _written(e)
    for _ in range(max_rounds):
        if not before[0]:
            break
        e, after = _written(_round(e))
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(
        e.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    )


def _written(e: DataFrame) -> tuple[DataFrame, tuple]:
    """The links with their lineage cut, their number and a checksum, by one job."""
    seen = Observation()
    done = cut(e.observe(seen, F.count("*").alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("sum")))
    return done, (seen.get["n"], seen.get["sum"])


def _round(e: DataFrame) -> DataFrame:
    """A large-star step, then a small-star step."""
    both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(e.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
    large = _to_least(both, least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
    floor = large.groupBy("hi").agg(F.min("lo").alias("m"))
    small = large.join(floor, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return small.unionByName(floor.select("hi", F.col("m").alias("lo"))).distinct()


def _to_least(links: DataFrame, least: DataFrame, on: str) -> DataFrame:
    """Join of links with the least neighbour of each node; nodes of ``_HUB`` links and more are few and broadcast."""
    hubs = least.where(F.col("n") >= _HUB).drop("n")
    return links.join(least.where(F.col("n") < _HUB).drop("n"), on).unionByName(links.join(F.broadcast(hubs), on))
