"""Fusion of ranked lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .search import top_k


def ranked(scored: DataFrame, limit: int) -> DataFrame:
    """``id`` and ``rank`` (from 1) of the ``limit`` best rows of ``scored(id, score)``; ties by id."""
    best = top_k(scored.select("id", "score"), limit)
    return best.withColumn("rank", F.row_number().over(W.orderBy(F.desc("score"), "id")))  # at most ``limit`` rows


def fuse_rrf(lists: Sequence[DataFrame], k: int = 10, limit: int = 100, constant: int = 60, mode: str = "outer", weights: Sequence[float] | None = None) -> DataFrame:
    """Reciprocal rank fusion: the sum of weight / (constant + rank) over the lists that hold a point.

    ``mode='inner'`` keeps only points that all lists hold. Returns ``id`` and ``score``.
    """
    weights = list(weights or [1.0] * len(lists))
    parts = [ranked(x, limit).select("id", (F.lit(w) / (constant + F.col("rank"))).alias("part")) for x, w in zip(lists, weights, strict=True)]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    fused = union.groupBy("id").agg(F.sum("part").alias("score"), F.count("*").alias("n"))
    return top_k((fused.where(F.col("n") == len(lists)) if mode == "inner" else fused).select("id", "score"), k)


def fuse_dbsf(lists: Sequence[DataFrame], k: int = 10, limit: int = 100) -> DataFrame:
    """Distribution-based fusion: scores of each list scaled to 0..1 within three standard deviations of its mean, summed."""
    union = None
    for x in lists:
        best = top_k(x.select("id", "score"), limit)
        low = F.avg("score").over(W.partitionBy()) - 3 * F.stddev_pop("score").over(W.partitionBy())
        high = F.avg("score").over(W.partitionBy()) + 3 * F.stddev_pop("score").over(W.partitionBy())
        part = best.select("id", F.coalesce(F.try_divide(F.col("score") - low, high - low), F.lit(0.5)).alias("part"))
        union = part if union is None else union.unionByName(part)
    return top_k(union.groupBy("id").agg(F.sum("part").alias("score")), k)
