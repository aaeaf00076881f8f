"""Recommendation from examples and discovery in a context."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vectors as V
from ..sources.collection import Collection
from .search import score, top_k

Examples = Sequence[str] | Sequence[Sequence[float]] | None


def mean_of_points(collection: Collection, ids: Sequence[str], using: str | None = None) -> DataFrame:
    """One row with ``mean``, the mean vector of the points with these ids; null if none has a vector."""
    name, _ = collection.config.resolve(using)
    sums = collection.df.where(F.col("id").isin(*ids)).select(F.posexplode(name).alias("at", "x")).groupBy("at").agg(F.avg(F.col("x").cast("double")).alias("m"))
    pairs = sums.agg(F.array_sort(F.collect_list(F.struct("at", "m"))).alias("pairs"))
    return pairs.select(F.when(F.size("pairs") > 0, F.transform("pairs", lambda p: p.m)).alias("mean"))


def _mean(collection: Collection, examples: Examples, using: str | None) -> DataFrame | None:
    """One-row frame with the mean of examples, points by id or vectors; None without examples."""
    if not examples:
        return None
    if isinstance(examples[0], str):
        return mean_of_points(collection, list(examples), using)
    _, params = collection.config.resolve(using)
    vs = [V.vector(V.checked(v, params.size)) for v in examples]
    return collection.spark.range(1).select(V.mean_vector(F.array(*vs)).alias("mean"))


def _example_ids(*examples: Examples) -> list[str]:
    return [e for group in examples if group for e in group if isinstance(e, str)]


def recommend(collection: Collection, positive: Examples, negative: Examples = None, k: int = 10, using: str | None = None, where: Column | str | None = None, columns: Sequence[str] = ("id", "payload")) -> DataFrame:
    """Points near twice the mean of the positive examples less that of the negative ones.

    Without negatives the mean of the positives is the query. Example points are left out of the result;
    unknown ids are ignored, and if no positive example is known the result is empty.
    """
    plus, minus = _mean(collection, positive, using), _mean(collection, negative, using)
    df = collection.df if where is None else collection.df.where(where)
    seen = _example_ids(positive, negative)
    if seen:
        df = df.where(~F.col("id").isin(*seen))
    if plus is None:
        return df.select(*columns, F.lit(None).cast("double").alias("score")).limit(0)
    query = plus.withColumnRenamed("mean", "__plus")
    query = query.join(minus.withColumnRenamed("mean", "__minus")) if minus is not None else query.withColumn("__minus", F.lit(None).cast("array<double>"))
    query = query.select(F.when(F.col("__minus").isNull(), F.col("__plus")).otherwise(F.zip_with("__plus", "__minus", lambda p, n: 2 * p - n)).alias("__query"))
    asked = df.join(F.broadcast(query))  # one row
    return top_k(asked.select(*columns, score(collection, F.col("__query"), using).alias("score")), k)


def _squashed(s: Column) -> Column:
    """0 to 1, monotone: what a target's similarity adds can't outweigh a context pair."""
    return F.lit(0.5) * (s / (1 + F.abs(s)) + 1)


def discover(collection: Collection, target: V.Vector, context: Sequence[tuple[Sequence[float], Sequence[float]]], k: int = 10, using: str | None = None, columns: Sequence[str] = ("id", "payload")) -> DataFrame:
    """Discovery by pairs (positive, negative) of vectors: +1 for each pair whose positive is nearer, -1 for
    each whose negative is, plus the target's similarity squashed to between 0 and 1."""
    total = _squashed(score(collection, target, using))
    for positive, negative in context:
        total = total + F.signum(score(collection, positive, using) - score(collection, negative, using))
    return top_k(collection.df.select(*columns, total.alias("score")), k)


def discover_weighted(collection: Collection, target: V.Vector, context: Sequence[tuple[str, float]], k: int = 10, using: str | None = None, columns: Sequence[str] = ("id", "payload")) -> DataFrame:
    """Discovery by (point id, weight): the target's score plus the weighted scores against those points.

    Unknown ids add nothing; context points are left out of the result.
    """
    name, _ = collection.config.resolve(using)
    ids = [i for i, _ in context]
    known = collection.df.where(F.col("id").isin(*ids)).select("id", name)
    weights = F.create_map(*[F.lit(x) for pair in context for x in (pair[0], float(pair[1]))])
    # as many rows as context points
    query = known.agg(F.array_sort(F.collect_list(F.struct("id", F.col(name).alias("v"), weights[F.col("id")].alias("w")))).alias("__context"))
    params = collection.config.dense[name]
    extra = F.aggregate("__context", F.lit(0.0), lambda s, c: s + c.w * F.coalesce(V.similarity(F.col(name), c.v, params.distance), F.lit(0.0)))
    asked = collection.df.where(~F.col("id").isin(*ids)).join(F.broadcast(query))
    return top_k(asked.select(*columns, (score(collection, target, using) + extra).alias("score")), k)
