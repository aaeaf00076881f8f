"""Exact nearest-point search over collections.

A single query is a projection and a top-k, which Spark runs as one scan with a bounded heap in each
task. A batch of queries is scored in blocks: every task multiplies blocks of points with blocks of
queries and keeps the best k of each query, so what is exchanged is k rows a query and task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..errors import MalformedVector
from ..functions import vectors as V
from ..sources.collection import Collection
from ..sources.config import COSINE, DOT, EUCLID, MANHATTAN
from ..workers import importable


def score(collection: Collection, query: V.Vector, using: str | None = None, metric: str | None = None) -> Column:
    """Score of every point against a query vector under the column's metric; higher is nearer."""
    name, params = collection.config.resolve(using)
    if params.multivector:
        return V.max_sim(query, name, metric or params.distance)
    return V.similarity(name, V.checked(query, params.size), metric or params.distance)


def top_k(scored: DataFrame, k: int, by: str = "score", ascending: bool = False) -> DataFrame:
    """The k best rows: nulls last, ties by id.

    Nulls sort last, so they are dropped from the k rows: a filter below would score every point twice.
    """
    order = F.col(by).asc_nulls_last() if ascending else F.col(by).desc_nulls_last()
    return scored.orderBy(order, "id").limit(k).where(F.col(by).isNotNull())


def search(collection: Collection, query: V.Vector, k: int = 10, using: str | None = None, where: Column | str | None = None, threshold: float | None = None, columns: Sequence[str] = ("id", "payload"), metric: str | None = None) -> DataFrame:
    """The k nearest points to a vector: ``columns`` and ``score``. ``where`` filters points first."""
    df = collection.df if where is None else collection.df.where(where)
    best = top_k(df.select(*columns, score(collection, query, using, metric).alias("score")), k)
    return best if threshold is None else best.where(F.col("score") > threshold)


def vector_of(collection: Collection, point_id: str, using: str | None = None) -> list[float] | None:
    """A stored point's vector."""
    name, _ = collection.config.resolve(using)
    row = collection.df.where(F.col("id") == point_id).select(name).first()
    return None if row is None else row[0]


def search_by_id(collection: Collection, point_id: str, k: int = 10, using: str | None = None, **kwargs) -> DataFrame:
    """The k nearest points to a stored one, itself excluded; none if it is unknown or has no vector."""
    name, _ = collection.config.resolve(using)
    one = collection.df.where(F.col("id") == point_id).select(F.col(name).alias("__query")).limit(1)
    where = kwargs.pop("where", None)
    columns = kwargs.pop("columns", ("id", "payload"))
    df = collection.df if where is None else collection.df.where(where)
    asked = df.where(F.col("id") != point_id).join(F.broadcast(one))  # one row
    return top_k(asked.select(*columns, score(collection, F.col("__query"), using, kwargs.get("metric")).alias("score")), k)


def sparse_search(collection: Collection, indices: Sequence[int], values: Sequence[float], k: int = 10, using: str | None = None, columns: Sequence[str] = ("id", "payload")) -> DataFrame:
    """The k points of the largest sparse dot product."""
    if len(indices) != len(values) or len(set(indices)) != len(indices):
        raise MalformedVector("a sparse query needs as many values as indices, each index once")
    name = collection.config.resolve_sparse(using)
    return top_k(collection.df.select(*columns, V.sparse_dot(f"{name}_indices", f"{name}_values", indices, values).alias("score")), k)


def within_radius(collection: Collection, query: V.Vector, radius: float, using: str | None = None, metric: str | None = None) -> DataFrame:
    """All points at a distance of at most ``radius``, with ``distance``."""
    name, params = collection.config.resolve(using)
    d = V.distance(name, V.checked(query, params.size), metric or params.distance)
    return collection.df.withColumn("distance", d).where(F.col("distance") <= radius)


def weighted_search(collection: Collection, parts: Sequence[tuple[str, V.Vector, float]], k: int = 10, columns: Sequence[str] = ("id", "payload")) -> DataFrame:
    """Several named vectors at once: a weighted sum of their scores, each also as ``<name>_score``."""
    each = [score(collection, q, n).alias(f"{n}_score") for n, q, _ in parts]
    total = sum((F.col(f"{n}_score") * w for n, _, w in parts), F.lit(0.0))
    return top_k(collection.df.select(*columns, *each).withColumn("score", total), k)


def rerank(first: DataFrame, second: Column, k: int = 10) -> DataFrame:
    """Second stage over a first stage's survivors, which keep their columns: ``score`` replaced, k best."""
    return top_k(first.withColumn("score", second), k)


def prefetch(collection: Collection, query: V.Vector, limit: int, using: str | None = None) -> DataFrame:
    """First stage: whole points of the ``limit`` best."""
    return top_k(collection.df.withColumn("score", score(collection, query, using)), limit).drop("score")


def boosted(scored: DataFrame, boost: Column, k: int = 10, multiply: bool = False) -> DataFrame:
    """Scores raised by a column expression, added or multiplied; ``base_score`` keeps the old one."""
    new = F.col("base_score") * boost if multiply else F.col("base_score") + boost
    return top_k(scored.withColumnRenamed("score", "base_score").withColumn("score", new), k)


def random_sample(collection: Collection, k: int, seed: int | None = None, where: Column | str | None = None) -> DataFrame:
    """k points in random order; the same for a seed and an unchanged table layout."""
    df = collection.df if where is None else collection.df.where(where)
    return df.orderBy(F.rand(seed) if seed is not None else F.rand()).limit(k)


def _scores(q: np.ndarray, x: np.ndarray, metric: str) -> np.ndarray:
    """Scores of every query (rows) against every point (columns), to within rounding."""
    if metric in (DOT, COSINE):
        s = q @ x.T
        if metric == COSINE:
            with np.errstate(divide="ignore", invalid="ignore"):
                s = s / (np.linalg.norm(q, axis=1)[:, None] * np.linalg.norm(x, axis=1)[None])
        return s
    if metric == EUCLID:
        return -np.sqrt(np.maximum(0, (q * q).sum(1)[:, None] + (x * x).sum(1)[None] - 2 * (q @ x.T)))
    return -np.stack([np.abs(x - row).sum(1) for row in q])


def _exact(q: np.ndarray, x: np.ndarray, metric: str) -> np.ndarray:
    """Scores of pairs, row by row: equal vectors have equal scores wherever they stand."""
    if metric == COSINE:
        return np.einsum("ij,ij->i", q, x) / (np.sqrt(np.einsum("ij,ij->i", q, q)) * np.sqrt(np.einsum("ij,ij->i", x, x)))
    if metric == DOT:
        return np.einsum("ij,ij->i", q, x)
    return -(np.sqrt(((q - x) ** 2).sum(1)) if metric == EUCLID else np.abs(q - x).sum(1))


def search_batch(collection: Collection, queries: DataFrame, k: int = 10, using: str | None = None, exclude_same_id: bool = False, max_bytes: int = 32 << 20, block: int = 256) -> DataFrame:
    """The k nearest points for every row of ``queries(query_id, vector)``: ``query_id, rank, id, score``.

    Query vectors of up to ``max_bytes`` go to every task with the code. More are dealt out in parts of that size,
    one pass over the points for each. Queries or points without a vector of the column's size have no rows; queries
    that share an id rank together. Ties go to the smaller id.
    """
    name, params = collection.config.resolve(using)
    if params.multivector:
        raise MalformedVector("batch search takes dense vectors")
    importable(collection.spark)
    queries = queries.where(F.col("query_id").isNotNull() & (F.size("vector") == params.size)).select("query_id", F.col("vector").cast("array<double>").alias("vector"))
    points = collection.df.where(F.size(name) == params.size).select("id", F.col(name).cast("array<double>").alias("v"))
    parts = max(1, -(-queries.count() * params.size * 8 // max_bytes))
    id_type = queries.schema["query_id"].dataType.simpleString()
    found = None
    for at in range(parts):
        table = (queries if parts == 1 else queries.where(F.pmod(F.xxhash64("query_id"), F.lit(parts)) == at)).toArrow()
        q = np.array(table.column("vector").to_pylist(), float).reshape(table.num_rows, params.size)
        ours = points.mapInArrow(_best(table.column("query_id").combine_chunks(), q, k, params.distance, exclude_same_id, block), f"query_id {id_type}, id string, score double")
        found = ours if found is None else found.unionByName(ours)
    ranked = found.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def _first_k(query: np.ndarray, names: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best rows of each query: by score, then by name."""
    order = np.lexsort((np.unique(names, return_inverse=True)[1], -score, query))
    start = np.flatnonzero(np.r_[True, np.diff(query[order]) != 0])
    rank = np.arange(len(order)) - np.repeat(start, np.diff(np.r_[start, len(order)]))
    return order[rank < k]


def _best(keys: pa.Array, q: np.ndarray, k: int, metric: str, exclude_same_id: bool, block: int):
    """Arrow function: the k best points of each query in a partition; no more than those are held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.array([str(i) for i in keys.to_pylist()]) if exclude_same_id else None
        kept: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        held = limit = 0
        for b in batches:
            if not b.num_rows or not len(q):
                continue
            names = np.array(b.column(0).to_pylist(), object)
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            m = min(k + exclude_same_id, len(x))
            for s in range(0, len(q), block):
                scores = _scores(q[s : s + block], x, metric)
                scores[np.isnan(scores)] = -np.inf
                floor = np.partition(scores, -m, axis=1)[:, -m]
                slack = np.where(np.isfinite(floor), 1e-9 * np.maximum(1.0, np.abs(floor)), 0)
                i, j = np.nonzero((scores >= (floor - slack)[:, None]) & (scores > -np.inf))
                if exclude_same_id:
                    other = own[s + i] != names[j].astype(str)
                    i, j = i[other], j[other]
                exact = _exact(q[s + i], x[j], metric)
                best = _first_k(i, names[j].astype(str), exact, k) if len(i) else np.zeros(0, int)
                kept.append((s + i[best], names[j[best]], exact[best]))
                held += len(best)
            if held > limit:
                kept = [_merged(kept, k)]
                held = len(kept[0][0])
                limit = 2 * held + 1_000_000
        if kept:
            i, names, score = _merged(kept, k)
            yield pa.RecordBatch.from_arrays([keys.take(pa.array(i, pa.int64())), pa.array(names, pa.string()), pa.array(score, pa.float64())], ["query_id", "id", "score"])

    return run


def _merged(kept: list[tuple[np.ndarray, np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    i, names, score = (np.concatenate(x) for x in zip(*kept, strict=True))
    best = _first_k(i, names.astype(str), score, k) if len(i) else np.zeros(0, int)
    return i[best], names[best], score[best]
