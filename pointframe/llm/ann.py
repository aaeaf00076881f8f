"""Approximate nearest neighbours by cross-polytope hashing.

A unit vector is turned by pseudo-rotations, three rounds of random signs and a fast Hadamard
transform, and hashed to the nearest signed axis. A cell joins the axes of one or more rotations, so the
number of cells grows with the rows. Several tables turn vectors differently. A query probes in each table
the cells whose axes it lies nearest to, best first; all rows of the probed cells are its candidates, and
the candidates are reranked by the exact inner product in double precision.

How many rotations make a cell and how many cells are probed is measured, not guessed: for a bounded number
of the queries (``calibrate``) the exact neighbours among all rows are found by one pass, and the cheapest
setting is taken that holds the wanted share of them.

Rows of unequal length get one more coordinate that brings all to the largest length, which makes
the largest inner product the smallest angle. Neighbouring cells lie together in shards of some ``block``
rows; a row goes to one shard of each table, a query once to each shard that it probes. Shards that a hot
direction has filled, and queries that meet in one, are dealt out in blocks of bounded size; a task holds
one block of rows and keeps no more than the nearest of each query.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, matrix, usable, whole_groups

_ROTATIONS = 4  # that a cell joins at most
_WIDE = 48  # axes of each rotation that probing considers where a cell joins several


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of every row, scaled to keep lengths."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.concatenate([x[:, :, :1] + x[:, :, 1:], x[:, :, :1] - x[:, :, 1:]], axis=2).reshape(n, d)
        h *= 2
    return x / math.sqrt(d)


def turned(x: np.ndarray, table: int, seed: int) -> np.ndarray:
    """Pseudo-rotation of a table: three rounds of random signs and Hadamard."""
    signs = np.random.default_rng([seed, table]).choice([-1.0, 1.0], (3, x.shape[1]))
    for s in signs:
        x = hadamard(x * s)
    return x


def axes(x: np.ndarray) -> np.ndarray:
    """The nearest signed axis of every row: 2 * axis, plus 1 if negative."""
    return np.stack([x, -x], axis=2).reshape(len(x), -1).argmax(1)


def cells_of(u: np.ndarray, table: int, rotations: int, seed: int) -> np.ndarray:
    """The cell of every unit vector: the axes of a table's rotations as digits of one number."""
    cell = np.zeros(len(u), np.int64)
    for r in range(rotations):
        cell = cell * (2 * u.shape[1]) + axes(turned(u, table * _ROTATIONS + r, seed))
    return cell


def probed(u: np.ndarray, table: int, rotations: int, probes: int, seed: int) -> np.ndarray:
    """The ``probes`` nearest cells of every unit vector, nearest first.

    A cell is the farther the more its axes fall short of the best ones (squares, summed over the rotations);
    of each rotation the ``_WIDE`` nearest axes are considered where a cell joins several.
    """
    base = 2 * u.shape[1]
    short, cell = np.zeros((len(u), 1)), np.zeros((len(u), 1), np.int64)
    for r in range(rotations):
        t = turned(u, table * _ROTATIONS + r, seed)
        score = np.stack([t, -t], axis=2).reshape(len(u), -1)
        order = np.argsort(-score, axis=1, kind="stable")[:, : base if rotations == 1 else _WIDE]
        best = np.take_along_axis(score, order, 1)
        short = (short[:, :, None] + ((best[:, :1] - best) ** 2)[:, None, :]).reshape(len(u), -1)
        cell = (cell[:, :, None] * base + order[:, None, :]).reshape(len(u), -1)
    return np.take_along_axis(cell, np.argsort(short, axis=1, kind="stable")[:, :probes], 1)


def _directions(v: np.ndarray, largest: float, extra: bool, query: bool) -> np.ndarray:
    """Unit vectors to hash, padded to a power of two; with the extra coordinate where lengths differ."""
    length = np.linalg.norm(v, axis=1, keepdims=True)
    if query or not extra:
        u = v / length
        rest = np.zeros((len(v), 1))
    else:
        u = v / largest
        rest = np.sqrt(np.maximum(0, 1 - (length / largest) ** 2))
    u = np.concatenate([u, rest], axis=1) if extra else u
    return np.pad(u, ((0, 0), (0, (1 << (u.shape[1] - 1).bit_length()) - u.shape[1])))


def nearest(query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best distinct ids of each query: by score, then smaller id."""
    order = np.lexsort((ids, -score, query))
    q, i = query[order], ids[order]
    new = np.r_[True, (q[1:] != q[:-1]) | (i[1:] != i[:-1])]  # one id has one score, so repeats are neighbours
    order, q = order[new], q[new]
    start = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
    rank = np.arange(len(q)) - np.repeat(start, np.diff(np.r_[start, len(q)]))
    return order[rank < k]


def search(
    rows: DataFrame, queries: DataFrame, k: int = 20, tables: int = 2, recall: float = 0.97, calibrate: int = 64, cell_rows: int = 1 << 16, block: int = 8192, seed: int = 11, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """The k rows of the largest inner product found for each query, its own id excluded.

    ``recall`` is the share of the true neighbours of ``calibrate`` of the queries that the probed cells must hold.
    Vectors without any structure need most cells for it (their k nearest are hardly nearer than the rest), clustered
    ones few. Up to ``cell_rows`` rows lie in a cell on average before cells join another rotation.

    Returns ``query_id``, ``rank`` (from 1), ``id_col`` and ``score``; ties go to the smaller id. A query has
    fewer than k rows only where there are fewer candidates: one whose cells hold too few searches all.
    Vectors that are null, empty, all zero or hold null or non-finite numbers take no part, nor do null ids;
    vectors of a length other than the most common one are not comparable and take no part. Rows that repeat
    an id count once. An empty table gives an empty table. Other columns are not read.
    """
    keep = lambda df: df.where(usable(vector_col) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    base, asked = keep(rows), keep(queries)
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    dims = base.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"), F.min(length).alias("low"), F.max(length).alias("high")).orderBy(F.desc("n"), "d").first()
    n, dim, low, high = (dims.n, dims.d, dims.low, dims.high) if dims else (0, 1, 1.0, 1.0)
    base, asked = (df.where(F.size("v") == dim) for df in (base, asked))
    asked = asked.dropDuplicates(["id"])
    extra = low < high * (1 - 1e-4)
    unit = _Unit(high, extra)
    most = min(_ROTATIONS, max(1, math.ceil(math.log(max(n, 2) / cell_rows) / math.log(2 * unit.width(dim)))))
    sample = asked.orderBy(F.xxhash64("id"), "id").limit(calibrate).toArrow()  # a bounded number of vectors
    rotations, probes = _calibrated(base, sample, k, tables, most, recall, unit, seed)
    shards = _Shards((2 * unit.width(dim)) ** rotations, max(1, -(-n // block)))

    kind = base.schema["v"].dataType.simpleString()

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                u = unit(matrix(b.column(1)), False)
                for t in range(tables):
                    cell = cells_of(u, t, rotations, seed)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(u), t, np.int32)), pa.array(shards.of(cell)), b.column(0), b.column(1), pa.array(cell)], ["t", "shard", "id", "v", "cell"])

    def probing(every: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if not b.num_rows:
                    continue
                u = unit(matrix(b.column(1)), True)
                for t in range(1 if every else tables):
                    # one row for each shard that a query probes, with its cells there; no cells mean all of the shard
                    cell = np.tile(shards.first(), (len(u), 1)) if every else np.sort(probed(u, t, rotations, probes, seed), axis=1)
                    of = np.repeat(np.arange(len(u)), cell.shape[1])
                    shard = shards.of(cell.ravel())
                    start = np.flatnonzero(np.r_[True, (of[1:] != of[:-1]) | (shard[1:] != shard[:-1])])
                    ends = np.r_[start, len(of)] if not every else np.zeros(len(start) + 1, np.int64)
                    cells = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(cell.ravel()[: ends[-1]]))
                    take = pa.array(of[start])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(start), t, np.int32)), pa.array(shard[start]), b.column(0).take(take), b.column(1).take(take), cells], ["t", "shard", "id", "v", "cells"])

        return run

    points = base.mapInArrow(placed, f"t int, shard long, id long, v {kind}, cell long")
    sizes = cut(points.groupBy("t", "shard").agg(F.ceil(F.count("*") / block).cast("int").alias("bs")))

    def found(who: DataFrame, every: bool) -> DataFrame:
        kinds = f"t int, shard long, id long, v {who.schema['v'].dataType.simpleString()}, cells array<long>"
        return _ranked(_met(points, who.mapInArrow(probing(every), kinds), sizes, tables * shards.count, k, block), k)

    best = cut(found(asked, False))
    full = best.groupBy("query_id").agg(F.count("*").alias("n")).where(F.col("n") >= k)
    short = cut(asked.join(full, asked["id"] == full["query_id"], "left_anti"))
    if n > 1 and not short.isEmpty():  # queries whose cells held fewer than k, or all of a small table
        best = best.join(full, "query_id", "left_semi").unionByName(found(short, True))
    return best.select("query_id", "rank", F.col("id").alias(id_col), "score")


class _Unit:
    """Unit vectors to hash, of vectors whose lengths reach up to ``largest``."""

    def __init__(self, largest: float, extra: bool):
        self.largest, self.extra = largest, extra

    def width(self, dim: int) -> int:
        return 1 << (dim + self.extra - 1).bit_length()

    def __call__(self, v: np.ndarray, query: bool) -> np.ndarray:
        return _directions(v, self.largest, self.extra, query)


class _Shards:
    """Neighbouring cells together: ``count`` ranges of equal width."""

    def __init__(self, cells: int, count: int):
        self.width = -(-cells // count)
        self.count = -(-cells // self.width)

    def of(self, cell: np.ndarray) -> np.ndarray:
        return cell // self.width

    def first(self) -> np.ndarray:
        """A cell of every shard."""
        return np.arange(self.count) * self.width


def _calibrated(base: DataFrame, sample: pa.Table, k: int, tables: int, most: int, recall: float, unit: _Unit, seed: int) -> tuple[int, int]:
    """How many rotations to join and how many cells to probe, from the sample's exact neighbours among all rows."""
    if not sample.num_rows:
        return 1, 1
    ids, q = sample.column("id").to_numpy(), matrix(sample.column("v"))

    def nearest_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[np.ndarray, ...]] = []
        for b in batches:
            if not b.num_rows:
                continue
            own, v = b.column(0).to_numpy(), matrix(b.column(1))
            score = q @ v.T
            score[ids[:, None] == own[None]] = -np.inf
            a, at = np.nonzero(score >= np.partition(score, -min(k, len(v)), axis=1)[:, -min(k, len(v))][:, None])
            kept.append((a, own[at], score[a, at], v[at]))
            kept = [tuple(np.concatenate(x) for x in zip(*kept, strict=True))]
            best = nearest(*kept[0][:3], k)
            kept = [tuple(x[best] for x in kept[0])]
        for a, own, score, v in kept:
            u = unit(v, False)
            cells = np.stack([cells_of(u, t, r, seed) for r in range(1, most + 1) for t in range(tables)], axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(own), pa.array(score), pa.array(list(cells))], ["query_id", "id", "score", "cells"])

    near = base.mapInArrow(nearest_cells, "query_id long, id long, score double, cells array<long>")
    ranked = near.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "id"))).where(F.col("rank") <= k).toArrow()  # k rows a sampled query
    if not ranked.num_rows:
        return 1, 1
    of, cells = ranked.column("query_id").to_numpy(), np.array(ranked.column("cells").to_pylist())
    u, settings = unit(q, True), []
    for r in range(1, most + 1):
        count = (2 * u.shape[1]) ** r
        at = np.full(len(of), count)
        for t in range(tables):
            order = probed(u, t, r, count, seed)
            hit = order[of] == cells[:, (r - 1) * tables + t][:, None]
            at = np.minimum(at, np.where(hit.any(1), hit.argmax(1), count))
        probes = int(np.sort(at)[min(len(at) - 1, math.ceil(recall * len(at)) - 1)]) + 1
        if probes <= order.shape[1]:
            settings.append((probes / count, r, probes))
    return min(settings)[1:]


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query among ``found``, which may repeat rows."""
    once = found.groupBy("query_id", "id").agg(F.max("score").alias("score"))
    ranked = once.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "id")))
    return ranked.where(F.col("rank") <= k).withColumn("rank", F.col("rank").cast("int"))


def _met(points: DataFrame, asked: DataFrame, sizes: DataFrame, most: int, k: int, block: int) -> DataFrame:
    """Exact scores of the best rows for each query among the cells that it probes; ``most`` bounds the rows of ``sizes``."""
    shard, key = ["t", "shard"], ["t", "shard", "i", "j"]
    asking = cut(sizes.join(asked.groupBy(*shard).agg(F.ceil(F.count("*") / block).cast("int").alias("qs")), shard))
    asking = F.broadcast(asking) if most <= 100_000 else asking
    points = points.join(asking, shard).withColumn("i", F.pmod(F.xxhash64("id"), "bs").cast("int")).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("qs") - 1)))
    asked = asked.join(asking, shard).withColumn("j", F.pmod(F.xxhash64("id"), "qs").cast("int")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("bs") - 1)))
    none = F.lit(None)
    both = points.select(*key, F.lit(0).alias("side"), "cell", "id", none.cast("array<long>").alias("cells"), "v").unionByName(asked.select(*key, F.lit(1).alias("side"), F.lit(-1).cast("long").alias("cell"), "id", "cells", "v"))
    both = both.repartition(*key).sortWithinPartitions(*key, "side", "cell", "id")

    def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        held = limit = 0

        def merged() -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
            q, i, s = (np.concatenate(x) for x in zip(*kept, strict=True))
            best = nearest(q, i, s, k)
            return [(q[best], i[best], s[best])]

        for table, at in whole_groups(batches, 4):
            side, cell, ids = (table.column(c).to_numpy() for c in ("side", "cell", "id"))
            for s, e in zip(at[:-1], at[1:], strict=True):
                m = s + int(np.count_nonzero(side[s:e] == 0))
                if m in (s, e):
                    continue
                x, q = matrix(table.column("v").slice(s, m - s)), matrix(table.column("v").slice(m, e - m))
                found = _best_of(x, ids[s:m], cell[s:m], q, ids[m:e], table.column("cells").slice(m, e - m), k)
                kept += found
                held += sum(len(f[0]) for f in found)
                if held > limit:
                    kept = merged() if kept else []
                    held = sum(len(f[0]) for f in kept)
                    limit = 2 * held + 500_000
        if kept:
            q, i, s = merged()[0]
            yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(i), pa.array(s)], ["query_id", "id", "score"])

    return both.mapInArrow(rerank, "query_id long, id long, score double")


def _best_of(x: np.ndarray, ids: np.ndarray, cell: np.ndarray, q: np.ndarray, asking: np.ndarray, cells: pa.ChunkedArray, k: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query, id, score) of the k best rows for each query among the cells that it names, or all where it names none."""
    starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    ends = np.r_[starts[1:], len(cell)]
    lists = cells.combine_chunks()
    lists = pa.concat_arrays(lists.chunks) if isinstance(lists, pa.ChunkedArray) else lists
    sizes = lists.value_lengths().to_numpy()
    flat, of = lists.flatten().to_numpy(), np.repeat(np.arange(len(q)), sizes)
    names = np.searchsorted(cell[starts], flat)
    known = (names < len(starts)) & (cell[starts][np.minimum(names, len(starts) - 1)] == flat)
    asks = np.zeros((len(q), len(starts)), bool)
    asks[of[known], names[known]] = True
    asks[sizes == 0] = True
    slack = 1e-10 * np.linalg.norm(q, axis=1) * np.linalg.norm(x, axis=1).max()
    out = []
    for a in range(0, len(q), 256):
        score = np.full((min(256, len(q) - a), len(x)), -np.inf)
        for c, (s, e) in enumerate(zip(starts, ends, strict=True)):
            who = np.flatnonzero(asks[a : a + 256, c])
            if len(who):
                score[who, s:e] = q[a + who] @ x[s:e].T
        score[asking[a : a + 256, None] == ids[None]] = -np.inf
        m = min(k, len(x))
        floor = np.partition(score, -m, axis=1)[:, -m]
        # what might be among the k best, then their exact scores
        i, j = np.nonzero((score >= (floor - slack[a : a + 256])[:, None]) & (score > -np.inf))
        exact = np.concatenate([np.einsum("ij,ij->i", q[a + i[p : p + 65536]], x[j[p : p + 65536]]) for p in range(0, len(i), 65536)]) if len(i) else np.zeros(0)
        best = nearest(asking[a + i], ids[j], exact, k) if len(i) else np.zeros(0, np.int64)
        out.append((asking[a + i[best]], ids[j[best]], exact[best]))
    return out
