"""Near-duplicate embeddings by randomised-rotation binary codes.

Every distinct vector is scaled to length one and turned by a seeded random rotation. Its binary code holds
four bits for each turned coordinate, the highest being the sign; the inner product of the vector with its own
code is stored beside it as correction factor. Two codes and their factors give an unbiased estimate of the
vectors' cosine, and the factors a bound on its error. Vectors travel only where that bound can't decide:

* Sign bits are banded into keys under which vectors meet; what meets are codes (a byte for two coordinates),
  factors and ids. The number of bands follows from the wanted recall at the threshold.
* Vectors whose upper confidence bound with another one of the band reaches the threshold are fetched for that
  band, and their cosines recomputed exactly, in double precision; only exact values make links.

``exact`` misses nothing: all codes meet, tile by tile, and the bound is the Cauchy-Schwarz one, which holds
always. It compares codes of all pairs.

Exact copies are one vector with a weight, so a third of all rows may be one vector. A band bucket
that is large because of near copies is dealt out as tiles of bounded size. Tiles return link counts
and a spanning forest, not pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, matrix, salted_join, usable, whole_groups
from .components import connected_components, spanning_forest

_MIDDLE = 7.5  # of the sixteen levels of a coordinate
_BUCKET = 11  # buckets hold some 2 ** 11 rows


def rotation(dim: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix, the same on every machine."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def padded(x: np.ndarray) -> np.ndarray:
    """Rows of length one, with zero coordinates up to a multiple of 64."""
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    return np.pad(x, ((0, 0), (0, -x.shape[1] % 64)))


def sign_code(turned: np.ndarray) -> np.ndarray:
    """Signs as 64-bit words, lowest bit first."""
    return np.packbits(turned > 0, axis=1, bitorder="little").view("<u8")


def level_code(turned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Four bits for every coordinate, two coordinates a byte, and the correction factors: the cosines of rows and codes."""
    step = np.abs(turned).max(1, keepdims=True) / _MIDDLE
    level = np.clip(np.floor(turned / step + _MIDDLE + 0.5), 0, 15).astype(np.uint8)
    level = np.where(turned > 0, np.maximum(level, 8), np.minimum(level, 7)).astype(np.uint8)  # the highest bit is the sign
    middled = levels(level)
    return level[:, 0::2] | level[:, 1::2] << 4, (middled * turned).sum(1) / np.linalg.norm(middled, axis=1)


def levels(level: np.ndarray) -> np.ndarray:
    return level.astype(np.float32) - np.float32(_MIDDLE)


def unpacked(code: np.ndarray) -> np.ndarray:
    """Codes as unit vectors (single precision), highest bits as signs."""
    level = np.empty((len(code), 2 * code.shape[1]), np.uint8)
    level[:, 0::2], level[:, 1::2] = code & 15, code >> 4
    middled = levels(level)
    return middled / np.linalg.norm(middled, axis=1, keepdims=True)


def estimate(a: np.ndarray, factor_a: np.ndarray, b: np.ndarray, factor_b: np.ndarray) -> np.ndarray:
    """Unbiased estimates of the cosines of coded vectors (rows of a) with coded vectors (rows of b); codes unpacked."""
    return (a / factor_a[:, None].astype(np.float32)) @ (b / factor_b[:, None].astype(np.float32)).T


def error_bound(f: np.ndarray, g: np.ndarray, dim: int, epsilon: float | None) -> np.ndarray:
    """How far estimates may lie from cosines, from the correction factors: ``epsilon`` standard errors, or always (None).

    A vector is its code's direction times the factor and a rest at right angles to the code, which a random
    rotation turns anywhere; the rests of two vectors are independent. The bound falls as the factors rise.
    """
    r, s = (np.sqrt(np.maximum(1 - x**2, 0)) for x in (f, g))
    if epsilon is None:
        # cos = f g <c, d> + f <c, s> + g <r, d> + <r, s>, each rest bounded by its length; an estimate is <c, d> / (f g)
        return f * s + g * r + r * s + (1 / (f * g) - f * g) + 1e-6
    return epsilon * np.sqrt((r / f) ** 2 + (s / g) ** 2 + (r / f * s / g) ** 2) / math.sqrt(dim - 1) + 1e-6


def bands(rows: int, threshold: float, recall: float) -> tuple[int, int]:
    """Bits of a band and number of bands: buckets of some 2,048 rows, pairs at the threshold found with ``recall``."""
    bits = min(32, max(3, int(math.log2(max(rows, 2))) - _BUCKET))
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - agree))


def _band_keys(code: np.ndarray, bits: int, first: int, last: int) -> np.ndarray:
    """Keys of every row in bands ``first`` to ``last``; ``code`` holds the sign words of the rotations that they lie in."""
    if not bits:
        return np.zeros((len(code), last - first), np.uint64)
    each = 64 // bits
    at = np.arange(first, last)
    return (code[:, at // each - first // each] >> (at % each * bits).astype(np.uint64)) & np.uint64((1 << bits) - 1)


def _all_keys(x: np.ndarray, bits: int, count: int, seed: int) -> np.ndarray:
    """Band keys of padded unit vectors under as many rotations as the bands need."""
    words = x.shape[1] // 64
    turns = -(-count // max(1, 64 // max(bits, 1) * words))
    return _band_keys(np.concatenate([sign_code(x @ rotation(x.shape[1], seed + t)) for t in range(max(1, turns))], axis=1), bits, 0, count)


def link_counts(vectors: DataFrame, threshold: float, recall: float, epsilon: float, tile: int, seed: int, exact: bool) -> DataFrame:
    """Links among distinct vectors ``(node, n, dim, v)``: rows ``(a, b, links)``.

    Rows with ``b`` null add ``links`` to the weighted link count of ``a``; the others are a forest.
    """
    bits, count = (0, 1) if exact else bands(vectors.count(), threshold, recall)
    sure = None if exact else epsilon

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = b.column(1).to_numpy()
            for dim in np.unique(dims):
                part = b.filter(pa.array(dims == dim))
                x = padded(matrix(part.column(2)))
                packed, factor = level_code(x @ rotation(x.shape[1], seed))
                keys = _all_keys(x, bits, count, seed).astype(np.int64)
                bytes_ = pa.array([row.tobytes() for row in packed], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(factor, pa.float32()), bytes_, pa.array(list(keys), pa.list_(pa.int64()))], ["node", "dim", "factor", "code", "bands"])

    coded = cut(vectors.select("node", "dim", "v").mapInArrow(code, "node long, dim int, factor float, code binary, bands array<long>"))
    met = coded.select("dim", F.posexplode("bands").alias("t", "key"), "node", "factor", "code")
    sizes = cut(met.groupBy("dim", "t", "key").agg(F.ceil(F.count("*") / tile).cast("int").alias("parts")).where("parts > 1"))
    # only buckets of more than one tile, rows / tile * bands at most
    sizes = F.broadcast(sizes) if sizes.count() <= 200_000 else sizes
    dealt = met.join(sizes, ["dim", "t", "key"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cell = ["dim", "t", "key", "i", "j"]
    dealt = dealt.select("dim", "t", "key", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "node", "factor", "code")
    dealt = dealt.repartition(*cell).sortWithinPartitions(*cell, "part", "node")

    def ranges(i: int, j: int, part: np.ndarray, s: int, e: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks of positions to compare: a tile with itself, or its first with its second part."""
        split = e if i == j else s + int(np.count_nonzero(part[s:e] == i))
        for a in range(s, split, 1024):
            for b in range(a if i == j else split, e, 1024):
                yield np.arange(a, min(a + 1024, split)), np.arange(b, min(b + 1024, e))

    def hopeful(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The members of each tile that may be linked with another one there and don't both meet in an earlier band."""
        for table, at in whole_groups(batches, 5):
            dims, ts, i, j, part = (table.column(c).to_numpy() for c in (0, 1, 3, 4, 5))
            factor = table.column("factor").to_numpy().astype(np.float64)
            use = np.zeros(table.num_rows, bool)
            for s, e in zip(at[:-1], at[1:], strict=True):
                if e - s < 2:
                    continue
                codes = unpacked(np.frombuffer(b"".join(table.column("code").slice(s, e - s).to_pylist()), np.uint8).reshape(e - s, -1))
                each = 64 // bits * (codes.shape[1] // 64) if bits else 1  # bands whose bits the code holds
                keys = _band_keys(sign_code(codes), bits, 0, min(each, count, int(ts[s])))
                low = factor[s:e].min()
                least = threshold - error_bound(low, low, codes.shape[1], sure)  # no pair's own bound is wider
                for p, q in ranges(i[s], j[s], part, s, e):
                    hope = estimate(codes[p - s], factor[p], codes[q - s], factor[q])
                    a, b = np.nonzero(hope >= least)
                    hope, a, b = hope[a, b], p[a], q[b]
                    own = (a != b) & (hope + error_bound(factor[a], factor[b], codes.shape[1], sure) >= threshold)
                    a, b = a[own], b[own]
                    if keys.shape[1] and len(a):
                        new = np.concatenate([~(keys[a[k : k + 65536] - s] == keys[b[k : k + 65536] - s]).any(1) for k in range(0, len(a), 65536)])
                        a, b = a[new], b[new]
                    use[a] = use[b] = True
            yield from table.select([*cell, "part", "node"]).filter(pa.array(use)).combine_chunks().to_batches()

    wanted = cut(dealt.mapInArrow(hopeful, "dim int, t int, key long, i int, j int, part int, node long"))
    fetched = salted_join(wanted, vectors.select("node", "n", "v"), ["node"])
    fetched = fetched.select(*cell, "part", "node", "n", "v").repartition(*cell).sortWithinPartitions(*cell, "part", "node")

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, at in whole_groups(batches, 5):
            ts, i, j, part = (table.column(c).to_numpy() for c in (1, 3, 4, 5))
            node, n = table.column("node").to_numpy(), table.column("n").to_numpy()
            found: list[tuple[np.ndarray, np.ndarray]] = []
            links, root = np.zeros(table.num_rows, np.int64), np.arange(table.num_rows)
            for s, e in zip(at[:-1], at[1:], strict=True):
                if e - s < 2:
                    continue
                x = padded(matrix(table.column("v").slice(s, e - s)))
                keys = _all_keys(x, bits, count, seed)
                for p, q in ranges(i[s], j[s], part, s, e):
                    a, b = np.nonzero(x[p - s] @ x[q - s].T >= threshold - 1e-9)
                    a, b = p[a], q[b]
                    a, b = (y[a < b] for y in (a, b)) if i[s] == j[s] else (a, b)
                    for k in range(0, len(a), 65536):
                        c, d = a[k : k + 65536] - s, b[k : k + 65536] - s
                        real = np.einsum("ij,ij->i", x[c], x[d]) >= threshold
                        real[real] = (keys[c[real]] == keys[d[real]]).argmax(1) == ts[s]  # a pair counts in the first band where it meets
                        c, d = c[real] + s, d[real] + s
                        np.add.at(links, c, n[d])
                        np.add.at(links, d, n[c])
                        found.append((c, d))
                if found:
                    c, d = (np.concatenate(y) for y in zip(*found, strict=True))
                    found.clear()
                    low = spanning_forest(c - s, d - s, e - s) + s
                    root[s:e] = low
                    off = np.flatnonzero(low != np.arange(s, e)) + s
                    yield pa.RecordBatch.from_arrays([pa.array(node[off]), pa.array(node[root[off]]), pa.array(np.zeros(len(off), np.int64))], ["a", "b", "links"])
            ids, back = np.unique(node, return_inverse=True)
            total = np.bincount(back, weights=links, minlength=len(ids)).astype(np.int64)
            some = total > 0
            yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.nulls(int(some.sum()), pa.int64()), pa.array(total[some])], ["a", "b", "links"])

    return fetched.mapInArrow(tiles, "a long, b long, links long")


def near_duplicate_vectors(
    rows: DataFrame, threshold: float = 0.9, recall: float = 0.999, epsilon: float = 5.0, tile: int = 4096, seed: int = 7, exact: bool = False, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """One row per input row: ``id_col``, ``n_links`` (other rows at a cosine of ``threshold`` or more),
    ``component`` (smallest id reachable, itself included) and ``kept`` (whether it is its own component).

    Vectors that are null, empty, all zero or hold null or non-finite numbers link with nothing, and
    so do vectors of different length. Copies, repeated rows included, link with one another. Null
    ids take part but never name a component while another member has an id. ``recall`` is the
    least share of pairs at the very threshold that meet; nearer pairs meet almost surely. With ``exact`` all
    do, at the price of comparing all codes. An empty table gives an empty table; other columns are not read.
    """
    base = rows.select(F.col(id_col), F.col(vector_col).alias("v"), usable(vector_col).alias("ok"))
    # 128 bits name a vector: two hashes with seeds of their own
    good = base.where("ok").select(id_col, "v", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit("second"), "v").alias("h2"))
    distinct = good.groupBy("h1", "h2").agg(F.min(id_col).alias("first"), F.count("*").alias("n"), F.first("v").alias("v"))
    distinct = cut(distinct.withColumn("dim", F.size("v")).withColumn("node", F.monotonically_increasing_id()))
    links = cut(link_counts(distinct, threshold, recall, epsilon, tile, seed, exact))
    roots = connected_components(links.where("b is not null").select("a", "b"))
    counts = links.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    named = distinct.select("h1", "h2", "node", "first", "n").join(roots, "node", "left").join(counts, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = cut(named)
    firsts = named.groupBy("root").agg(F.min("first").alias("component"), F.count("*").alias("count"))
    classes = salted_join(named, firsts.drop("count"), ["root"], counts=firsts.select("root", "count"))
    classes = classes.select("h1", "h2", "component", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    linked = salted_join(good.select(id_col, "h1", "h2"), classes, ["h1", "h2"], counts=distinct.select("h1", "h2", F.col("n").alias("count"))).select(id_col, "n_links", "component")
    alone = base.where("not ok").select(id_col, F.lit(0).cast("long").alias("n_links"), F.col(id_col).alias("component"))
    return linked.unionByName(alone).withColumn("kept", F.col(id_col).eqNullSafe(F.col("component")))
