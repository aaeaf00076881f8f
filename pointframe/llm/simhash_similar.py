"""SimHash near-dedup by similarity: the trie walk under a wide budget.

Texts whose five-word shingles are alike to 0.8 differ in up to some twenty of 64 fingerprint bits. No block of
bits is spared by so wide a budget, so fingerprints meet in MinHash bands instead of blocks: a text's 80 minima
form 20 bands of four, and two texts of similarity 0.8 miss each other in all of them once in 37,000 times (a
fingerprint differs in more than ``max_bits`` = 21 bits once in 8,000). In each band the binary trie self-join of
``simhash`` proposes the pairs within the budget, and the exact similarity of the two texts decides.

A band of n alike texts has n * n / 2 pairs. Its task proposes only a spanning forest of them, nearest fingerprints
first; a band of more than ``_STAR`` texts is not gathered at all, but each member is compared with one of them, its
pivot. Where a link of a forest fails, and in every band with a pivot, the members that the links so far haven't
settled meet all others of the band with their shingles, in blocks of bounded size, which return no more than
a forest of the exact links. Texts are made distinct by their words first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, salted_join, spread, trimmed, whole_groups
from .components import connected_components, spanning_forest
from .simhash import majority, named_rows, only_named, trie_links

_BANDS, _ROWS = 20, 4
_MINIMA = _BANDS * _ROWS
_CHUNK = 1 << 11
_LOCAL = 200_000
_STAR = 1_000  # members of a band that one task joins
_BLOCK, _BLOCK_SHINGLES = 1_000, 500_000  # texts and shingles of one side of a block
_STRIPE = 64  # texts of a block whose pairs are held at once


def _words(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def shingles(words: list[bytes], width: int) -> set[bytes]:
    """Distinct runs of ``width`` words; fewer words make one shingle, no words the empty one."""
    return set(map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))) or {b" ".join(words)}


def similarity(a: bytes | None, b: bytes | None, width: int = 5) -> float:
    """Jaccard similarity of two texts' shingles."""
    x, y = shingles(_words(a), width), shingles(_words(b), width)
    both = len(x & y)
    return both / (len(x) + len(y) - both)


def _key(words: list[bytes]) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(words))


def _hashes(words: list[bytes], width: int) -> np.ndarray:
    """64-bit hashes of the distinct shingles."""
    own = shingles(words, width)
    return np.fromiter(map(xxhash.xxh3_64_intdigest, own), np.uint64, len(own))


def _minima(h: np.ndarray, factors: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    low = np.full(_MINIMA, np.iinfo(np.uint64).max)
    for at in range(0, len(h), _CHUNK):
        low = np.minimum(low, (h[at : at + _CHUNK, None] * factors + shifts).min(0))
    return low


def _sketches(rows: DataFrame, width: int, seed: int) -> DataFrame:
    """``who``, ``key`` (of the words), ``fp`` (fingerprint of the distinct shingles), their number ``size`` and ``bands`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng(seed)
        factors, shifts = (rng.integers(0, 1 << 64, _MINIMA, np.uint64) for _ in range(2))
        factors |= np.uint64(1)
        for b in batches:
            keys, fps, sizes, bands = [], np.zeros(b.num_rows, np.uint64), np.zeros(b.num_rows, np.int64), []
            for i, t in enumerate(b.column(1)):
                words = _words(t.as_py())
                h = _hashes(words, width)
                low = _minima(h, factors, shifts)
                keys.append(_key(words))
                fps[i], sizes[i] = majority([h]), len(h)
                bands.append([xxhash.xxh3_64_intdigest(low[k * _ROWS : (k + 1) * _ROWS].tobytes(), k) - (1 << 63) for k in range(_BANDS)])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(keys, pa.binary()), pa.array(fps.view(np.int64)), pa.array(sizes), pa.array(bands, pa.list_(pa.int64()))], ["who", "key", "fp", "size", "bands"])

    who = rows.schema["who"].dataType.simpleString()
    return spread(rows.select("who", F.col("text").cast("binary"))).mapInArrow(trimmed(run), f"who {who}, key binary, fp long, size long, bands array<long>")


def _forest(banded: DataFrame, max_bits: int) -> DataFrame:
    """Rows (h, key, fp) to (h, a, b): for each band the links of a spanning forest of its trie self-join."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, at in whole_groups(batches, 1):
            h, fp = table.column(0).to_numpy(), table.column(2).to_numpy().view(np.uint64)
            out: tuple[list, list, list] = ([], [], [])
            for g in np.flatnonzero(np.diff(at) > 1):
                s, e = at[g], at[g + 1]
                values, back = np.unique(fp[s:e], return_inverse=True)
                zero, all_ = np.zeros(1, np.int64), np.full(1, len(values))
                a, b = trie_links(values, zero, all_, zero, all_, 0, max_bits)
                first = np.zeros(len(values), np.int64)
                first[back[::-1]] = np.arange(e - s)[::-1]  # texts of one fingerprint join its first
                same = np.flatnonzero(first[back] != np.arange(e - s))
                p, q = np.r_[first[a], first[back[same]]], np.r_[first[b], same]
                apart = np.bitwise_count(fp[s + p] ^ fp[s + q])
                order = np.argsort(apart, kind="stable")  # the nearest are the likeliest to be similar
                p, q = p[order], q[order]
                tree = spanning_tree(p, q, e - s)
                keys = table.column(1).slice(s, e - s).to_pylist()
                for i in tree:
                    x, y = sorted((keys[p[i]], keys[q[i]]))
                    for column, v in zip(out, (h[s], x, y), strict=True):
                        column.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.binary())], ["h", "a", "b"])

    dealt = banded.select("h", "key", "fp").repartition("h").sortWithinPartitions("h", "key")
    return dealt.mapInArrow(trimmed(run), "h long, a binary, b binary")


def spanning_tree(p: np.ndarray, q: np.ndarray, n: int) -> list[int]:
    """Numbers of links that join what all of the links (p[i], q[i]) join, no more than n - 1."""
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    out = []
    for c in range(0, len(p), _CHUNK):
        for i, (a, b) in enumerate(zip(p[c : c + _CHUNK].tolist(), q[c : c + _CHUNK].tolist(), strict=True), c):
            a, b = find(a), find(b)
            if a != b:
                root[b] = a
                out.append(i)
        if len(out) == n - 1:
            break
    return out


def _unsettled(opened: DataFrame, rows: DataFrame, threshold: float, width: int) -> DataFrame:
    """Rows (h, key, size, root) to links (a, b) between members of a band whose roots differ, decided by their
    shingles: for each block a forest.

    One of two such members lies outside the band's main root, that of its least key: those meet all.
    """
    bands = cut(opened.groupBy("h").agg(F.min(F.struct("key", "root"))["root"].alias("main"), F.count("*").alias("count")))
    marked = cut(salted_join(opened, bands.select("h", "main"), ["h"], counts=bands.select("h", "count")).withColumn("out", F.col("root") != F.col("main")))
    blocks = lambda which: F.greatest(F.ceil(F.count_if(which) / _BLOCK), F.ceil(F.sum(F.when(which, F.col("size"))) / _BLOCK_SHINGLES)).cast("int")
    sizes = cut(marked.groupBy("h").agg(blocks(F.lit(True)).alias("ps"), blocks(F.col("out")).alias("qs"), F.count("*").alias("count")).where("qs > 0"))
    dealt = salted_join(marked.join(sizes.select("h"), "h", "left_semi"), sizes.select("h", "ps", "qs"), ["h"], counts=sizes.select("h", "count"))
    part = lambda n: F.pmod(F.xxhash64("key"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    sides = dealt.withColumn("i", part("ps")).withColumn("j", each("qs")).withColumn("side", F.lit(0))
    sides = sides.unionByName(dealt.where("out").withColumn("j", part("qs")).withColumn("i", each("ps")).withColumn("side", F.lit(1)))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, sets, held = [], [], 0
            for i, t in enumerate(b.column(0)):  # one text's words at a time
                words = _words(t.as_py())
                keys.append(_key(words))
                sets.append(_hashes(words, width).view(np.int64))
                held += len(sets[-1])
                if held > _BLOCK_SHINGLES or i + 1 == b.num_rows:
                    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(sets, pa.list_(pa.int64()))], ["key", "shingles"])
                    keys, sets, held = [], [], 0

    texts = _of_keys(marked.select("key"), rows).select("text").mapInArrow(trimmed(hashed), "key binary, shingles array<long>")
    sides = sides.select("h", "i", "j", "side", "key", "root").join(texts, "key").select("h", "i", "j", "side", "key", "root", "shingles")
    sides = sides.repartition("h", "i", "j").sortWithinPartitions("h", "i", "j", "side", "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, at in whole_groups(batches, 3):
            side = table.column("side").to_numpy()
            for s, e in zip(at[:-1], at[1:], strict=True):
                m = int(np.count_nonzero(side[s:e] == 0))
                own = table.slice(s, e - s)
                keys = own.column("key").to_pylist()
                number = {r: i for i, r in enumerate(own.column("root").unique().to_pylist())}
                root = np.array([number[r] for r in own.column("root").to_pylist()])
                first = {k: i for i, k in reversed(list(enumerate(keys)))}  # a text stands on both sides
                place = np.array([first[k] for k in keys])
                label = np.arange(e - s)
                for p, q in alike_pairs(own.column("shingles").combine_chunks(), m, threshold):
                    apart = root[p] != root[q]
                    label = spanning_forest(np.r_[place[p[apart]], label], np.r_[place[q[apart]], np.arange(e - s)], e - s)
                pairs = [sorted((keys[i], keys[label[i]])) for i in np.flatnonzero(label != np.arange(e - s))]
                yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.binary()), pa.array([p[1] for p in pairs], pa.binary())], ["a", "b"])

    return sides.mapInArrow(trimmed(run), "a binary, b binary").distinct()


def alike_pairs(sets: pa.ListArray | pa.ChunkedArray, m: int, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (p[i] >= m, q[i] < m) of sets of hashes whose Jaccard similarity reaches the threshold, by products of 0-1 matrices.

    They come in stripes of ``_STRIPE`` sets: of a group of alike texts, all pairs are never held at once.
    """
    sets = pa.concat_arrays(sets.chunks) if isinstance(sets, pa.ChunkedArray) else sets
    size = sets.value_lengths().to_numpy().astype(np.int64)
    code, of, width = _shared(sets.flatten().to_numpy(), size)
    both = np.zeros((len(size) - m, m), np.float32)
    for c in range(0, width, 256):
        lo, hi = np.searchsorted(code, (c, c + 256))
        block = np.zeros((len(size), 256), np.float32)
        block[of[lo:hi], code[lo:hi] - c] = 1
        both += block[m:] @ block[:m].T
    for c in range(0, len(both), _STRIPE):  # the quotients in double precision
        some = both[c : c + _STRIPE].astype(np.float64)
        i, j = np.nonzero(some / (size[m + c : m + c + _STRIPE, None] + size[None, :m] - some) >= threshold)
        yield i + (m + c), j


def _shared(flat: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Hashes of sets of these sizes that occur more than once (others are in no intersection), in order: their number, their set; how many differ."""
    names = np.sort(flat)
    names = np.unique(names[1:][names[1:] == names[:-1]])
    if not len(names):
        return np.zeros(0, np.int32), np.zeros(0, np.int32), 0
    code = np.searchsorted(names, flat).astype(np.int32)
    shared = names[np.minimum(code, len(names) - 1)] == flat
    code, of = code[shared], np.repeat(np.arange(len(size), dtype=np.int32), size)[shared]
    order = np.argsort(code, kind="stable")
    return code[order], of[order], len(names)


def _of_keys(keys: DataFrame, rows: DataFrame) -> DataFrame:
    """``key`` and ``text`` of each of the keys."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([_key(_words(t.as_py())) for t in b.column(0)], pa.binary()), b.column(0)], ["key", "text"])

    need = cut(keys.distinct())
    need = F.broadcast(need) if need.count() <= _LOCAL else need
    texts = spread(rows.select(F.col("text").cast("binary"))).mapInArrow(trimmed(keyed), "key binary, text binary")
    return cut(texts.join(need, "key", "left_semi").groupBy("key").agg(F.first("text").alias("text")))


def _decided(pairs: DataFrame, rows: DataFrame, threshold: float, width: int) -> DataFrame:
    """``pairs(a, b)`` with ``similar``, by the texts of ``rows``."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            similar = [similarity(x.as_py(), y.as_py(), width) >= threshold for x, y in zip(b.column(2), b.column(3), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(similar, pa.bool_())], ["a", "b", "similar"])

    texts = _of_keys(pairs.select(F.explode(F.array("a", "b")).alias("key")), rows)
    # links of a star all name its pivot
    both = salted_join(pairs, texts.select(F.col("key").alias("a"), F.col("text").alias("x")), ["a"])
    both = both.join(texts.select(F.col("key").alias("b"), F.col("text").alias("y")), "b")
    return cut(both.select("a", "b", "x", "y").mapInArrow(trimmed(judge), "a binary, b binary, similar boolean"))


def drop_near_copies(docs: DataFrame, threshold: float = 0.8, width: int = 5, max_bits: int = 21, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component of texts linked by a similarity of ``threshold`` or more: that of the
    smallest id (a row without an id only where no row has one; of rows that share that id, the one with the
    smallest hash of its columns).

    A-Z are lower-cased, words are runs of bytes other than ASCII white space. Null and empty texts are
    alike. Very long texts are compared whole. Rows that repeat in all columns are one row. All columns are kept,
    whatever their names. An empty table gives an empty table.
    """
    rows = named_rows(docs, id_col, text_col)
    sketches = cut(_sketches(rows, width, seed))
    distinct = cut(sketches.groupBy("key").agg(F.min("who").alias("who"), F.first("fp").alias("fp"), F.first("size").alias("size"), F.first("bands").alias("bands")))
    banded = distinct.select("key", "fp", "size", F.explode("bands").alias("h"))
    stars = cut(banded.groupBy("h").agg(F.count("*").alias("count"), F.min(F.struct("key", "fp")).alias("pivot")).where(F.col("count") > _STAR))
    if stars.isEmpty():
        small, joined = banded, None
    else:
        small = banded.join(stars.select("h"), "h", "left_anti")
        joined = salted_join(banded.join(stars.select("h"), "h", "left_semi"), stars.select("h", "pivot"), ["h"], counts=stars.select("h", "count"))
        joined = joined.where((F.col("key") != F.col("pivot.key")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("pivot.fp"))) <= max_bits)).select("h", F.col("pivot.key").alias("a"), F.col("key").alias("b"))
    forest = _forest(small, max_bits)
    forest = cut(forest if joined is None else forest.unionByName(joined))
    decided = _decided(cut(forest.select("a", "b").distinct()), rows, threshold, width)
    links = decided.where("similar").select("a", "b")
    failed = forest.join(decided.where("not similar"), ["a", "b"], "left_semi").select("h").unionByName(stars.select("h"))
    failed = cut(failed.distinct())
    if not failed.isEmpty():
        roots = connected_components(links).withColumnRenamed("node", "key")
        opened = cut(banded.join(failed, "h", "left_semi").join(roots, "key", "left").withColumn("root", F.coalesce("root", "key")).select("h", "key", "size", "root"))
        links = links.unionByName(cut(_unsettled(opened, rows, threshold, width)))
    named = distinct.select("key", "who").join(connected_components(links).withColumnRenamed("node", "key"), "key", "left")
    kept = named.groupBy(F.coalesce("root", "key").alias("root")).agg(F.min("who").alias("who")).select("who")
    return only_named(docs, sketches.select("who"), kept)
