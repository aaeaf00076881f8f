"""SimHash near-duplicates by a binary trie self-join.

A fingerprint is a path in a binary trie. The join walks pairs of trie nodes together, one bit at a
time, adds up the bits in which the two paths differ and drops a pair of nodes as soon as the sum
exceeds the error budget. Three things make the walk fit a cluster:

* Fingerprints are made distinct first, so exact copies (a third of all rows may be one text) are a
  single leaf with its smallest document.
* With a budget of k bits, two linked fingerprints agree on at least one of k + 1 blocks of bits.
  The trie is built once for each block rotated to the top, and there the walk allows no error: the
  pairs of nodes at that depth are the equal blocks, which is an ordinary shuffle key.
* A block that holds more fingerprints than ``node_limit`` is walked on by Spark: rows move to pairs
  of child nodes, seven bits at a time, until each pair of nodes is small enough for one task.

Only a spanning forest of the links leaves a task: components need no more.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, salted_join, spread
from .components import connected_components, spanning_forest

_CHUNK = 1 << 15
_STEP = 7
_BYTE = np.arange(8, dtype=np.int64) * 256
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.float64)


def fingerprint(text: bytes | None, width: int = 3, seed: int = 42) -> int:
    """SimHash of a text's word shingles, as an unsigned 64-bit number.

    A-Z are lower-cased, words are runs of bytes other than ASCII white space. Fewer words than
    ``width`` make one shingle; no words (null included) give zero.
    """
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) < width:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    digest, n = xxhash.xxh64_intdigest, len(words) - width + 1

    def hashes() -> Iterator[np.ndarray]:
        for at in range(0, n, _CHUNK):
            part = words[at : at + _CHUNK + width - 1]
            shingles = map(b" ".join, zip(*(part[i:] for i in range(width)), strict=False))
            yield np.fromiter((digest(s, seed) for s in shingles), np.uint64)

    return majority(hashes())


def majority(hashes: Iterable[np.ndarray]) -> int:
    """The number whose bits are those that more than half of the 64-bit hashes have."""
    seen, n = np.zeros(8 * 256, np.int64), 0
    for h in hashes:
        seen += np.bincount((h.astype("<u8").view(np.uint8).reshape(-1, 8) + _BYTE).ravel(), minlength=8 * 256)
        n += len(h)
    ones = (seen.reshape(8, 256) @ _BITS).ravel()  # from how often each byte stands at each place
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col`` and ``fp``, the fingerprint as a signed long. No shuffle."""
    id_type = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint(t.as_py(), width, seed) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], [id_col, "fp"])

    return spread(docs.select(F.col(id_col), F.col(text_col).cast("binary"))).mapInArrow(run, f"`{id_col}` {id_type.simpleString()}, fp long")


def trie_links(values: np.ndarray, lo1: np.ndarray, hi1: np.ndarray, lo2: np.ndarray, hi2: np.ndarray, depth: int, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Walk pairs of trie nodes over sorted distinct ``values`` and return the linked index pairs.

    A node is the range [lo, hi) of values that share their top ``depth`` bits. A pair (lo1 == lo2)
    is a node with itself. The walk starts with the bits in which the two nodes differ.
    """
    found_a, found_b = [], []
    stack = [(lo1, hi1, lo2, hi2, depth)]
    while stack:
        lo1, hi1, lo2, hi2, depth = stack.pop()
        while len(lo1):
            if len(lo1) > 1 << 18:
                half = len(lo1) // 2
                stack.append((lo1[half:], hi1[half:], lo2[half:], hi2[half:], depth))
                lo1, hi1, lo2, hi2 = lo1[:half], hi1[:half], lo2[:half], hi2[:half]
            n1, n2 = hi1 - lo1, hi2 - lo2
            leaf = n1 * n2 <= 32 if depth < 64 else np.ones(len(n1), bool)
            if leaf.any():
                cells = (n1 * n2)[leaf]
                node = np.repeat(np.arange(len(cells)), cells)
                cell = np.arange(cells.sum()) - np.repeat(np.cumsum(cells) - cells, cells)
                a = lo1[leaf][node] + cell // n2[leaf][node]
                b = lo2[leaf][node] + cell % n2[leaf][node]
                near = (a < b) & (np.bitwise_count(values[a] ^ values[b]) <= budget)
                found_a.append(a[near])
                found_b.append(b[near])
                lo1, hi1, lo2, hi2 = (x[~leaf] for x in (lo1, hi1, lo2, hi2))
                if not len(lo1):
                    break
            bit = np.uint64(1) << np.uint64(63 - depth)
            above = ~((bit << np.uint64(1)) - np.uint64(1)) if depth else np.uint64(0)
            mid1 = np.searchsorted(values, (values[lo1] & above) | bit)
            mid2 = np.searchsorted(values, (values[lo2] & above) | bit)
            mid1, mid2 = np.clip(mid1, lo1, hi1), np.clip(mid2, lo2, hi2)
            same = lo1 == lo2
            pairs = [(lo1, mid1, lo2, mid2), (mid1, hi1, mid2, hi2), (lo1, mid1, mid2, hi2), tuple(x[~same] for x in (mid1, hi1, lo2, mid2))]
            lo1, hi1, lo2, hi2 = (np.concatenate(x) for x in zip(*pairs, strict=True))
            full = (lo1 < hi1) & (lo2 < hi2) & ~((lo1 == lo2) & (hi1 - lo1 == 1))
            lo1, hi1, lo2, hi2 = (x[full] for x in (lo1, hi1, lo2, hi2))
            depth += 1
            if len(lo1):
                differ = np.bitwise_count((values[lo1] ^ values[lo2]) >> np.uint64(64 - depth))
                lo1, hi1, lo2, hi2 = (x[differ <= budget] for x in (lo1, hi1, lo2, hi2))
    return np.concatenate([*found_a, np.zeros(0, np.int64)]).astype(np.int64), np.concatenate([*found_b, np.zeros(0, np.int64)]).astype(np.int64)


def _walk(budget: int, bits_of: dict[int, int]):
    """Arrow function: sorted rows (r, d, p, q, v) to a spanning forest of links between values."""

    def links(r: int, d: int, p: np.ndarray, q: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        new = np.r_[True, (p[1:] != p[:-1]) | (q[1:] != q[:-1])]
        at = np.flatnonzero(new)
        end = np.r_[at[1:], len(v)]
        out_a, out_b = [], []
        top = v >> np.uint64(64 - d)
        lone = p[at] == q[at]
        # the pairs of nodes of a group: itself with itself, or its first with its second node
        second = np.where(lone, at, at + np.add.reduceat((top == p).astype(np.int64), at))
        first_end = np.where(lone, end, second)
        use = (end - at >= 2) & (first_end > at) & (second < end)
        if use.any():
            # larger groups are walked one by one, all smaller ones are compared at once
            big = use & (end - at > 64)
            for s, m, fe, e in zip(at[big], second[big], first_end[big], end[big], strict=True):
                a, b = trie_links(v[s:e], np.array([0]), np.array([fe - s]), np.array([m - s]), np.array([e - s]), d, budget)
                out_a.append(a + s)
                out_b.append(b + s)
            small = use & ~big
            n1, n2 = (first_end - at)[small], (end - second)[small]
            cells = n1 * n2
            node = np.repeat(np.arange(len(cells)), cells)
            cell = np.arange(cells.sum()) - np.repeat(np.cumsum(cells) - cells, cells)
            a, b = at[small][node] + cell // n2[node], second[small][node] + cell % n2[node]
            near = (a < b) & (np.bitwise_count(v[a] ^ v[b]) <= budget)
            out_a.append(a[near])
            out_b.append(b[near])
        if not out_a:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        a, b = np.concatenate(out_a), np.concatenate(out_b)
        if len(a):
            nodes, back = np.unique(np.r_[v[a], v[b]], return_inverse=True)
            root = spanning_forest(back[: len(a)], back[len(a) :], len(nodes))
            off = np.flatnonzero(root != np.arange(len(nodes)))
            turn = np.uint64(bits_of[r])
            plain = (nodes >> turn) | (nodes << (np.uint64(64) - turn)) if bits_of[r] else nodes
            return plain[off].view(np.int64), plain[root[off]].view(np.int64)
        return np.zeros(0, np.int64), np.zeros(0, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] | None = None

        def flush(cols: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            r, d, p, q, v = cols
            for s, e in _runs(r, d):
                a, b = links(int(r[s]), int(d[s]), p[s:e].view(np.uint64), q[s:e].view(np.uint64), v[s:e].view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            cols = cols if kept is None else [np.concatenate(x) for x in zip(kept, cols, strict=True)]
            r, d, p, q, _ = cols
            if not len(r):
                continue
            last = np.flatnonzero((r != r[-1]) | (d != d[-1]) | (p != p[-1]) | (q != q[-1]))
            cut_at = int(last[-1]) + 1 if len(last) else 0
            if cut_at:
                yield from flush([c[:cut_at] for c in cols])
            kept = [c[cut_at:] for c in cols]
        if kept is not None and len(kept[0]):
            yield from flush(kept)

    return run


def _runs(r: np.ndarray, d: np.ndarray) -> Iterator[tuple[int, int]]:
    at = np.flatnonzero(np.r_[True, (r[1:] != r[:-1]) | (d[1:] != d[:-1])])
    yield from zip(at, np.r_[at[1:], len(r)], strict=True)


def hamming_forest(distinct: DataFrame, max_bits: int = 2, node_limit: int = 20_000) -> DataFrame:
    """A spanning forest ``(a, b)`` of the links between distinct fingerprints ``fp`` (signed longs)
    that differ in at most ``max_bits`` bits. Links found under several blocks may repeat."""
    blocks = max_bits + 1
    width = 64 // blocks
    bits_of = {r: width * r for r in range(blocks)}
    turned = F.array(*[F.struct(F.lit(r).alias("r"), (F.expr(f"shiftleft(fp, {s}) | shiftrightunsigned(fp, {64 - s})") if s else F.col("fp")).alias("v")) for r, s in bits_of.items()])
    rows = distinct.select(F.explode(turned).alias("t")).select("t.r", F.lit(width).alias("d"), "t.v")
    rows = rows.withColumn("p", F.expr(f"shiftrightunsigned(v, {64 - width})")).select("r", "d", "p", F.col("p").alias("q"), "v")
    masks = [m for m in range(1 << _STEP) if m.bit_count() <= max_bits]
    done: list[DataFrame] = []
    depth = width
    while True:
        key = ["r", "d", "p", "q"]
        sizes = rows.groupBy(*key).agg(
            F.count("*").alias("n"), F.count_if(F.expr(f"shiftrightunsigned(v, {64 - depth}) = p")).alias("n1"), F.count_if(F.expr(f"shiftrightunsigned(v, {64 - depth}) = q")).alias("n2")
        ).where("n > 1 and n1 > 0 and n2 > 0")
        large = cut(sizes.where(F.col("n") > node_limit).select(*key)) if depth + _STEP < 64 else None
        if large is None or large.isEmpty():
            done.append(rows)
            break
        done.append(rows.join(large, key, "left_anti"))
        kids = rows.join(large, key, "left_semi")
        own = F.expr(f"shiftrightunsigned(v, {64 - depth})")
        kids = kids.withColumn("other", F.when(own == F.col("p"), F.col("q")).otherwise(F.col("p")))
        kids = kids.withColumn("m", F.explode(F.array(*[F.lit(m).cast("long") for m in masks])))
        kids = kids.where(F.bit_count(F.col("m")) + F.bit_count(F.expr("p ^ q")) <= max_bits)
        depth += _STEP
        kids = kids.withColumn("mine", F.expr(f"shiftrightunsigned(v, {64 - depth})"))
        kids = kids.withColumn("their", F.expr(f"shiftleft(other, {_STEP}) | ((mine & {(1 << _STEP) - 1}) ^ m)"))
        rows = cut(kids.select("r", F.lit(depth).alias("d"), F.least("mine", "their").alias("p"), F.greatest("mine", "their").alias("q"), "v").distinct())
    out = None
    for part in done:
        dealt = part.repartition("r", "d", "p", "q").sortWithinPartitions("r", "d", "p", "q", F.expr("shiftrightunsigned(v, 1)"), F.expr("v & 1"))
        links = dealt.select(F.col("r").cast("int"), F.col("d").cast("int"), "p", "q", "v").mapInArrow(_walk(max_bits, bits_of), "a long, b long")
        out = links if out is None else out.unionByName(links)
    return out


def link_fingerprints(distinct: DataFrame, max_bits: int = 2, node_limit: int = 20_000) -> DataFrame:
    """``fp`` and ``root`` for every row of ``distinct(fp)``; linked fingerprints share a root."""
    nodes = connected_components(hamming_forest(distinct.select("fp"), max_bits, node_limit))
    return distinct.select("fp").join(nodes.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def simhash_components(docs: DataFrame, max_bits: int = 2, width: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text", node_limit: int = 20_000) -> DataFrame:
    """One row per input row: ``id_col``, ``fp`` (signed long) and ``component`` (the smallest id reachable over
    links of at most ``max_bits`` differing bits, itself included).

    Null and empty texts have fingerprint zero and link with one another. A row whose id is null
    takes part; it never names a component, which is null only where no member has an id. Repeated
    rows give repeated rows. An empty table gives an empty table. Other columns are not read.
    """
    rows = cut(fingerprints(docs, width, seed, id_col, text_col))
    distinct = cut(rows.groupBy("fp").agg(F.min(id_col).alias("first"), F.count("*").alias("count")))
    nodes = connected_components(hamming_forest(distinct.select("fp"), max_bits, node_limit))
    linked = cut(distinct.join(nodes.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    firsts = linked.groupBy("root").agg(F.min("first").alias("component"), F.count("*").alias("count"))
    by_fp = salted_join(linked.select("fp", "root"), firsts.drop("count"), ["root"], counts=firsts.select("root", "count")).select("fp", "component")
    return salted_join(rows, by_fp, ["fp"], counts=distinct.select("fp", "count")).select(id_col, "fp", "component")


def _row_hashes(docs: DataFrame) -> list:
    """Two hashes of all columns of a row, 128 bits together."""
    plain = {f.name: "map<" not in f.dataType.simpleString() for f in docs.schema.fields}  # Spark doesn't hash maps
    columns = [docs[c] if plain[c] else F.to_json(F.struct(docs[c])) for c in docs.columns]
    return [F.xxhash64(*columns), F.xxhash64(F.lit("second"), *columns)]


def named_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``who`` (smallest for the row to keep: lacks an id, id, hashes of all columns) and ``text`` of every row."""
    h1, h2 = _row_hashes(docs)
    return docs.select(F.struct(F.col(id_col).isNull().alias("lacks"), F.col(id_col).alias("id"), h1.alias("h1"), h2.alias("h2")).alias("who"), F.col(text_col).alias("text"))


def only_named(docs: DataFrame, all_rows: DataFrame, kept: DataFrame, local: int = 1_000_000) -> DataFrame:
    """The rows of ``docs`` that ``kept(who)`` names, each once; ``all_rows(who)`` names all of them, with repeats.

    What is to go is decided on names alone. Up to ``local`` names of such rows are broadcast and texts stay where
    they are; more meet the rows by one exchange.
    """
    hashes = lambda df: df.select(F.col("who.h1").alias("gone 1"), F.col("who.h2").alias("gone 2"))
    kept = hashes(kept)
    counted = hashes(all_rows).groupBy("gone 1", "gone 2").agg(F.count("*").alias("rows"))
    stays = counted.join(kept, ["gone 1", "gone 2"], "left_semi")
    gone = cut(counted.join(kept, ["gone 1", "gone 2"], "left_anti").select("gone 1", "gone 2"))
    twice = cut(stays.where("rows > 1").select("gone 1", "gone 2"))
    mark = "row hash" + "_" * max(map(len, docs.columns))  # longer than any column's name
    h1, h2 = _row_hashes(docs)
    marked = docs.withColumns({mark + "1": h1, mark + "2": h2})
    same = lambda names: (marked[mark + "1"] == names["gone 1"]) & (marked[mark + "2"] == names["gone 2"])
    once = lambda df: df.dropDuplicates([mark + "1", mark + "2"])
    if gone.count() + twice.count() <= local:
        few = F.broadcast(twice)
        rest = marked.join(F.broadcast(gone), same(gone), "left_anti").join(few, same(few), "left_anti")
        found = rest.unionByName(once(marked.join(few, same(few), "left_semi")))
    else:
        found = once(marked.join(cut(kept), same(kept), "left_semi"))
    return found.drop(mark + "1", mark + "2")


def hex_fingerprint(fp: str = "fp"):
    """The 16 lower-case hex digits of a signed 64-bit fingerprint."""
    return F.lpad(F.lower(F.hex(F.col(fp))), 16, "0")
