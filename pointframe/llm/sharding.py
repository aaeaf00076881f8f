"""Shards of near-equal bytes by histogram sort, in DataFrame operations only.

Every row gets a 64-bit sort key: the upper half from a hash of its text, the lower half from a hash
of its id. Equal texts are therefore neighbours, and a group of copies of any size can still be cut
by id. The splitters between shards come from counting, not from a sample:

1. Count rows and bytes below 2^12 candidate boundaries over the key's whole range.
2. Only the bins that hold a splitter's target are probed again with 2^12 finer boundaries, until
   each splitter meets its tolerance or the key is exhausted.
3. The rows are exchanged once, by fine bins of that order; a row's slot is the exact number of rows
   of its shard in earlier bins plus its rank in its bin.

The driver sees at most ``(shards - 1) * 2^12`` counts a round and never a row.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut

_BITS = 12
_ROWS_PER_BIN = 20_000


def sort_key(text: str = "text", row_id: str = "doc_id") -> Column:
    """Upper 32 bits from the text, lower 32 from the id; non-negative order of a signed long."""
    high = F.xxhash64(F.col(text)).bitwiseAND(0x7FFFFFFF)
    low = F.xxhash64(F.col(row_id), F.lit("id")).bitwiseAND(0xFFFFFFFF)
    return F.shiftleft(high, 32).bitwiseOR(low)


def splitters(keyed: DataFrame, shards: int, tolerance: float, key_bits: int = 63) -> list[int]:
    """Keys at which shards 1, 2, ... begin, for ``keyed(key, size)``; found by repeated histograms.

    A cut that leaves a group of equal upper halves whole is taken if it is within ``tolerance``
    of a shard's size; else the cut is the key nearest to the target.
    """
    total = keyed.agg(F.sum("size")).first()[0] or 0
    targets = [total * s // shards for s in range(1, shards)]
    slack = tolerance * total / shards
    # what is known about a target: the bin [base, base + 2^width) that holds it and the bytes below the bin
    open_ = {i: (0, key_bits, 0) for i in range(len(targets))} if total else {}
    cuts = [0] * len(targets)
    while open_:
        width = next(iter(open_.values()))[1]
        step = max(0, width - _BITS)
        bases = sorted({b for b, _, _ in open_.values()})
        inside = keyed if width == key_bits else keyed.where(F.shiftright("key", width).isin([b >> width for b in bases]))
        counts = dict(inside.groupBy(F.shiftright("key", step).alias("bin")).agg(F.sum("size").alias("size")).collect())
        bins = sorted(counts)
        by_base: dict[int, tuple[list[int], list[int]]] = {}
        for base in bases:
            own = [b for b in bins if base <= b << step < base + (1 << width)]
            by_base[base] = (own, [0, *accumulate(counts[b] for b in own)])
        still = {}
        for i, (base, _, below) in open_.items():
            own, sums = by_base[base]
            at = min(max(bisect_right(sums, targets[i] - below) - 1, 0), len(own) - 1)
            low, high = below + sums[at], below + sums[at + 1]
            near_low = targets[i] - low <= high - targets[i]
            error = min(targets[i] - low, high - targets[i])
            edge = (own[at] << step) if near_low else ((own[at] + 1) << step)
            if step == 0 or (error <= slack and step >= 32):
                cuts[i] = edge
            else:
                still[i] = (own[at] << step, step, low)
        open_ = still
    return cuts


def histogram_shards(docs: DataFrame, shards: int = 24, tolerance: float = 0.01, id_col: str = "doc_id", text_col: str = "text", overhead: int = 8) -> DataFrame:
    """Put every row into one of ``shards`` shards of near-equal bytes.

    Returns ``id_col``, ``size`` (UTF-8 bytes of the text plus ``overhead``), ``text_crc32``
    (null texts: that of no bytes), ``law`` ('bytes'), ``shard``, ``slot`` (gapless from 0) and
    ``grown_shard`` (null under this law). Null texts have no bytes; null ids sort as one id; repeated
    rows are kept, each with a slot of its own; an empty table gives an empty table. Equal texts stay
    in one shard unless a cut elsewhere would leave sizes uneven by more than ``tolerance`` of a
    shard. Other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = cut(
        docs.select(
            F.col(id_col), (F.octet_length(text) + overhead).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"), sort_key(text_col, id_col).alias("key"),
        )
    )
    cuts = splitters(keyed.select("key", "size"), shards, tolerance)
    shard = F.lit(0)
    for s, edge in enumerate(cuts, 1):
        shard = F.when(F.col("key") >= F.lit(edge), F.lit(s)).otherwise(shard)
    rows = keyed.count()
    fine = min(31, max(6, (max(rows, 1) // _ROWS_PER_BIN).bit_length() + 1))
    # keys are hashes and so even in their lower half; a bin is (shard, upper bits, bits of the id) and small even in one group of copies
    placed = keyed.withColumn("shard", shard).withColumn("bin", F.shiftright("key", 63 - fine)).withColumn("sub", F.shiftright(F.col("key").bitwiseAND(0xFFFFFFFF), 32 - fine))
    group_rows = placed.groupBy("shard", "bin").agg(F.count("*").alias("n"))
    large = group_rows.where(F.col("n") > 4 * _ROWS_PER_BIN).select("shard", "bin", F.lit(True).alias("large"))
    placed = placed.join(F.broadcast(large), ["shard", "bin"], "left").withColumn("sub", F.when(F.col("large"), F.col("sub")).otherwise(F.lit(0)))
    placed = placed.withColumn("group", F.when(F.col("large"), F.shiftright("key", 32)).otherwise(F.lit(0))).drop("large")
    cell = ["shard", "bin", "group", "sub"]
    before = placed.groupBy(*cell).agg(F.count("*").alias("n"))
    before = before.withColumn("before", F.sum("n").over(W.partitionBy("shard").orderBy("bin", "group", "sub")) - F.col("n")).drop("n")
    ranked = placed.withColumn("rank", F.row_number().over(W.partitionBy(*cell).orderBy("key", id_col)) - 1)
    return ranked.join(before, cell).select(
        id_col, "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("before") + F.col("rank")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
