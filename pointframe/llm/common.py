"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import re
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder.

    The folder named by ``spark.checkpoint.dir`` is used where it is set. A session on one machine (master
    ``local``) that names none gets a folder of its own; on a cluster that raises, since no executor sees
    a folder of the driver's machine.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="pointframe-checkpoint-")
    sc.setCheckpointDir(folder)
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared checkpoint folder; survives the loss of executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def spread(df: DataFrame, bytes_per_core: int = 2 << 20) -> DataFrame:
    """The rows of a small table dealt out over all cores; a larger one, which has splits for them, as it is.

    A small file is often one row group, so that one task would do all the work on it. What is exchanged is at
    most ``bytes_per_core`` a core, whatever the table.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size <= bytes_per_core * cores else df


def salted_join(many: DataFrame, one: DataFrame, keys: list[str], counts: DataFrame | None = None, salts: int = 64, share: int = 2_000) -> DataFrame:
    """Inner join of ``many`` with ``one``, which has at most one row for a key, where keys may be hot in ``many``.

    Keys with at least one row in ``share`` are dealt out over ``salts`` tasks, and their rows of ``one`` repeated
    for each. There are at most ``share`` of them, so their list is broadcast. ``many``, whose lineage should be cut,
    is counted first unless the ``counts(keys, count)`` of all its keys are at hand. No key is null.
    """
    total = many.count() if counts is None else counts.agg(F.sum("count")).first()[0] or 0
    counts = many.groupBy(*keys).count() if counts is None else counts
    hot = cut(counts.where(F.col("count") >= max(100, total // share)).select(*keys)).withColumn("is hot", F.lit(True))
    if hot.isEmpty():
        return many.join(one, keys)
    marked = [df.join(F.broadcast(hot), keys, "left") for df in (many, one)]
    spread = marked[0].withColumn("salt", F.when(F.col("is hot"), F.pmod(F.monotonically_increasing_id(), F.lit(salts))).otherwise(0)).drop("is hot")
    copies = marked[1].withColumn("salt", F.explode(F.when(F.col("is hot"), F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).otherwise(F.array(F.lit(0).cast("long"))))).drop("is hot")
    return spread.join(copies, [*keys, "salt"]).drop("salt")


def whole_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Regroup sorted Arrow batches so that no group is cut: tables of whole groups and their starts (with the end).

    The first ``keys`` columns, numbers without nulls, name the group. Memory is that of a batch plus one group.
    """
    kept: pa.Table | None = None

    def starts(table: pa.Table) -> np.ndarray:
        new = np.zeros(table.num_rows, bool)
        new[0] = True
        for c in table.columns[:keys]:
            v = c.to_numpy()
            new[1:] |= v[1:] != v[:-1]
        return np.r_[np.flatnonzero(new), table.num_rows]

    for b in batches:
        if not b.num_rows:
            continue
        table = pa.Table.from_batches([b])
        if kept is not None:
            table = pa.concat_tables([kept, table]).combine_chunks()
        at = starts(table)
        if len(at) > 2:
            yield table.slice(0, at[-2]), at[:-1]
        kept = table.slice(at[-2])
    if kept is not None and kept.num_rows:
        yield kept, np.array([0, kept.num_rows])


def trimmed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``, which gives back what it has freed when it ends.

    A Python worker lives on for the next stages, and its allocators would keep each stage's peak.
    """

    def lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return lean


def give_back() -> None:
    """Return freed memory of Arrow's and the C library's allocator to the system, as far as they can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def matrix(column: pa.ChunkedArray | pa.Array, dtype=np.float64) -> np.ndarray:
    """Rows of equal length without nulls as a matrix."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(flat, pa.ChunkedArray):
        flat = pa.concat_arrays(flat.chunks)
    n = len(flat)
    return flat.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(n, -1) if n else np.zeros((0, 0), dtype)


def usable(vector: str) -> Column:
    """True for vectors that are not null, not empty, not all zero and hold only finite numbers."""
    v = F.col(vector)
    ok = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & F.forall(v, ok) & F.exists(v, lambda x: x != 0), F.lit(False))


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder of whatever store its path names."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
