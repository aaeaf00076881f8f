"""Collections: Parquet tables of points with a description beside them.

Layout of a stored collection::

    <path>/collection.json        description
    <path>/snapshots/<n>.json     for each bucket of ids, the folder that holds its rows
    <path>/data/<write>/bucket=<b>/...parquet

A write reads and rewrites only the buckets that it touches, into a folder that no other write uses, and then
publishes snapshot n + 1 by creating a file that must not exist yet. Of two writers that started from one
snapshot the second raises ``SnapshotConflict`` and leaves no trace; what has been published never changes. A
reader keeps the snapshot that it opened. One column for each vector means that Spark reads just the vectors a
query asks for.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import CollectionNotFound, InvalidSchema, SnapshotConflict
from ..workers import importable
from .config import CollectionConfig
from .ingest import with_metadata


class _Files:
    """Small text files in whatever store a path names."""

    def __init__(self, spark: SparkSession, path: str):
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())
        self._jvm = jvm

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, path: str, text: str) -> None:
        """Create a file with its whole text at once; raises ``SnapshotConflict`` where there is one already.

        Local files are hard-linked into place, object stores create conditionally, and others (HDFS) rename
        without overwriting: each refuses an existing file in one atomic step.
        """
        scheme, target = self._fs.getScheme(), self._path(path)
        whole = scheme in ("s3", "s3a", "gs")
        part = target if whole else self._path(f"{path}.{uuid.uuid4().hex}.part")
        try:
            made = self._fs.createFile(part).overwrite(False)
            stream = (made.opt("fs.option.create.conditional.overwrite", True) if whole else made).recursive().build()
            stream.write(bytearray(text.encode()))
            stream.close()
            if scheme == "file":
                as_file = lambda p: self._jvm.java.io.File(p.toUri().getPath()).toPath()
                self._jvm.java.nio.file.Files.createLink(as_file(target), as_file(part))
            elif not whole:
                context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._fs.getConf())
                none = self._jvm.org.apache.hadoop.fs.Options.Rename.NONE
                options = self._jvm.java.lang.reflect.Array.newInstance(none.getClass(), 1)
                options[0] = none
                context.rename(part, target, options)
        except Py4JJavaError as e:
            if self._fs.exists(target):
                raise SnapshotConflict(f"another writer has published {path}") from e
            raise
        finally:
            if not whole:
                self._fs.delete(part, False)

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def names(self, path: str) -> list[str]:
        return [s.getPath().getName() for s in self._fs.listStatus(self._path(path))] if self.exists(path) else []


class Collection:
    """A table of points: ``id``, ``payload`` and one column (sparse: two) for each vector."""

    def __init__(self, spark: SparkSession, config: CollectionConfig, df: DataFrame, name: str = "collection", path: str | None = None, snapshot: int | None = None):
        self.spark, self.config, self.name, self.path, self.snapshot = spark, config, name, path, snapshot
        self._df = df

    # -- opening and creating

    @classmethod
    def create(cls, spark: SparkSession, path: str, config: CollectionConfig, buckets: int = 64) -> Collection:
        """A new, empty collection at a path that holds none."""
        files = _Files(spark, path)
        if files.exists(f"{path}/collection.json"):
            raise InvalidSchema(f"there is a collection at {path} already")
        about = json.loads(config.to_json()) | {"buckets": buckets}
        files.publish(f"{path}/collection.json", json.dumps(about))
        files.publish(f"{path}/snapshots/0.json", "{}")
        return cls.open(spark, path)

    @classmethod
    def open(cls, spark: SparkSession, path: str, snapshot: int | None = None) -> Collection:
        """The collection at a path, as its newest (or the given) snapshot has it; later writes don't show."""
        files = _Files(spark, path)
        if not files.exists(f"{path}/collection.json"):
            raise CollectionNotFound(f"no collection at {path}")
        text = files.read(f"{path}/collection.json")
        config = CollectionConfig.from_json(text)
        if snapshot is None:
            snapshot = max(int(n.removesuffix(".json")) for n in files.names(f"{path}/snapshots") if n.removesuffix(".json").isdigit())
        folders = json.loads(files.read(f"{path}/snapshots/{snapshot}.json"))
        schema = config.schema()
        if folders:
            df = spark.read.schema(schema).parquet(*[f"{path}/{f}" for f in sorted(set(folders.values()))])
            df = with_metadata(df, config)
        else:
            df = spark.createDataFrame([], schema)
        return cls(spark, config, df, path.rstrip("/").rpartition("/")[2], path, snapshot)

    @classmethod
    def from_frame(cls, df: DataFrame, config: CollectionConfig, name: str = "collection") -> Collection:
        """A collection over any DataFrame with the columns that ``config`` describes."""
        return cls(df.sparkSession, config, with_metadata(df, config), name)

    # -- reading

    @property
    def df(self) -> DataFrame:
        """All points; Spark prunes columns and pushes filters and limits by itself."""
        return self._df

    @property
    def schema(self):
        return self._df.schema

    @property
    def table_type(self) -> str:
        """A collection is a base table: neither a view nor temporary."""
        return "BASE"

    def select(self, *columns: str) -> DataFrame:
        """A projection in the order asked for; no columns mean all."""
        return self._df.select(*columns) if columns else self._df

    def register(self, name: str | None = None) -> str:
        """A temporary view for SQL, named as wished."""
        view = name or self.name
        self._df.createOrReplaceTempView(view)
        return view

    def batches(self, max_rows: int = 10_000) -> Iterator[pa.RecordBatch]:
        """Arrow batches of at most ``max_rows``, pulled one partition at a time; an empty table gives one empty batch."""
        importable(self.spark)

        def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for at in range(0, b.num_rows, max_rows):
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, b.schema) as out:
                        out.write_batch(b.slice(at, max_rows))
                    yield pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["batch"])

        none = True
        for row in self._df.mapInArrow(packed, "batch binary").toLocalIterator():
            none = False
            yield pa.ipc.open_stream(row[0]).read_next_batch()
        if none:
            yield from self._df.limit(0).toArrow().to_batches() or [pa.RecordBatch.from_pylist([], self._df.limit(0).toArrow().schema)]

    def describe(self, limit: int | None = None, columns: list[str] | None = None) -> str:
        """One line on a scan: collection, vectors that it reads, limit."""
        from .config import payload_selector, vector_selector

        columns = columns or self._df.columns
        parts = [f"collection={self.name}", f"vectors={vector_selector(columns, self.config)}", f"payload={payload_selector(columns)}"]
        return "PointScan: " + ", ".join(parts + [f"limit={limit}"] * (limit is not None))

    def __repr__(self) -> str:
        return f"Collection(name={self.name!r}, path={self.path!r}, snapshot={self.snapshot}, columns={self._df.columns})"

    # -- writing

    def _bucket(self, buckets: int):
        return F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int")

    def upsert(self, points: DataFrame, retries: int = 0) -> Collection:
        """Insert points, replacing those with the same ids; returns the collection with its new snapshot.

        Null ids raise. Of points that repeat an id within ``points`` any one may stay. Only touched
        buckets are read and rewritten. Another writer's snapshot in between raises ``SnapshotConflict``;
        ``retries`` start over from the newest snapshot so many times before that.
        """
        new = self._checked(points)
        if self.path is None:
            kept = self._df.join(new.select("id"), "id", "left_anti").select(*new.columns)
            return Collection(self.spark, self.config, with_metadata(kept.unionByName(new), self.config), self.name)
        return self._retried(retries, lambda c: c._rewrite(new.select("id"), new))

    def delete(self, ids: DataFrame, retries: int = 0) -> Collection:
        """Remove the points whose ``id`` is in ``ids``."""
        if self.path is None:
            return Collection(self.spark, self.config, self._df.join(ids.select("id"), "id", "left_anti").select(*self._df.columns), self.name)
        return self._retried(retries, lambda c: c._rewrite(ids.select("id"), None))

    def overwrite(self, points: DataFrame) -> Collection:
        """All points replaced by the given ones; earlier snapshots keep theirs."""
        new = self._checked(points)
        if self.path is None:
            return Collection(self.spark, self.config, with_metadata(new, self.config), self.name)
        return self._publish([new], {}, self._buckets())

    def _checked(self, points: DataFrame) -> DataFrame:
        new = with_metadata(points, self.config)
        return new.withColumn("id", F.coalesce("id", F.raise_error(F.lit("a point has no id")).cast("string"))).dropDuplicates(["id"])

    def _retried(self, retries: int, write) -> Collection:
        at = self
        while True:
            try:
                return write(at)
            except SnapshotConflict:
                if not retries:
                    raise
                retries, at = retries - 1, Collection.open(self.spark, self.path)

    def _buckets(self) -> int:
        return json.loads(_Files(self.spark, self.path).read(f"{self.path}/collection.json"))["buckets"]

    def _rewrite(self, gone: DataFrame, new: DataFrame | None) -> Collection:
        buckets = self._buckets()
        folders = json.loads(_Files(self.spark, self.path).read(f"{self.path}/snapshots/{self.snapshot}.json"))
        touched = sorted(r.b for r in gone.select(self._bucket(buckets).alias("b")).distinct().collect())
        old = [folders[str(b)] for b in touched if str(b) in folders]
        parts = []
        if old:
            rows = with_metadata(self.spark.read.schema(self.config.schema()).parquet(*[f"{self.path}/{f}" for f in old]), self.config)
            parts.append(rows.join(gone, "id", "left_anti").select(*self.config.schema().names))
        if new is not None:
            parts.append(new)
        return self._publish(parts, {b: f for b, f in folders.items() if int(b) not in touched}, buckets)

    def _publish(self, parts: list[DataFrame], kept: dict[str, str], buckets: int) -> Collection:
        """Write ``parts`` into a folder of their own and publish them with the ``kept`` folders."""
        files, at = _Files(self.spark, self.path), self.snapshot + 1
        folder = f"data/{at}-{uuid.uuid4().hex}"
        try:
            for part in parts:
                out = part.withColumn("bucket", self._bucket(buckets)).hint("rebalance", "bucket")
                out.write.mode("append").partitionBy("bucket").parquet(f"{self.path}/{folder}")
            written = {n.partition("=")[2] for n in files.names(f"{self.path}/{folder}") if n.startswith("bucket=")}
            files.publish(f"{self.path}/snapshots/{at}.json", json.dumps(kept | {b: f"{folder}/bucket={b}" for b in written}))
        except Exception:
            files.delete(f"{self.path}/{folder}")
            raise
        return Collection.open(self.spark, self.path, at)
