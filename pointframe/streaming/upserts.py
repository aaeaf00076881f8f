"""Points from a stream into a stored collection."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..sources.collection import Collection


def upsert_stream(points: DataFrame, collection: Collection, checkpoint: str, available_now: bool = True):
    """Start a query that upserts every micro-batch of a streaming ``points`` frame; returns the query.

    Within a batch the collection's upsert keeps one point of an id, and later batches replace earlier
    ones, so replaying a batch after a failure leaves the same table.
    """
    spark, path = collection.spark, collection.path
    if path is None:
        raise ValueError("a stream needs a stored collection")

    def batch(df: DataFrame, _: int) -> None:
        Collection.open(spark, path).upsert(df, retries=3)

    writer = points.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if available_now else writer).start()
