"""Points in wire form to table columns, as column expressions.

Wire form of a vector: a struct of any of ``dense``, ``indices`` with ``values``, ``vectors`` (a list of
lists) and, in the older form, ``data`` with ``vectors_count`` and ``indices``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import MalformedVector
from .config import DEFAULT_VECTOR, CollectionConfig

#: Wire form of one vector.
WIRE = T.StructType(
    [
        T.StructField("dense", T.ArrayType(T.FloatType())),
        T.StructField("indices", T.ArrayType(T.LongType())),
        T.StructField("values", T.ArrayType(T.FloatType())),
        T.StructField("vectors", T.ArrayType(T.ArrayType(T.FloatType()))),
        T.StructField("data", T.ArrayType(T.FloatType())),
        T.StructField("vectors_count", T.LongType()),
    ]
)


def point_id(number: Column, uuid: Column, present: Column) -> Column:
    """Text of an id: a number in decimal, a UUID as it is, '' for an id without either; null if absent."""
    return F.when(present, F.coalesce(number.cast("string"), uuid, F.lit("")))


def payload_json(payload: Column) -> Column:
    """JSON of a payload map of JSON values (text); an empty or missing map is null."""
    quoted = lambda k: F.concat(F.lit('"'), F.regexp_replace(F.regexp_replace(k, r"\\", r"\\\\"), '"', r'\\"'), F.lit('":'))
    pairs = F.transform(F.array_sort(F.map_entries(payload)), lambda e: F.concat(quoted(e.key), F.coalesce(e.value, F.lit("null"))))
    return F.when(payload.isNotNull() & (F.size(payload) > 0), F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}")))


def to_multi_vector(data: Column, count: Column | int) -> Column:
    """Flat data as ``count`` vectors of equal length; raises if it can't be divided."""
    n = (F.lit(count) if isinstance(count, int) else count).cast("int")
    size = F.size(data)
    told = F.concat(F.lit("Malformed multi vector: data length "), size.cast("string"), F.lit(" is not divisible by vectors count "), n.cast("string"))
    width = F.expr("0") + F.when((n > 0) & (size > 0) & (F.try_mod(size, n) == 0), F.try_divide(size, n).cast("int"))
    good = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.slice(data, i * width + 1, width))
    return F.when(data.isNull() | n.isNull(), None).when(width.isNull(), F.raise_error(told)).otherwise(good)


def reshape(data: list[float], count: int) -> list[list[float]]:
    """The same for a local list."""
    if count <= 0 or not data or len(data) % count:
        raise MalformedVector(f"Malformed multi vector: data length {len(data)} is not divisible by vectors count {count}")
    width = len(data) // count
    return [data[i : i + width] for i in range(0, len(data), width)]


def normalised(wire: Column) -> Column:
    """A wire vector as struct ``kind, dense, indices, values, multi``; null if there is none.

    Newer fields come first. Of the older ones: a count that divides the data means a list of vectors,
    else indices mean a sparse vector, else empty data mean no vector, else it is dense.
    """
    floats, longs, lists = "array<float>", "array<bigint>", "array<array<float>>"

    def made(kind: str, dense=None, indices=None, values=None, multi=None) -> Column:
        col = lambda c, t: (F.lit(None) if c is None else c).cast(t)
        return F.struct(F.lit(kind).alias("kind"), col(dense, floats).alias("dense"), col(indices, longs).alias("indices"), col(values, floats).alias("values"), col(multi, lists).alias("multi"))

    data, count = wire["data"], wire["vectors_count"]
    divides = count.isNotNull() & (count > 0) & (F.size(data) > 0) & (F.try_mod(F.size(data).cast("bigint"), count) == 0)
    return (
        F.when(wire["dense"].isNotNull(), made("dense", dense=wire["dense"]))
        .when(wire["vectors"].isNotNull(), made("multi", multi=wire["vectors"]))
        .when(wire["values"].isNotNull(), made("sparse", indices=wire["indices"], values=wire["values"]))
        .when(divides, made("multi", multi=to_multi_vector(F.when(divides, data), F.when(divides, count))))
        .when(data.isNotNull() & wire["indices"].isNotNull(), made("sparse", indices=wire["indices"], values=data))
        .when(data.isNull() | (F.size(data) == 0), None)
        .otherwise(made("dense", dense=data))
    )


def wire_to_columns(points: DataFrame, config: CollectionConfig) -> DataFrame:
    """Rows ``id string, payload string, vectors map<string, wire>`` to the table's columns.

    An unnamed vector has the key 'vector'. A missing vector, or one of another kind than its column,
    is null; an empty dense vector of the newer form stays an empty list.
    """
    out = points.select("id", "payload", "vectors")
    cols = [F.col("id"), F.col("payload")]
    norm = {n: normalised(F.try_element_at("vectors", F.lit(n))) for n in [*config.dense, *config.sparse]}
    for name, p in config.dense.items():
        v = norm[name]
        cols.append(F.when(v["kind"] == p.kind, v["multi"] if p.multivector else v["dense"]).alias(name))
    for name in config.sparse:
        v = norm[name]
        cols += [F.when(v["kind"] == "sparse", v[part]).alias(f"{name}_{part}") for part in ("indices", "values")]
    return with_metadata(out.select(*cols), config)


def with_metadata(df: DataFrame, config: CollectionConfig) -> DataFrame:
    """The table's columns in order and type, vector metadata attached; missing vectors become null."""
    have = set(df.columns)
    return df.select(*[(F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name, metadata=f.metadata) for f in config.schema().fields])


def points(spark: SparkSession, rows: Iterable[Mapping], config: CollectionConfig) -> DataFrame:
    """A small local batch of points ``{'id', 'payload', vector name: value}`` as a table.

    Ids are numbers or text, payloads mappings or None; a sparse value is a pair (indices, values).
    A null id raises.
    """
    import json

    out = []
    for row in rows:
        if row.get("id") is None:
            raise MalformedVector("a point has no id")
        payload = row.get("payload")
        made = [str(row["id"]), json.dumps(payload, separators=(",", ":"), ensure_ascii=False) if payload else None]
        for name, p in config.dense.items():
            v = row.get(name)
            made.append(None if v is None else [list(map(float, x)) for x in v] if p.multivector else list(map(float, v)))
        for name in config.sparse:
            v = row.get(name)
            made += [None, None] if v is None else [list(map(int, v[0])), list(map(float, v[1]))]
        out.append(tuple(made))
    return with_metadata(spark.createDataFrame(out, config.schema()), config)


__all__ = ["DEFAULT_VECTOR", "WIRE", "normalised", "payload_json", "point_id", "points", "reshape", "to_multi_vector", "wire_to_columns", "with_metadata"]
