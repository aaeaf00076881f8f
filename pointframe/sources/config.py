"""Description of a collection and the table schema that follows from it.

A vector's kind, size and metric travel in the column's metadata, so nothing is ever guessed from a
column's name, and Parquet keeps them.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import types as T

from ..errors import CollectionParamsMissing, InvalidSchema

COSINE, DOT, EUCLID, MANHATTAN = "cosine", "dot", "euclid", "manhattan"
METRICS = (COSINE, DOT, EUCLID, MANHATTAN)
DEFAULT_VECTOR = "vector"


@dataclass(frozen=True)
class VectorParams:
    """A dense vector, or with ``multivector`` a list of them compared by maximal similarity."""

    size: int
    distance: str = COSINE
    datatype: str = "float32"
    multivector: bool = False

    def __post_init__(self):
        if self.size <= 0:
            raise InvalidSchema(f"vector size must be positive, not {self.size}")
        if self.distance not in METRICS:
            raise InvalidSchema(f"unknown distance {self.distance!r}; known: {', '.join(METRICS)}")

    @property
    def kind(self) -> str:
        return "multi" if self.multivector else "dense"


@dataclass(frozen=True)
class CollectionConfig:
    """One unnamed vector or any number of named ones, and named sparse vectors.

    ``vectors`` is a single ``VectorParams`` (column ``vector``), a mapping by name, or None; with None a
    table has ids, payloads and sparse vectors only.
    """

    vectors: VectorParams | dict[str, VectorParams] | None = None
    sparse: tuple[str, ...] = field(default=())

    def __post_init__(self):
        object.__setattr__(self, "sparse", tuple(self.sparse))
        names = [f.name.lower() for f in self._fields()]
        twice = sorted({n for n in names if names.count(n) > 1})
        if twice:
            raise InvalidSchema(f"columns named twice: {', '.join(twice)}")

    @property
    def dense(self) -> dict[str, VectorParams]:
        """Dense and multi vectors by column name, in the order of declaration."""
        if self.vectors is None:
            return {}
        return {DEFAULT_VECTOR: self.vectors} if isinstance(self.vectors, VectorParams) else dict(self.vectors)

    def _fields(self) -> list[T.StructField]:
        fields = [T.StructField("id", T.StringType(), False), T.StructField("payload", T.StringType(), True)]
        for name, p in self.dense.items():
            of = T.ArrayType(T.FloatType())
            about = {"kind": p.kind, "size": p.size, "distance": p.distance}
            fields.append(T.StructField(name, T.ArrayType(of) if p.multivector else of, True, about))
        for name in self.sparse:
            fields.append(T.StructField(f"{name}_indices", T.ArrayType(T.LongType()), True, {"kind": "sparse_indices", "vector": name}))
            fields.append(T.StructField(f"{name}_values", T.ArrayType(T.FloatType()), True, {"kind": "sparse_values", "vector": name}))
        return fields

    def schema(self) -> T.StructType:
        """``id``, ``payload``, then dense and multi vectors, then pairs of sparse columns, as declared."""
        return T.StructType(self._fields())

    def resolve(self, name: str | None = None) -> tuple[str, VectorParams]:
        """The named vector; without a name, the default or the only one."""
        dense = self.dense
        if name is None:
            name = DEFAULT_VECTOR if DEFAULT_VECTOR in dense else next(iter(dense)) if len(dense) == 1 else None
            if name is None:
                raise InvalidSchema(f"name one of the vectors {', '.join(dense) or '(none)'}")
        if name not in dense:
            raise InvalidSchema(f"no dense vector {name!r}; there are {', '.join(dense) or 'none'}")
        return name, dense[name]

    def resolve_sparse(self, name: str | None = None) -> str:
        """The named sparse vector; without a name, the only one."""
        if name is None and len(self.sparse) == 1:
            return self.sparse[0]
        if name not in self.sparse:
            raise InvalidSchema(f"no sparse vector {name!r}; there are {', '.join(self.sparse) or 'none'}")
        return name

    def to_json(self) -> str:
        vectors = asdict(self.vectors) if isinstance(self.vectors, VectorParams) else self.vectors and {n: asdict(p) for n, p in self.vectors.items()}
        return json.dumps({"params": {"vectors": vectors, "unnamed": isinstance(self.vectors, VectorParams), "sparse": list(self.sparse)}}, indent=1)

    @classmethod
    def from_json(cls, text: str) -> CollectionConfig:
        params = json.loads(text).get("params")
        if params is None:
            raise CollectionParamsMissing("the description has no params")
        vectors = params.get("vectors")
        if vectors is not None:
            vectors = VectorParams(**vectors) if params.get("unnamed") else {n: VectorParams(**p) for n, p in vectors.items()}
        return cls(vectors, tuple(params.get("sparse", ())))

    @classmethod
    def from_schema(cls, schema: T.StructType) -> CollectionConfig:
        """The description that a schema's metadata keeps."""
        dense = {f.name: VectorParams(f.metadata["size"], f.metadata["distance"], multivector=f.metadata["kind"] == "multi") for f in schema.fields if f.metadata.get("kind") in ("dense", "multi")}
        sparse = tuple(f.metadata["vector"] for f in schema.fields if f.metadata.get("kind") == "sparse_indices")
        return cls(dense[DEFAULT_VECTOR] if list(dense) == [DEFAULT_VECTOR] else dense or None, sparse)


def vector_selector(columns: list[str], config: CollectionConfig) -> str | list[str]:
    """Which vectors a projection reads: 'none', 'all' (the unnamed one) or their names, in table order.

    Spark prunes columns by itself; this states for callers what the projection amounts to.
    """
    wanted = set(columns)
    names = [n for n in config.dense if n in wanted]
    names += [s for s in config.sparse if {f"{s}_indices", f"{s}_values"} & wanted]
    if not names:
        return "none"
    return "all" if isinstance(config.vectors, VectorParams) and DEFAULT_VECTOR in names else names


def payload_selector(columns: list[str]) -> bool:
    """Whether a projection reads payloads."""
    return "payload" in columns
