"""Similarity of vectors as column expressions, summed in double precision.

Null vectors, and dense vectors of unequal or no length, give null, so points without a vector never fill a
top-k (scores are ordered with nulls last).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ..errors import DimensionMismatch
from ..sources.config import COSINE, DOT, EUCLID, MANHATTAN

Vector = str | Column | Sequence[float]


def vector(v: Vector) -> Column:
    """A column by name, a column, or a literal of a local list."""
    if isinstance(v, str):
        return F.col(v)
    if isinstance(v, Column):
        return v
    return _literal(v)


def _literal(v: Sequence[float]) -> Column:
    """One parsed literal; a call to the JVM for each number would cost more than a small search."""
    one = lambda x: f"{x!r}D" if math.isfinite(x) else f"CAST('{x}' AS DOUBLE)"
    return F.expr(f"CAST(array({', '.join(one(float(x)) for x in v)}) AS ARRAY<DOUBLE>)")


def checked(v: Vector, size: int | None) -> Vector:
    """Raise if a local vector, other than an empty one, differs from a known size."""
    if size is not None and not isinstance(v, (str, Column)) and len(v) not in (0, size):
        raise DimensionMismatch(f"the query has {len(v)} numbers, the column {size}")
    return v


def _summed(a: Vector, b: Vector, term) -> Column:
    a, b = vector(a), vector(b)
    pairs = F.zip_with(a, b, lambda x, y: term(x.cast("double"), y.cast("double")))
    return F.when((F.size(a) > 0) & (F.size(a) == F.size(b)), F.aggregate(pairs, F.lit(0.0), lambda s, x: s + x))


def dot(a: Vector, b: Vector) -> Column:
    return _summed(a, b, lambda x, y: x * y)


def norm(a: Vector) -> Column:
    if not isinstance(a, (str, Column)):  # Spark doesn't fold higher-order functions of literals
        return F.lit(math.sqrt(sum(float(x) ** 2 for x in a)))
    v = vector(a)
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def cosine(a: Vector, b: Vector) -> Column:
    """Cosine similarity; null where a vector is all zero."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def euclid(a: Vector, b: Vector) -> Column:
    return F.sqrt(_summed(a, b, lambda x, y: (x - y) * (x - y)))


def manhattan(a: Vector, b: Vector) -> Column:
    return _summed(a, b, lambda x, y: F.abs(x - y))


def similarity(a: Vector, b: Vector, metric: str) -> Column:
    """Score under a metric, higher is nearer: cosine and dot as they are, distances negated."""
    return {COSINE: lambda: cosine(a, b), DOT: lambda: dot(a, b), EUCLID: lambda: -euclid(a, b), MANHATTAN: lambda: -manhattan(a, b)}[metric]()


def distance(a: Vector, b: Vector, metric: str) -> Column:
    """Distance under a metric, lower is nearer: 1 - cosine, negated dot product, or the distance itself."""
    return {COSINE: lambda: 1 - cosine(a, b), DOT: lambda: -dot(a, b), EUCLID: lambda: euclid(a, b), MANHATTAN: lambda: manhattan(a, b)}[metric]()


def within(a: Vector, b: Vector, radius: float | Column, metric: str) -> Column:
    return distance(a, b, metric) <= radius


def sparse_dot(indices: str | Column, values: str | Column, query_indices: Sequence[int] | Column, query_values: Sequence[float] | Column) -> Column:
    """Sum over the indices that both have; null where the point has no such vector or the query repeats an index."""
    i, v = vector(indices), vector(values)
    qi = query_indices if isinstance(query_indices, Column) else F.array(*[F.lit(int(x)) for x in query_indices]).cast("array<bigint>")
    qv = vector(query_values)
    query = F.map_from_arrays(qi, qv.cast("array<double>"))
    terms = F.zip_with(i, v, lambda k, x: x.cast("double") * F.coalesce(F.try_element_at(query, k), F.lit(0.0)))
    return F.aggregate(terms, F.lit(0.0), lambda s, x: s + x)


def max_sim(query: Sequence[Sequence[float]] | Column, document: str | Column, metric: str = DOT) -> Column:
    """Late interaction: for each query vector its best match in the document, summed."""
    q = query if isinstance(query, Column) else F.array(*[vector(v) for v in query])
    d = vector(document)
    best = F.transform(q, lambda a: F.array_max(F.transform(d, lambda b: similarity(a, b, metric))))
    return F.when(F.size(d) > 0, F.aggregate(best, F.lit(0.0), lambda s, x: s + x))


def mean_vector(vectors: str | Column) -> Column:
    """Mean of a list of vectors of equal length, by position."""
    vs = vector(vectors)
    first = F.transform(F.try_element_at(vs, F.lit(1)), lambda _: F.lit(0.0))
    total = F.aggregate(vs, first, lambda s, v: F.zip_with(s, v, lambda a, b: a + b.cast("double")))
    return F.transform(total, lambda x: F.try_divide(x, F.size(vs)))


def _pairs(term: str, a: str, b: str) -> str:
    return f"aggregate(zip_with({a}, {b}, (x, y) -> {term}), 0D, (s, x) -> s + x)"


def _same_length(body: str, a: str, b: str) -> str:
    return f"CASE WHEN size({a}) > 0 AND size({a}) = size({b}) THEN {body} END"


def _length(a: str) -> str:
    return f"sqrt(aggregate({a}, 0D, (s, x) -> s + x * x))"


_D, _A, _AA, _L = "DOUBLE", "ARRAY<DOUBLE>", "ARRAY<ARRAY<DOUBLE>>", "ARRAY<BIGINT>"

#: SQL forms: types of the arguments, type of the result, text for given arguments.
SQL_FORMS = {
    "pf_dot": ((_A, _A), _D, lambda a, b: _same_length(_pairs("x * y", a, b), a, b)),
    "pf_cosine": ((_A, _A), _D, lambda a, b: f"try_divide({_same_length(_pairs('x * y', a, b), a, b)}, {_length(a)} * {_length(b)})"),
    "pf_euclid": ((_A, _A), _D, lambda a, b: _same_length(f"sqrt({_pairs('(x - y) * (x - y)', a, b)})", a, b)),
    "pf_manhattan": ((_A, _A), _D, lambda a, b: _same_length(_pairs("abs(x - y)", a, b), a, b)),
    "pf_sparse_dot": (
        (_L, _A, _L, _A), _D,
        lambda i, v, qi, qv: f"aggregate(zip_with({i}, {v}, (k, x) -> x * coalesce(try_element_at(map_from_arrays({qi}, {qv}), k), 0D)), 0D, (s, x) -> s + x)",
    ),
    "pf_max_sim": (
        (_AA, _AA), _D,
        lambda q, d: f"CASE WHEN size({d}) > 0 THEN aggregate(transform({q}, u -> array_max(transform({d}, w -> {_pairs('x * y', 'u', 'w')}))), 0D, (s, x) -> s + x) END",
    ),
    "pf_mean": (
        (_AA,), _A,
        lambda vs: f"transform(aggregate({vs}, transform(try_element_at({vs}, 1), x -> 0D), (s, v) -> zip_with(s, v, (x, y) -> x + y)), x -> try_divide(x, size({vs})))",
    ),
    "pf_recommend": ((_A, _A), _A, lambda p, n: f"CASE WHEN {n} IS NULL OR size({n}) = 0 THEN {p} ELSE zip_with({p}, {n}, (x, y) -> 2 * x - y) END"),
}


def inlined(name: str, *args: str) -> str:
    """A form's text with its arguments cast and bound once: each becomes a lambda variable."""
    types, _, body = SQL_FORMS[name]
    names = [f"arg{i}_{name}" for i in range(len(args))]
    text = body(*names)
    for n, arg, kind in zip(names, args, types, strict=True):
        text = f"element_at(transform(array(CAST({arg} AS {kind})), {n} -> {text}), 1)"
    return text


def register_vector_functions(spark: SparkSession) -> list[str]:
    """The SQL forms as temporary functions, for hand-written SQL. Spark takes them in projections, filters and
    aggregates, not in ORDER BY: sort by an alias there."""
    for name, (types, result, body) in SQL_FORMS.items():
        names = [f"arg{i}" for i in range(len(types))]
        args = ", ".join(f"{n} {t}" for n, t in zip(names, types, strict=True))
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {result} RETURN {body(*names)}")
    return sorted(SQL_FORMS)
