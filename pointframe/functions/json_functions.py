"""JSON access over text columns, as column functions and as SQL functions.

Path steps are keys (text) or array positions (numbers). Malformed JSON and missing paths give null.
Typed getters don't convert: a number read as text is null.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

_NUMBERS = ("BIGINT", "DOUBLE", "FLOAT")


def _col(json: str | Column) -> Column:
    return F.col(json) if isinstance(json, str) else json


def path_of(*steps: str | int) -> str:
    """JSON path of the steps."""
    return "$" + "".join(f"[{s}]" if isinstance(s, int) else "['" + s.replace("\\", "\\\\").replace("'", "\\'") + "']" for s in steps)


def _at(json: str | Column, steps: tuple[str | int, ...]) -> Column:
    v = F.try_parse_json(_col(json))
    return F.try_variant_get(v, path_of(*steps), "variant") if steps else v


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def json_get(json: str | Column, *steps: str | int) -> Column:
    """The value at a path as VARIANT."""
    return _at(json, steps)


def json_as_text(json: str | Column, *steps: str | int) -> Column:
    """The value at a path as text; objects and arrays as JSON, JSON null as null."""
    return F.get_json_object(_col(json), path_of(*steps))


def json_get_str(json: str | Column, *steps: str | int) -> Column:
    v = _at(json, steps)
    return F.when(_kind(v) == "STRING", F.try_variant_get(v, "$", "string"))


def json_get_int(json: str | Column, *steps: str | int) -> Column:
    v = _at(json, steps)
    return F.when(_kind(v) == "BIGINT", F.try_variant_get(v, "$", "bigint"))


def json_get_float(json: str | Column, *steps: str | int) -> Column:
    v = _at(json, steps)
    return F.when(_kind(v).isin(*_NUMBERS) | _kind(v).startswith("DECIMAL"), F.try_variant_get(v, "$", "double"))


def json_get_bool(json: str | Column, *steps: str | int) -> Column:
    v = _at(json, steps)
    return F.when(_kind(v) == "BOOLEAN", F.try_variant_get(v, "$", "boolean"))


def json_get_json(json: str | Column, *steps: str | int) -> Column:
    """The value at a path as JSON text; strings keep their quotes."""
    return F.to_json(_at(json, steps))


def json_get_array(json: str | Column, *steps: str | int) -> Column:
    """The array at a path as array of VARIANT."""
    return F.try_variant_get(_at(json, steps), "$", "array<variant>")


def json_contains(json: str | Column, *steps: str | int) -> Column:
    """Whether the path exists; a key whose value is JSON null exists. Null for a null input."""
    *above, last = steps
    parent = F.get_json_object(_col(json), path_of(*above)) if above else _col(json)
    if isinstance(last, int):
        there = F.json_array_length(parent) > last
    else:
        there = F.array_contains(F.json_object_keys(parent), last)
    return F.when(_col(json).isNotNull(), F.coalesce(there, F.lit(False)))


def json_length(json: str | Column, *steps: str | int) -> Column:
    """Number of keys of an object or of elements of an array; null for others."""
    j = F.get_json_object(_col(json), path_of(*steps)) if steps else _col(json)
    return F.coalesce(F.json_array_length(j), F.size(F.json_object_keys(j)))


def json_object_keys(json: str | Column, *steps: str | int) -> Column:
    j = F.get_json_object(_col(json), path_of(*steps)) if steps else _col(json)
    return F.json_object_keys(j)


def json_from_scalar(value: Column) -> Column:
    """A number, text or truth value as JSON text."""
    return F.to_json(value.cast("variant"))


def json_contains_all(json: str | Column, wanted: str | Column) -> Column:
    """Whether a JSON array holds every element of another JSON array."""
    right = F.from_json(F.lit(wanted) if isinstance(wanted, str) else wanted, "array<string>")
    return F.size(F.array_except(right, F.from_json(_col(json), "array<string>"))) == 0


# name, parameters, result, body; ``k2`` and ``k3`` are further keys
_STEPS = "k1 STRING, k2 STRING DEFAULT NULL, k3 STRING DEFAULT NULL"
_PATH = "concat('$[''', k1, ''']', coalesce(concat('[''', k2, ''']'), ''), coalesce(concat('[''', k3, ''']'), ''))"


def register_json_functions(spark: SparkSession) -> list[str]:
    """Register the JSON functions for SQL and return their names. Keys are text; up to three steps."""
    made = {
        "json_as_text": (f"j STRING, {_STEPS}", "STRING", f"get_json_object(j, {_PATH})"),
        "json_object_keys_of": ("j STRING", "ARRAY<STRING>", "json_object_keys(j)"),
        "json_length": ("j STRING", "INT", "coalesce(json_array_length(j), size(json_object_keys(j)))"),
        "json_contains": ("j STRING, k STRING", "BOOLEAN", "CASE WHEN j IS NOT NULL THEN coalesce(array_contains(json_object_keys(j), k), false) END"),
        "json_contains_all": ("j STRING, wanted STRING", "BOOLEAN", "size(array_except(from_json(wanted, 'array<string>'), from_json(j, 'array<string>'))) = 0"),
        "json_from_scalar": ("x STRING", "STRING", "to_json(cast(x AS VARIANT))"),
    }
    # a value's JSON form, quotes included, by way of the variant of the whole document
    whole = f"to_json(try_variant_get(try_parse_json(j), {_PATH}, 'variant'))"
    kind = f"schema_of_variant(try_variant_get(try_parse_json(j), {_PATH}, 'variant'))"
    got = lambda t: f"try_variant_get(try_parse_json(j), {_PATH}, '{t}')"
    made |= {
        "json_get_json": (f"j STRING, {_STEPS}", "STRING", whole),
        "json_get_str": (f"j STRING, {_STEPS}", "STRING", f"CASE WHEN {kind} = 'STRING' THEN {got('string')} END"),
        "json_get_int": (f"j STRING, {_STEPS}", "BIGINT", f"CASE WHEN {kind} = 'BIGINT' THEN {got('bigint')} END"),
        "json_get_float": (f"j STRING, {_STEPS}", "DOUBLE", f"CASE WHEN {kind} IN ('BIGINT', 'DOUBLE', 'FLOAT') OR {kind} LIKE 'DECIMAL%' THEN {got('double')} END"),
        "json_get_bool": (f"j STRING, {_STEPS}", "BOOLEAN", f"CASE WHEN {kind} = 'BOOLEAN' THEN {got('boolean')} END"),
        "json_get": (f"j STRING, {_STEPS}", "VARIANT", got("variant")),
        "json_get_array": (f"j STRING, {_STEPS}", "ARRAY<VARIANT>", got("array<variant>")),
    }
    for name, (args, result, body) in made.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {result} RETURN {body}")
    return sorted(made)
