"""Score shaping: decay, distance on the globe, text match, fields, random order."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from .json_functions import json_contains

EARTH_RADIUS_M = 6_371_000.0


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def gauss_decay(x: str | Column, scale: float, midpoint: float = 0.5, target: float = 0.0) -> Column:
    """exp(ln(midpoint) * ((x - target) / scale)^2): 1 at the target, ``midpoint`` at a distance of ``scale``."""
    return F.exp(F.lit(math.log(midpoint)) * F.pow((_col(x) - target) / scale, 2))


def exp_decay(x: str | Column, scale: float, midpoint: float = 0.5, target: float = 0.0) -> Column:
    return F.exp(F.lit(math.log(midpoint)) * F.abs(_col(x) - target) / scale)


def linear_decay(x: str | Column, scale: float, midpoint: float = 0.5, target: float = 0.0) -> Column:
    return F.greatest(F.lit(0.0), 1 - (1 - midpoint) * F.abs(_col(x) - target) / scale)


def geo_distance(lat1: str | Column, lon1: str | Column, lat2: float | Column, lon2: float | Column) -> Column:
    """Great-circle distance in metres by the haversine formula."""
    a, b = (F.radians(_col(x)) for x in (lat1, lon1))
    c, d = (F.radians(x if isinstance(x, Column) else F.lit(float(x))) for x in (lat2, lon2))
    h = F.pow(F.sin((c - a) / 2), 2) + F.cos(a) * F.cos(c) * F.pow(F.sin((d - b) / 2), 2)
    return 2 * EARTH_RADIUS_M * F.asin(F.least(F.lit(1.0), F.sqrt(h)))


def tokens(text: str | Column) -> Column:
    """Distinct words (letters, digits, underscore; of any script), lower-cased."""
    return F.array_distinct(F.regexp_extract_all(F.lower(_col(text)), F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1)))


def match_text(text: str | Column, query: str | Column) -> Column:
    """Share of the query's distinct words that the text holds; null for a query without words.

    Words of a local query are looked for one by one, first as plain substrings, so texts aren't split.
    """
    if isinstance(query, Column):
        q = tokens(query)
        return F.try_divide(F.size(F.array_intersect(tokens(text), q)).cast("double"), F.size(q).cast("double"))
    words = list(dict.fromkeys(re.findall(r"\w+", query.lower())))
    low = F.lower(_col(text))
    held = [(low.contains(w) & low.rlike(rf"(?<![\p{{L}}\p{{N}}_]){w}(?![\p{{L}}\p{{N}}_])")).cast("double") for w in words]
    return sum(held, F.lit(0.0)) / len(words) if words else F.lit(None).cast("double")


def has_field(payload: str | Column, key: str) -> Column:
    """Whether a payload has a key; false for no payload."""
    return F.coalesce(json_contains(payload, key), F.lit(False))


def register_scoring_functions(spark: SparkSession) -> list[str]:
    """SQL forms: ``v_gauss_decay``, ``v_geo_distance``, ``match_text``, ``has_field`` and ``v_random``."""
    words = lambda t: f"array_distinct(regexp_extract_all(lower({t}), '([\\\\p{{L}}\\\\p{{N}}_]+)', 1))"
    made = {
        "v_gauss_decay": ("x DOUBLE, scale DOUBLE", "DOUBLE", "exp(ln(0.5D) * power(x / scale, 2D))"),
        "v_geo_distance": (
            "place STRING, target STRUCT<lat: DOUBLE, lon: DOUBLE>", "DOUBLE",
            f"2 * {EARTH_RADIUS_M}D * asin(least(1D, sqrt(power(sin((radians(target.lat) - radians(cast(get_json_object(place, '$.lat') AS DOUBLE))) / 2), 2D)"
            " + cos(radians(cast(get_json_object(place, '$.lat') AS DOUBLE))) * cos(radians(target.lat))"
            " * power(sin((radians(target.lon) - radians(cast(get_json_object(place, '$.lon') AS DOUBLE))) / 2), 2D))))",
        ),
        "match_text": ("t STRING, q STRING", "DOUBLE", f"try_divide(cast(size(array_intersect({words('t')}, {words('q')})) AS DOUBLE), cast(size({words('q')}) AS DOUBLE))"),
        "has_field": ("j STRING, k STRING", "BOOLEAN", "coalesce(array_contains(json_object_keys(j), k), false)"),
    }
    for name, (args, result, body) in made.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {result} RETURN {body}")
    return sorted(made)
