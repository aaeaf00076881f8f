"""Driver queries: one for each operator, with the same question in DuckDB SQL."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import json_functions as J
from ..functions import scoring as S
from ..functions import vectors as V
from ..operators import fusion, recommend, search
from ..sources.collection import Collection
from ..sources.config import CollectionConfig, VectorParams
from ..sources.ingest import to_multi_vector
from . import dialect

QUERIES: dict = {}
ORACLE: dict[str, str] = {}

SIZE = 64
#: the points of the oracle: id, payload, v (in double precision), vec_id, label
_P = """WITH p AS (SELECT CAST(vec_id AS VARCHAR) AS id, '{"label":' || CAST(label AS VARCHAR) || '}' AS payload, CAST(embedding AS DOUBLE[]) AS v, vec_id, label FROM embeddings)"""


def query(sql: str | None):
    """Register a query under its function's name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return add


def _read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


def points(spark: SparkSession, sf: str, metric: str = "cosine") -> Collection:
    """``embeddings`` as a collection with one unnamed vector."""
    df = _read(spark, sf, "embeddings").select(F.col("vec_id").cast("string").alias("id"), F.to_json(F.struct("label")).alias("payload"), F.col("embedding").alias("vector"))
    return Collection.from_frame(df, CollectionConfig(VectorParams(SIZE, metric)), "points")


def mixed(spark: SparkSession, sf: str) -> Collection:
    """Named vectors of several kinds, each missing from some points."""
    e = F.col("embedding")
    df = _read(spark, sf, "embeddings").select(
        F.col("vec_id").cast("string").alias("id"), F.to_json(F.struct("label")).alias("payload"),
        F.when(F.col("vec_id") % 3 != 0, F.slice(e, 1, 32)).alias("text"), F.when(F.col("vec_id") % 3 != 1, F.slice(e, 33, 32)).alias("image"),
        F.when(F.col("vec_id") % 5 != 0, to_multi_vector(e, 4)).alias("parts"),
        F.transform(F.filter(F.transform(e, lambda x, i: F.struct(i.cast("long").alias("i"), x.alias("x"))), lambda s: F.abs(s.x) > 0.1), lambda s: s.i).alias("words_indices"),
        F.filter(e, lambda x: F.abs(x) > 0.1).alias("words_values"),
    )
    config = CollectionConfig({"text": VectorParams(32), "image": VectorParams(32, "dot"), "parts": VectorParams(16, "dot", multivector=True)}, ("words",))
    return Collection.from_frame(df, config, "mixed")


_M = """WITH m AS (SELECT CAST(vec_id AS VARCHAR) AS id, vec_id, label, CAST(embedding AS DOUBLE[]) AS v,
    CASE WHEN vec_id % 3 <> 0 THEN CAST(embedding AS DOUBLE[])[1:32] END AS text, CASE WHEN vec_id % 3 <> 1 THEN CAST(embedding AS DOUBLE[])[33:64] END AS image,
    list_filter(range(64), lambda i: abs(embedding[i + 1]) > CAST(0.1 AS DOUBLE)) AS words_indices, list_filter(CAST(embedding AS DOUBLE[]), lambda x: abs(x) > CAST(0.1 AS DOUBLE)) AS words_values FROM embeddings)"""


def _vector(spark: SparkSession, sf: str, vec_id: int) -> list[float]:
    return [float(x) for x in _read(spark, sf, "embeddings").where(F.col("vec_id") == vec_id).first()["embedding"]]


def _r(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names or ("score",)})


# -- scans, projections, filters, limits


@query(_P + " SELECT id, payload, len(v) AS dims, round(list_sum(v), 6) AS total FROM p")
def scan_all(spark, sf):
    total = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double"))
    return points(spark, sf).select().select("id", "payload", F.size("vector").alias("dims"), F.round(total, 6).alias("total"))


@query(_P + " SELECT id, payload FROM p")
def project_metadata(spark, sf):
    return points(spark, sf).select("id", "payload")


@query(_P + " SELECT payload, len(v) AS dims, id FROM p")
def project_reordered(spark, sf):
    return points(spark, sf).select("payload", "vector", "id").select("payload", F.size("vector").alias("dims"), "id")


@query(_P + " SELECT id FROM p ORDER BY id LIMIT 25")
def limit_ordered(spark, sf):
    return points(spark, sf).select("id").orderBy("id").limit(25)


@query(_P + " SELECT id FROM p ORDER BY id LIMIT 10 OFFSET 15")
def offset_page(spark, sf):
    return points(spark, sf).select("id").orderBy("id").offset(15).limit(10)


@query(_P + " SELECT id, payload FROM p WHERE id IN ('1', '10', '100', '250')")
def filter_id_in(spark, sf):
    return points(spark, sf).select("id", "payload").where(F.col("id").isin("1", "10", "100", "250"))


@query(_P + " SELECT id, label FROM p WHERE label > 6")
def filter_payload(spark, sf):
    return points(spark, sf).df.select("id", J.json_get_int("payload", "label").cast("int").alias("label")).where("label > 6")


@query("SELECT CAST(event_id AS VARCHAR) AS id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE CAST(json_extract_string(props, '$.k') AS BIGINT) > 50")
def filter_payload_events(spark, sf):
    e = _read(spark, sf, "events").select(F.col("event_id").cast("string").alias("id"), J.json_get_int("props", "k").alias("k"))
    return e.where("k > 50")


@query(_M + " SELECT id, text IS NULL AS no_text, image IS NULL AS no_image, vec_id % 5 = 0 AS no_parts FROM m")
def hetero_nulls(spark, sf):
    return mixed(spark, sf).df.select("id", F.isnull("text").alias("no_text"), F.isnull("image").alias("no_image"), F.isnull("parts").alias("no_parts"))


@query(_M + " SELECT id, len(words_indices) AS n, list_sum(words_indices)::BIGINT AS positions, round(list_sum(words_values), 6) AS total FROM m")
def sparse_project(spark, sf):
    d = mixed(spark, sf).df.select("id", "words_indices", "words_values")
    return d.select("id", F.size("words_indices").alias("n"), F.aggregate("words_indices", F.lit(0).cast("long"), lambda s, x: s + x).alias("positions"), F.round(F.aggregate("words_values", F.lit(0.0), lambda s, x: s + x.cast("double")), 6).alias("total"))


@query("SELECT count(*) AS n FROM embeddings")
def count_star(spark, sf):
    return points(spark, sf).df.agg(F.count("*").alias("n"))


# -- similarity


@query(_P + " SELECT id, round(list_cosine_similarity(v, (SELECT v FROM p WHERE vec_id = 7)), 6) AS score FROM p ORDER BY list_cosine_similarity(v, (SELECT v FROM p WHERE vec_id = 7)) DESC, id LIMIT 10")
def search_cosine(spark, sf):
    return _r(search.search(points(spark, sf), _vector(spark, sf, 7), 10, columns=("id",)))


@query(_P + " SELECT id, round(list_inner_product(v, (SELECT v FROM p WHERE vec_id = 11)), 6) AS score FROM p ORDER BY list_inner_product(v, (SELECT v FROM p WHERE vec_id = 11)) DESC, id LIMIT 10")
def search_dot(spark, sf):
    return _r(search.search(points(spark, sf, "dot"), _vector(spark, sf, 11), 10, columns=("id",)))


@query(_P + " SELECT id, round(-list_distance(v, (SELECT v FROM p WHERE vec_id = 5)), 6) + 0.0 AS score FROM p ORDER BY list_distance(v, (SELECT v FROM p WHERE vec_id = 5)), id LIMIT 10")
def search_euclid(spark, sf):
    return _r(search.search(points(spark, sf, "euclid"), _vector(spark, sf, 5), 10, columns=("id",)))


@query(_P + """ SELECT a.id, round(-list_sum(list_transform(range(1, 65), lambda i: abs(a.v[i] - b.v[i]))), 6) + 0.0 AS score FROM p a, p b WHERE b.vec_id = 5
    ORDER BY list_sum(list_transform(range(1, 65), lambda i: abs(a.v[i] - b.v[i]))), a.id LIMIT 10""")
def search_manhattan(spark, sf):
    return _r(search.search(points(spark, sf, "manhattan"), _vector(spark, sf, 5), 10, columns=("id",)))


@query(_P + " SELECT id, round(list_cosine_similarity(v, (SELECT v FROM p WHERE vec_id = 3)), 6) AS score FROM p WHERE id <> '3' ORDER BY list_cosine_similarity(v, (SELECT v FROM p WHERE vec_id = 3)) DESC, id LIMIT 10")
def search_by_id(spark, sf):
    return _r(search.search_by_id(points(spark, sf), "3", 10, columns=("id",)))


@query(_P + " SELECT id, round(list_cosine_similarity(v, (SELECT v FROM p WHERE vec_id = 7)), 6) AS score FROM p WHERE label IN (1, 2, 3) AND list_cosine_similarity(v, (SELECT v FROM p WHERE vec_id = 7)) > 0.1 ORDER BY list_cosine_similarity(v, (SELECT v FROM p WHERE vec_id = 7)) DESC, id LIMIT 20")
def search_filtered_threshold(spark, sf):
    label = J.json_get_int("payload", "label")
    return _r(search.search(points(spark, sf), _vector(spark, sf, 7), 20, where=label.isin(1, 2, 3), threshold=0.1, columns=("id",)))


@query(_P + " SELECT id, round(1 - list_cosine_similarity(v, (SELECT v FROM p WHERE vec_id = 9)), 6) AS distance FROM p WHERE 1 - list_cosine_similarity(v, (SELECT v FROM p WHERE vec_id = 9)) < 0.8")
def distance_filter(spark, sf):
    d = V.distance("vector", _vector(spark, sf, 9), "cosine")
    return _r(points(spark, sf).df.select("id", d.alias("distance")).where("distance < 0.8"), "distance")


@query(_P + " SELECT label, count(*) AS n FROM p WHERE list_distance(v, (SELECT v FROM p WHERE vec_id = 9)) <= 1.4 GROUP BY label")
def radius_count_by_category(spark, sf):
    near = search.within_radius(points(spark, sf, "euclid"), _vector(spark, sf, 9), 1.4)
    return near.groupBy(J.json_get_int("payload", "label").cast("int").alias("label")).agg(F.count("*").alias("n"))


@query(_M + """, s AS (SELECT id, coalesce(list_sum(list_transform(range(1, len(words_indices) + 1), lambda i: words_values[i] * CASE words_indices[i] WHEN 1 THEN 0.5 WHEN 10 THEN 0.8 WHEN 42 THEN 0.2 ELSE 0 END)), 0) AS x FROM m)
    SELECT id, round(x, 6) AS score FROM s ORDER BY x DESC, id LIMIT 10""")
def sparse_search(spark, sf):
    return _r(search.sparse_search(mixed(spark, sf), [1, 10, 42, 100000], [0.5, 0.8, 0.2, 0.9], 10, columns=("id",)))


@query(_M + """, q AS (SELECT v[1:32] AS qt, v[33:64] AS qi FROM m WHERE vec_id = 8), s AS (SELECT id, list_cosine_similarity(text, qt) * 0.7 + list_inner_product(image, qi) * 0.3 AS x FROM m, q WHERE text IS NOT NULL AND image IS NOT NULL)
    SELECT id, round(x, 6) AS score FROM s ORDER BY x DESC, id LIMIT 20""")
def multi_search_weighted(spark, sf):
    q = _vector(spark, sf, 8)
    return _r(search.weighted_search(mixed(spark, sf), [("text", q[:32], 0.7), ("image", q[32:], 0.3)], 20, columns=("id",)).select("id", "score"))


@query(_M + """, q AS (SELECT v AS qv FROM m WHERE vec_id = 8), s AS (SELECT id, (SELECT sum(best) FROM (SELECT max(list_inner_product(qv[a * 16 + 1 : a * 16 + 16], v[b * 16 + 1 : b * 16 + 16])) AS best FROM range(4) x(a), range(4) y(b) GROUP BY a)) AS x FROM m, q WHERE vec_id % 5 <> 0)
    SELECT id, round(x, 6) AS score FROM s ORDER BY x DESC, id LIMIT 10""")
def maxsim(spark, sf):
    q = _vector(spark, sf, 8)
    return _r(search.search(mixed(spark, sf), [q[i : i + 16] for i in range(0, 64, 16)], 10, using="parts", columns=("id",)))


# -- examples, context, stages, fusion

_MEAN = "(SELECT list(m ORDER BY i) FROM (SELECT i, avg(v[i]) AS m FROM p, range(1, 65) t(i) WHERE id IN ({}) GROUP BY i))"
_POS, _NEG = _MEAN.format("'1', '2', '3'"), _MEAN.format("'4', '5'")


@query(_P + f", q AS (SELECT {_POS} AS q) SELECT id, round(list_cosine_similarity(v, q), 6) AS score FROM p, q WHERE id NOT IN ('1', '2', '3') ORDER BY list_cosine_similarity(v, q) DESC, id LIMIT 10")
def recommend_pos(spark, sf):
    return _r(recommend.recommend(points(spark, sf), ["1", "2", "3"], None, 10, columns=("id",)))


@query(_P + f", q AS (SELECT list_transform(range(1, 65), lambda i: 2 * a[i] - b[i]) AS q FROM (SELECT {_POS} AS a, {_NEG} AS b)) SELECT id, round(list_cosine_similarity(v, q), 6) AS score FROM p, q WHERE id NOT IN ('1', '2', '3', '4', '5') ORDER BY list_cosine_similarity(v, q) DESC, id LIMIT 10")
def recommend_pos_neg(spark, sf):
    return _r(recommend.recommend(points(spark, sf), ["1", "2", "3"], ["4", "5"], 10, columns=("id",)))


@query(_P + f", q AS (SELECT list_transform(range(1, 65), lambda i: 2 * a[i] - b[i]) AS q FROM (SELECT {_MEAN.format(repr('1'))} AS a, {_MEAN.format(repr('4'))} AS b)) SELECT id, round(list_cosine_similarity(v, q), 6) AS score FROM p, q ORDER BY list_cosine_similarity(v, q) DESC, id LIMIT 10")
def recommend_vectors(spark, sf):
    return _r(recommend.recommend(points(spark, sf), [_vector(spark, sf, 1)], [_vector(spark, sf, 4)], 10, columns=("id",)))


@query(_P + """, c AS (SELECT (SELECT v FROM p WHERE vec_id = 1) AS a1, (SELECT v FROM p WHERE vec_id = 2) AS b1, (SELECT v FROM p WHERE vec_id = 3) AS a2, (SELECT v FROM p WHERE vec_id = 4) AS b2, (SELECT v FROM p WHERE vec_id = 5) AS t),
    s AS (SELECT id, list_cosine_similarity(v, t) AS c, sign(list_cosine_similarity(v, a1) - list_cosine_similarity(v, b1)) + sign(list_cosine_similarity(v, a2) - list_cosine_similarity(v, b2)) AS r FROM p, c)
    SELECT id, round(r + 0.5 * (c / (1 + abs(c)) + 1), 6) AS score FROM s ORDER BY r + 0.5 * (c / (1 + abs(c)) + 1) DESC, id LIMIT 10""")
def discover(spark, sf):
    v = {i: _vector(spark, sf, i) for i in range(1, 6)}
    return _r(recommend.discover(points(spark, sf), v[5], [(v[1], v[2]), (v[3], v[4])], 10, columns=("id",)))


@query(_P + """, c AS (SELECT (SELECT v FROM p WHERE vec_id = 1) AS a, (SELECT v FROM p WHERE vec_id = 2) AS b, (SELECT v FROM p WHERE vec_id = 5) AS t),
    s AS (SELECT id, list_cosine_similarity(v, t) + 0.5 * list_cosine_similarity(v, a) + 0.3 * list_cosine_similarity(v, b) AS x FROM p, c WHERE id NOT IN ('1', '2'))
    SELECT id, round(x, 6) AS score FROM s ORDER BY x DESC, id LIMIT 10""")
def discover_weighted(spark, sf):
    return _r(recommend.discover_weighted(points(spark, sf), _vector(spark, sf, 5), [("1", 0.5), ("2", 0.3)], 10, columns=("id",)))


@query(_P + """, f AS (SELECT id, v FROM p ORDER BY list_cosine_similarity(v, (SELECT v FROM p WHERE vec_id = 7)) DESC, id LIMIT 100)
    SELECT id, round(list_inner_product(v, (SELECT v FROM p WHERE vec_id = 12)), 6) AS score FROM f ORDER BY list_inner_product(v, (SELECT v FROM p WHERE vec_id = 12)) DESC, id LIMIT 10""")
def prefetch_rerank(spark, sf):
    first = search.prefetch(points(spark, sf), _vector(spark, sf, 7), 100)
    return _r(search.rerank(first, V.dot("vector", _vector(spark, sf, 12)), 10).select("id", "score"))


_LISTS = """, a AS (SELECT id, row_number() OVER (ORDER BY list_cosine_similarity(v, (SELECT v FROM p WHERE vec_id = 7)) DESC, id) AS r FROM p), b AS (SELECT id, row_number() OVER (ORDER BY list_cosine_similarity(v, (SELECT v FROM p WHERE vec_id = 21)) DESC, id) AS r FROM p),
    u AS (SELECT id, 1.0 / (60 + r) AS s FROM a WHERE r <= {n} UNION ALL SELECT id, 1.0 / (60 + r) AS s FROM b WHERE r <= {n})"""


def _two_lists(spark, sf, n):
    c = points(spark, sf)
    return [search.search(c, _vector(spark, sf, i), n, columns=("id",)) for i in (7, 21)]


@query(_P + _LISTS.format(n=20) + " SELECT id, round(sum(s), 6) AS score FROM u GROUP BY id ORDER BY sum(s) DESC, id LIMIT 10")
def fusion_rrf(spark, sf):
    return _r(fusion.fuse_rrf(_two_lists(spark, sf, 20), 10, limit=20))


@query(_P + _LISTS.format(n=200) + " SELECT id, round(sum(s), 6) AS score FROM u GROUP BY id HAVING count(*) = 2 ORDER BY sum(s) DESC, id LIMIT 10")
def fusion_rrf_inner(spark, sf):
    return _r(fusion.fuse_rrf(_two_lists(spark, sf, 200), 10, limit=200, mode="inner"))


@query(_P + """, s AS (SELECT q.vec_id AS query_id, p.id, list_cosine_similarity(q.v, p.v) AS x, row_number() OVER (PARTITION BY q.vec_id ORDER BY list_cosine_similarity(q.v, p.v) DESC, p.id) AS rank FROM p q, p WHERE q.vec_id % 50 = 0)
    SELECT query_id, CAST(rank AS INT) AS rank, id, round(x, 6) AS score FROM s WHERE rank <= 5""")
def batch_topk(spark, sf):
    asked = _read(spark, sf, "embeddings").where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    return _r(search.search_batch(points(spark, sf), asked, 5)).withColumn("rank", F.col("rank").cast("int"))


@query(_P + """, b AS (SELECT id, label, list_cosine_similarity(v, (SELECT v FROM p WHERE vec_id = 7)) AS x FROM p ORDER BY x DESC, id LIMIT 50), s AS (SELECT id, x, x + CASE WHEN label IN (1, 2) THEN 0.5 WHEN label IN (3, 4) THEN 0.25 ELSE 0 END AS y FROM b)
    SELECT id, round(x, 6) AS base_score, round(y, 6) AS score FROM s ORDER BY y DESC, id LIMIT 10""")
def boost_case(spark, sf):
    base = search.search(points(spark, sf), _vector(spark, sf, 7), 50)
    label = J.json_get_int("payload", "label")
    out = search.boosted(base, F.when(label.isin(1, 2), 0.5).when(label.isin(3, 4), 0.25).otherwise(0.0), 10)
    return _r(out.select("id", "base_score", "score"), "base_score", "score")


@query("""WITH g AS (SELECT c_custkey AS id, 48 + (c_custkey % 97) / 10.0 AS lat, 8 + (c_custkey % 89) / 10.0 AS lon FROM customer),
    d AS (SELECT id, 2 * 6371000.0 * asin(least(1.0, sqrt(power(sin((radians(52.504043) - radians(lat)) / 2), 2) + cos(radians(lat)) * cos(radians(52.504043)) * power(sin((radians(13.393236) - radians(lon)) / 2), 2)))) AS metres FROM g)
    SELECT id, round(metres, 3) AS metres, round(exp(ln(0.5) * power(metres / 50000, 2)), 6) AS score FROM d WHERE metres < 100000""")
def geo_decay(spark, sf):
    c = _read(spark, sf, "customer").select(F.col("c_custkey").alias("id"), (48 + (F.col("c_custkey") % 97) / 10).alias("lat"), (8 + (F.col("c_custkey") % 89) / 10).alias("lon"))
    d = c.select("id", S.geo_distance("lat", "lon", 52.504043, 13.393236).alias("metres")).where("metres < 100000")
    return d.select("id", F.round("metres", 3).alias("metres"), F.round(S.gauss_decay("metres", 50000), 6).alias("score"))


# -- payloads


@query(r"""WITH t AS (SELECT doc_id, list_distinct(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS w FROM documents), s AS (SELECT doc_id, len(list_intersect(w, ['machine', 'the', 'and', 'der'])) / 4.0 AS x FROM t)
    SELECT CAST(doc_id AS VARCHAR) AS id, round(x, 6) AS score FROM s WHERE x > 0""")
def match_text(spark, sf):
    d = _read(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("id"), S.match_text("text", "The machine and der THE").alias("score"))
    return _r(d.where("score > 0"))


@query("SELECT CAST(event_id AS VARCHAR) AS id, json_exists(props, '$.k') AS has_k, json_exists(props, '$.gone') AS has_gone FROM events")
def has_field(spark, sf):
    return _read(spark, sf, "events").select(F.col("event_id").cast("string").alias("id"), S.has_field("props", "k").alias("has_k"), S.has_field("props", "gone").alias("has_gone"))


@query("SELECT c_custkey AS id, c_mktsegment AS segment, CAST(c_nationkey AS BIGINT) AS nation FROM customer WHERE c_nationkey > 10")
def json_nested(spark, sf):
    c = _read(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.to_json(F.struct(F.struct(F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation")).alias("address"))).alias("payload"))
    return c.select("id", J.json_get_str("payload", "address", "segment").alias("segment"), J.json_get_int("payload", "address", "nation").alias("nation")).where("nation > 10")


@query("SELECT p_partkey AS id FROM part WHERE list_contains(string_split(p_type, ' '), 'STANDARD') AND list_contains(string_split(p_name || ' ' || p_brand, ' '), p_brand)")
def json_contains_all(spark, sf):
    """Parts whose tags (words of type, name and brand) hold both the brand and STANDARD."""
    tags = F.to_json(F.split(F.concat_ws(" ", "p_type", "p_name", "p_brand"), " "))
    return _read(spark, sf, "part").where(J.json_contains_all(tags, F.to_json(F.array(F.lit("STANDARD"), "p_brand")))).select(F.col("p_partkey").alias("id"))


def _customer_payload():
    """A payload with each kind of value, and with missing ones, from a customer; the SQL reads the table's own columns."""
    inner = F.struct(F.col("c_mktsegment").alias("name"), F.when(F.col("c_custkey") % 4 == 0, F.col("c_acctbal")).alias("balance"), (F.col("c_acctbal") > 0).alias("solvent"))
    codes, alias = F.array("c_nationkey", F.col("c_custkey") % 7), F.when(F.col("c_custkey") % 3 == 0, F.col("c_name"))
    return F.to_json(F.struct(inner.alias("segment"), codes.alias("codes"), alias.alias("alias")))


@query("""SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN c_name END AS alias, CAST(NULL AS BIGINT) AS alias_int, c_mktsegment AS segment, CASE WHEN c_custkey % 4 = 0 THEN round(CAST(c_acctbal AS DOUBLE), 2) END AS balance, c_acctbal > 0 AS solvent,
    CAST(c_custkey % 7 AS BIGINT) AS second_code, '"' || c_mktsegment || '"' AS raw, 2 AS n_codes, CASE WHEN c_custkey % 3 = 0 THEN 'segment,codes,alias' ELSE 'segment,codes' END AS keys FROM customer WHERE c_custkey % 3 = 0 OR c_acctbal > 0""")
def json_getters(spark, sf):
    c = _read(spark, sf, "customer").withColumn("p", _customer_payload())
    solvent = J.json_get_bool("p", "segment", "solvent")
    return c.where(J.json_contains("p", "alias") | solvent).select(
        F.col("c_custkey").alias("id"), J.json_as_text("p", "alias").alias("alias"), J.json_get_int("p", "alias").alias("alias_int"), J.json_get_str("p", "segment", "name").alias("segment"),
        F.round(J.json_get_float("p", "segment", "balance"), 2).alias("balance"), solvent.alias("solvent"), J.json_get_int("p", "codes", 1).alias("second_code"),
        J.json_get_json("p", "segment", "name").alias("raw"), J.json_length("p", "codes").alias("n_codes"), F.array_join(J.json_object_keys("p"), ",").alias("keys"),
    )


# -- relational operators over scores


@query(_P + """ SELECT label, count(*) AS points, round(max(list_cosine_similarity(v, (SELECT v FROM p WHERE vec_id = 7))), 6) AS best, round(avg(list_cosine_similarity(v, (SELECT v FROM p WHERE vec_id = 7))), 6) AS mean FROM p GROUP BY label HAVING count(*) >= 3""")
def agg_group_having(spark, sf):
    c = points(spark, sf)
    scored = c.df.select(J.json_get_int("payload", "label").cast("int").alias("label"), search.score(c, _vector(spark, sf, 7)).alias("s"))
    out = scored.groupBy("label").agg(F.count("*").alias("points"), F.max("s").alias("best"), F.avg("s").alias("mean")).where("points >= 3")
    return _r(out, "best", "mean")


@query(_P + " SELECT id, payload FROM p WHERE id IN (SELECT CAST(doc_id AS VARCHAR) FROM labels WHERE toxic = 1)")
def semi_join_in(spark, sf):
    toxic = _read(spark, sf, "labels").where("toxic = 1").select(F.col("doc_id").cast("string").alias("id"))
    return points(spark, sf).select("id", "payload").join(toxic, "id", "left_semi")


@query(_P + " SELECT p.id, p.label, CAST(coalesce(l.quality, -1) AS INT) AS quality FROM p LEFT JOIN labels l ON p.vec_id = l.doc_id")
def join_payload(spark, sf):
    labels = _read(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("id"), "quality")
    c = points(spark, sf).df.select("id", J.json_get_int("payload", "label").cast("int").alias("label"))
    return c.join(labels, "id", "left").withColumn("quality", F.coalesce("quality", F.lit(-1)))


@query(_P + """, s AS (SELECT id, label, list_cosine_similarity(v, (SELECT v FROM p WHERE vec_id = 7)) AS x FROM p), r AS (SELECT id, label, row_number() OVER (PARTITION BY label ORDER BY x DESC, id) AS r FROM s)
    SELECT id, label, CAST(r AS INT) AS r FROM r WHERE r <= 3""")
def window_top_per_label(spark, sf):
    from pyspark.sql import Window as W

    c = points(spark, sf)
    s = c.df.select("id", J.json_get_int("payload", "label").cast("int").alias("label"), search.score(c, _vector(spark, sf, 7)).alias("x"))
    return s.withColumn("r", F.row_number().over(W.partitionBy("label").orderBy(F.desc("x"), "id"))).where("r <= 3").select("id", "label", "r")


@query(_P + " SELECT id FROM p WHERE label < 3 UNION SELECT id FROM p WHERE label > 7 EXCEPT SELECT id FROM p WHERE label IN (0, 9)")
def set_operations(spark, sf):
    d = points(spark, sf).df.select("id", J.json_get_int("payload", "label").alias("label"))
    either = d.where("label < 3").select("id").union(d.where("label > 7").select("id")).distinct()
    return either.exceptAll(d.where("label in (0, 9)").select("id"))


@query(_P + """ SELECT CAST(coalesce(label, -1) AS INT) AS label, CAST(coalesce(label // 5, -1) AS BIGINT) AS half, count(*) AS n FROM p GROUP BY CUBE (label, label // 5)""")
def cube_counts(spark, sf):
    d = points(spark, sf).df.select(J.json_get_int("payload", "label").cast("int").alias("label")).withColumn("half", F.expr("label div 5"))
    return d.cube("label", "half").agg(F.count("*").alias("n")).fillna(-1)


@query(_P + """ SELECT id, CASE WHEN label < 3 THEN '{"label":-1}' ELSE payload END AS payload FROM p UNION ALL SELECT 'new' AS id, '{"label":99}' AS payload""")
def upsert(spark, sf):
    c = points(spark, sf)
    changed = c.df.where(J.json_get_int("payload", "label") < 3).withColumn("payload", F.lit('{"label":-1}'))
    added = changed.limit(1).select(F.lit("new").alias("id"), F.lit('{"label":99}').alias("payload"), "vector")
    return c.upsert(changed.unionByName(added)).df.select("id", "payload")


# -- the SQL dialect


def _literal(values: list[float]) -> str:
    return "[" + ", ".join(repr(x) for x in values) + "]"


@query(ORACLE["search_cosine"])
def sql_search(spark, sf):
    text = f"SELECT id, round(V_SEARCH({_literal(_vector(spark, sf, 7))}), 6) AS score FROM points ORDER BY V_SEARCH({_literal(_vector(spark, sf, 7))}) DESC, id LIMIT 10"
    return dialect.sql(spark, text, points(spark, sf))


@query(ORACLE["recommend_pos_neg"])
def sql_recommend(spark, sf):
    text = "WITH r AS (SELECT id, V_RECOMMEND(['1', '2', '3'], ['4', '5']) AS s FROM points ORDER BY s DESC, id LIMIT 10) SELECT id, round(s, 6) AS score FROM r"
    return dialect.sql(spark, text, points(spark, sf))


@query(ORACLE["agg_group_having"])
def sql_group(spark, sf):
    q = _literal(_vector(spark, sf, 7))
    text = f"SELECT CAST(payload->'label' AS INT) AS label, COUNT(*) AS points, round(MAX(V_SEARCH({q})), 6) AS best, round(AVG(V_SEARCH({q})), 6) AS mean FROM points GROUP BY payload->'label' HAVING COUNT(*) >= 3"
    return dialect.sql(spark, text, points(spark, sf))


@query(_P + """, s AS (SELECT q.vec_id AS query_id, p.id, list_cosine_similarity(q.v, p.v) AS x, row_number() OVER (PARTITION BY q.vec_id ORDER BY list_cosine_similarity(q.v, p.v) DESC, p.id) AS rank FROM p q, p WHERE q.vec_id IN (4, 6))
    SELECT CAST(query_id AS INT) AS query_id, id, round(x, 6) AS score FROM s WHERE rank <= 5""")
def sql_lateral(spark, sf):
    rows = ", ".join(f"({i}, {_literal(_vector(spark, sf, i))})" for i in (4, 6))
    text = f"""WITH queries AS (SELECT * FROM (VALUES {rows}) AS t(query_id, query_vector))
        SELECT q.query_id, c.id, round(V_SEARCH(q.query_vector), 6) AS score FROM queries q
        CROSS JOIN LATERAL (SELECT * FROM points ORDER BY V_SEARCH(q.query_vector) DESC LIMIT 5) c"""
    return dialect.sql(spark, text, points(spark, sf))


def _floats(values: list[float]) -> str:
    """A vector as a DuckDB list."""
    return "[" + ", ".join(f"CAST({x!r} AS DOUBLE)" for x in values) + "]"


# fixed query vectors, so that the SQL needs no lookups
_Q16 = [[round(((i * 7 + j * 3) % 11 - 5) / 10, 1) for i in range(16)] for j in range(3)]
_Q32 = [round(((i * 5) % 13 - 6) / 10, 1) for i in range(32)]
_Q64 = [round(((i * 3) % 17 - 8) / 10, 1) for i in range(64)]
_R64 = [round(((i * 11) % 7 - 3) / 10, 1) for i in range(64)]


@query(_M + """, s AS (SELECT id, label, coalesce(list_sum(list_transform(range(1, len(words_indices) + 1), lambda i: words_values[i] * CASE words_indices[i] WHEN 2 THEN 0.6 WHEN 30 THEN 0.9 ELSE 0 END)), 0) AS x FROM m)
    SELECT id, round(x, 6) AS score FROM s WHERE label < 7 AND x > 0 ORDER BY x DESC, id LIMIT 12""")
def sql_sparse(spark, sf):
    v = "V_SPARSE_SEARCH('words', [2, 30, 4000], [0.6, 0.9, 0.4])"
    return dialect.sql(spark, f"SELECT id, round({v}, 6) AS score FROM mixed WHERE payload->'label' < 7 AND {v} > 0 ORDER BY {v} DESC, id LIMIT 12", mixed(spark, sf))


_NEAR = f", n AS (SELECT id, label, image, 1 - list_cosine_similarity(text, {_floats(_Q32)}) AS near FROM m WHERE text IS NOT NULL)"


@query(_M + _NEAR + f", f AS (SELECT id, near, list_distance(image, {_floats(_Q32)}) AS far FROM n WHERE image IS NOT NULL) SELECT id, round(near, 6) AS near, round(far, 6) AS far FROM f WHERE near < 0.9 AND far > 1")
def sql_distance(spark, sf):
    a, b = f"V_DISTANCE('text', {_Q32})", f"V_DISTANCE('image', {_Q32}, 'euclid')"
    return dialect.sql(spark, f"SELECT id, round({a}, 6) AS near, round({b}, 6) AS far FROM mixed WHERE {a} < 0.9 AND {b} > 1", mixed(spark, sf))


@query(_M + _NEAR + " SELECT label, count(*) AS n FROM n WHERE near <= 0.95 GROUP BY label HAVING count(*) > 1")
def sql_within(spark, sf):
    return dialect.sql(spark, f"SELECT CAST(payload->'label' AS INT) AS label, COUNT(*) AS n FROM mixed WHERE V_WITHIN('text', {_Q32}, 0.95) GROUP BY payload->'label' HAVING COUNT(*) > 1", mixed(spark, sf))


_SIM16 = " + ".join("greatest(" + ", ".join(f"list_inner_product({_floats(q)}, v[{b * 16 + 1}:{b * 16 + 16}])" for b in range(4)) + ")" for q in _Q16)


@query(_M + f""", f AS (SELECT * FROM m WHERE image IS NOT NULL ORDER BY list_inner_product(image, {_floats(_Q32)}) DESC, id LIMIT 60), s AS (SELECT id, {_SIM16} AS x FROM f WHERE vec_id % 5 <> 0)
    SELECT id, round(x, 6) AS score FROM s ORDER BY x DESC, id LIMIT 9""")
def sql_colbert(spark, sf):
    v = f"V_COLBERT('parts', {_Q16})"
    text = f"WITH f AS (SELECT * FROM mixed ORDER BY V_SEARCH('image', {_Q32}) DESC NULLS LAST, id LIMIT 60) SELECT id, round({v}, 6) AS score FROM f WHERE {v} IS NOT NULL ORDER BY {v} DESC, id LIMIT 9"
    return dialect.sql(spark, text, mixed(spark, sf))


@query(_P + f""", s AS (SELECT id, list_cosine_similarity(v, {_floats(_Q64)}) + 0.4 * list_cosine_similarity(v, (SELECT v FROM p WHERE id = '6')) + 0.2 * list_cosine_similarity(v, (SELECT v FROM p WHERE id = '9')) AS x FROM p WHERE id NOT IN ('6', '9'))
    SELECT id, round(x, 6) AS score FROM s ORDER BY x DESC, id LIMIT 15""")
def sql_discover(spark, sf):
    text = f"WITH d AS (SELECT id, V_DISCOVER({_Q64}, [['6', 0.4], ['9', 0.2]]) AS x FROM points) SELECT id, round(x, 6) AS score FROM d WHERE x IS NOT NULL ORDER BY x DESC, id LIMIT 15"
    return dialect.sql(spark, text, points(spark, sf))


_FUSED = f""", a AS (SELECT id, row_number() OVER (ORDER BY list_cosine_similarity(v, {_floats(_Q64)}) DESC, id) AS r FROM p), b AS (SELECT id, row_number() OVER (ORDER BY list_inner_product(v, {_floats(_R64)}) DESC, id) AS r FROM p)"""


def _lists_sql(n: int) -> str:
    return f"WITH a AS (SELECT id, V_SEARCH({_Q64}) AS x FROM points ORDER BY x DESC, id LIMIT {n}), b AS (SELECT id, -V_DISTANCE({_R64}, 'dot') AS x FROM points ORDER BY x DESC, id LIMIT {n})"


@query(_P + _FUSED + " SELECT id, round(1.0 / (60 + a.r) + 1.0 / (60 + b.r), 6) AS score FROM a JOIN b USING (id) WHERE a.r <= 150 AND b.r <= 150 ORDER BY 1.0 / (60 + a.r) + 1.0 / (60 + b.r) DESC, id LIMIT 10")
def sql_fusion(spark, sf):
    text = _lists_sql(150) + " SELECT c.id, round(V_FUSION([a.x, b.x], 'rrf'), 6) AS score FROM points c JOIN a ON c.id = a.id JOIN b ON c.id = b.id ORDER BY V_FUSION([a.x, b.x], 'rrf') DESC, c.id LIMIT 10"
    return dialect.sql(spark, text, points(spark, sf))


@query(_P + _FUSED + """, s AS (SELECT p.id, p.label, (1.0 / (60 + a.r) + 1.0 / (60 + b.r)) * CASE WHEN p.label = 2 THEN 1.3 ELSE 1.0 END AS x FROM p JOIN a USING (id) JOIN b USING (id) WHERE a.r <= 300 AND b.r <= 300 AND p.label <> 5)
    SELECT id, label, round(x, 6) AS score FROM s ORDER BY x DESC, id LIMIT 10""")
def sql_composite(spark, sf):
    text = _lists_sql(300) + """, s AS (SELECT c.id, CAST(c.payload->'label' AS INT) AS label, V_FUSION([a.x, b.x]) * CASE WHEN c.payload->'label' = 2 THEN 1.3 ELSE 1.0 END AS x
        FROM points c JOIN a ON c.id = a.id JOIN b ON c.id = b.id WHERE c.payload->'label' <> 5) SELECT id, label, round(x, 6) AS score FROM s ORDER BY x DESC, id LIMIT 10"""
    return dialect.sql(spark, text, points(spark, sf))


def _payloads(df: DataFrame, key: str, payload, name: str) -> Collection:
    """A collection without vectors."""
    return Collection.from_frame(df.select(F.col(key).cast("string").alias("id"), payload.alias("payload")), CollectionConfig(None), name)


@query("""WITH g AS (SELECT CAST(c_custkey AS VARCHAR) AS id, 40 + (c_custkey % 83) / 10.0 AS lat, 2 + (c_custkey % 71) / 10.0 AS lon FROM customer),
    d AS (SELECT id, 2 * 6371000.0 * asin(least(1.0, sqrt(power(sin((radians(45.75) - radians(lat)) / 2), 2) + cos(radians(lat)) * cos(radians(45.75)) * power(sin((radians(4.85) - radians(lon)) / 2), 2)))) AS metres FROM g)
    SELECT id, round(exp(ln(0.5) * power(metres / 30000, 2)), 5) AS score FROM d WHERE metres < 90000""")
def sql_geo(spark, sf):
    place = F.struct((40 + (F.col("c_custkey") % 83) / 10).alias("lat"), (2 + (F.col("c_custkey") % 71) / 10).alias("lon"))
    shops = _payloads(_read(spark, sf, "customer"), "c_custkey", F.to_json(F.struct(F.struct(place.alias("place")).alias("shop"))), "shops")
    d = "V_GEO_DISTANCE(payload->'shop'->'place', POINT(45.75, 4.85))"
    return dialect.sql(spark, f"SELECT id, round(V_GAUSS_DECAY({d}, 30000), 5) AS score FROM shops WHERE {d} < 90000", shops)


@query(r"""WITH t AS (SELECT doc_id, list_distinct(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS w FROM documents), s AS (SELECT doc_id, len(list_intersect(w, ['the', 'und', 'people'])) / 3.0 AS x FROM t)
    SELECT CAST(doc_id AS VARCHAR) AS id, round(x, 6) AS score FROM s WHERE x > 0.3""")
def sql_match(spark, sf):
    docs = _payloads(_read(spark, sf, "documents"), "doc_id", F.to_json(F.struct(F.struct("text").alias("body"))), "docs")
    v = "MATCH_TEXT(payload->'body'->'text', 'the UND people')"
    return dialect.sql(spark, f"SELECT id, round({v}, 6) AS score FROM docs WHERE {v} > 0.3", docs)


@query("SELECT CAST(c_custkey AS VARCHAR) AS id FROM customer WHERE c_custkey % 3 <> 0 AND c_custkey % 4 = 0")
def sql_has_field(spark, sf):
    c = _payloads(_read(spark, sf, "customer"), "c_custkey", _customer_payload(), "people")
    return dialect.sql(spark, "SELECT id FROM people WHERE HAS_FIELD(payload, 'alias') = false AND payload->'segment' ? 'balance'", c)


@query("SELECT CAST(p_partkey AS VARCHAR) AS id, p_brand AS second FROM part WHERE p_type = 'STANDARD' AND p_brand <> 'Brand#1'")
def sql_contains(spark, sf):
    parts = _payloads(_read(spark, sf, "part"), "p_partkey", F.to_json(F.struct(F.struct(F.array("p_type", "p_brand").alias("words")).alias("kind"))), "parts")
    return dialect.sql(spark, """SELECT id, (payload->'kind')->'words'->1 AS second FROM parts WHERE payload->'kind'->'words' @> '["STANDARD"]' AND NOT payload->'kind'->'words' @> '["Brand#1"]'""", parts)


@query(_P + """ SELECT id, CASE WHEN label >= 8 THEN '{"label":-1}' ELSE payload END AS payload, len(v) AS dims FROM p WHERE label <> 4 UNION ALL SELECT 'new', '{"label":99}', 64""")
def upsert_stored(spark, sf):
    """A stored collection: all points, a change, a new point and a deletion, each published as a snapshot."""
    c = points(spark, sf)
    label = J.json_get_int("payload", "label")
    # the session's shared folder, where it has one
    folder = (spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="pointframe-")).rstrip("/")
    stored = Collection.create(spark, f"{folder}/upsert-stored-{uuid.uuid4().hex}", c.config, buckets=4).upsert(c.df)
    changed = c.df.where(label >= 8).withColumn("payload", F.lit('{"label":-1}'))
    added = c.df.orderBy("id").limit(1).select(F.lit("new").alias("id"), F.lit('{"label":99}').alias("payload"), "vector")
    stored = stored.upsert(changed.unionByName(added)).delete(c.df.where(label == 4).select("id"))
    return stored.df.select("id", "payload", F.size("vector").alias("dims"))


# -- not a question for SQL


@query(None)
def random_sample(spark, sf):
    return search.random_sample(points(spark, sf), 10, seed=3).select("id", "payload")


@query(None)
def fusion_dbsf(spark, sf):
    return fusion.fuse_dbsf(_two_lists(spark, sf, 20), 10, limit=20)
