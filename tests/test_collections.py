import json
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

import pointframe as pf
from pointframe.errors import CollectionNotFound, CollectionParamsMissing, InvalidSchema, MalformedVector
from pointframe.sources import ingest
from pointframe.sources.config import payload_selector, vector_selector
from pointframe.streaming.upserts import upsert_stream

# bird recordings: a pitch and a tempo curve, a spectrum, a place, calls and species notes, none of them on every point
MIXED = pf.CollectionConfig(
    {"pitch": pf.VectorParams(3), "tempo": pf.VectorParams(2, "manhattan"), "spectrum": pf.VectorParams(5, "dot"), "place": pf.VectorParams(2, "euclid"), "calls": pf.VectorParams(4, "dot", multivector=True)},
    ("notes",),
)
POINTS = [
    {"id": 40, "payload": {"bird": "wren"}, "pitch": [2.5, -1.0, 0.25], "place": [47.5, 8.25], "notes": ([7, 300], [1.25, -0.5])},
    {"id": 41, "payload": {"bird": "robin"}, "spectrum": [0.5, 0.0, 1.5, 2.0, -3.0], "calls": [[1.0, 0.0, 0.5, 0.5], [0.0, 2.0, 0.0, 1.0], [4.0, 4.0, 4.0, 4.0]], "notes": ([0], [2.0])},
    {"id": 42, "payload": {"bird": "kite"}, "pitch": [0.0, 1.0, 1.0], "tempo": [96.0, 104.5], "calls": [[0.25, 0.25, 0.25, 0.25]], "notes": ([3, 5, 8, 13], [0.5, 0.25, 0.125, 4.0])},
]


@pytest.fixture(scope="module")
def mixed(spark):
    return pf.Collection.from_frame(pf.points(spark, POINTS, MIXED), MIXED, "mixed")


def near(a, b):
    return a is None and b is None or a is not None and b is not None and all(abs(x - y) < 1e-6 for x, y in zip(a, b, strict=True))


def test_schema_names_types_and_metadata(mixed):
    s = mixed.schema
    assert s.names == ["id", "payload", "pitch", "tempo", "spectrum", "place", "calls", "notes_indices", "notes_values"]
    assert s["notes_indices"].dataType == T.ArrayType(T.LongType())
    assert s["calls"].dataType == T.ArrayType(T.ArrayType(T.FloatType()))
    assert s["place"].metadata == {"kind": "dense", "size": 2, "distance": "euclid"}
    assert pf.CollectionConfig.from_schema(s).dense == {n: p for n, p in MIXED.dense.items()}
    assert pf.CollectionConfig.from_json(MIXED.to_json()) == MIXED
    assert pf.CollectionConfig().schema().names == ["id", "payload"]


def test_missing_vectors_are_null_and_values_are_kept(mixed):
    got = {r.id: r for r in mixed.df.collect()}
    assert json.loads(got["40"].payload) == {"bird": "wren"}
    for want in POINTS:
        r = got[str(want["id"])]
        for name in ("pitch", "tempo", "spectrum", "place"):
            assert near(r[name], want.get(name))
        assert list(r.notes_indices) == want["notes"][0] and near(r.notes_values, want["notes"][1])
    assert got["40"].calls is None and near(got["41"].calls[1], [0.0, 2.0, 0.0, 1.0])


@pytest.mark.parametrize(
    ("columns", "selected"),
    [
        (["pitch"], ["pitch"]), (["notes_indices", "notes_values"], ["notes"]), (["place", "spectrum"], ["spectrum", "place"]),
        (["calls", "notes_values"], ["calls", "notes"]), (["id", "payload"], "none"), (["tempo"], ["tempo"]),
    ],
)
def test_projections_read_only_their_columns(spark, mixed, tmp_path, columns, selected):
    assert vector_selector(columns, MIXED) == selected
    stored = pf.Collection.create(spark, str(tmp_path / "c"), MIXED, buckets=2).upsert(pf.points(spark, POINTS, MIXED))
    stored.register("projected")
    df = spark.sql(f"SELECT {', '.join(columns)} FROM projected")
    assert df.columns == columns and df.count() == 3
    scan = df._jdf.queryExecution().executedPlan().toString().split("ReadSchema: ")[1].splitlines()[0]
    assert set(re.findall(r"(\w+):", scan)) == set(columns)


def test_unnamed_collection_projection_and_limit(spark):
    config = pf.CollectionConfig(pf.VectorParams(3))
    c = pf.Collection.from_frame(pf.points(spark, [{"id": i, "payload": {"nr": i}, "vector": [i, i * i, 1]} for i in (4, 5, 6)], config), config, "unnamed")
    view = c.register("any_name")
    assert spark.catalog.getTable(view).tableType == "TEMPORARY"
    assert spark.sql("SELECT * FROM any_name").columns == ["id", "payload", "vector"]
    assert spark.sql("SELECT payload, vector, id FROM any_name").columns == ["payload", "vector", "id"]
    assert spark.sql("SELECT * FROM any_name LIMIT 2").count() == 2 and spark.sql("SELECT * FROM any_name").count() == 3
    assert vector_selector(["id", "vector"], config) == "all" and vector_selector(["id", "payload"], config) == "none"
    assert payload_selector(["payload", "id"]) and not payload_selector(["id"])
    assert c.describe(limit=5) == "PointScan: collection=unnamed, vectors=all, payload=True, limit=5"
    assert "unnamed" in repr(c)
    assert c.table_type == "BASE"
    for size in (1, 2, 3, 50):
        pulled = list(c.batches(size))
        assert sum(b.num_rows for b in pulled) == 3 and all(0 < b.num_rows <= size for b in pulled) and pulled[0].schema.names == ["id", "payload", "vector"]
    empty = list(pf.Collection.from_frame(c.df.limit(0), config).batches())
    assert [b.num_rows for b in empty] == [0] and empty[0].schema.names == ["id", "payload", "vector"]


def test_more_than_ten_points_without_limit_and_text_order(spark):
    config = pf.CollectionConfig(pf.VectorParams(1))
    c = pf.Collection.from_frame(pf.points(spark, [{"id": i, "payload": None, "vector": [1.0]} for i in range(25)], config), config)
    assert c.df.count() == 25
    assert [r.id for r in c.df.orderBy("id").limit(4).collect()] == ["0", "1", "10", "11"]
    assert c.df.where("payload is not null").count() == 0


def test_point_ids_and_payloads(spark):
    df = spark.createDataFrame([(7, None, True), (None, "0f8fad5b-d9cb-469f-a165-70867728950e", True), (None, None, True), (None, None, False)], "n long, u string, p boolean")
    assert [r[0] for r in df.select(ingest.point_id(F.col("n"), F.col("u"), F.col("p"))).collect()] == ["7", "0f8fad5b-d9cb-469f-a165-70867728950e", "", None]
    df = spark.createDataFrame([({"b": "1", 'q"\\': '"x"', "a": None},), ({},), (None,)], "m map<string,string>")
    got = [r[0] for r in df.select(ingest.payload_json(F.col("m"))).collect()]
    assert json.loads(got[0]) == {"a": None, "b": 1, 'q"\\': "x"} and got[1:] == [None, None]
    with pytest.raises(MalformedVector):
        pf.points(spark, [{"id": None}], pf.CollectionConfig())


def test_wire_forms(spark):
    config = pf.CollectionConfig({"d": pf.VectorParams(2), "m": pf.VectorParams(2, multivector=True)}, ("s",))
    w = lambda **k: Row(**{f.name: k.get(f.name) for f in ingest.WIRE.fields})
    rows = [
        ("new", None, {"d": w(dense=[1.0, 2.0]), "m": w(vectors=[[1.0, 2.0], [3.0, 4.0]]), "s": w(indices=[0, 4294967295], values=[0.5, 1.0])}),
        ("old", None, {"d": w(data=[1.0, 2.0]), "m": w(data=[1.0, 2.0, 3.0, 4.0], vectors_count=2), "s": w(data=[0.5], indices=[3])}),
        ("odd", None, {"d": w(data=[]), "m": w(data=[1.0, 2.0, 3.0], vectors_count=2), "s": w(dense=[1.0])}),
        ("empty", None, {"d": w(dense=[])}),
        ("zero", None, {"m": w(data=[1.0, 2.0], vectors_count=0)}),
    ]
    df = spark.createDataFrame(rows, T.StructType([T.StructField("id", T.StringType()), T.StructField("payload", T.StringType()), T.StructField("vectors", T.MapType(T.StringType(), ingest.WIRE))]))
    got = {r.id: r for r in pf.wire_to_columns(df, config).collect()}
    for k in ("new", "old"):
        assert got[k].d == [1.0, 2.0] and got[k].m == [[1.0, 2.0], [3.0, 4.0]]
    assert got["new"].s_indices == [0, 4294967295] and got["old"].s_indices == [3] and got["old"].s_values == [0.5]
    assert got["odd"].d is None and got["odd"].m is None and got["odd"].s_indices is None  # empty, undividable, other kind
    assert got["empty"].d == [] and got["empty"].m is None
    assert got["zero"].m is None


def test_reshape(spark):
    assert ingest.reshape([1, 2, 3, 4], 2) == [[1, 2], [3, 4]]
    for data, n in (([1, 2, 3], 2), ([1, 2], 0), ([], 2)):
        with pytest.raises(MalformedVector, match=f"data length {len(data)} is not divisible by vectors count {n}"):
            ingest.reshape(data, n)
    df = spark.createDataFrame([([1.0, 2.0, 3.0, 4.0],)], "v array<float>")
    assert df.select(ingest.to_multi_vector(F.col("v"), 2)).first()[0] == [[1.0, 2.0], [3.0, 4.0]]
    for n in (3, 0):
        with pytest.raises(Exception, match="not divisible by vectors count"):
            df.select(ingest.to_multi_vector(F.col("v"), n)).collect()


@given(st.integers(1, 6), st.integers(1, 6))
def test_reshape_round_trip(n, width):
    data = [float(i) for i in range(n * width)]
    assert [x for v in ingest.reshape(data, n) for x in v] == data


def test_names_are_never_sniffed(spark):
    config = pf.CollectionConfig({"x_values": pf.VectorParams(2), "y_indices": pf.VectorParams(2)}, ("a_indices",))
    c = pf.Collection.from_frame(pf.points(spark, [{"id": 1, "x_values": [1, 2], "y_indices": [3, 4], "a_indices": ([1], [1.0])}], config), config)
    r = c.df.first()
    assert r.x_values == [1.0, 2.0] and r.y_indices == [3.0, 4.0] and r.a_indices_indices == [1]
    for bad in (lambda: pf.CollectionConfig({"id": pf.VectorParams(2)}), lambda: pf.CollectionConfig({"kw_values": pf.VectorParams(2)}, ("kw",)), lambda: pf.VectorParams(0), lambda: pf.VectorParams(2, "nope")):
        with pytest.raises(InvalidSchema):
            bad()


def test_errors_of_opening(spark, tmp_path):
    with pytest.raises(CollectionNotFound):
        pf.Collection.open(spark, str(tmp_path / "none"))
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "collection.json").write_text("{}")
    with pytest.raises(CollectionParamsMissing):
        pf.Collection.open(spark, str(tmp_path / "bad"))


def test_upsert_delete_and_snapshots(spark, tmp_path):
    config = pf.CollectionConfig(pf.VectorParams(2))
    make = lambda ids, v: pf.points(spark, [{"id": i, "payload": {"v": v}, "vector": [1.0, float(v)]} for i in ids], config)
    empty = pf.Collection.create(spark, str(tmp_path / "c"), config, buckets=4)
    assert empty.df.count() == 0
    one = empty.upsert(make(range(20), 1))
    two = one.upsert(make(range(15, 30), 2))
    assert {r.id: json.loads(r.payload)["v"] for r in two.df.collect()} == {str(i): 1 if i < 15 else 2 for i in range(30)}
    assert one.df.count() == 20  # what was opened stays
    three = two.delete(spark.createDataFrame([("3",), ("77",)], "id string"))
    assert three.df.count() == 29 and three.df.where("id = '3'").count() == 0
    assert pf.Collection.open(spark, str(tmp_path / "c")).df.count() == 29
    assert three.df.schema["vector"].metadata["distance"] == "cosine"
    with pytest.raises(InvalidSchema):
        pf.Collection.create(spark, str(tmp_path / "c"), config)
    with pytest.raises(Exception, match="a point has no id"):
        one.upsert(spark.createDataFrame([(None, None, [1.0, 2.0])], "id string, payload string, vector array<float>"))


def files_below(path):
    return {str(p.relative_to(path)): p.read_bytes() for p in sorted(path.rglob("*")) if p.is_file()}


def test_a_losing_writer_changes_nothing(spark, tmp_path):
    config = pf.CollectionConfig(pf.VectorParams(2))
    make = lambda name: pf.points(spark, [{"id": i, "payload": {"by": name}, "vector": [1.0, 2.0]} for i in range(8)], config)
    start = pf.Collection.create(spark, str(tmp_path / "c"), config, buckets=3)
    other = pf.Collection.open(spark, str(tmp_path / "c"))
    won = start.upsert(make("first"))
    published = files_below(tmp_path / "c")
    with pytest.raises(pf.SnapshotConflict):
        other.upsert(make("second"))
    with pytest.raises(pf.SnapshotConflict):
        other.delete(make("x").select("id"))
    with pytest.raises(pf.SnapshotConflict):
        other.overwrite(make("x"))
    assert files_below(tmp_path / "c") == published
    assert {json.loads(r.payload)["by"] for r in pf.Collection.open(spark, str(tmp_path / "c")).df.collect()} == {"first"}
    # a retry starts over from what the winner published
    again = other.upsert(make("third").where("id < '4'"), retries=1)
    assert again.snapshot == 2 and sorted(json.loads(r.payload)["by"] for r in again.df.collect()) == ["first"] * 4 + ["third"] * 4
    assert {json.loads(r.payload)["by"] for r in won.df.collect()} == {"first"}


def test_a_failed_write_leaves_no_folder_and_can_be_repeated(spark, tmp_path, monkeypatch):
    from pointframe.sources import collection as module

    config = pf.CollectionConfig(pf.VectorParams(2))
    c = pf.Collection.create(spark, str(tmp_path / "c"), config, buckets=3).upsert(pf.points(spark, [{"id": 1, "vector": [1.0, 2.0]}], config))
    before = files_below(tmp_path / "c")
    more = pf.points(spark, [{"id": 2, "vector": [3.0, 4.0]}], config)
    with monkeypatch.context() as m:
        m.setattr(module._Files, "publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            c.upsert(more)
    assert files_below(tmp_path / "c") == before
    assert c.upsert(more).df.count() == 2
    bad = spark.createDataFrame([("3", None, None), (None, None, None)], "id string, payload string, vector array<float>")
    with pytest.raises(Exception, match="a point has no id"):
        pf.Collection.open(spark, str(tmp_path / "c")).upsert(bad)


def test_publishing_beside_a_store_without_links(spark, tmp_path):
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.depot.link./in", f"file://{tmp_path}")
    config = pf.CollectionConfig(pf.VectorParams(1))
    c = pf.Collection.create(spark, "viewfs://depot/in/c", config, buckets=2)
    row = pf.points(spark, [{"id": 1, "vector": [1.0]}], config)
    assert c.upsert(row).df.count() == 1
    with pytest.raises(pf.SnapshotConflict):
        c.upsert(row)


def test_stream_upsert(spark, tmp_path):
    config = pf.CollectionConfig(pf.VectorParams(2))
    c = pf.Collection.create(spark, str(tmp_path / "c"), config, buckets=2)
    for n, v in enumerate((1, 2)):
        pf.points(spark, [{"id": i, "payload": {"v": v}, "vector": [0.0, 1.0]} for i in range(n, n + 3)], config).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(config.schema()).parquet(str(tmp_path / "in"))
        upsert_stream(stream, c, str(tmp_path / "cp")).awaitTermination(60)
    got = {r.id: json.loads(r.payload)["v"] for r in pf.Collection.open(spark, str(tmp_path / "c")).df.collect()}
    assert got == {"0": 1, "1": 2, "2": 2, "3": 2}


floats = st.lists(st.floats(-5, 5, width=32), min_size=3, max_size=3)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(floats, floats), min_size=1, max_size=20))
def test_similarities_against_plain_arithmetic(spark, pairs):
    import math

    from pointframe.functions import vectors as V

    df = spark.createDataFrame(pairs, "a array<float>, b array<float>")
    for r in df.select("a", "b", V.dot("a", "b").alias("d"), V.dot("b", "a").alias("e"), V.cosine("a", "b").alias("c"), V.euclid("a", "b").alias("u"), V.manhattan("a", "b").alias("m")).collect():
        assert r.d == pytest.approx(sum(x * y for x, y in zip(r.a, r.b, strict=True)), abs=1e-9) and r.d == pytest.approx(r.e, abs=1e-9)
        assert r.c is None or abs(r.c) <= 1 + 1e-9
        assert r.u == pytest.approx(math.dist(r.a, r.b), abs=1e-6) and r.m == pytest.approx(sum(abs(x - y) for x, y in zip(r.a, r.b, strict=True)), abs=1e-9)


def test_null_and_odd_vectors_never_score(spark):
    config = pf.CollectionConfig(pf.VectorParams(2))
    c = pf.Collection.from_frame(spark.createDataFrame([("a", None, [1.0, 0.0]), ("b", None, None), ("c", None, []), ("d", None, [0.0, 0.0]), ("e", None, [1.0]), ("f", None, [1.0, 0.0])], "id string, payload string, vector array<float>"), config)
    assert [r.id for r in pf.search(c, [1.0, 0.0], 10).collect()] == ["a", "f"]
    assert pf.search(c, [], 10).count() == 0
    with pytest.raises(pf.DimensionMismatch):
        pf.search(c, [1.0], 10)
    plan = pf.search(c, [1.0, 0.0], 3)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    asked = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0]), (3, None)], "query_id long, vector array<float>")
    got = pf.search_batch(c, asked, 3).collect()
    assert [(r.query_id, r.id) for r in got] == [(1, "a"), (1, "f")]
    many = pf.search_batch(c, asked.unionByName(asked.withColumn("query_id", F.col("query_id") + 10)), 1, max_bytes=20).collect()
    assert sorted((r.query_id, r.id) for r in many) == [(1, "a"), (11, "a")]
    assert pf.recommend(c, ["nobody"]).count() == 0
    assert [r.id for r in pf.search_by_id(c, "a", 5).collect()] == ["f"]
    assert pf.search_by_id(c, "b", 5).count() == 0


def test_sparse_equals_dense_after_spreading(spark):
    from pointframe.functions import vectors as V

    df = spark.createDataFrame([([0, 3, 9], [1.0, 2.0, 3.0]), ([], []), (None, None)], "i array<long>, v array<float>")
    assert [r[0] for r in df.select(V.sparse_dot("i", "v", [3, 9, 100000], [0.5, 1.0, 7.0])).collect()] == [4.0, 0.0, None]
    with pytest.raises(MalformedVector):
        config = pf.CollectionConfig(None, ("s",))
        pf.sparse_search(pf.Collection.from_frame(pf.points(spark, [], config), config), [1, 1], [0.1, 0.2])


def test_fusion_counts_lists_and_ranks(spark):
    a = spark.createDataFrame([("x", 3.0), ("y", 2.0), ("z", 1.0)], "id string, score double")
    b = spark.createDataFrame([("y", 9.0), ("w", 8.0)], "id string, score double")
    got = {r.id: r.score for r in pf.fuse_rrf([a, b]).collect()}
    assert got == pytest.approx({"y": 1 / 62 + 1 / 61, "x": 1 / 61, "w": 1 / 62, "z": 1 / 63})
    assert [r.id for r in pf.fuse_rrf([a, b], mode="inner").collect()] == ["y"]
    assert pf.fuse_dbsf([a, b]).first().id == "y"


def test_json_functions_agree_in_both_forms(spark):
    from pointframe.functions import json_functions as J

    doc = '{"s":"3","i":3,"f":1.5,"b":true,"n":null,"o":{"k":[1,"x"]},"a":["p","q"]}'
    df = spark.createDataFrame([(doc,), ("broken {",), (None,)], "j string")
    got = df.select(
        J.json_get_str("j", "s").alias("s"), J.json_get_str("j", "i").alias("si"), J.json_get_int("j", "i").alias("i"), J.json_get_int("j", "f").alias("fi"), J.json_get_float("j", "f").alias("f"), J.json_get_float("j", "i").alias("if"),
        J.json_get_bool("j", "b").alias("b"), J.json_get_bool("j", "s").alias("sb"), J.json_as_text("j", "o").alias("o"), J.json_get_json("j", "s").alias("js"), J.json_contains("j", "n").alias("has_n"), J.json_contains("j", "o", "k", 1).alias("has_k"),
        J.json_contains("j", "zz").alias("has_z"), J.json_length("j").alias("len"), J.json_length("j", "a").alias("len_a"), F.size(J.json_get_array("j", "a")).alias("arr"), J.json_object_keys("j", "o").alias("keys"), J.json_as_text("j", "o", "k", 1).alias("deep"),
        J.json_contains_all(J.json_as_text("j", "a"), '["q"]').alias("all"), J.json_from_scalar(F.lit("x")).alias("scalar"), F.to_json(J.json_get("j", "i")).alias("any"),
    ).collect()
    r = got[0]
    assert (r.s, r.si, r.i, r.fi, r.f, r["if"], r.b, r.sb, r.o, r.js) == ("3", None, 3, None, 1.5, 3.0, True, None, '{"k":[1,"x"]}', '"3"')
    assert (r.has_n, r.has_k, r.has_z, r.len, r.len_a, r.arr, r["keys"], r.deep, r.all, r.scalar, r.any) == (True, True, False, 7, 2, 2, ["k"], "x", True, '"x"', "3")
    assert got[1].s is None and got[2].has_n is None
    names = pf.register_json_functions(spark)
    assert "json_get_str" in names
    df.createOrReplaceTempView("docs")
    q = spark.sql("SELECT json_get_str(j, 's') a, json_get_int(j, 'i') b, json_get_float(j, 'f') c, json_get_bool(j, 'b') d, json_as_text(j, 'o', 'k') e, json_contains(j, 'n') f, json_length(j) g, json_get_json(j, 's') h, json_get_str(j, 'i') i FROM docs").first()
    assert tuple(q) == ("3", 3, 1.5, True, '[1,"x"]', True, 7, '"3"', None)


def test_scores_shaped(spark):
    from pointframe.functions import scoring as S

    one = spark.range(1)
    r = one.select(S.gauss_decay(F.lit(5000.0), 5000).alias("g"), S.exp_decay(F.lit(2.0), 2).alias("e"), S.linear_decay(F.lit(9.0), 2).alias("l"), S.geo_distance(F.lit(52.52), F.lit(13.405), 48.1372, 11.5756).alias("d"), S.match_text(F.lit("Größe der Welt"), "GRÖSSE welt größe").alias("m"), S.match_text(F.lit("x"), " ").alias("none"), S.has_field(F.lit(None).cast("string"), "k").alias("h")).first()
    assert r.g == pytest.approx(0.5) and r.e == pytest.approx(0.5) and r.l == 0 and abs(r.d - 504_400) < 2_000 and r.m == pytest.approx(2 / 3) and r.none is None and r.h is False
