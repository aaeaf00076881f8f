import zlib

import pandas as pd

from pointframe.llm import queries as Q
from pointframe.llm.sharding import histogram_shards


def check(got, docs, shards, tolerance=None):
    assert len(got) == len(docs)
    for s, part in got.groupby("shard"):
        assert 0 <= s < shards
        assert sorted(part.slot) == list(range(len(part)))
    sizes = got.groupby("shard")["size"].sum().reindex(range(shards), fill_value=0)
    largest = got["size"].max()
    mean = got["size"].sum() / shards
    assert (abs(sizes - mean) <= 2 * max(largest, 0.01 * mean)).all()


def test_query(spark, sf):
    docs = pd.read_parquet(f"{sf}/documents.parquet").set_index("doc_id")
    got = Q.op4_sharding(spark, sf).toPandas()
    assert got.doc_id.is_unique
    check(got, docs, 24)
    data = [docs.text[i].encode() for i in got.doc_id]
    assert list(got["size"]) == [len(b) + 8 for b in data]
    assert list(got.text_crc32) == [zlib.crc32(b) for b in data]
    assert set(got.law) == {"bytes"} and got.grown_shard.isna().all()


def test_hot_group_repeats_and_nulls(spark):
    rows = [(i, "same text") for i in range(3000)] + [(i, f"text {i} " * (i % 7)) for i in range(3000, 6000)] + [(1, "same text")] * 5 + [(None, None)] * 40 + [(i, None) for i in range(9000, 9100)] + [(9999, "long " * 5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as shard", "2 as slot", "3 as key", "4 as bin")
    check(histogram_shards(df, 7).toPandas(), rows, 7)
    assert histogram_shards(df.limit(0)).count() == 0
    one = histogram_shards(df, 1).toPandas()
    assert set(one.shard) == {0} and sorted(one.slot) == list(range(len(rows)))


def test_small_groups_stay_whole(spark):
    rows = [(i, f"copy {i // 4} " * 3) for i in range(40_000)]
    got = histogram_shards(spark.createDataFrame(rows, "doc_id long, text string"), 8).toPandas()
    check(got, rows, 8)
    assert (got.assign(g=got.doc_id // 4).groupby("g").shard.nunique() == 1).all()
