"""Driver queries over the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from . import ann, bpe, embedding_dedup, packing, pii, secrets, sharding, simhash, toxicity, url_filter


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.simhash_components(_table(spark, sf_dir, "documents"), max_bits=2, width=3)
    return out.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), F.col("component").alias("component_id"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_table(spark, sf_dir, "documents"))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = embedding_dedup.near_duplicate_vectors(_table(spark, sf_dir, "embeddings"), threshold=0.9)
    return out.select("vec_id", "n_links", F.col("component").alias("component_id"), "kept")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.histogram_shards(_table(spark, sf_dir, "documents"), shards=24)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(_table(spark, sf_dir, "pages"))


def op8_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    return ann.search(rows, rows.where("vec_id % 20 = 0"), k=20)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the key of a real run comes from its owner; this one is public
    return pii.replace_private(_table(spark, sf_dir, "documents"), secret="public key of the driver's runs")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    pieces = packing.pack(_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, capacity=1024)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


QUERIES = {f.__name__: f for f in (op1_simhash, op2_secrets, op3_embedding_dedup, op4_sharding, op5_bpe, op6_toxicity, op7_url_filter, op8_ann, op9_pii, op10_packing)}

#: The other operators rest on hashes, tokenizers, fitted models or approximate search; tests hold them against brute force.
ORACLE_SQL: dict[str, str] = {
    "op3_embedding_dedup": """WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
        e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.x, b.x) >= 0.9),
        r AS (SELECT vec_id, vec_id AS m FROM v UNION SELECT r.vec_id, e.b FROM r JOIN e ON r.m = e.a),
        n AS (SELECT a AS vec_id, count(*) AS n FROM e GROUP BY a)
        SELECT r.vec_id, coalesce(any_value(n.n), 0) AS n_links, min(r.m) AS component_id, min(r.m) = r.vec_id AS kept FROM r LEFT JOIN n ON n.vec_id = r.vec_id GROUP BY r.vec_id""",
}
