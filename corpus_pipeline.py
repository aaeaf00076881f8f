"""Corpus pipeline: toxicity, near-dedup, secret redaction, packing.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. ``run`` writes
each stage's rows as Parquet below the shared checkpoint folder and reads them again for the next; what
a stage has read is removed, the last stage's folder stays as the product.
SQL can't express the stages (a learned grammar, a trie walk under MinHash bands, a forest, a tokenizer), so
``ORACLE_SQL`` is None and the stages are tested against brute-force versions.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pointframe.llm import packing, secrets, simhash_similar, toxicity
from pointframe.llm.common import ensure_checkpoint_dir, remove
from pointframe.workers import with_workers

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar doesn't reject (score below 0.7)."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(toxicity.training_rows(docs, labels, max_train=20_000))
    return toxicity.score(docs.select(*COLUMNS), model).where("predicted = 0").select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles alike to 0.8 or more): the one with the smallest id."""
    return simhash_similar.drop_near_copies(docs.select(*COLUMNS))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret replaced by its kind; ``n_chars`` follows the new text."""
    out = secrets.redact(docs.select(*COLUMNS))
    return out.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars")).select(*COLUMNS)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, with their token ids, in windows of 1,024 tokens."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(docs, path, public_tokenizers.PATTERN, capacity=1024)


STAGES = [
    ("toxicity", with_workers(drop_toxic)),
    ("simhash_dedup", with_workers(drop_near_copies)),
    ("secrets", with_workers(redact_secrets)),
    ("packing", with_workers(pack_windows)),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    last = None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if last:
            remove(spark, last)
        last = f"{folder}/{name}"
    return docs
