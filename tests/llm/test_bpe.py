import hashlib
import random

import pandas as pd
import public_tokenizers as P
import tiktoken

from pointframe.llm import bpe
from pointframe.llm import queries as Q

PATH = P.path("byte_bpe_multi_50k.tiktoken")


def reference():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load(PATH, P.PATTERN).ranks, special_tokens={})


def test_query_equals_library(spark, sf):
    docs = pd.read_parquet(f"{sf}/documents.parquet").set_index("doc_id")
    enc = reference()
    for r in Q.op5_bpe(spark, sf).collect():
        ids = enc.encode_ordinary(docs.text[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs.text[r.doc_id].encode()).hexdigest()


def test_hard_words():
    rng = random.Random(5)
    texts = ["".join(rng.choice("aab eé\n'stll  12日本🙂\x00-<|endoftext|>") for _ in range(rng.randint(0, 200))) for _ in range(800)]
    texts += ["a" * 5000, "ab" * 4000, "ñ" * 3000, " " * 900, "x", ""]
    enc, own = reference(), bpe.load(PATH, P.PATTERN)
    for text, words in zip(texts, bpe._encoded(iter(texts), own, {}, tuple), strict=True):
        assert [i for w in words for i in w] == enc.encode_ordinary(text)


def test_edges(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (2, "", "y"), (None, "word word", "z")], "doc_id long, text string, ids string")
    got = bpe.round_trip(df, PATH, P.PATTERN).collect()
    assert sorted(r.n_tokens for r in got) == [0, 0, 0, 2]
    ids = bpe.encode(df, PATH, P.PATTERN)
    back = bpe.decode(ids, PATH, P.PATTERN).collect()
    assert sorted(bytes(r.bytes) for r in back) == [b"", b"", b"", b"word word"]
    assert bpe.round_trip(df.limit(0), PATH, P.PATTERN).count() == 0
