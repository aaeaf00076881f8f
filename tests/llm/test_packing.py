import zlib

import numpy as np
import pandas as pd
import public_tokenizers as P
from tokenizers import Tokenizer

from pointframe.llm import packing
from pointframe.llm import queries as Q

PATH = P.path("byte_bpe_50k.json")


def reference():
    return Tokenizer.from_file(PATH)


def check(got, ids_of, capacity):
    for doc, part in got.groupby("doc_id"):
        part, ids, at = part.sort_values("start"), ids_of[doc], 0
        for p in part.itertuples():
            assert p.start == at and p.length > 0 and p.doc_tokens == len(ids)
            own = np.array(ids[at : at + p.length], "<u4").tobytes()
            assert p.ids_crc32 == zlib.crc32(own) if hasattr(p, "ids_crc32") else bytes(p.ids) == own
            at += p.length
        assert at == len(ids)
    for _, seq in got.groupby("sequence_id"):
        seq = seq.sort_values("offset")
        assert list(seq.offset) == [0, *seq.length.cumsum()[:-1]]
        assert seq.length.sum() <= capacity


def test_query(spark, sf):
    docs = pd.read_parquet(f"{sf}/documents.parquet")
    tok = reference()
    ids = {d: [*e.ids, 0] for d, e in zip(docs.doc_id, tok.encode_batch(list(docs.text), add_special_tokens=False), strict=True)}
    got = Q.op10_packing(spark, sf).toPandas()
    assert set(got.doc_id) == set(docs.doc_id)
    check(got, ids, 1024)
    assert got.length.sum() / (1024 * got.sequence_id.nunique()) > 0.97


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "a b c " * 3000), (4, "<|endoftext|> it's  \n 'll")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as start", "'x' as ids")
    tok = reference()
    got = packing.pack(df, PATH, P.PATTERN, capacity=64, stretch_windows=4).toPandas()
    check(got, {d: [*tok.encode(t or "", add_special_tokens=False).ids, 0] for d, t in rows}, 64)
    assert len(got[got.doc_id == 4]) and 50256 in np.frombuffer(got[got.doc_id == 4].ids.iloc[0], "<u4")
    assert packing.pack(df.limit(0), PATH, P.PATTERN).count() == 0
    twice = packing.pack(df.where("doc_id = 2").union(df.where("doc_id = 2")), PATH, P.PATTERN).toPandas()
    assert len(twice) == 2


def test_differencing_balances():
    rng = np.random.default_rng(1)
    sizes = [int(x) for x in rng.integers(1, 300, 900)]
    windows = packing.karmarkar_karp(sizes, 40)
    assert sorted(i for w in windows for i in w) == list(range(900))
    sums = [sum(sizes[i] for i in w) for w in windows]
    assert max(sums) - min(sums) <= 12
    assert packing.partition([5, 5, 5], 7) and len(packing.partition([5, 5, 5], 7)) == 3


def test_encoder_gives_the_ids_of_the_tokenizers_library():
    rng = np.random.default_rng(4)
    alphabet = list("aab eé\n'stll  12日本🙂\x00-<|endoftext|>ÑßЖ\u00a0\u2003")
    texts = ["".join(rng.choice(alphabet, rng.integers(0, 300))) for _ in range(1500)] + ["<|endoftext|>", "x  <|endoftext|>  y", "<|endoftext|><|endoftext|> <|endof", "a" * 4000, " \n" * 500]
    want = reference().encode_batch(texts, add_special_tokens=False)
    own = packing.encoder(PATH, P.PATTERN)
    assert [own.encode(t, allowed_special="all") for t in texts] == [e.ids for e in want]
    assert own.encode("a<|endoftext|>b", allowed_special="all") == [64, 50256, 65]
