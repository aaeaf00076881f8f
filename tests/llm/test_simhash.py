import random

import numpy as np
import pandas as pd
import xxhash

from pointframe.llm import queries as Q
from pointframe.llm.components import connected_components
from pointframe.llm.simhash import fingerprint, hamming_forest, simhash_components


def slow_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in low.replace("\t", " ").replace("\n", " ").replace("\v", " ").replace("\f", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def slow_components(ids, fps, bits):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    f = np.array(fps, np.uint64)
    for i in range(len(f)):
        for j in np.flatnonzero(np.bitwise_count(f[i + 1 :] ^ f[i]) <= bits) + i + 1:
            root[find(int(j))] = find(i)
    least = {}
    for i, x in enumerate(ids):
        if x is not None:
            r = find(i)
            least[r] = min(least.get(r, x), x)
    return [least.get(find(i)) for i in range(len(ids))]


def test_fingerprint_against_slow_form():
    for t in [None, "", " \n", "A b", "Ä É x", "one two three", "a\tb\vc\fd\re  f", "x " * 70000, "no break space here too"]:
        assert fingerprint(t if t is None else t.encode()) == slow_fingerprint(t)


def test_query_equals_brute_force(spark, sf):
    got = Q.op1_simhash(spark, sf).toPandas().set_index("doc_id")
    docs = pd.read_parquet(f"{sf}/documents.parquet")
    fps = [slow_fingerprint(t) for t in docs.text]
    want = dict(zip(docs.doc_id, slow_components(list(docs.doc_id), fps, 2), strict=True))
    assert len(got) == len(docs)
    assert [got.fingerprint[i] for i in docs.doc_id] == [f"{f:016x}" for f in fps]
    assert {i: int(got.component_id[i]) for i in docs.doc_id} == want


def test_forest_with_small_nodes(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(40)]
    fps = list({b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(5))) & (2**64 - 1) for b in base for _ in range(40)})
    signed = [f - (f >> 63 << 64) for f in fps]
    for bits, limit in ((2, 8), (2, 20_000), (3, 30)):
        forest = hamming_forest(spark.createDataFrame([(x,) for x in signed], "fp long"), bits, limit)
        nodes = {r.node: r.root for r in connected_components(forest).collect()}
        want = slow_components(signed, fps, bits)
        assert [nodes.get(x, x) for x in signed] == want


def test_edge_rows(spark):
    rows = [(1, None, 9), (2, "", 9), (3, " \n ", 9), (None, "a b c d", 9), (7, "a b c d", 9), (7, "A B C D", 9), (None, "solo words only here", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, component long").withColumnRenamed("component", "fp")
    got = simhash_components(df, width=3).collect()
    assert len(got) == len(rows)
    assert sorted((r.doc_id or -1, r.component or -1) for r in got) == [(-1, -1), (-1, 7), (1, 1), (2, 1), (3, 1), (7, 7), (7, 7)]
    assert simhash_components(df.limit(0)).count() == 0


def test_chain_of_links(spark):
    n = 300
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(5, 5), (None, 3)], "a long, b long")
    got = {r.node: r.root for r in connected_components(edges).collect()}
    assert got == dict.fromkeys(range(n + 1), 0)
    assert connected_components(edges.limit(0)).count() == 0
