import numpy as np
import pandas as pd

from pointframe.llm import ann, embedding_dedup
from pointframe.llm import queries as Q

NAN, INF = float("nan"), float("inf")


def brute_links(x, threshold):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    g = u @ u.T >= threshold
    np.fill_diagonal(g, False)
    return g


def brute_components(g, ids):
    out = np.array(ids)
    while True:
        new = np.minimum(out, np.where(g, out[None], max(ids)).min(1))
        if (new == out).all():
            return out
        out = new


def test_links_equal_brute_force(spark, sf):
    got = Q.op3_embedding_dedup(spark, sf).toPandas().sort_values("vec_id")
    e = pd.read_parquet(f"{sf}/embeddings.parquet").sort_values("vec_id")
    g = brute_links(np.stack(e.embedding).astype(float), 0.9)
    assert list(got.vec_id) == list(e.vec_id)
    assert list(got.n_links) == list(g.sum(1))
    assert list(got.component_id) == list(brute_components(g, list(e.vec_id)))
    assert list(got.kept) == list(got.vec_id == got.component_id)


def test_large_near_group_in_tiles(spark):
    rng = np.random.default_rng(2)
    c = rng.standard_normal((3, 48))
    x = np.concatenate([c[i % 3] + 0.28 * rng.standard_normal((300, 48)) for i in range(3)] + [rng.standard_normal((300, 48))])
    df = spark.createDataFrame([(i, [float(y) for y in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = embedding_dedup.near_duplicate_vectors(df, 0.9, tile=64).toPandas().sort_values("vec_id")
    g = brute_links(x, 0.9)
    assert g.sum() > 50_000
    assert abs(got.n_links.to_numpy() - g.sum(1)).sum() <= 0.002 * g.sum()
    assert (got.n_links.to_numpy() <= g.sum(1)).all()
    assert list(got.component) == list(brute_components(g, list(range(len(x)))))


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(0)
    x = embedding_dedup.padded(rng.standard_normal((200, 100)) + 0.7)
    true, off = x @ x.T, ~np.eye(len(x), dtype=bool)
    err = []
    for seed in range(12):
        code, f = embedding_dedup.level_code(x @ embedding_dedup.rotation(x.shape[1], seed))
        c = embedding_dedup.unpacked(code)
        assert ((c > 0) == (x @ embedding_dedup.rotation(x.shape[1], seed) > 0)).all() and code.shape[1] * 2 == x.shape[1]
        e = embedding_dedup.estimate(c, f, c, f) - true
        assert (abs(e) <= embedding_dedup.error_bound(f[:, None], f[None], x.shape[1], 5.0))[off].mean() > 0.9999
        assert (abs(e) <= embedding_dedup.error_bound(f[:, None], f[None], x.shape[1], None)).all()
        err.append(e[off].mean())
    assert abs(np.mean(err)) < 0.002 and embedding_dedup.error_bound(f, f, x.shape[1], 5.0).max() < 0.1


def test_exact_mode_loses_no_link(spark):
    rng = np.random.default_rng(4)
    c = rng.standard_normal((40, 24))
    x = np.concatenate([c[i % 40] + 0.33 * rng.standard_normal((1, 24)) for i in range(900)])
    df = spark.createDataFrame([(i, [float(y) for y in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = embedding_dedup.near_duplicate_vectors(df, 0.9, tile=200, exact=True).toPandas().sort_values("vec_id")
    g = brute_links(x, 0.9)
    assert list(got.n_links) == list(g.sum(1)) and list(got.component) == list(brute_components(g, list(range(len(x)))))


def test_unusable_vectors_copies_and_empty_table(spark):
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [NAN, 1.0]), (6, [INF, 1.0]), (7, [1.0, 0.0]), (8, [1.0, 0.0]), (8, [1.0, 0.0]), (9, [2.0, 0.01]), (10, [1.0, 0.0, 0.0]), (None, [0.0, 1.0]), (11, [0.0, 5.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as n", "2 as node", "'x' as v")
    got = sorted(((r.vec_id or -1, r.n_links, r.component) for r in embedding_dedup.near_duplicate_vectors(df).collect()))
    assert got == [(-1, 1, 11), *((i, 0, i) for i in range(1, 7)), (7, 3, 7), (8, 3, 7), (8, 3, 7), (9, 3, 7), (10, 0, 10), (11, 1, 11)]
    assert embedding_dedup.near_duplicate_vectors(df.limit(0)).count() == 0
    found = ann.search(df, df.where("vec_id in (7, 4, 10)"), k=20).collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in sorted(found, key=lambda r: r["rank"])] == [(7, 1, 9), (7, 2, 8), (7, 3, 11)]
    assert ann.search(df.limit(0), df, k=3).count() == 0


def brute_top(x, ids, queries, k):
    out = {}
    for q in queries:
        s = np.einsum("ij,j->i", x, x[ids.index(q)])
        out[q] = sorted(((-a, i) for a, i in zip(s, ids, strict=True) if i != q))[:k]
    return out


def test_search_recall_and_scores(spark, sf):
    for scale in (False, True):
        e = pd.read_parquet(f"{sf}/embeddings.parquet")
        x, ids = np.stack(e.embedding).astype(float), list(e.vec_id)
        if scale:
            x = x * (1 + np.arange(len(x)) % 5)[:, None]
        df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<double>")
        got = ann.search(df, df.where("vec_id % 20 = 0"), k=20).toPandas()
        want = brute_top(x, ids, [i for i in ids if i % 20 == 0], 20)
        hit = 0
        for q, part in got.sort_values("rank").groupby("query_id"):
            assert list(part["rank"]) == list(range(1, 21)) and q not in set(part.vec_id)
            assert np.allclose(part.score, [x[ids.index(v)] @ x[ids.index(q)] for v in part.vec_id], rtol=0, atol=1e-12)
            assert [(-s, v) for s, v in zip(part.score, part.vec_id, strict=True)] == sorted((-s, v) for s, v in zip(part.score, part.vec_id, strict=True))
            hit += len(set(part.vec_id) & {i for _, i in want[q]})
        assert set(got.query_id) == set(want)
        assert hit / (20 * len(want)) >= 0.9


def test_ties_and_small_blocks(spark):
    rows = [(i, [1.0, 0.0, 0.0, 1.0]) for i in range(200)] + [(i, [0.0, float(i), 1.0, 1.0]) for i in range(200, 260)]
    for scale in (1.0, 1e-6, 1e5):
        df = spark.createDataFrame([(i, [scale * x for x in v]) for i, v in rows], "vec_id long, embedding array<double>")
        got = ann.search(df, df.where("vec_id in (0, 100)"), k=5, block=16).collect()
        by = {q: [r.vec_id for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q] for q in (0, 100)}
        want = {q: [i for _, i in brute_top(np.array([v for _, v in rows]), list(range(260)), [q], 5)[q]] for q in (0, 100)}
        assert by == want
    copies = spark.createDataFrame([(i, [1e5 * x for x in (0.3, -1.7, 0.11, 0.9, 2.2)]) for i in range(300)], "vec_id long, embedding array<double>")
    got = ann.search(copies, copies.where("vec_id in (0, 100)"), k=5, block=7).collect()
    assert {q: [r.vec_id for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q] for q in (0, 100)} == {0: [1, 2, 3, 4, 5], 100: [0, 1, 2, 3, 4]}


def test_cells_join_rotations_as_rows_grow(spark):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((60, 16)) * 4
    x = np.concatenate([c + 0.4 * rng.standard_normal((40, 16)) for c in centres])
    df = spark.createDataFrame([(i, [float(y) for y in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    sample = df.limit(64).withColumnsRenamed({"vec_id": "id", "embedding": "v"}).toArrow()
    unit = ann._Unit(float(np.linalg.norm(x, axis=1).max()), True)
    base = df.withColumnsRenamed({"vec_id": "id", "embedding": "v"})
    rotations, probes = ann._calibrated(base, sample, 10, 2, 2, 0.97, unit, 11)
    assert rotations == 2 and probes < 64 * 64 / 4
    got = ann.search(df, df.where("vec_id % 20 = 0"), k=10, cell_rows=8, block=100).toPandas()
    want = brute_top(x, list(range(len(x))), range(0, len(x), 20), 10)
    hit = sum(len(set(part.vec_id) & {i for _, i in want[q]}) for q, part in got.groupby("query_id"))
    assert (got.groupby("query_id").size() == 10).all() and hit >= 0.93 * 10 * len(want)
    u = unit(x[:50], True)
    for r in (1, 2):
        order = ann.probed(u, 1, r, 10**6, 11)
        assert (np.sort(order, axis=1)[:, 1:] != np.sort(order, axis=1)[:, :-1]).all()
        if r == 1:
            assert (order[:, 0] == ann.cells_of(u, 1, 1, 11)).all() and order.shape[1] == 64
