import tracemalloc

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline as C
from pointframe.llm import common, packing, secrets, simhash, simhash_similar, toxicity

from .test_packing import check


def test_stages_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = C.drop_toxic(spark, docs, sf).toPandas()
    model = toxicity.train(toxicity.training_rows(docs, spark.read.parquet(f"{sf}/labels.parquet"), 20_000))
    raw, scorer = docs.toPandas(), toxicity.Scorer(model)
    assert set(kept.doc_id) == {i for i, t in zip(raw.doc_id, raw.text, strict=True) if scorer.score(t) < 0.7}
    assert list(kept.columns) == C.COLUMNS and len(kept) < len(raw)

    once = C.drop_near_copies(spark, spark.createDataFrame(kept, docs.schema), sf).toPandas()
    assert sorted(once.doc_id) == slow_near_copies(list(kept.doc_id), list(kept.text)) and list(once.columns) == C.COLUMNS

    safe = C.redact_secrets(spark, spark.createDataFrame(once, docs.schema), sf).toPandas().set_index("doc_id")
    forest = secrets.default_forest()
    for r in once.itertuples():
        found = secrets._judged([r.text], forest, 0.5)[0]
        assert safe.text[r.doc_id].count("[SECRET:") == len(found) and (found or safe.text[r.doc_id] == r.text)
        assert safe.n_chars[r.doc_id] == len(safe.text[r.doc_id])

    pieces = C.run(spark, sf).toPandas()
    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    ids = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 0] for i, t in safe.text.items()}
    assert set(pieces.doc_id) == set(safe.index)
    check(pieces, ids, 1024)


def test_stages_on_odd_rows(spark, tmp_path):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (3, "a b c d", None, "s", None), (3, "other words here now", "en", None, 4), (None, "alone in the world today", "en", "s", 1), (None, None, "en", "s", 1), (7, "long " * 50_000, "en", "s", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "1 as fp", "2 as root", "3 as score")
    spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int").selectExpr("*", "1 as text").write.parquet(str(tmp_path / "labels.parquet"))
    for frame in (docs, docs.limit(0)):
        n = frame.count()
        step = frame
        for name, stage in C.STAGES:
            stage(spark, step, str(tmp_path)).write.parquet(str(tmp_path / f"{n}-{name}"))
            step = spark.read.parquet(str(tmp_path / f"{n}-{name}"))
            if name == "simhash_dedup":
                got = sorted((r.doc_id or -1, r.text or "") for r in step.collect())
                assert [g[0] for g in got] == ([-1, 1, 3, 3, 7] if n else [])
        assert n == 0 or step.count() > 0


def test_registered_and_complete():
    q = entry.queries()
    assert [n for n, _ in C.STAGES] == ["toxicity", "simhash_dedup", "secrets", "packing"]
    assert "pipeline" in q and all(any(k.startswith(f"op{n}_") for k in q) for n in range(1, 11))


@pytest.mark.parametrize("local", [0, 10**6])
def test_rows_are_named_and_kept_once(spark, local):
    rows = [(i % 40, f"text {i % 80}", i % 40) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept_id long").selectExpr("*", "map('a', named_struct('b', 1)) as kept_hash")
    names = simhash.named_rows(docs, "doc_id", "text").select("who")
    kept = names.where("who.id < 30").distinct()
    out = simhash.only_named(docs, names, kept, local)
    assert sorted((r.doc_id, r.text) for r in out.collect()) == sorted({r[:2] for r in rows if r[0] < 30}) and out.columns == ["doc_id", "text", "kept_id", "kept_hash"]


def slow_near_copies(ids, texts):
    """The smallest id of each component of texts whose five-word shingles are alike to 0.8 or more."""
    words = [t.encode().lower().split() for t in texts]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in words]
    root = list(range(len(ids)))
    find = lambda x: x if root[x] == x else find(root[x])
    for i in range(len(ids)):
        for j in range(i):
            small, large = sorted((len(sets[i]), len(sets[j])))
            if small >= 0.8 * large and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                root[max(find(i), find(j), key=lambda x: ids[x])] = min(find(i), find(j), key=lambda x: ids[x])
    return sorted({ids[find(i)] for i in range(len(ids))})


def test_near_copies_by_five_word_shingles(spark, sf):
    rng = np.random.default_rng(5)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    raw = docs.toPandas()
    rows = list(raw.itertuples(index=False, name=None))
    for r in raw[raw.text.str.split().str.len() >= 300].head(25).itertuples():
        for copy in range(3):
            words = r.text.split()
            words[7 + copy :: 50] = [f"changed{x}" for x in rng.integers(0, 10**9, len(words[7 + copy :: 50]))]
            rows.append((10**6 + 10 * r.doc_id + copy, " ".join(words), r.lang, r.source, r.n_chars))
    got = C.drop_near_copies(spark, spark.createDataFrame(rows, docs.schema), sf)
    assert sorted(r.doc_id for r in got.collect()) == slow_near_copies([r[0] for r in rows], [r[1] for r in rows])


def test_large_bands_go_by_a_pivot_and_lose_no_link(spark, sf, monkeypatch):
    rng = np.random.default_rng(6)
    texts, vocabulary = [], [f"w{i}" for i in range(4000)]
    for size, change in ((150, 12), (90, 25), (60, 40)):  # groups of near copies, the last ones at and below the threshold
        base = rng.choice(vocabulary, 260)
        for _ in range(size):
            words = base.copy()
            at = rng.choice(260, int(rng.integers(0, change)) // 4, replace=False)
            words[at] = rng.choice(vocabulary, len(at))
            texts.append(" ".join(words))
    texts += [" ".join(rng.choice(vocabulary, 80)) for _ in range(100)] + ["", None, "one two"]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    want = slow_near_copies(list(range(len(texts))), [t or "" for t in texts])
    monkeypatch.setattr(simhash_similar, "_BLOCK", 50)
    for star in (20, 1000):
        monkeypatch.setattr(simhash_similar, "_STAR", star)
        assert sorted(r.doc_id for r in simhash_similar.drop_near_copies(docs).collect()) == want


def peak_mb(f):
    tracemalloc.start()
    out = f()
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    return out, peak


def test_a_block_of_alike_texts_is_compared_in_little_memory():
    rng = np.random.default_rng(7)
    rows = np.tile(rng.integers(-(2**62), 2**62, 120), (2000, 1))
    rows[np.arange(2000), rng.integers(0, 120, 2000)] = rng.integers(-(2**62), 2**62, 2000)
    sets = pa.array(list(rows), pa.list_(pa.int64()))
    pairs, peak = peak_mb(lambda: sum(len(p) for p, _ in simhash_similar.alike_pairs(sets, 1000, 0.8)))
    assert pairs == 1000 * 1000 and peak < 30
    p, q = np.triu_indices(1000, 1)
    tree, peak = peak_mb(lambda: simhash_similar.spanning_tree(p, q, 1000))
    assert tree == list(range(999)) and peak < 20


def test_pairs_of_a_block_against_sets():
    rng = np.random.default_rng(8)
    sets = [set(rng.integers(0, 12, int(n)).tolist()) for n in rng.integers(0, 14, 300)]
    got = [(p, q) for ps, qs in simhash_similar.alike_pairs(pa.array(list(map(list, sets)), pa.list_(pa.int64())), 130, 0.5) for p, q in zip(ps, qs, strict=True)]
    want = [(p, q) for p in range(130, 300) for q in range(130) if (sets[p] or sets[q]) and len(sets[p] & sets[q]) >= 0.5 * len(sets[p] | sets[q])]
    assert got == want and got
    for lone in ([[1], [2]], [[1, 2]], []):
        assert not sum(len(p) for p, _ in simhash_similar.alike_pairs(pa.array(lone, pa.list_(pa.int64())), len(lone) // 2, 0.5))


def test_workers_give_freed_memory_back(monkeypatch):
    given = []
    monkeypatch.setattr(common, "give_back", lambda: given.append(1))
    assert list(common.trimmed(iter)([1, 2])) == [1, 2] and given == [1]
    monkeypatch.undo()
    common.give_back()
