import random
import re
import zlib

import numpy as np
import pandas as pd

from pointframe.llm import queries as Q
from pointframe.llm import toxicity as T


def test_grammar_marks_clauses():
    s = T.Scorer(T.Model())
    alone = [1.0, 0, 0, 0, 0, 0]
    for text, mark in (("what an idiot", T.PLAIN), ("you are an idiot", T.AIMED), ("an idiot, she is", T.AIMED), ("Not an idiot!", T.NEGATED), ("She said idiot", T.REPORTED), ("The word scum describes foam on a pond", T.REPORTED), ("no. an idiot", T.PLAIN), ("what an idiot, what a moron", T.RUN), ("an idiot here. a moron there", T.RUN), ("idiot. idiot", T.RUN), ("he called them, repeatedly and loudly, an idiot", T.REPORTED)):
        marks = {m for _, m, _ in s.marked(text)[0]}
        assert marks == {mark}, text
        f = s.features(text)
        assert (f[:6] == alone) if mark == T.PLAIN else [i for i in range(1, 5) if f[i]] == [mark], text
    assert s.features("idiot. moron. idiot. idiot")[T.RUN] == s.features("idiot. moron")[T.RUN]  # repeated clauses count once
    assert s.features("idiot. " + "fine words. " * 3 + "moron")[T.RUN] > 0
    far = "idiot. " + " ".join(f"fine words {'x' * i}." for i in range(T._RUN + 1)) + " moron"
    assert s.features(far)[T.RUN] == 0
    assert s.score("you are an idiot") >= 0.7 > s.score("you are not an idiot") and s.score("he said you are an idiot") < 0.7
    assert s.score("I will kill you") >= 0.7 > s.score("they said I will kill you")
    assert s.score("The word scum describes foam on a pond") < 0.7 and s.score("Scum floats on the pond") < 0.7
    assert s.features(None) == s.features("") == [1.0, 0, 0, 0, 0, 0, 0]


def slow_marked(scorer, text):
    """What the grammar marks, by looking back and forth from every word."""
    clauses, insults, threats, words = [], [], 0, 0
    for c in re.split(r"[.!?;\n]+", (text or "").lower()):
        clauses.append(c.strip())
    for at, clause in enumerate(sorted(set(clauses), key=clauses.index)):
        found = T._WORD.findall(clause)
        words += len(found)
        kinds = [scorer.symbol(w) for w in found]
        for i, (kind, weight) in enumerate(kinds):
            near = [k for j, (k, _) in enumerate(kinds) if 0 < abs(i - j) <= 6]
            back = [k for k, _ in kinds[:i]]
            aimed = T.TARGET in near or kind == T.INSULT and T.PERSON in near
            quiet = T.REPORT in back or T.NEGATION in back[-3:]
            if kind == T.THREAT and aimed and not quiet:
                threats += 1
            if kind == T.INSULT:
                insults.append([at, T.REPORTED if T.REPORT in back else T.NEGATED if quiet else T.AIMED if aimed else T.PLAIN, weight, clauses.count(clause) > 1])
    loud = [x for x in insults if x[1] in (T.PLAIN, T.AIMED)]
    for x in insults:
        if x[1] == T.PLAIN and (x[3] or any(y is not x and abs(x[0] - y[0]) <= T._RUN for y in loud)):
            x[1] = T.RUN
    return [tuple(x[:3]) for x in insults], threats, words


def test_grammar_equals_a_plain_interpreter(sf):
    rng = random.Random(3)
    words = T.INSULTS[:9] + T.THREATS[:4] + T.TARGETS[:4] + T.PERSONS[:4] + T.NEGATIONS[:3] + T.REPORTS[:4] + ["fine"] * 25 + [".", "!", "\n", "; "] * 3
    texts = [" ".join(rng.choices(words, k=rng.randrange(60))) for _ in range(1500)] + [" ".join(rng.choices(["idiot", *["calm."] * 70, "moron"], k=400)) for _ in range(20)]
    texts += list(pd.read_parquet(f"{sf}/documents.parquet").text)
    s, seen = T.Scorer(T.Model()), set()
    s.model.stems["achl"] = 2.5
    for t in texts:
        got = s.marked(t)
        assert got == slow_marked(s, t), t
        seen |= {m for _, m, _ in got[0]}
    assert seen == {T.PLAIN, T.AIMED, T.RUN, T.NEGATED, T.REPORTED}


def test_composition_equals_running_both():
    a, b = T._memory(T.NEGATION, T.NEGATED, 2), T._memory(T.REPORT, T.REPORTED, None)
    both = T.composed(a, b)
    rng = np.random.default_rng(0)
    for _ in range(200):
        p = q = r = "0"
        for s in rng.integers(0, len(T.SYMBOLS), 12).tolist():
            (p, m), (q, n), (r, o) = a[p, s], b[q, s], both[r, s]
            assert o == m | n


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = Q.op6_toxicity(spark, sf).toPandas()
    docs, labels = pd.read_parquet(f"{sf}/documents.parquet"), pd.read_parquet(f"{sf}/labels.parquet")
    assert sorted(got.doc_id) == sorted(docs.doc_id)
    assert list(got.held_out) == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.doc_id]
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.7)).all()
    h = got[got.held_out].merge(labels, on="doc_id")
    assert (h[h.predicted == 1].toxic == 1).mean() > 0.97
    assert (h[h.toxic == 1].predicted == 1).mean() > 0.93


def test_nothing_is_learned_from_held_out_rows_or_other_columns(spark):
    n = 600
    train = [i for i in range(n) if zlib.crc32(str(i).encode()) % 3 != 1]
    docs = spark.createDataFrame([(i, f"word{i % 7} common text zorgle{'x' if i % 2 else ''}" if i % 2 == 0 else "common text", "en" if i % 2 else "de", 5) for i in range(n)], "doc_id long, text string, lang string, score long")
    labels = spark.createDataFrame([(i, int(i % 2 == 0), "z") for i in range(n)], "doc_id long, toxic long, text string")
    rows = T.training_rows(docs, labels, 10_000).collect()
    assert len(rows) == len(train)
    held = labels.where("crc32(cast(doc_id as string)) % 3 = 1")
    assert T.training_rows(docs, held, 10_000).count() == 0
    assert 50 < T.training_rows(docs, labels, 100).count() < 160


def test_edges(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (2, ""), (None, "you idiot, you stupid idiot, you scum"), (4, "fine words " * 30_000)], "doc_id long, text string").selectExpr("*", "'x' as score", "1 as predicted")
    labels = spark.createDataFrame([(1, None), (2, 1), (2, 0), (None, 1), (9, 1)], "doc_id long, toxic int")
    got = T.toxicity(docs, labels).collect()
    assert len(got) == 5 and sum(r.predicted for r in got) == 1
    assert [r.held_out for r in got if r.doc_id is None] == [True]
    assert T.toxicity(docs.limit(0), labels).count() == 0
    kept = T.score(docs, T.Model())
    assert kept.columns == ["doc_id", "text", "score", "predicted"]


def test_targets_on_both_sides():
    s = T.Scorer(T.Model())
    aimed, run, threats = T.AIMED, T.RUN, 5
    for text in ("you I will kill", "I will kill you", "we destroy you all", "ich werde dich töten", "wir vernichten euch", "kill one two three four five you"):
        assert s.features(text)[threats] == 1, text
    for text in ("I will kill", "I will not kill you", "she said I will kill you", "I will kill. You", "kill one two three four five six you"):
        assert s.features(text)[threats] == 0, text
    for text in ("they kill him", "the lions hurt her"):  # another person isn't threatened by being spoken of
        assert s.features(text)[threats] == 0, text
    assert s.features("idiot, you")[aimed] == s.features("you idiot")[aimed] > 0 == s.features("idiot, you")[run]
