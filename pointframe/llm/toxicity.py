"""Toxicity by a weighted finite-state pattern grammar.

A lexical transducer maps each word of a clause to a symbol (insult, threat, person spoken to, other person,
negation, reported speech, other) and, for insults, a weight. Four transducers read the symbols of a clause and
mark its insults and threats: one remembers a negation for a few words, one a verb of speech or a word about words
("the word ...") for the rest of the clause, one the person spoken to and one other persons. Each of the first
two reads forwards; the persons' run both ways, so a target counts on either side. What a direction composes is one
table, built in advance. A fifth transducer reads the sequence of insults of the text and marks those that come in a run:
another insult lies within ``_RUN`` clauses, or the clause itself occurs again.

A clause matches where an insult is aimed at a person, stands in a run, or a threat meets the person
spoken to; negated and reported ones match patterns of their own with little weight. A word that matches no
pattern, an insult alone in its text included, weighs nothing. A document is scored from the weights of its
matched clauses.

The general word lists are fixed. Insult stems of the corpus at hand are learned from labelled
documents: word beginnings and words that are much more frequent in documents labelled toxic. A hit
weighs the logarithm of its rates in the two classes, every word costs the difference of the rates
(so long clean texts don't add up chance hits), and repeated clauses count once. How much each mark
counts is a logistic fit with the grammar's own weights as prior means.

Learning reads a bounded sample of labelled rows (``max_train``, drawn by a hash of the id) and keeps the
``max_stems`` best stems; only counts of the best ``14 * max_stems`` of them and seven numbers a sampled document
reach the driver. Scoring is one pass without an exchange.
"""

from __future__ import annotations

import math
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, spread, trimmed

# word lists of the grammar: fixed values
INSULTS = """idiot moron stupid loser pathetic worthless scum trash clown disgusting imbecile dumbass bastard
    dummkopf trottel abschaum versager arschloch imbécile connard débile salaud minable
    estúpido imbécil basura escoria perdedor""".split()
THREATS = "kill hurt destroy beat burn töten vernichten schlagen tuer détruire frapper matar destruir golpear".split()
TARGETS = "you your yourself yourselves u du dich dir ihr euch euer toi te vous ton ti tú tu usted ustedes vosotros".split()
PERSONS = "he she they him her them his their er sie ihn ihm il elle ils lui él ella ellos".split()
NEGATIONS = "not no never isn't aren't don't nicht kein keine nie pas jamais ne nunca ni".split()
REPORTS = """said says say called calls wrote reported claimed quoted sagte nannte dit appelé déclaré dijo llamó
    word words term expression wort begriff mot terme expresión palabra término""".split()

SYMBOLS = OTHER, INSULT, THREAT, TARGET, PERSON, NEGATION, REPORT = range(7)
PLAIN, AIMED, RUN, NEGATED, REPORTED = range(5)
_NEAR, _SHORT, _RUN = 6, 3, 60  # words that a person and a negation are remembered, clauses between the insults of a run

_CLAUSE = re.compile(r"[.!?;\n]+")
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")
_STEM_LENGTHS = range(3, 9)


def _clauses(text: str | None) -> Counter:
    """Distinct clauses of a text in their order, lower-cased, and how often each occurs."""
    return Counter(c.strip() for c in _CLAUSE.split((text or "").lower()))


def composed(a: dict, b: dict) -> dict:
    """Composition of two transducers ``{(state, symbol): (state, marks)}`` that read the same symbols."""
    start, table = ("0", "0"), {}
    queue, seen = deque([start]), {start}
    while queue:
        p, q = state = queue.popleft()
        for symbol in SYMBOLS:
            (p2, m), (q2, n) = a[p, symbol], b[q, symbol]
            table[state, symbol] = ((p2, q2), m | n)
            if (p2, q2) not in seen:
                seen.add((p2, q2))
                queue.append((p2, q2))
    names = {s: "0" if s == start else repr(s) for s in seen}
    return {(names[s], symbol): (names[t], marks) for (s, symbol), (t, marks) in table.items()}


def _memory(symbol: int, mark: int, span: int | None, reads: tuple[int, ...] = (INSULT, THREAT)) -> dict:
    """Transducer that marks what it reads for ``span`` words after ``symbol`` (None: to the end of the clause)."""
    last = span or 1
    table = {}
    for left in range(last + 1):
        for s in SYMBOLS:
            after = last if s == symbol else left if span is None else max(0, left - 1)
            table[str(left), s] = (str(after), frozenset({mark}) if left and s in reads else frozenset())
    return table


def grammar() -> tuple[dict, dict]:
    """The composed transducers: what marks forwards (negation, reported speech, persons) and backwards (persons)."""
    persons = composed(_memory(TARGET, AIMED, _NEAR), _memory(PERSON, AIMED, _NEAR, (INSULT,)))
    return composed(composed(_memory(NEGATION, NEGATED, _SHORT), _memory(REPORT, REPORTED, None)), persons), persons


def _marks(table: dict, symbols: list[int]) -> list[frozenset]:
    state, out = "0", []
    for s in symbols:
        state, marked = table[state, s]
        out.append(marked)
    return out


def runs(places: list[int]) -> list[bool]:
    """Whether each insult, by the number of its clause, has another within ``_RUN`` clauses: the run transducer, which
    remembers the last insult's clause, read forwards and backwards."""
    near = [b - a <= _RUN for a, b in zip(places, places[1:], strict=False)]
    return [before or after for before, after in zip([False, *near], [*near, False], strict=True)] if places else []


@dataclass
class Model:
    """Insult weights by word and by stem, the cost of a word, and the weights of the marks."""

    words: dict[str, float] = field(default_factory=lambda: dict.fromkeys(INSULTS, 6.0))
    stems: dict[str, float] = field(default_factory=dict)
    cost: float = 0.01
    # bias; insults aimed, in a run, negated and reported; aimed threats; words
    weights: tuple[float, ...] = (-2.2, 1.1, 1.0, 0.05, 0.05, 6.0, 1.0)


class Scorer:
    """Runs the grammar over texts; one for each task."""

    def __init__(self, model: Model):
        self.model, (self.table, self.backwards) = model, grammar()
        self.fixed = {w: (s, 0.0) for s, ws in ((THREAT, THREATS), (PERSON, PERSONS), (TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS)) for w in ws}
        self.fixed |= {w: (INSULT, v) for w, v in model.words.items()}
        self.known: dict[str, tuple[int, float]] = {}

    def symbol(self, word: str) -> tuple[int, float]:
        """The lexical transducer: a word's symbol and weight; the longest stem that fits counts."""
        out = self.known.get(word)
        if out is None:
            out = self.fixed.get(word)
            if out is None:
                out = (OTHER, 0.0)
                for n in reversed(_STEM_LENGTHS):
                    if n < len(word) and word[:n] in self.model.stems:
                        out = (INSULT, self.model.stems[word[:n]])
                        break
            if len(self.known) > 200_000:
                self.known.clear()
            self.known[word] = out
        return out

    def marked(self, text: str | None) -> tuple[list[tuple[int, int, float]], int, int]:
        """Insults of a text as (clause, mark, weight), aimed threats and words; a clause counts once however often it occurs."""
        insults, threats, words, again = [], 0, 0, set()
        for at, (clause, times) in enumerate(_clauses(text).items()):
            found = _WORD.findall(clause)
            words += len(found)
            symbols = [self.symbol(w) for w in found]
            if not any(s in (INSULT, THREAT) for s, _ in symbols):
                continue
            read = [s for s, _ in symbols]
            for (s, weight), before, after in zip(symbols, _marks(self.table, read), reversed(_marks(self.backwards, read[::-1])), strict=True):
                marks = before | after
                if s == INSULT:
                    again |= {at} if times > 1 else set()
                    insults.append((at, next((m for m in (REPORTED, NEGATED, AIMED) if m in marks), PLAIN), weight))
                elif s == THREAT and AIMED in marks and not marks & {NEGATED, REPORTED}:
                    threats += 1
        plain = [i for i, (_, mark, _) in enumerate(insults) if mark in (PLAIN, AIMED)]
        for i, run in zip(plain, runs([insults[i][0] for i in plain]), strict=True):
            if (run or insults[i][0] in again) and insults[i][1] == PLAIN:
                insults[i] = (insults[i][0], RUN, insults[i][2])
        return insults, threats, words

    def features(self, text: str | None) -> list[float]:
        """What the fit weighs: 1; summed weights by mark, plain ones left out; aimed threats; minus the cost of the words. Sums end at 40."""
        insults, threats, words = self.marked(text)
        sums = [0.0] * 5
        for _, mark, weight in insults:
            sums[mark] += weight
        return [1.0, *(min(40.0, m) for m in sums[1:]), min(40.0, float(threats)), max(-40.0, -self.model.cost * words)]

    def score(self, text: str | None) -> float:
        z = sum(a * b for a, b in zip(self.model.weights, self.features(text), strict=True))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _stem_counts(texts: Iterator[tuple[str | None, int]]) -> Iterator[tuple[dict[str, list[int]], int]]:
    """Counts of stems and words, in stretches: documents and occurrences of each class."""
    counts: dict[str, list[int]] = {}
    for text, y in texts:
        own: Counter = Counter()
        total = 0
        for clause in _clauses(text):
            for w in _WORD.findall(clause):
                total += 1
                own[w + "$"] += 1
                own.update(w[:n] for n in _STEM_LENGTHS if n < len(w))
        own[""] = total
        for stem, n in own.items():
            c = counts.setdefault(stem, [0, 0, 0, 0])
            c[y] += 1
            c[2 + y] += n
        if len(counts) > 400_000:
            yield counts
            counts = {}
    yield counts


def training_rows(docs: DataFrame, labels: DataFrame, max_train: int, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """``text`` and ``y`` of labelled documents that may be learned from: crc32(id as text) mod 3 is not 1.

    Ids with contradicting or null labels are left out. At most about ``max_train`` rows are drawn by a
    hash of the id; that bound makes the drawn labels small enough to broadcast.
    """
    clean = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & (F.crc32(F.col(id_col).cast("string")) % 3 != 1))
    clean = clean.groupBy(id_col).agg(F.min(label_col).alias("y"), F.max(label_col).alias("y2")).where("y = y2").select(F.col(id_col).alias("labelled"), F.col("y").cast("int"))
    share = min(1.0, max_train / max(1, clean.count()))
    drawn = clean.where(F.pmod(F.xxhash64("labelled"), F.lit(1 << 20)) < int(share * (1 << 20)))
    texts = spread(docs.select(F.col(id_col).alias("labelled"), F.col(text_col).alias("text")))
    # rows that repeat a drawn id are one row: that of the least text
    return texts.join(F.broadcast(drawn), "labelled").groupBy("labelled", "y").agg(F.min("text").alias("text")).select("text", "y")


def _g2(a: Column, n: float, b: Column, m: float) -> Column:
    """Likelihood-ratio statistic of a hits among n against b among m."""
    p = (a + b) / (n + m)
    term = lambda k, t, q: F.when(k > 0, k * F.log(k / (t * q))).otherwise(0.0)
    return 2 * (term(a, n, p) + term(n - a, n, 1 - p) + term(b, m, p) + term(m - b, m, 1 - p))


def train(rows: DataFrame, max_stems: int = 300, least_g2: float = 34.0) -> Model:
    """Learn a model from ``rows(text, y)``; with no toxic or no clean rows, the grammar's own model."""
    rows = cut(rows)

    def stems(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = ((t.as_py(), y) for b in batches for t, y in zip(b.column(0), b.column(1).to_pylist(), strict=True))
        for counts in _stem_counts(texts):
            cols = [pa.array(list(counts)), *(pa.array([c[i] for c in counts.values()], pa.int64()) for i in range(4))]
            yield pa.RecordBatch.from_arrays(cols, ["stem", "d0", "d1", "n0", "n1"])

    counted = rows.mapInArrow(trimmed(stems), "stem string, d0 long, d1 long, n0 long, n1 long").groupBy("stem").agg(*[F.sum(c).alias(c) for c in ("d0", "d1", "n0", "n1")])
    counted = cut(counted.where("d1 >= 3 or stem = ''"))
    total = counted.where("stem = ''").first()
    if total is None or not total.d0 or not total.d1:
        return Model()
    rate = F.col("d1") / total.d1 / ((F.col("d0") + 0.5) / total.d0)
    g2 = _g2(F.col("d1"), float(total.d1), F.col("d0"), float(total.d0))
    best = counted.where((F.col("stem") != "") & (rate > 2)).withColumn("g2", g2).where(F.col("g2") >= least_g2)
    # a word has up to seven stems, itself included, and most of them say the same
    best = best.orderBy(F.desc("g2"), F.desc(F.length("stem")), "stem").limit(14 * max_stems).collect()
    model, spent = Model(), 0.0
    used: set[str] = set()
    for r in best:
        stem = r.stem.rstrip("$")
        if len(used) >= max_stems:
            break
        if any(stem.startswith(u.rstrip("$")) or (u.startswith(stem) and not r.stem.endswith("$")) for u in used):
            continue
        used.add(r.stem)
        r1, r0 = r.n1 / max(1, total.n1), (r.n0 + 0.5) / max(1, total.n0)
        if r1 <= r0:
            continue
        (model.words if r.stem.endswith("$") else model.stems)[stem] = math.log(r1 / r0)
        spent += r1 - r0
    model.cost = max(spent, 1e-4)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([scorer.features(t.as_py()) for t in b.column(0)], pa.list_(pa.float64())), b.column(1)], ["x", "y"])

    sample = rows.mapInArrow(trimmed(measure), "x array<double>, y int").toArrow()
    x = np.array(sample.column("x").to_pylist(), float).reshape(sample.num_rows, -1)
    model.weights = tuple(fit(x, sample.column("y").to_numpy().astype(float), np.array(Model().weights)))
    return model


def fit(x: np.ndarray, y: np.ndarray, prior: np.ndarray, strength: float = 4.0) -> np.ndarray:
    """Logistic weights with a Gaussian prior around ``prior``."""
    w, pull = prior.copy(), np.full(len(prior), strength)
    pull[0] = 0.1

    def loss(v: np.ndarray) -> float:
        z = x @ v
        return float((np.logaddexp(0, z) - y * z).sum() + (pull * (v - prior) ** 2).sum() / 2)

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(pull), x.T @ (y - p) - pull * (w - prior))
        size = 1.0
        while size > 1e-6 and loss(w + size * step) > loss(w):
            size /= 2
        w = w + size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return w


def score(docs: DataFrame, model: Model, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 if score >= threshold) of every whole text added.

    Null and empty texts have the score of no matched clause; very long texts are read whole; repeated rows are
    scored each; an empty table gives an empty table. Columns of these names are replaced.
    """
    kept = [c for c in docs.columns if c.lower() not in ("score", "predicted")]
    schema = T.StructType([*(T.StructField(c, docs.schema[c].dataType) for c in kept), T.StructField("score", T.DoubleType())])
    at = kept.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for b in batches:
            s = pa.array([scorer.score(t.as_py()) for t in b.column(at)], pa.float64())
            yield pa.RecordBatch.from_arrays([*b.columns, s], [*kept, "score"])

    return spread(docs.select(*kept)).mapInArrow(trimmed(run), schema).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def toxicity(docs: DataFrame, labels: DataFrame, max_train: int = 20_000, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Learn from the labelled documents that are not held out and score all of ``docs``.

    Returns ``id_col``, ``held_out`` (crc32(id as text) mod 3 is 1; null ids, never learned from, count
    as held out), ``score`` and ``predicted``. Without labels of both kinds the grammar's own model
    scores. Repeated rows are scored each; an empty table gives an empty table; other columns are
    not read.
    """
    docs = docs.select(F.col(id_col), F.col(text_col))
    model = train(training_rows(docs, labels, max_train, id_col, text_col))
    held = F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(True))
    return score(docs, model, threshold, id_col, text_col).select(id_col, held.alias("held_out"), "score", "predicted")
