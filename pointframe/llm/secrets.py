"""Secret scan: patterns propose candidates, a random forest removes false positives.

Candidates are strings of known key formats, values assigned to names that sound secret, and long
strings of mixed characters. The forest judges each from its length, the transitions between its
characters, how much of it dictionary words cover, whether it is part of a path or address, and the
words beside it. It is trained from labelled findings, by default ``labelled_findings()``: made up
by rule from a seed, keys of many services against commits, checksums, identifiers, paths, names
and placeholders. The trees are a few thousand numbers and go to the tasks with the code; texts
are scanned in one pass without an exchange.
"""

from __future__ import annotations

import math
import re
import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import spread, trimmed

# kind and pattern; a group 's' or 's2' holds the secret: fixed values. Every repeat is bounded, possessive or begins
# where its run of characters begins, so a scan takes linear time whatever the text.
KINDS = [
    ("private_key", r"-----BEGIN (?:[A-Z]{1,20} ){0,8}PRIVATE KEY-----(?:[A-Za-z0-9+/=\s\\:,.]|-(?!----))++-----END (?:[A-Z]{1,20} ){0,8}PRIVATE KEY-----"),
    ("aws_key", r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b"),
    ("github_token", r"\b(?:gh[pousr]_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{30,})"),
    ("slack_token", r"\bxox[abprs]-[A-Za-z0-9-]{10,}"),
    ("google_key", r"\bAIza[0-9A-Za-z_-]{35}"),
    ("stripe_key", r"\b[sr]k_(?:live|test)_[0-9A-Za-z]{16,}"),
    ("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}"),
    ("assigned", r"(?i:token|secret|passw(?:or)?d|pwd|api[_-]?key|access[_-]?key|auth|credential)[\w-]{0,64}[\"']?\s{0,16}+(?::=|=>|[:=])\s{0,16}+[\"']?(?P<s>[^\s\"'<>(){}\[\],;]{8,})"),
    ("opaque", r"(?<![A-Za-z0-9+/_=-])(?P<s2>[A-Za-z0-9+/_-]{20,}+={0,2})"),
]
_SCAN = re.compile("|".join(f"(?P<k{i}>{p})" for i, (_, p) in enumerate(KINDS)))
# every candidate holds one of these; most texts hold none
_HINT = re.compile(r"[0-9:=_]|-----BEGIN|A[KS]IA|AIza|xox|eyJ|[a-z][A-Z]")
_FORMATS = 7  # kinds before this one are formats of their own
# an opaque string is a candidate if it holds a digit or changes from small to capital letters so often
_MIXED = re.compile(r"[0-9]|(?:[a-z][^a-z]{0,8}?[A-Z].{0,16}?){3}", re.S)

# words for dictionary coverage: fixed values
DICTIONARY = """about account action admin after again api app application array base before build button cache change
    check class click client cloud code color column com common config connect content control copy count create current
    data database date debug default delete demo description dev device dir document domain down download dummy edit
    element email enable end engine entry error event example execute export fake false field file filter find first
    font form format frame from function get global group handler hash head height hello help home host html http icon
    image import index info init input insert item java json key label language last layout length level library license
    line link list load local lock log login main manager map master max media member memory menu message meta method
    min mode model module name network new next node null number object offset open option order output package page
    panel param parent password path pattern phone plugin point port post prefix print private process product profile
    project property public query read record release remove report request reset resource response result return root
    sample save schema screen script search secret section secure select server service session set setting source sql
    start state static status store stream string style system table target task temp template test text theme time
    title token tool total tree true type update upload user util value version video view web width window word world
    write your""".split()


def _longest_first(words: list[str]) -> str:
    """A pattern that matches the longest of the words at a place, by their common beginnings."""
    by: dict[str, list[str]] = {}
    for w in words:
        by.setdefault(w[0], []).append(w[1:])
    parts = []
    for c, rests in sorted(by.items()):
        longer = [r for r in rests if r]
        parts.append(re.escape(c) + (f"(?:{_longest_first(longer)})" + "?" * ("" in rests) if longer else ""))
    return "|".join(parts)


_WORDS = re.compile(_longest_first([w for w in DICTIONARY if len(w) >= 3]))
_SECRET_NEAR = re.compile(r"(?i)token|secret|passw|pwd|api.?key|access.?key|auth|credential|bearer|private|signing|client.?key")
_PLAIN_NEAR = re.compile(r"(?i)commit|sha\d*|md5|checksum|hash|digest|uuid|guid|revision|etag|integrity|fingerprint|build|version|example|sample|placeholder|dummy|fake|isbn|serial|order|invoice")
_PLACEHOLDER = re.compile(r"(?i)x{4,}|\*{3,}|(.)\1{5,}|your|example|sample|dummy|changeme|placeholder|todo|1234567|abcdef|none|null|undefined|\$\{|%\(|<")

FEATURES = [
    "length", "entropy", "digits", "upper", "lower", "others", "transitions", "vowels", "hex", "uuid", "covered", "format",
    "assigned", "secret_near", "plain_near", "placeholder", "in_path", "dotted", "camel", "quoted", "longest_letters",
]


def _covered(s: str) -> float:
    """Share of the characters that dictionary words cover, longest first."""
    return sum(len(w) for w in _WORDS.findall(s.lower())) / max(1, len(s))


def _class(c: str) -> int:
    """0 digit, 1 capital, 2 small letter, 3 other."""
    return 0 if c.isdigit() else 1 if c.isupper() else 2 if c.islower() else 3


def features(secret: str, before: str, after: str, kind: int) -> list[float]:
    """Numbers that the forest judges a candidate by, from all of its characters; in the order of ``FEATURES``."""
    s, n = secret, len(secret)
    counts = Counter(s)
    of = {c: _class(c) for c in counts}
    share = [sum(k for c, k in counts.items() if of[c] == which) / n for which in range(4)]
    row = np.frombuffer(bytes(map(of.__getitem__, s)), np.uint8)
    near = before.rsplit("\n", 1)[-1][-32:]
    return [
        float(n), -sum(k / n * math.log2(k / n) for k in counts.values()), *share,
        int(np.count_nonzero(row[1:] != row[:-1])) / max(1, n - 1), sum(counts[c] for c in "aeiouAEIOU") / n,
        float(all(c in string.hexdigits for c in counts)), float(n == 36 and bool(re.fullmatch(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}", s))), _covered(s), float(kind < _FORMATS),
        float(kind == _FORMATS), float(bool(_SECRET_NEAR.search(near))), float(bool(_PLAIN_NEAR.search(near))), float(bool(_PLACEHOLDER.search(s))),
        float(bool(re.search(r"[/\\]\S*$|://\S*$", before)) or "/" in after[:1] or s.count("/") >= 3), float(s.count(".") + s.count("_") + s.count("-")),
        float(len(re.findall(r"[a-z][A-Z][a-z]", s))), float(before[-1:] in "\"'" and before != ""), float(max(map(len, re.findall(r"[A-Za-z]+", s)), default=0)),
    ]


def candidates(text: str) -> Iterator[tuple[int, int, int, list[float]]]:
    """Start, end, kind and features of every candidate of a text."""
    if not _HINT.search(text):
        return
    for m in _SCAN.finditer(text):
        kind = int(m.lastgroup[1:])
        s, e = m.span("s") if kind == _FORMATS else m.span("s2") if kind == _FORMATS + 1 else m.span()
        if kind <= _FORMATS or _MIXED.search(text, s, e):
            yield s, e, kind, features(text[s:e], text[max(0, s - 64) : s], text[e : e + 8], kind)


def labelled_findings(count: int = 3000, seed: int = 17) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of ``count`` made-up findings, the same for the same seed."""
    rng = np.random.default_rng(seed)
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    chars = lambda alphabet, n: "".join(pick(alphabet) for _ in range(n))
    hexa, alnum, b64 = "0123456789abcdef", string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/"
    lows = string.ascii_lowercase
    words = lambda n, sep: sep.join(pick(DICTIONARY) for _ in range(n))
    size = lambda a, b: int(rng.integers(a, b))
    name = lambda: pick(["token", "api_key", "secret", "password", "auth_token", "client_secret", "access_key", "API_KEY", "db_password", "Authorization"])
    mark = lambda: pick([' = "', "=", ": ", ': "', " := '", "='"])
    body = lambda: pick([chars(hexa, size(32, 65)), chars(alnum, size(20, 60)), chars(b64, size(28, 80)), chars(lows + string.digits, size(24, 40)), chars(alnum + "!#%&", size(12, 30)).replace("<", "x")])
    noise = lambda: " ".join(chars(lows, size(2, 9)) for _ in range(size(1, 6))) + " "
    true = [
        lambda: name() + mark() + body(), lambda: "AKIA" + chars(string.ascii_uppercase + string.digits, 16), lambda: "ghp_" + chars(alnum, 36),
        lambda: "xoxb-" + chars(string.digits, 12) + "-" + chars(alnum, 24), lambda: "AIza" + chars(alnum, 35), lambda: "sk_live_" + chars(alnum, 24),
        lambda: "eyJ" + chars(alnum, 20) + "." + chars(alnum, 40) + "." + chars(alnum, 40), lambda: "Bearer " + chars(alnum, size(30, 60)),
    ]
    false = [
        lambda: pick(["commit ", "sha1 ", "md5: ", "checksum ", "revision ", "sha256:", "etag "]) + chars(hexa, pick([32, 40, 64])),
        lambda: pick(["id ", "uuid=", "request ", ""]) + "-".join(chars(hexa, n) for n in (8, 4, 4, 4, 12)),
        lambda: name() + mark() + pick(["your_token_here1", "xxxxxxxxxxxxxxxx1", "changeme1234567", "${SECRET_TOKEN}", "example-token-1234", "none_undefined", words(3, "_") + "1"]),
        lambda: "https://host.example/" + words(3, "/") + "/" + words(2, "-") + "-" + chars(string.digits, 6), lambda: "/usr/lib/" + words(4, "/") + "1.2",
        lambda: words(size(3, 6), pick(["_", "-"])) + chars(string.digits, size(1, 4)), lambda: "".join(w.title() for w in words(size(4, 7), " ").split()) + chars(string.digits, 1),
        lambda: chars(string.digits, size(20, 30)), lambda: chars(lows, size(18, 30)) + chars(string.digits, 1), lambda: name() + mark() + words(size(2, 4), "."),
        lambda: name() + mark() + pick(["required", "undefined", "expired_or_invalid", "process.env.TOKEN", "config.password", "get_password()", "len(tokens)"]),
        lambda: "=" * size(20, 40) + "1", lambda: "_".join(chars(lows, size(3, 7)) for _ in range(4)) + "_" + chars(string.digits, 2),
    ]
    x, y = [], []
    while len(x) < count:
        label = len(x) % 2
        text = noise() + pick(true if label else false)() + pick(['"', " ", "\n", "; ", ""])
        found = list(candidates(text + noise()))
        if found:
            x.append(found[-1][3])
            y.append(label)
    return np.array(x), np.array(y)


@dataclass
class Forest:
    """Trees as flat arrays: feature (-1 in leaves), cut, left child (right is next to it) and leaf share."""

    feature: list[np.ndarray]
    cut: list[np.ndarray]
    left: list[np.ndarray]
    share: list[np.ndarray]

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Mean share of true findings in the leaves that rows of features fall into."""
        total = np.zeros(len(x))
        for feature, cut, left, share in zip(self.feature, self.cut, self.left, self.share, strict=True):
            at = np.zeros(len(x), int)
            while True:
                inner = np.flatnonzero(feature[at] >= 0)
                if not len(inner):
                    break
                node = at[inner]
                at[inner] = left[node] + (x[inner, feature[node]] > cut[node])
            total += share[at]
        return total / max(1, len(self.feature))


def grow(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 9, least: int = 4, seed: int = 5) -> Forest:
    """Random forest: bootstrap samples, a random subset of features at each node, Gini impurity."""
    rng, forest = np.random.default_rng(seed), Forest([], [], [], [])
    tried = max(1, round(math.sqrt(x.shape[1])))
    for _ in range(trees):
        feature, cut, left, share = [-1], [0.0], [0], [0.0]
        stack = [(0, rng.integers(len(x), size=len(x)), 0)]
        while stack:
            node, rows, level = stack.pop()
            share[node] = float(y[rows].mean())
            if level == depth or len(rows) < 2 * least or share[node] in (0.0, 1.0):
                continue
            best = None
            for f in rng.permutation(x.shape[1])[:tried]:
                order = rows[np.argsort(x[rows, f], kind="stable")]
                v, t = x[order, f], y[order].cumsum()
                k = np.arange(1, len(order))
                ok = (v[1:] > v[:-1]) & (k >= least) & (len(order) - k >= least)
                if not ok.any():
                    continue
                a, b = t[:-1] / k, (t[-1] - t[:-1]) / (len(order) - k)
                impure = np.where(ok, k * a * (1 - a) + (len(order) - k) * b * (1 - b), np.inf)
                i = int(impure.argmin())
                if best is None or impure[i] < best[0]:
                    best = (impure[i], f, (v[i] + v[i + 1]) / 2)
            if best is None:
                continue
            feature[node], cut[node], left[node] = int(best[1]), float(best[2]), len(feature)
            for side, part in enumerate((rows[x[rows, best[1]] <= best[2]], rows[x[rows, best[1]] > best[2]])):
                stack.append((len(feature), part, level + 1))
                feature.append(-1), cut.append(0.0), left.append(0), share.append(0.0)
        for have, new in ((forest.feature, feature), (forest.cut, cut), (forest.left, left), (forest.share, share)):
            have.append(np.array(new))
    return forest


@lru_cache(maxsize=1)
def default_forest() -> Forest:
    """The forest trained from the made-up findings."""
    return grow(*labelled_findings())


def _judged(texts: list[str | None], forest: Forest, threshold: float) -> list[list[tuple[int, int, int, float]]]:
    """Findings (start, end, kind, score) of each text."""
    found = [list(candidates(t)) if t else [] for t in texts]
    flat = [c for own in found for c in own]
    score = forest.predict(np.array([c[3] for c in flat])) if flat else []
    scores = iter(score)
    return [[(s, e, k, float(p)) for (s, e, k, _), p in ((c, next(scores)) for c in own) if p >= threshold] for own in found]


def scan(docs: DataFrame, forest: Forest | None = None, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per finding: ``id_col``, ``start`` and ``end`` (characters), ``kind``, ``secret`` and ``score``.

    Texts without findings, null and empty ones have no rows; repeated rows repeat their findings;
    other columns are not read. No shuffle.
    """
    forest = forest or default_forest()
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, cols = [], ([], [], [], [], [])
            for i, t in enumerate(b.column(1)):
                text = t.as_py()
                for s, e, k, p in _judged([text], forest, threshold)[0]:
                    at.append(i)
                    for c, v in zip(cols, (s, e, KINDS[k][0], text[s:e], p), strict=True):
                        c.append(v)
            types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), *map(pa.array, cols, types)], [id_col, "start", "end", "kind", "secret", "score"])

    return spread(docs.select(F.col(id_col), F.col(text_col))).mapInArrow(trimmed(run), f"`{id_col}` {id_type}, start long, end long, kind string, secret string, score double")


def redact(docs: DataFrame, forest: Forest | None = None, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs``, every finding in ``text_col`` replaced by ``[SECRET:kind]``.

    Null and empty texts stay as they are, whole long texts are scanned, repeated rows are all kept, and an
    empty table gives an empty table. Other columns, whatever their names, aren't changed. No shuffle.
    """
    forest = forest or default_forest()
    names, at = docs.columns, docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = []
            for t in b.column(at):
                text = t.as_py()
                for s, e, k, _ in reversed(_judged([text], forest, threshold)[0]):
                    text = f"{text[:s]}[SECRET:{KINDS[k][0]}]{text[e:]}"
                texts.append(text)
            cols = list(b.columns)
            cols[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(cols, names)

    return spread(docs).mapInArrow(trimmed(run), docs.schema)
