"""Byte-level BPE by corpus-level merge replay.

The words of a stretch of the corpus are made distinct and laid out as one long run of tokens. An
inverted index maps each pair of neighbouring tokens to the positions where it stands; merges are
then replayed in rank order over the whole run, and each touches only its own positions and their
two neighbours; a merge with many positions takes them all at once. A word that occurs a million times in a
stretch is merged once. Where a merge brings up a pair of lower rank, that pair comes next in its word, exactly
as in word-by-word encoding.

Tasks need no exchange: each holds a bounded cache of words and merges the new words of a batch
together, so a lost executor costs only its own splits.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import spread

_CACHE_WORDS = 400_000
_BATCH_BYTES = 8 << 20


class MergeReplay:
    """Encoder and decoder for one vocabulary of byte-level ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.byte_id = [ranks[bytes([b])] for b in range(256)]
        self.rank_of: dict[tuple[int, int], int] = {}
        self.caches: dict[str, dict] = {}  # of words met before by this worker, by kind of entry

    def rank(self, a: int, b: int) -> int:
        """Rank of the merge of two tokens; -1 if there is none."""
        r = self.rank_of.get((a, b))
        if r is None:
            r = self.rank_of[a, b] = self.ranks.get(self.bytes_of[a] + self.bytes_of[b], -1)
        return r

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        """Token ids of every word, by one replay over all of them."""
        size = len(self.bytes_of)
        ends = np.cumsum([len(w) + 1 for w in words], dtype=np.int64) - 1
        token = np.append(np.array(self.byte_id, np.int64)[np.frombuffer(b"\n".join(words), np.uint8)], -1) if words else np.zeros(0, np.int64)
        token[ends] = -1
        n = len(token)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        # the same memory, for one position at a time
        t, nxt, prv = memoryview(token), memoryview(after), memoryview(before)
        index: dict[int, list] = {}  # rank of a pair -> positions of its left token, as numbers and arrays
        queue: list[int] = []

        def note(positions: np.ndarray) -> None:
            """Enter the pairs that begin at these positions."""
            positions = positions[token[positions] >= 0]
            right = token[after[positions]]
            positions, right = positions[right >= 0], right[right >= 0]
            if not len(positions):
                return
            pairs, back = np.unique(token[positions] * size + right, return_inverse=True)
            rank = np.array([self.rank(p // size, p % size) for p in pairs.tolist()], np.int64)[back]
            order = np.argsort(rank)
            rank, positions = rank[order], positions[order]
            at = np.flatnonzero(np.r_[True, rank[1:] != rank[:-1]])
            for s, e in zip(at, np.r_[at[1:], len(rank)], strict=True):
                r = int(rank[s])
                if r in index:
                    index[r].append(positions[s:e])
                elif r >= 0:
                    index[r] = [positions[s:e]]
                    heappush(queue, r)

        note(np.arange(n))
        while queue:
            r = heappop(queue)
            entries = index.pop(r)
            count = sum(1 if type(x) is int else len(x) for x in entries)
            if count >= 48:
                p = np.unique(np.concatenate([[x] if type(x) is int else x for x in entries]).astype(np.int64))
                p = p[token[p] >= 0]
                q = after[p]
                ok = token[q] >= 0
                p, q = p[ok], q[ok]
                pairs, back = np.unique(token[p] * size + token[q], return_inverse=True)
                ok = np.array([self.rank(x // size, x % size) == r for x in pairs.tolist()], bool)[back]
                p, q = p[ok], q[ok]
                if not len(p):
                    continue
                # of overlapping positions, as in a run of one letter, every second from the left
                chained = np.r_[False, q[:-1] == p[1:]]
                start = np.maximum.accumulate(np.where(chained, 0, np.arange(len(p))))
                p, q = (x[(np.arange(len(p)) - start) % 2 == 0] for x in (p, q))
                left, right = before[p], token[after[q]]
                near = np.where(left >= 0, token[left], -1)
                near = np.where(np.r_[False, q[:-1] == left[1:]], r, near)
                sides = np.unique(np.r_[near[near >= 0] * size + r, r * size + right[right >= 0]])
                if not any(0 <= self.rank(x // size, x % size) < r for x in sides.tolist()):
                    token[p], token[q] = r, -2
                    after[p] = after[q]
                    before[after[p]] = p
                    left = before[p]
                    note(np.unique(np.r_[left[left >= 0], p]))
                    continue
                entries = p.tolist()
            positions = sorted({y for x in entries for y in ([x] if type(x) is int else x.tolist())})
            held = -1  # the end of the word whose later positions wait for a lower rank
            for p in positions:
                left = t[p]
                if left < 0:
                    continue
                q = nxt[p]
                if t[q] < 0 or self.rank(left, t[q]) != r:
                    continue
                if p < held:
                    index.setdefault(r, []).append(p)
                    continue
                t[p], t[q] = r, -2
                q = nxt[p] = nxt[q]
                prv[q] = p
                low = False
                for a, b in ((prv[p], p), (p, q)):
                    if a >= 0 and t[a] >= 0 and t[b] >= 0:
                        new = self.rank(t[a], t[b])
                        if new >= 0:
                            low |= new < r
                            if new in index:
                                index[new].append(a)
                            else:
                                index[new] = [a]
                                if new != r:
                                    heappush(queue, new)
                if low:
                    held = int(ends[np.searchsorted(ends, p)])
            if r in index:
                heappush(queue, r)
        alive = token >= 0
        upto = np.r_[0, np.cumsum(alive)[ends]].tolist()
        flat = token[alive].tolist()
        return [flat[s:e] for s, e in zip(upto[:-1], upto[1:], strict=True)]

    def decode(self, ids: list[int]) -> bytes:
        """The bytes that the ids stand for."""
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=2)
def load(path: str, pattern: str) -> MergeReplay:
    """Read a rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as f:
        return MergeReplay({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}, pattern)


def _encoded(texts: Iterator[str], replay: MergeReplay, cache: dict, entry) -> Iterator[list]:
    """For each text, the cached entries of its words; the new words of a stretch are merged together."""
    stretch: list[list[str]] = []
    held = 0

    def flush() -> Iterator[list]:
        new = list({w for words in stretch for w in words if w not in cache})
        for w, ids in zip(new, replay.encode_words([w.encode() for w in new]), strict=True):
            cache[w] = entry(ids)
        for words in stretch:
            yield [cache[w] for w in words]
        if len(cache) > _CACHE_WORDS:
            cache.clear()
        if len(replay.rank_of) > 1_000_000:
            replay.rank_of.clear()

    for text in texts:
        stretch.append(replay.pattern.findall(text))
        held += len(text)
        if held > _BATCH_BYTES:
            yield from flush()
            stretch.clear()
            held = 0
    yield from flush()


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``ids``, the whole text's token ids (null and empty texts: no ids). No shuffle."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replay = load(path, pattern)
        cache = replay.caches.setdefault("ids", {})
        for b in batches:
            at, held, rows = 0, 0, []
            for words in _encoded((t.as_py() or "" for t in b.column(1)), replay, cache, tuple):
                rows.append([i for w in words for i in w])
                held += len(rows[-1])
                if held > 1 << 20 or at + len(rows) == b.num_rows:
                    yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(rows)), pa.array(rows, pa.list_(pa.int32()))], [id_col, "ids"])
                    at, held, rows = at + len(rows), 0, []

    return spread(docs.select(F.col(id_col), F.col(text_col))).mapInArrow(run, f"`{id_col}` {id_type}, ids array<int>")


def decode(tokens: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col`` and ``bytes``, what the ids stand for (null ids: no bytes). Unknown ids raise."""
    id_type = tokens.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replay = load(path, pattern)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([replay.decode(i.as_py() or []) for i in b.column(1)], pa.binary())], [id_col, "bytes"])

    return tokens.select(F.col(id_col), F.col(ids_col)).mapInArrow(run, f"`{id_col}` {id_type}, bytes binary")


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text and decode the ids again; digests instead of the ids themselves.

    Returns ``id_col``, ``n_tokens``, ``ids_sha256`` (of the decimal ids joined by commas) and
    ``decoded_sha256`` (of the bytes that a document's ids stand for). Null and empty texts have no tokens; whole
    long texts are encoded (an unbroken word of n bytes takes some 24 n bytes of memory).
    Repeated rows give repeated rows; other columns are not read. One pass, no shuffle.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replay = load(path, pattern)
        cache = replay.caches.setdefault("digests", {})
        entry = lambda ids: (",".join(map(str, ids)), tuple(ids))
        for b in batches:
            n, ids, back = [], [], []
            for words in _encoded((t.as_py() or "" for t in b.column(1)), replay, cache, entry):
                own = list(chain.from_iterable([w[1] for w in words]))
                n.append(len(own))
                ids.append(hashlib.sha256(",".join([w[0] for w in words]).encode()).hexdigest())
                back.append(hashlib.sha256(replay.decode(own)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids), pa.array(back)], [id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    return spread(docs.select(F.col(id_col), F.col(text_col))).mapInArrow(run, f"`{id_col}` {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string")
