"""Packing of token streams into windows by Karmarkar-Karp multiway differencing.

A document's full windows need no search. The remainders of a stretch of documents are partitioned:
starting from one partial partition for each piece, the two partitions with the largest imbalance
are merged with opposing order (largest window with smallest), until one partition into near-equal
windows is left. Where its largest window exceeds the capacity, the window count rises and the
stretch is partitioned again. A small share of the remainders is cut into grains beforehand: coarse
pieces alone can't be balanced to a few tokens.

Each task packs its own splits in stretches of bounded size: no exchange, no state beyond a stretch.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import spread, trimmed


def karmarkar_karp(sizes: list[int], k: int) -> list[list[int]]:
    """Partition items into at most k windows with near-equal sums: the item numbers of each."""
    heap = [(-s, i, [(s, i)]) for i, s in enumerate(sizes)]
    heapify(heap)
    made = len(heap)
    while len(heap) > 1:
        a, b = heappop(heap)[2], heappop(heap)[2]
        both = max(0, len(a) + len(b) - k)
        sums = a[: len(a) - both] + b[: len(b) - both]
        sums += [(x[0] + y[0], (x[1], y[1])) for x, y in zip(a[len(a) - both :], reversed(b[len(b) - both :]), strict=True)]
        sums.sort(key=lambda w: -w[0])
        heappush(heap, (sums[-1][0] * (len(sums) == k) - sums[0][0], made, sums))
        made += 1
    windows = []
    for _, tree in heap[0][2] if heap else []:
        items, stack = [], [tree]
        while stack:
            node = stack.pop()
            if isinstance(node, tuple):
                stack += node
            else:
                items.append(node)
        windows.append(items)
    return windows


def partition(sizes: list[int], capacity: int) -> list[list[int]]:
    """Near-equal windows of at most ``capacity``; the fewest that differencing finds."""
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        windows = karmarkar_karp(sizes, k)
        if all(sum(sizes[i] for i in w) <= capacity for w in windows):
            return windows
        k += 1


def _cuts(remainders: list[int], grain: int, share: float) -> list[tuple[int, int, int]]:
    """Pieces (owner, start, length) of the remainders: an even share of the owners is cut into grains."""
    every = max(1, round(1 / share)) if share > 0 else 0
    pieces = []
    for i, n in enumerate(remainders):
        step = grain if every and i % every == 0 else n
        pieces += [(i, s, min(step, n - s)) for s in range(0, n, step)]
    return pieces


def _byte_symbols() -> dict[str, int]:
    """The printable symbol of each byte in byte-level vocabulary files, as symbol -> byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@lru_cache(maxsize=1)
def encoder(path: str, pattern: str) -> tiktoken.Encoding:
    """Encoder with the vocabulary of a tokenizers file, whose ids are the ranks of its merges.

    ``encode(text, allowed_special="all")`` gives the ids of that library's ``encode(text,
    add_special_tokens=False)``, which reads the file's added tokens wherever their strings stand in a
    text, at a fifth of the CPU seconds.
    """
    byte = _byte_symbols()
    tokenizer = Tokenizer.from_file(path)
    added = {str(t.content): i for i, t in tokenizer.get_added_tokens_decoder().items()}
    vocabulary = tokenizer.get_vocab(with_added_tokens=False)
    ranks = {bytes(byte[c] for c in symbols): i for symbols, i in vocabulary.items() if symbols not in added and all(c in byte for c in symbols)}
    return tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens=added)


def pack(docs: DataFrame, tokenizer: str, pattern: str, capacity: int = 1024, end_id: int = 0, stretch_windows: int = 256, grain: int = 16, grain_share: float = 0.05, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenise every whole text, end it with ``end_id`` and pack all ids into windows of at most ``capacity``.

    One row per piece: ``id_col``, ``start``, ``length``, ``doc_tokens``, ``sequence_id`` (unique, not gapless),
    ``offset`` (gapless from 0 in its sequence) and the piece's ``ids`` (binary: little-endian unsigned 32-bit
    numbers, as training reads them; ``numpy.frombuffer(ids, "<u4")``). Null and empty texts have the end id
    only; a very long text is cut into full windows and one remainder; repeated rows are packed each; an
    empty table gives no pieces. Other columns are not read.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    names = [id_col, "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    schema = f"`{id_col}` {id_type}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, pattern)
        first = TaskContext.get().partitionId() << 40
        made = 0
        rests: list[tuple[object, int, int, np.ndarray]] = []
        waiting = 0

        def out(rows: list[tuple[object, int, np.ndarray, int, int, int]]) -> pa.RecordBatch:
            doc, start, ids, total, seq, offset = zip(*rows, strict=True)
            numbers = [pa.array(x, pa.int64()) for x in (start, [len(x) for x in ids], total, seq, offset)]
            return pa.RecordBatch.from_arrays([pa.array(doc, docs_type), *numbers, pa.array([x.tobytes() for x in ids], pa.binary())], names)

        def flush() -> pa.RecordBatch:
            nonlocal made
            pieces = _cuts([len(r[3]) for r in rests], grain, grain_share)
            rows = []
            for window in partition([p[2] for p in pieces], capacity):
                at = 0
                for i in sorted(window):
                    owner, s, n = pieces[i]
                    doc, start, total, ids = rests[owner]
                    rows.append((doc, start + s, ids[s : s + n], total, first + made, at))
                    at += n
                made += 1
            return out(rows)

        for b in batches:
            docs_type = b.schema.field(0).type
            full = []
            for doc, text in zip(b.column(0), b.column(1), strict=True):
                doc, ids = doc.as_py(), np.array([*enc.encode(text.as_py() or "", allowed_special="all"), end_id], "<u4")
                whole = len(ids) // capacity
                for w in range(whole):
                    full.append((doc, w * capacity, ids[w * capacity : (w + 1) * capacity], len(ids), first + made, 0))
                    made += 1
                if len(ids) % capacity:
                    rests.append((doc, whole * capacity, len(ids), ids[whole * capacity :].copy()))
                    waiting += len(ids) % capacity
                if waiting >= stretch_windows * capacity:
                    yield flush()
                    rests, waiting = [], 0
                if len(full) >= 4096:
                    yield out(full)
                    full = []
            if full:
                yield out(full)
        if rests:
            yield flush()

    return spread(docs.select(F.col(id_col), F.col(text_col))).mapInArrow(trimmed(run), schema)
