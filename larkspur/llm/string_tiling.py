"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items are compared as words (A-Z lower-cased, ASCII punctuation left out).  Seeds are the
``k``-word windows that a document shares with an item, joined on Karp-Rabin hashes.  For each document and item that
share seeds, runs of seeds on one diagonal are maximal matches; the longest is marked, matches that overlap it are cut
back to what is unmarked on both sides, and so on down to ``k`` words, so every word is in one tile at most.  The share
of the item's words inside tiles decides, in whatever order the passages stand in the document.

The benchmark is the stated query set: it goes to the tasks in blocks of at most ``BLOCK_WORDS`` words, one pass over
the documents a block, and documents are never shuffled, so a passage that a third of them share costs no more than
any other.

Results for odd input: null or empty texts and items match nothing; an item of fewer than ``k`` words must occur whole;
repeated documents or items are each reported; a null doc_id or item_id is reported as null; further columns are
ignored; an empty table on either side gives an empty result."""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import small_batches
from .words import PUNCTUATION, U, rolling, text_slices, windows, word_hashes

K, COVERAGE = 5, 0.5
BLOCK_WORDS, BLOCK_BYTES = 1 << 20, 8 << 20
OUT = "doc_id long, item_id long, matched_words int, item_words int, tiles int, coverage double"
_SIEVE = 20


def tile(p: np.ndarray, q: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling from seeds (p in the document, q in the item): tiles (p, q, length)."""
    order = np.lexsort((p, p - q))
    p, q = p[order], q[order]
    new = np.concatenate([[True], (p[1:] != p[:-1] + 1) | (q[1:] != q[:-1] + 1)])
    head = np.flatnonzero(new)
    length = np.diff(np.append(head, len(p))) + k - 1
    heap = [(-int(n), int(p[i]), int(q[i])) for n, i in zip(length, head)]
    heapq.heapify(heap)
    in_doc: set[int] = set()
    in_item: set[int] = set()
    out = []
    while heap:
        n, a, b = heapq.heappop(heap)
        n = -n
        free = [a + i not in in_doc and b + i not in in_item for i in range(n)]
        if all(free):
            in_doc.update(range(a, a + n))
            in_item.update(range(b, b + n))
            out.append((a, b, n))
            continue
        start = None
        for i, f in enumerate([*free, False]):
            if f and start is None:
                start = i
            elif not f and start is not None:
                if i - start >= k:
                    heapq.heappush(heap, (start - i, a + start, b + start))
                start = None
    return out


def _words(col: pa.Array):
    for lo, hi, data, off in text_slices(col):
        yield (lo, hi, *word_hashes(data, off, lower=True, separators=PUNCTUATION))


def _seed_table(items: list[tuple[int | None, str]], k: int):
    """Seeds of a block of items by window length: {length: (sorted hashes, item, place, sieve)}, and item lengths."""
    h, ptr = [], [0]
    for _, _, hs, ps in _words(pa.array([t for _, t in items], pa.string())):
        h.append(hs)
        ptr.extend((ps[1:] + ptr[-1]).tolist() if ps[0] == 0 else [])
    h, ptr = np.concatenate([np.zeros(0, U), *h]), np.array(ptr)
    n = np.diff(ptr)
    table = {}
    for size in sorted({int(min(x, k)) for x in n if x}):
        at, item, before = windows(ptr, size)
        mine = np.minimum(n, k)[item] == size
        at, item, place = at[mine], item[mine], (np.arange(len(at)) - before[item])[mine]
        g = rolling(h, at, size, 41)
        order = np.argsort(g, kind="stable")
        sieve = np.zeros(1 << _SIEVE, bool)
        sieve[(g >> U(64 - _SIEVE)).astype(np.int64)] = True
        table[size] = (g[order], item[order], place[order], sieve)
    return table, n


def _hits(h, ptr, seeds, size):
    """(document, place in it, item, place in it) of every shared seed."""
    g, item, place, sieve = seeds
    at, doc, before = windows(ptr, size)
    x = rolling(h, at, size, 41) if len(at) else np.zeros(0, U)
    maybe = np.flatnonzero(sieve[(x >> U(64 - _SIEVE)).astype(np.int64)])
    lo, hi = np.searchsorted(g, x[maybe], "left"), np.searchsorted(g, x[maybe], "right")
    many = hi - lo
    src = np.repeat(maybe, many)
    to = np.repeat(lo, many) + np.arange(len(src)) - np.repeat(np.cumsum(many) - many, many)
    return doc[src], src - before[doc[src]], item[to], place[to]


def _block(docs: DataFrame, items: list[tuple[int | None, str]], k: int, coverage: float) -> DataFrame:
    table = docs.sparkSession.sparkContext.broadcast((_seed_table(items, k), [i for i, _ in items]))

    def run(batches):
        (seeds, lengths), names = table.value
        for batch in batches:
            ids = batch.column("doc_id")
            for lo, hi, h, ptr in _words(batch.column("text")):
                rows = []
                for size, part in seeds.items():
                    d, p, i, q = _hits(h, ptr, part, size)
                    order = np.lexsort((q, i, d))
                    d, p, i, q = d[order], p[order], i[order], q[order]
                    if not len(d):
                        continue
                    head = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (i[1:] != i[:-1])]))
                    for a, b in zip(head, np.append(head[1:], len(d))):
                        n = int(lengths[i[a]])
                        reach = np.unique(q[a:b])
                        most = int(np.minimum(np.diff(np.append(reach, reach[-1] + size)), size).sum())
                        if most < coverage * n:
                            continue
                        tiles = tile(p[a:b], q[a:b], size)
                        got = sum(t[2] for t in tiles)
                        if got >= coverage * n:
                            rows.append((ids[lo + int(d[a])].as_py(), names[i[a]], got, n, len(tiles), got / n))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                    list(zip(*rows)) or [[]] * 6, (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64()))],
                    names=["doc_id", "item_id", "matched_words", "item_words", "tiles", "coverage"])

    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, OUT)


def blocks(bench: DataFrame, most_words: int = BLOCK_WORDS, most_bytes: int = BLOCK_BYTES):
    """The benchmark's items in blocks of bounded size (one larger item is a block of its own)."""
    block, words, size = [], 0, 0
    for row in bench.where("text is not null").select(F.col("item_id").cast("long"), "text").toLocalIterator():
        n, b = len(row["text"].split()), len(row["text"].encode())
        if block and (words + n > most_words or size + b > most_bytes):
            yield block
            block, words, size = [], 0, 0
        block.append((row["item_id"], row["text"]))
        words, size = words + n, size + b
    if block:
        yield block


def contaminated(docs: DataFrame, bench: DataFrame, k: int = K, coverage: float = COVERAGE) -> DataFrame:
    """Rows (doc_id, item_id, matched_words, item_words, tiles, coverage) of the pairs at or above ``coverage``."""
    out = None
    for items in blocks(bench):
        part = _block(docs, items, k, coverage)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], OUT)
