"""Vectorised word and word-window hashes over Arrow string columns (numpy, no per-word Python).

A word is a maximal run of bytes other than space, tab, LF, VT, FF and CR of the UTF-8 text.  Every function works on
whole texts; texts are taken in slices of a few MB so temporary arrays stay small whatever the batch size."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
_SEP = np.zeros(256, dtype=bool)
_SEP[[9, 10, 11, 12, 13, 32]] = True
#: Separators when punctuation does not count either: all ASCII but letters and digits.
PUNCTUATION = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
SLICE_BYTES = 1 << 20


def mix(h: np.ndarray) -> np.ndarray:
    """Finalising bit mixer (bijective on 64 bits)."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def stream(n: int, seed: int) -> np.ndarray:
    """n well-mixed odd multipliers."""
    return mix(np.arange(1, n + 1, dtype=U) * U(0x9E3779B97F4A7C15) + U(seed)) | U(1)


_BYTE = stream(256, 11)
_PLACE = stream(64, 23)


def _place(n: int) -> np.ndarray:
    return _PLACE if n <= len(_PLACE) else stream(n, 23)


def text_slices(col: pa.Array, limit: int = SLICE_BYTES):
    """(first row, last row, bytes, offsets) of consecutive slices of about ``limit`` bytes; nulls count as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    bufs = col.buffers()
    n = len(col)
    if not n:
        return
    off = np.frombuffer(bufs[1], dtype=np.int64 if wide else np.int32)[col.offset:col.offset + n + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None and bufs[2].size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, side="right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


def word_hashes(data: np.ndarray, off: np.ndarray, lower: bool = False,
                separators: np.ndarray = _SEP) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, in order, and the index of each text's first word (length texts + 1).

    Temporary arrays, several times the text's size, are made for about half a MB of text at a time."""
    hashes, ptr, lo = [np.zeros(0, U)], [np.zeros(1, np.int64)], 0
    while lo < len(off) - 1:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + (1 << 19), side="right")) - 1)
        h, p = _word_hashes(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], lower, separators)
        hashes.append(h)
        ptr.append(p[1:] + ptr[-1][-1])
        lo = hi
    return np.concatenate(hashes), np.concatenate(ptr)


def _word_hashes(data: np.ndarray, off: np.ndarray, lower: bool, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if lower:
        data = _LOWER[data]
    inside = ~separators[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = off[:-1][(off[:-1] < off[1:])]
    first[heads] = inside[heads]
    at = np.flatnonzero(first)
    ptr = np.searchsorted(at, off).astype(np.int64)
    if not len(at):
        return np.zeros(0, U), ptr
    byte = np.flatnonzero(inside)
    word = np.cumsum(first)[byte] - 1
    place = byte - at[word]
    v = _BYTE[data[byte]] * _place(int(place.max()) + 1)[place]
    begin = np.searchsorted(byte, at)
    return mix(np.add.reduceat(v, begin) + place[np.append(begin[1:], len(byte)) - 1].astype(U)), ptr


def windows(ptr: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For windows of k words: (index of the first word, text index, windows before each text)."""
    cnt = np.maximum(np.diff(ptr) - k + 1, 0)
    before = np.concatenate([[0], np.cumsum(cnt)])
    text = np.repeat(np.arange(len(cnt)), cnt)
    return np.arange(before[-1]) - before[text] + ptr[:-1][text], text, before


def short_grams(h: np.ndarray, at: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Hashes of the k-word windows that begin at ``at`` (small k)."""
    m = stream(k, seed)
    g = np.zeros(len(at), U)
    for j in range(k):
        g += h[at + j] * m[j]
    return mix(g)


def rolling(h: np.ndarray, at: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Rolling (Karp-Rabin) hashes modulo 2^64 of the k-word windows that begin at ``at``, finally mixed."""
    base = int(stream(1, seed)[0])
    inv = pow(base, -1, 1 << 64)
    n = len(h)
    up = np.cumprod(np.full(n, base, dtype=U))
    down = np.cumprod(np.full(n, inv, dtype=U))
    s = np.concatenate([np.zeros(1, U), np.cumsum(mix(h + U(seed)) * up)])
    return mix((s[at + k] - s[at]) * down[at])


def sliding_min(x: np.ndarray, k: int) -> np.ndarray:
    """Minimum of every k consecutive values (length len(x) - k + 1)."""
    span, cur = 1, x
    while span * 2 <= k:
        cur = np.minimum(cur[:-span], cur[span:])
        span *= 2
    rest = k - span
    return np.minimum(cur[:len(cur) - rest], cur[rest:]) if rest else cur


def sort_unique(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x
