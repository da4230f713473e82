"""Count-min sketches of hashed keys: built per partition, merged by block in the cluster, of one fixed size.

Counters saturate at ``cap`` (below 2**31); an estimate is never below min(true count, cap).  The merged sketch has
``depth`` rows of 2**log2_width counters whatever the input's size, so sending it to every task has a proven bound."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .words import U, mix, stream

BLOCKS = 32


def cells(keys: np.ndarray, row: int, log2_width: int) -> np.ndarray:
    return (mix(keys * stream(row + 1, 77)[row]) >> U(64 - log2_width)).astype(np.int64)


def _add(counts: np.ndarray, cell: np.ndarray, cap: int) -> None:
    cell = np.sort(cell)
    if not len(cell):
        return
    head = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
    n = np.minimum(np.diff(np.append(head, len(cell))), cap)
    at = cell[head]
    counts[at] = np.minimum(counts[at].astype(np.int64) + n, cap).astype(counts.dtype)


def build(df: DataFrame, keys_of: Callable[[pa.RecordBatch], Iterator[np.ndarray | list[np.ndarray]]], depth: int,
          log2_width: int, cap: int) -> np.ndarray:
    """Sketch (depth x width) of the uint64 keys that ``keys_of`` draws from each Arrow batch of ``df``: an array of keys
    counts in every row, a list of arrays gives each row keys of its own."""
    dtype = np.uint8 if cap < 1 << 8 else np.uint16 if cap < 1 << 16 else np.uint32
    size = depth << log2_width

    def partial(batches):
        counts, seen = None, False
        for batch in batches:
            for keys in keys_of(batch):
                if counts is None:
                    counts = np.zeros(size, dtype)
                own = keys if isinstance(keys, list) else [keys] * depth
                seen = seen or any(len(x) > 0 for x in own)
                for r, x in enumerate(own):
                    _add(counts[r << log2_width:(r + 1) << log2_width], cells(x, r, log2_width), cap)
        if seen:
            for b, part in enumerate(np.split(counts, BLOCKS)):
                yield pa.RecordBatch.from_pydict({"block": pa.array([b], pa.int32()),
                                                  "part": pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())})

    def merge(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, part in zip(batch.column(0).to_pylist(), batch.column(1)):
                got = np.frombuffer(zlib.decompress(part.as_py()), dtype).astype(np.uint32)
                sums[b] = np.minimum(sums[b] + got, cap) if b in sums else got
        for b, s in sums.items():
            yield pa.RecordBatch.from_pydict({"block": pa.array([b], pa.int32()),
                                              "part": pa.array([zlib.compress(s.astype(dtype).tobytes(), 1)], pa.binary())})

    schema = "block int, part binary"
    parts = df.mapInArrow(partial, schema).repartition(BLOCKS, "block").mapInArrow(merge, schema)
    out = np.zeros(size, dtype)
    step = size // BLOCKS
    for row in parts.toLocalIterator():  # BLOCKS rows of fixed size
        out[row["block"] * step:(row["block"] + 1) * step] = np.frombuffer(zlib.decompress(row["part"]), dtype)
    return out.reshape(depth, 1 << log2_width)


def estimate(sketch: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Upper bound (up to the cap) of each key's count: the smallest of its counters."""
    width = sketch.shape[1].bit_length() - 1
    est = sketch[0][cells(keys, 0, width)]
    for r in range(1, len(sketch)):
        est = np.minimum(est, sketch[r][cells(keys, r, width)])
    return est
