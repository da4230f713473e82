"""Substring de-duplication of repeated word windows behind a count-min prefilter.

A window is ``width`` consecutive words of one document.  A word goes if a window covering it also begins in a
document with a smaller id.

1. Prefilter.  Every window has an anchor, the smallest hash of its ``gram``-word substrings, so equal windows have
   equal anchors.  Each partition counts, in a count-min sketch, every stretch of windows with one anchor; the merged
   sketch's estimate of an anchor is at least the number of documents holding the window.  One anchor serves about
   (width - gram) / 2 windows, so the sketch stays some twenty times sparser than if it counted windows one by one.
2. Only windows estimated at two or more go on, none that repeats is lost.  A slice of documents first settles its own
   repeats (all but its smallest document's go at once), so a window in a third of all documents sends one row per
   slice, not one per document.  The rest are grouped exactly by 128-bit window hashes over the cluster.
3. Documents that had no such window are finished in place; only the others' texts meet their removed windows.

Results for odd input: a null or empty text has no words and keeps ''; fewer than ``width`` words lose nothing; a
document without id is compared with nothing; rows that share an id never remove each other's words; repeated rows
are returned as often as given; further columns are ignored; an empty table gives an empty result."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import small_batches
from .sketch import build, estimate
from .words import U, mix, rolling, short_grams, sliding_min, text_slices, windows, word_hashes

WIDTH, GRAM, DEPTH, LOG2_WIDTH = 50, 8, 2, 25
SLICE = 4 << 20
OUT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"


def _anchors(h: np.ndarray, ptr: np.ndarray, width: int, gram: int):
    """(window starts, text of each, windows before each text, anchor of each window)."""
    at, text, before = windows(ptr, width)
    if not len(at):
        return at, text, before, np.zeros(0, U)
    grams = short_grams(h, np.arange(len(h) - gram + 1), gram, 5)
    return at, text, before, sliding_min(grams, width - gram + 1)[at]


def _slices(batch: pa.RecordBatch, limit: int = SLICE):
    for lo, hi, data, off in text_slices(batch.column("text"), limit):
        yield (lo, hi, *word_hashes(data, off))


def dedup(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, depth: int = DEPTH,
          log2_width: int = LOG2_WIDTH, texts: bool = True) -> DataFrame:
    """Rows (doc_id, n_words, n_removed, kept_sha256, kept_text); ``docs`` has doc_id and text.

    Without ``texts`` kept_text is null, which spares moving the texts of documents that keep every word."""
    spark = docs.sparkSession
    gram = min(gram, width)
    rows = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       F.xxhash64("text").alias("tkey"))

    def keys_of(batch):
        known = batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
        for lo, hi, h, ptr in _slices(batch):
            at, text, _, anchor = _anchors(h, ptr, width, gram)
            if len(at):
                new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])])
                yield anchor[new & known[lo:hi][text]]

    sketch = spark.sparkContext.broadcast(build(rows, keys_of, depth, log2_width, 2))

    def repeated(h, ptr, known):
        at, text, before, anchor = _anchors(h, ptr, width, gram)
        if len(at):
            run = np.concatenate([[True], anchor[1:] != anchor[:-1]])
            hit = (estimate(sketch.value, anchor[run]) > 1)[np.cumsum(run) - 1] & known[text]
        else:
            hit = np.zeros(0, bool)
        return at, text, before, hit

    def candidates(batches):
        for batch in batches:
            known = batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
            ids = batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
            tkeys = batch.column("tkey").to_numpy(zero_copy_only=False)
            for lo, hi, h, ptr in _slices(batch):
                at, text, before, hit = repeated(h, ptr, known[lo:hi])
                if not hit.any():
                    continue
                h1, h2 = rolling(h, at[hit], width, 31), rolling(h, at[hit], width, 97)
                text, pos = text[hit], (np.arange(len(at)) - before[text])[hit]
                doc = ids[lo:hi][text]
                order = np.lexsort((pos, doc, h2, h1))
                h1, h2, text, pos, doc = h1[order], h2[order], text[order], pos[order], doc[order]
                new = np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
                first = doc[np.flatnonzero(new)][np.cumsum(new) - 1]
                one = new | np.concatenate([[True], (doc[1:] != doc[:-1]) | (text[1:] != text[:-1])])
                h1, h2, text, pos, doc, sure = (x[one] for x in (h1, h2, text, pos.astype(np.int32), doc, doc > first))
                # Settled repeats: one row per document, spread by its own hash.  The others: one row per window.
                by = np.argsort(text[sure], kind="stable")
                gone, gone_pos = text[sure][by], pos[sure][by]
                cuts = np.flatnonzero(np.concatenate([[len(gone) > 0], gone[1:] != gone[:-1]])) if len(gone) else []
                ends = np.append(cuts[1:], len(gone)) if len(gone) else []
                own = gone[cuts] if len(gone) else np.zeros(0, np.int64)
                who = np.concatenate([text[~sure], own])
                spread = mix(ids[lo:hi][own].astype(U) * U(0x9E3779B97F4A7C15) + own.astype(U))
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(ids[lo:hi][who], pa.int64()), "tkey": pa.array(tkeys[lo:hi][who], pa.int64()),
                    "pos": pa.array([*pos[~sure].tolist(), *[None] * len(own)], pa.int32()),
                    "settled": pa.array([*[None] * int((~sure).sum()),
                                         *(gone_pos[a:b].tobytes() for a, b in zip(cuts, ends))], pa.binary()),
                    "h1": pa.array(np.concatenate([h1[~sure], spread]).view(np.int64)),
                    "h2": pa.array(np.concatenate([h2[~sure], np.zeros(len(own), U)]).view(np.int64))})

    found = rows.mapInArrow(candidates, "doc_id long, tkey long, pos int, settled binary, h1 long, h2 long")
    by_window = (Window.partitionBy("h1", "h2", F.isnull("settled")).orderBy("doc_id")
                 .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    removed = (found.withColumn("lowest", F.first("doc_id").over(by_window))
               .where("settled is not null or doc_id > lowest")
               .groupBy("doc_id", "tkey").agg(F.collect_list("pos").alias("pos"), F.collect_list("settled").alias("settled")))

    def finish_clean(batches):
        for batch in batches:
            known = batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
            col = batch.column("text")
            for lo, hi, h, ptr in _slices(batch):
                _, text, _, hit = repeated(h, ptr, known[lo:hi])
                pending = np.zeros(hi - lo, bool)
                pending[text[hit]] = True
                part = col.slice(lo, hi - lo)
                kept = [None if p else b" ".join((t.as_py() or "").encode().split()) for p, t in zip(pending, part)]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column("doc_id").slice(lo, hi - lo), "tkey": batch.column("tkey").slice(lo, hi - lo),
                    "n_words": pa.array(np.diff(ptr)),
                    "text": pa.array([t.as_py() if p else None for p, t in zip(pending, part)], pa.string()),
                    "kept_sha256": pa.array([None if k is None else hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
                    "kept_text": pa.array([None if k is None or not texts else k.decode() for k in kept], pa.string())})

    def cut_words(batches):
        for batch in batches:
            pend, pos, settled = (batch.column(c) for c in ("text", "pos", "settled"))
            lost = np.zeros(len(pend), np.int64)
            sha, kept = batch.column("kept_sha256").to_pylist(), batch.column("kept_text").to_pylist()
            for lo, hi, h, ptr in text_word_slices(pend):
                for i in range(lo, hi):
                    if not pend[i].is_valid:
                        continue
                    words = pend[i].as_py().encode().split()
                    if pos[i].is_valid:
                        hs = h[ptr[i - lo]:ptr[i - lo + 1]]
                        drop = covered(hs, starts(pos[i], settled[i]), width)
                        lost[i] = int(drop.sum())
                        words = [w for w, d in zip(words, drop) if not d]
                    out = b" ".join(words)
                    sha[i], kept[i] = hashlib.sha256(out).hexdigest(), out.decode() if texts else None
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "n_words": batch.column("n_words"), "n_removed": pa.array(lost),
                "kept_sha256": pa.array(sha, pa.string()), "kept_text": pa.array(kept, pa.string())})

    clean = rows.mapInArrow(finish_clean, "doc_id long, tkey long, n_words long, text string, "
                                          "kept_sha256 string, kept_text string")
    return (clean.join(removed, ["doc_id", "tkey"], "left")
            .select("doc_id", "n_words", "text", "kept_sha256", "kept_text", "pos", "settled").mapInArrow(cut_words, OUT))


def starts(pos: pa.ListScalar, settled: pa.ListScalar) -> np.ndarray:
    """First words of a document's removed windows, from both forms of rows."""
    return np.concatenate([np.asarray(pos.values, dtype=np.int64),
                           *(np.frombuffer(x.as_buffer(), np.int32).astype(np.int64) for x in settled.values)])


def text_word_slices(col: pa.Array):
    for lo, hi, data, off in text_slices(col):
        yield (lo, hi, *word_hashes(data, off))


def covered(h: np.ndarray, pos: np.ndarray, width: int) -> np.ndarray:
    """Words covered by the windows at ``pos`` or by any equal window of the same text."""
    at = np.arange(len(h) - width + 1)
    h1, h2 = rolling(h, at, width, 31), rolling(h, at, width, 97)
    gone = h1[pos]
    gone = np.isin(h1, gone) & np.isin(h2, h2[pos])
    edge = np.zeros(len(h) + 1, np.int64)
    edge[at[gone]] += 1
    np.subtract.at(edge, at[gone] + width, 1)
    return np.cumsum(edge[:-1]) > 0
