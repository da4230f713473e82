"""Language identification by rank-order n-gram profiles.

A text becomes its letters, lower-cased, with every run of other characters one blank; its 1-, 2- and 3-grams are
counted.  A language's profile ranks the ``top`` most frequent n-grams of its training texts; a document's profile
ranks its own.  The out-of-place distance sums, over the document's n-grams, how far each one's rank is from its rank
in the language (``top`` if the language lacks it); the nearest language wins.

Training counts every text given, per partition, then by (language, n-gram) with map-side sums.  Only the profiles
travel: at most ``top`` n-grams for each language label.

Results for odd input: a null text, or one without a letter, is ``und`` with score 0; equal counts rank by the
n-gram's code; equal distances go to the first language in order of code points; if nothing was trained all documents
are ``und``; repeated rows are returned as often as given; further columns are ignored; an empty table gives an empty
result."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F, types as T

from .common import small_batches
from .words import U

TOP = 300
UNKNOWN = "und"


#: Code points below this are looked up in a table, the others one distinct character at a time.
_SMALL = 0x800


def _letter(c: int) -> int:
    """Lower-case code point of a letter, a blank for anything else."""
    ch = chr(c)
    low = ch.lower()
    return 32 if not ch.isalpha() else ord(low) if len(low) == 1 else c


_TABLE = np.array([_letter(c) for c in range(_SMALL)], np.uint32)


def letters(text: str) -> np.ndarray:
    """Lower-case letters with single blanks between and around words; empty if there is no letter."""
    x = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    y = _TABLE[np.minimum(x, _SMALL - 1)]
    wide = np.flatnonzero(x >= _SMALL)
    if len(wide):
        chars, at = np.unique(x[wide], return_inverse=True)
        y[wide] = np.array([_letter(int(c)) for c in chars], np.uint32)[at]
    keep = y != 32
    if not keep.any():
        return y[:0]
    keep[1:] |= keep[:-1].copy()  # the first blank after a letter stays
    y = y[keep]
    blank = np.array([32], np.uint32)
    return np.concatenate([blank, y] if y[-1] == 32 else [blank, y, blank])


def _codes(x: np.ndarray) -> np.ndarray:
    """All 1-, 2- and 3-grams as integers (21 bits a character), without the lone blank."""
    y = x.astype(U)
    two = (y[:-1] << U(21)) | y[1:]
    three = (two[:-1] << U(21)) | y[2:]
    return np.concatenate([y[y != U(32)], two, three])


def gram_counts(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    g = np.sort(_codes(x))
    head = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
    return g[head], np.diff(np.append(head, len(g)))


def ranked(grams: np.ndarray, counts: np.ndarray, top: int) -> np.ndarray:
    """The ``top`` most frequent n-grams, most frequent first, ties by code (``grams`` ascend)."""
    if len(grams) > top:
        least = np.partition(counts, len(counts) - top)[len(counts) - top]
        few = np.flatnonzero(counts >= least)
        grams, counts = grams[few], counts[few]
    return grams[np.argsort(-counts, kind="stable")[:top]]


def train(labelled: DataFrame, top: int = TOP) -> dict[str, np.ndarray]:
    """Profiles of the languages in ``labelled`` (text, lang): language -> n-gram codes by rank."""
    def run(batches):
        sums: dict[str, dict[int, int]] = {}

        def flush(lang):
            grams = sums.pop(lang)
            return pa.RecordBatch.from_pydict({
                "lang": pa.array([lang] * len(grams), pa.string()), "gram": pa.array(list(grams), pa.int64()),
                "n": pa.array(list(grams.values()), pa.int64())})

        for batch in batches:
            texts, langs = batch.column("text"), batch.column("lang")
            for lang in set(langs.to_pylist()):
                part = texts.filter(pc.equal(langs, lang))
                for lo in range(0, len(part), 256):
                    xs = [letters(t.as_py()) for t in part.slice(lo, 256)]
                    xs = [x for x in xs if len(x)]
                    if not xs:
                        continue
                    # Texts begin and end with a blank; drop the doubled one where two meet.
                    g, n = gram_counts(np.concatenate([xs[0], *(x[1:] for x in xs[1:])]))
                    got = sums.setdefault(lang, {})
                    for a, b in zip(g.tolist(), n.tolist()):
                        got[a] = got.get(a, 0) + b
                    if len(got) > 1 << 16:
                        yield flush(lang)
        for lang in list(sums):
            yield flush(lang)

    counts = (small_batches(labelled).where("text is not null and lang is not null").select("text", "lang")
              .mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    by_lang = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    best = counts.withColumn("r", F.row_number().over(by_lang)).where(F.col("r") <= top)
    out: dict[str, list] = {}
    for row in best.select("lang", "gram", "r").orderBy("lang", "r").toLocalIterator():  # top rows a language
        out.setdefault(row["lang"], []).append(row["gram"])
    return {lang: np.array(g, dtype=U) for lang, g in sorted(out.items())}


def predict(docs: DataFrame, profiles: dict[str, np.ndarray], top: int = TOP, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (its columns ``keep``, all by default) with lang_pred and score (1: the profile itself, 0: no n-gram in
    common)."""
    docs = small_batches(docs)
    keep = docs.columns if keep is None else keep
    langs = list(profiles)
    known = np.unique(np.concatenate([np.zeros(0, U), *profiles.values()]))
    rank = np.full((len(known) + 1, len(langs)), top, np.int64)  # last row: n-grams no language has
    for j, lang in enumerate(langs):
        rank[np.searchsorted(known, profiles[lang]), j] = np.arange(len(profiles[lang]))
    model = docs.sparkSession.sparkContext.broadcast((langs, known, rank))

    def run(batches):
        langs, known, rank = model.value
        for batch in batches:
            pred, score = [], []
            for t in batch.column("text"):
                x = letters(t.as_py()) if t.is_valid else np.zeros(0, np.uint32)
                if not len(x) or not langs:
                    pred.append(UNKNOWN)
                    score.append(0.0)
                    continue
                doc = ranked(*gram_counts(x), top)
                at = np.searchsorted(known, doc)
                at[(at == len(known)) | (known[np.minimum(at, len(known) - 1)] != doc)] = len(known)
                place = np.arange(len(doc))[:, None]
                far = np.where(rank[at] == top, top, np.abs(rank[at] - place)).sum(axis=0)
                best = int(np.argmin(far))
                pred.append(langs[best])
                score.append(float(1.0 - far[best] / (top * len(doc))))
            kept = batch.select(keep)
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                                             names=[*keep, "lang_pred", "score"])

    schema = T.StructType([docs.schema[c] for c in keep]).add("lang_pred", "string").add("score", "double")
    return docs.mapInArrow(run, schema)


def held_out(doc_id) -> "F.Column":
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0


def identify(docs: DataFrame, top: int = TOP) -> DataFrame:
    """Rows (doc_id, held_out, lang_pred, score): trained on the labelled texts that are not held out."""
    docs = docs.select("doc_id", "text", "lang").withColumn("held_out", F.coalesce(held_out(F.col("doc_id")), F.lit(True)))
    profiles = train(docs.where("not held_out"), top)
    return predict(docs.select("doc_id", "held_out", "text"), profiles, top, ["doc_id", "held_out"])
