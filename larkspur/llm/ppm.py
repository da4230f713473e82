"""Language-model scores of documents: prediction by partial matching over bytes, and a unigram base.

The model is a byte-context trie of order ``ORDER``: for every context of up to that many bytes, how often each byte (or
the end of the text) followed it in the training documents.  A symbol is predicted from its longest context; where that
has not seen it, the model escapes to the next shorter one.  Escapes take d / (n + d) of a context's mass (method C: n
occurrences, d distinct symbols), and symbols that the longer context offered are excluded from the shorter one's counts;
below order 0 the rest of the 257 symbols are equally likely.  A text is its A-Z lower-cased UTF-8 bytes, preceded by
start marks and followed by an end, so the probabilities of all texts sum to one.  A document's score is its pretrained
code length: the log10 probability of all its symbols.

The trie is never held in one place.  A node of order j is the number that the last j + 1 symbols spell in nine bits each,
so its suffix, the node below, is a bit mask.  Texts are dealt into chunks of ``CHUNK_BYTES``.  Each chunk names its
distinct (ORDER + 1)-grams with their training counts; one aggregate adds them up.  Orders 0 to 2, tables of at most 257^3
rows, are joined suffix by suffix; then all grams that share their last three context bytes (at most 257^3 again) come
together once, and windows over nodes and contexts climb the higher orders to each gram's log probability.  Every chunk
gets back the grams it named and adds up its documents.  So what is shuffled grows with the distinct grams of chunks, never
with positions, and a task holds one chunk.  Words take the same way for the base score, as 63-bit hashes.

Results for odd input: a null or empty text is one end symbol and one end token; rows without doc_id are scored, counted
as held out and not learned from; rows that repeat are learned from and scored as often as given; a document longer
than a chunk is a chunk of its own; other columns are ignored; without training documents symbols and tokens get their
uniform shares; an empty table gives an empty result."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import shared_dir
from .words import _LOWER, U, text_slices, word_hashes

ORDER, JOINED, BITS = 5, 2, 9
SYMBOLS, END = 257, 257  # 0 is the start mark, bytes are 1 to 256
CHUNK_BYTES, PIECE = 64 << 20, 1 << 20
#: Keys: grams are 0 and up, the hashes of words below 0, the end of a text as a token is this one.
LAST = 1 << 62
SCHEMA = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 7 == 2, F.lit(True))


def symbols(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts of a slice as symbols, start marks and end included, and each text's first place."""
    size, pad = np.diff(off), ORDER + 1
    begin = off[:-1] + np.arange(len(size)) * pad
    out = np.zeros(int(off[-1]) + len(size) * pad, np.uint16)
    low = _LOWER[data]
    if len(size) == 1:
        out[ORDER:-1] = low
        out[ORDER:-1] += 1
    else:
        out[np.arange(len(low)) + np.repeat(np.arange(len(size)) * pad + ORDER, size)] = low.astype(np.uint16) + 1
    out[begin + size + ORDER] = END
    return out, begin


def grams(data: np.ndarray, off: np.ndarray):
    """(codes, index of the text) of all positions of a slice, some million at a time."""
    sym, _ = symbols(data, off)
    of, done = np.repeat(np.arange(len(off) - 1, dtype=np.int32), np.diff(off) + 1), 0
    for lo in range(ORDER, len(sym), PIECE):
        hi = min(lo + PIECE, len(sym))
        pair = sym[lo - ORDER + 1:hi].astype(np.int64)
        pair += sym[lo - ORDER:hi - 1].astype(np.int64) << BITS     # the symbol before each and the symbol
        code = pair[ORDER - 1:].copy()
        for j in range(2, ORDER + 1, 2):
            code += pair[ORDER - 1 - j:len(pair) - j] << (BITS * j)
        code = code[sym[lo:hi] != 0]
        yield code, of[done:done + len(code)]
        done += len(code)


def runs(x: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, np.int64)


def totals(keys: np.ndarray, of: np.ndarray, value, n: int) -> np.ndarray:
    """Sum of ``value(keys)`` for each of ``n`` texts, ``of`` being the texts of the keys: keys are looked up once each and
    in order, which spares the cache."""
    if n <= 1 << 64 - BITS * (ORDER + 1) and len(keys) and keys.min() >= 0:     # a gram and its text fit one number
        room = U(64 - BITS * (ORDER + 1))
        both = np.sort(keys.view(U) << room | of.astype(U))
        keys, of = (both >> room).view(np.int64), (both & ((U(1) << room) - U(1))).astype(np.int64)
    else:
        order = np.argsort(keys)
        keys, of = keys[order], of[order]
    head = runs(keys)
    found = np.repeat(value(keys[head]), np.diff(np.append(head, len(keys))))
    return np.bincount(of, weights=found, minlength=n)


def _chunked(batches):
    """The rows with the number of their chunk."""
    chunk, held = TaskContext.get().partitionId() << 32, 0
    for batch in batches:
        text = batch.column("text")
        size = np.nan_to_num(np.array(pc.binary_length(text).to_numpy(zero_copy_only=False), dtype=float)).astype(np.int64)
        of = np.empty(len(size), np.int64)
        for i, n in enumerate(size.tolist()):
            if held and held + n > CHUNK_BYTES:
                chunk, held = chunk + 1, 0
            of[i], held = chunk, held + n + 1
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(of)], names=[*batch.schema.names, "chunk"])


class _Tally:
    """Distinct keys with the number of their training occurrences, merged whenever they have doubled."""

    def __init__(self):
        self.parts, self.size, self.limit = [], 0, 2_000_000

    def add(self, keys: np.ndarray, train: np.ndarray):
        for mine, learn in ((keys[train], 1), (keys[~train], 0)):
            mine = np.sort(mine)
            head = runs(mine)
            if len(head):
                self.parts.append((mine[head], np.diff(np.append(head, len(mine))) * learn))
                self.size += len(head)
        if self.size > self.limit:
            self.parts = [self.total()]
            self.size = len(self.parts[0][0])
            self.limit = max(self.limit, 2 * self.size)

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        keys, n = (np.concatenate(x) for x in zip(*self.parts))
        self.parts = []
        order = np.argsort(keys)
        keys, n = keys[order], n[order]
        head = runs(keys)
        return keys[head], np.add.reduceat(n, head)


def word_keys(h: np.ndarray) -> np.ndarray:
    return -1 - (h >> U(1)).view(np.int64)


def _named(batches):
    """(chunk, key, n) of the distinct grams and words of each chunk, with their training occurrences."""
    def flush(chunk, tally, ends):
        for keys, n in (tally.total(), (np.array([LAST]), np.array([ends]))):
            for lo in range(0, len(keys), PIECE):
                part = keys[lo:lo + PIECE]
                yield pa.RecordBatch.from_pydict({"chunk": pa.array(np.full(len(part), chunk)), "key": pa.array(part), "n": pa.array(n[lo:lo + PIECE])})

    current, tally, ends = None, None, 0
    for batch in batches:
        chunks = batch.column("chunk").to_numpy()
        edge = np.flatnonzero(np.concatenate([[True], chunks[1:] != chunks[:-1]])).tolist() + [len(chunks)]
        for a, b in zip(edge, edge[1:]):
            if a == b:
                continue
            if chunks[a] != current:
                if current is not None:
                    yield from flush(current, tally, ends)
                current, tally, ends = int(chunks[a]), _Tally(), 0
            train = batch.column("train")[a:b].to_numpy(zero_copy_only=False).astype(bool)
            ends += int(train.sum())
            for lo, hi, data, off in text_slices(batch.column("text")[a:b]):
                for code, text in grams(data, off):
                    tally.add(code, train[lo:hi][text])
                h, ptr = word_hashes(data, off, lower=True)
                tally.add(word_keys(h), np.repeat(train[lo:hi], np.diff(ptr)))
    if current is not None:
        yield from flush(current, tally, ends)


def _node(order: int) -> Column:
    return F.col("key").bitwiseAND((1 << BITS * (order + 1)) - 1)


def _escaped(seen: Column) -> Column:
    """log10 of a node's symbol once its context, which has not seen it, has been escaped from: what the shorter contexts
    (c1, n1, d1, e1), less this context's d symbols and their x occurrences there, give it."""
    left, kinds = F.col("n1") - F.col("x"), F.col("d1") - F.col("d")
    return (F.when(seen, F.lit(None)).when(kinds == 0, F.col("e1"))
            .when(F.col("c1") > 0, F.log10(F.col("c1") / (left + _mass(kinds, F.col("d1")))))
            .otherwise(F.log10(kinds / (left + kinds)) + F.col("e1")))


def log_probabilities(counts: DataFrame) -> DataFrame:
    """(key, value): log10 of each (ORDER + 1)-gram's last symbol given the symbols before it, from grams (key, n).

    Grams with n = 0 were never seen in training but are asked for.  Of the node that a gram ends in at each order, c is
    the count, n and d its context's occurrences and distinct symbols; c1, n1, d1, e1 belong to the order below."""
    def lower(nodes: DataFrame) -> DataFrame:
        return nodes.select(F.col("node").alias("low"), F.col("c").alias("c1"), F.col("n").alias("n1"), F.col("d").alias("d1"), F.col("e").alias("e1"))

    seen, below = F.col("c") > 0, None
    for j in range(JOINED + 1):
        nodes = counts.groupBy(_node(j).alias("node")).agg(F.sum("n").alias("c"))
        context = Window.partitionBy(F.shiftright("node", BITS))
        if below is not None:
            nodes = (nodes.withColumn("low", F.col("node").bitwiseAND((1 << BITS * j) - 1)).join(lower(below), "low")
                     .withColumn("x", F.sum(F.when(seen, F.col("c1")).otherwise(0)).over(context)))
        nodes = nodes.withColumn("n", F.sum("c").over(context)).withColumn("d", F.sum(seen.cast("long")).over(context))
        none = -F.log10(F.greatest(SYMBOLS - F.col("d"), F.lit(1)).cast("double"))
        below = nodes.withColumn("e", none if below is None else _escaped(seen)).select("node", "c", "n", "d", "e")
    rows = (counts.select("key", F.col("n").alias("count"), _node(JOINED).alias("low")).join(lower(below), "low").drop("low")
            .withColumn("suffix", F.shiftright("key", BITS).bitwiseAND((1 << BITS * (JOINED + 1)) - 1)).repartition("suffix"))
    for j in range(JOINED + 1, ORDER + 1):
        node, context = Window.partitionBy("suffix", _node(j)), Window.partitionBy("suffix", F.shiftright(_node(j), BITS))
        rows = (rows.withColumn("c", F.sum("count").over(node)).withColumn("once", F.row_number().over(node.orderBy("key")) == 1)
                .withColumn("n", F.sum("count").over(context)).withColumn("d", F.sum((F.col("once") & seen).cast("long")).over(context))
                .withColumn("x", F.sum(F.when(F.col("once") & seen, F.col("c1")).otherwise(0)).over(context))
                .withColumn("e", _escaped(seen)))
        value = (F.when(seen, F.log10(F.col("c") / (F.col("n") + _mass(F.col("d"), F.col("d")))))
                 .when(F.col("n") == 0, F.col("e")).otherwise(F.log10(F.col("d") / (F.col("n") + F.col("d"))) + F.col("e")))
        rows = rows.select("key", "count", "suffix", F.col("c").alias("c1"), F.col("n").alias("n1"), F.col("d").alias("d1"), F.col("e").alias("e1"),
                           value.cast("double").alias("value"))
    return rows.select("key", "value")


def _mass(kinds: Column, distinct: Column) -> Column:
    """What a context keeps for escapes: none once it has seen every symbol."""
    return F.when(distinct < SYMBOLS, kinds).otherwise(0)


def _scored(tokens: int, types: int):
    def score(texts: pa.Table, known: pa.Table) -> pa.Table:
        order = np.argsort(known.column("key").to_numpy(), kind="stable")
        keys, values = known.column("key").to_numpy()[order], known.column("value").to_numpy()[order]
        lookup = lambda asked: values[np.searchsorted(keys, asked)]
        n, last = texts.num_rows, float(values[-1]) if len(values) else 0.0
        score_, base = np.zeros(n), np.zeros(n)
        n_words, n_known = np.ones(n, np.int64), np.full(n, int(last > 0), np.int64)
        share = np.log10(tokens + types + 1)
        base += np.log10(last + 1) - share
        for lo, hi, data, off in text_slices(texts.column("text")):
            for code, text in grams(data, off):
                score_[lo:hi] += totals(code, text, lookup, hi - lo)
            h, ptr = word_hashes(data, off, lower=True)
            count, of = np.diff(ptr), np.repeat(np.arange(hi - lo), np.diff(ptr))
            n_words[lo:hi] += count
            n_known[lo:hi] += totals(word_keys(h), of, lambda k: lookup(k) > 0, hi - lo).astype(np.int64)
            base[lo:hi] += totals(word_keys(h), of, lambda k: np.log10(lookup(k) + 1) - share, hi - lo)
        return pa.table({"doc_id": texts.column("doc_id"), "held_out": pc.invert(texts.column("train")), "n_tokens": n_words,
                         "n_known": n_known, "train_tokens": np.full(n, tokens, np.int64), "base_score": base, "score": score_})
    return score


def score(docs: DataFrame) -> DataFrame:
    """One row a document: see SCHEMA."""
    spark = docs.sparkSession
    folder = f"{shared_dir(spark)}/ppm-{uuid.uuid4().hex}"
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (~held_out(F.col("doc_id"))).alias("train"), F.col("text"))
    # The larger the chunks, the fewer grams they name between them: tasks take a chunk's worth of neighbouring splits.
    size = plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = max(-(-size // CHUNK_BYTES), spark.sparkContext.defaultParallelism)
    plain.coalesce(tasks).mapInArrow(_chunked, "doc_id long, train boolean, text string, chunk long").write.option("compression", "zstd").parquet(f"{folder}/texts")
    texts = spark.read.parquet(f"{folder}/texts")
    texts.mapInArrow(_named, "chunk long, key long, n long").write.option("compression", "zstd").parquet(f"{folder}/named")
    named = spark.read.parquet(f"{folder}/named")
    named.groupBy("key").agg(F.sum("n").alias("n")).write.parquet(f"{folder}/counts")
    counts = spark.read.parquet(f"{folder}/counts")
    token = (F.col("key") < 0) | (F.col("key") == LAST)
    size = counts.where(token).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.coalesce(F.sum((F.col("n") > 0).cast("long")), F.lit(0)).alias("types")).first()
    values = log_probabilities(counts.where(~token)).unionByName(counts.where(token).select("key", F.col("n").cast("double").alias("value")))
    known = named.select("chunk", "key").join(values, "key").select("chunk", "key", "value")
    return (texts.groupBy("chunk").cogroup(known.groupBy("chunk"))
            .applyInArrow(_scored(size["tokens"], size["types"]), SCHEMA))
