"""WARC archives compressed record by record with a trained Zstandard dictionary.

``write`` stores one record per page: of records with equal payloads those with the smallest page_id are responses, the
others revisits of it.  A Zstandard dictionary is trained on a bounded sample of the payloads to be archived
(``SAMPLE_RECORDS`` records by hash order, ``SAMPLE_BYTES`` bytes); every archive begins with a skippable frame that
holds it, and each record is one independent frame, so a reader can begin at any record's offset.  Each task writes its
partition's records in page_id order and renames the finished file, so a repeated or speculative task leaves the same
file.  ``read`` streams archives frame by frame.

Results for odd input: a null html is an empty payload; rows that repeat the smallest page_id of a payload are all
responses; a row without page_id is never the smallest (if all of a payload are without, all are responses); a null url
has no WARC-Target-URI; control characters and blanks in urls are percent-encoded; with too few or too small records to
train on, a raw-content dictionary of the sample is used; an empty table writes no archive and reads back empty."""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard as zstd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import shared_dir

SAMPLE_RECORDS, SAMPLE_BYTES, DICT_BYTES, LEVEL = 1000, 4 << 20, 64 << 10, 3
#: Magic number of the skippable frame that carries a dictionary (fixed by the format).
SKIPPABLE = 0x184D2A5D
DATE = "1970-01-01T00:00:00Z"
READ = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def train(payloads: DataFrame, records: int = SAMPLE_RECORDS, most: int = SAMPLE_BYTES, size: int = DICT_BYTES) -> bytes:
    """Dictionary of a bounded sample of the distinct values of ``payload``; empty if there is nothing to learn from.

    The sample is picked by hash from slim rows; only its own payloads move."""
    def run(batches):
        samples, total = [], 0
        for batch in batches:
            for p in batch.column(0):
                if total < most and p.is_valid and len(p.as_buffer()):
                    samples.append(p.as_py())
                    total += len(samples[-1])
        if samples:
            try:
                d = zstd.train_dictionary(size, samples).as_bytes()
            except zstd.ZstdError:
                d = b"".join(samples)[:size]
            yield pa.RecordBatch.from_pydict({"d": pa.array([d], pa.binary())})

    h = F.xxhash64("payload")
    picked = [r[0] for r in payloads.select(h.alias("h")).distinct().orderBy("h").limit(records).collect()]
    sample = payloads.where(h.isin(picked)).groupBy(h.alias("h")).agg(F.first("payload").alias("payload"))
    rows = sample.select("payload").coalesce(1).sortWithinPartitions(F.xxhash64("payload")).mapInArrow(run, "d binary").collect()
    return bytes(rows[0]["d"]) if rows else b""


def _dictionary(raw: bytes):
    return zstd.ZstdCompressionDict(raw) if raw else None


def _payload():
    return F.coalesce(F.col("html"), F.lit("")).cast("binary")


def plan(pages: DataFrame) -> DataFrame:
    """Rows (page_id, url, payload, digest hex, first): first is the smallest page_id with the payload."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url",
                        _payload().alias("payload"))
    rows = rows.withColumn("sha", F.sha1("payload"))
    first = rows.groupBy("sha").agg(F.min("page_id").alias("first"))
    return rows.join(first, "sha")


def _uri(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record(page_id, url, payload: bytes, digest: str, first, response: bool) -> bytes:
    name = lambda x: uuid.uuid5(uuid.NAMESPACE_OID, f"page:{x}")
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if response else http
    head = ["WARC/1.1", f"WARC-Type: {'response' if response else 'revisit'}", f"WARC-Record-ID: <urn:uuid:{name(page_id)}>",
            f"WARC-Date: {DATE}", "Content-Type: application/http; msgtype=response",
            f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_uri(url)}")
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if not response:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:uuid:{name(first)}>", f"X-Refers-To-Page: {first}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write(pages: DataFrame, path: str, level: int = LEVEL) -> DataFrame:
    """Write the archives under ``path`` (a folder all executors share); rows (archive, records, bytes), already
    written."""
    raw = train(pages.select(_payload().alias("payload")))
    planned = plan(pages)

    def run(batches):
        out, fs, n, size = None, None, 0, 0
        name = f"part-{TaskContext.get().partitionId():05d}.warc.zst"
        for batch in batches:
            cols = (batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "first"))
            for page_id, url, payload, first in zip(*cols):
                if out is None:
                    fs, root = pafs.FileSystem.from_uri(path)
                    fs.create_dir(root, recursive=True)
                    part = f"{root}/.{name}.{TaskContext.get().taskAttemptId()}"
                    out = fs.open_output_stream(part, compression=None)
                    packer = zstd.ZstdCompressor(level=level, dict_data=_dictionary(raw), write_content_size=True)
                    if raw:
                        size += out.write(struct.pack("<II", SKIPPABLE, len(raw)) + raw)
                size += out.write(packer.compress(record(page_id, url, payload, base32_sha1(payload), first, page_id == first)))
                n += 1
        if out is not None:
            out.close()
            fs.move(part, f"{root}/{name}")
            yield pa.RecordBatch.from_pydict({"archive": pa.array([f"{path}/{name}"]), "records": pa.array([n], pa.int64()),
                                              "bytes": pa.array([size], pa.int64())})

    rows = planned.select("page_id", "url", "payload", "first").sortWithinPartitions("page_id", "url")
    done = rows.mapInArrow(run, "archive string, records long, bytes long")
    spark = pages.sparkSession
    return spark.createDataFrame([tuple(r) for r in done.collect()], "archive string, records long, bytes long")


def frames(stream, chunk: int = 1 << 20):
    """Decompressed records of one archive."""
    data = stream.read(chunk)
    unpack = zstd.ZstdDecompressor()
    if len(data) >= 8 and struct.unpack("<I", data[:4])[0] == SKIPPABLE:
        n = struct.unpack("<I", data[4:8])[0]
        while len(data) < 8 + n and (more := stream.read(chunk)):
            data += more
        unpack = zstd.ZstdDecompressor(dict_data=_dictionary(data[8:8 + n]))
        data = data[8 + n:]
    while data or (data := stream.read(chunk)):
        one, out = unpack.decompressobj(), []
        while True:
            out.append(one.decompress(data))
            if one.eof:
                data = one.unused_data
                break
            data = stream.read(chunk)
            if not data:
                raise ValueError("truncated archive")
        yield b"".join(out)


def parse(rec: bytes) -> dict:
    head, rest = rec.split(b"\r\n\r\n", 1)
    lines = head.decode().split("\r\n")
    got = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[:int(got["Content-Length"])]
    kind = got["WARC-Type"]
    payload = block.split(b"\r\n\r\n", 1)[1] if kind == "response" else None
    digest = got["WARC-Payload-Digest"].removeprefix("sha1:")
    if payload is not None and base32_sha1(payload) != digest:
        raise ValueError("payload does not match its digest")
    num = lambda k: int(got[k]) if k in got and got[k] != "None" else None
    return {"page_id": num("X-Page-Id"), "url": got.get("WARC-Target-URI"), "record_type": kind,
            "refers_to": num("X-Refers-To-Page"), "payload_bytes": len(payload) if payload is not None else int(got["X-Payload-Length"]),
            "payload_digest": digest, "payload": payload}


def read(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """Records of the archives named in column ``archive``, one archive a task at a time."""
    def run(batches):
        for batch in batches:
            for name in batch.column(0).to_pylist():
                fs, at = pafs.FileSystem.from_uri(name)
                rows, size = [], 0
                with fs.open_input_stream(at, compression=None) as stream:
                    for rec in frames(stream):
                        size += len(rec)
                        rows.append(parse(rec))
                        if not payloads:
                            rows[-1]["payload"] = None
                        if size > 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])
    n = max(1, archives.count())
    return archives.select("archive").repartition(n).mapInArrow(run, READ)


def round_trip(pages: DataFrame) -> DataFrame:
    """Archive ``pages`` (page_id, url, html) in a fresh folder of the shared directory and read the archives back."""
    path = f"{shared_dir(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    path = path if "://" in path else re.sub("^(file:)?/+", "file:///", path)
    return read(write(pages, path), payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
