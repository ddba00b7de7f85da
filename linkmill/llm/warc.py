"""WARC archives by way of a chunked record table.

A payload becomes rows of (record, chunk number, bytes) of at most CHUNK bytes, each with the digest and the length up to
its end, cut from the bytes of the column as they came, so that no step holds a further copy of a record. Records of equal payload of MIN_SHARED bytes or more are one response,
that of the largest page id, and revisits that refer to it. Which are revisits is decided on digests alone and before the
chunks are dealt, so that revisits carry no payload through the shuffle.

Each task writes one archive of a gzip member per record, to a name of its own attempt and then renamed, so that a
repeated task leaves the same file. Reading streams a member at a time into the same chunked table and computes digests
again as the bytes pass.

Defined results: a null payload is empty; a null page id is a page like others, below all numbers; of repeated rows of one
page the first is the response if the page is, the rest revisit it; line breaks in a URL become spaces; an empty table gives no archive and no row.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkmill.llm.common import materialise, parts_for, small, work_path

CHUNK, MIN_SHARED = 65_536, 1000
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {}\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CHUNKS = "page_id long, url string, payload_digest string, payload_bytes long, uid long, chunk_no long, data binary, digest_so_far string, bytes_so_far long, refers_to long"
_KINDS = {"page_id": pa.int64(), "url": pa.string(), "payload_digest": pa.string(), "payload_bytes": pa.int64(), "uid": pa.int64(), "chunk_no": pa.int64(), "data": pa.binary(), "digest_so_far": pa.string(), "bytes_so_far": pa.int64(), "refers_to": pa.int64()}
#: Chunk bytes in an output batch.
OUT_BYTES = 4_000_000


def _payload_column(column: pa.Array):
    """The bytes of each value of a string or binary column, as views of its buffer; a null has none."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, "<i8" if wide else "<i4")[column.offset : column.offset + len(column) + 1].tolist()
    view = memoryview(data) if data is not None else memoryview(b"")
    for a, b in zip(at, at[1:], strict=False):
        yield view[a:b]


def chunk_table(pages: DataFrame) -> DataFrame:
    """Rows (page_id, url, html, payload_digest, payload_bytes, refers_to) as CHUNKS; a revisit, whose html is null, has one empty chunk.

    uid numbers the rows of a task.
    """

    def run(batches):
        part, n = TaskContext.get().partitionId() << 40, 0
        held, size = [], 0
        for batch in batches:
            told = [batch.column(c).to_pylist() for c in ("page_id", "url", "payload_digest", "payload_bytes", "refers_to")]
            for page, url, whole, length, refers, payload in zip(*told, _payload_column(batch.column("html")), strict=True):
                so_far = hashlib.sha1()
                for k in range(max(1, -(-len(payload) // CHUNK))):
                    data = payload[k * CHUNK : (k + 1) * CHUNK]
                    so_far.update(data)
                    held.append((page, url, whole, length, part + n, k, bytes(data), so_far.hexdigest(), k * CHUNK + len(data), refers))
                    size += len(data) + 200
                    if size > OUT_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), _KINDS.values(), strict=True)], list(_KINDS))
                        held, size = [], 0
                n += 1
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), _KINDS.values(), strict=True)], list(_KINDS))

    return pages.select("page_id", "url", "html", "payload_digest", "payload_bytes", "refers_to").mapInArrow(run, CHUNKS)


def with_digests(pages: DataFrame) -> DataFrame:
    """pages (page_id, url, html) with payload_digest and payload_bytes of the html's UTF-8 bytes."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    return pages.select("page_id", "url", "html", F.sha1(payload).alias("payload_digest"), F.octet_length(payload).cast("long").alias("payload_bytes"))


def revisits(digested: DataFrame, min_shared: int = MIN_SHARED) -> DataFrame:
    """(page_id, payload_digest, refers_to) of the pages that a page of larger id stands for."""
    keys = materialise(digested.where(F.col("payload_bytes") >= min_shared).select("page_id", "payload_digest"), "warc-keys")
    last = keys.groupBy("payload_digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1")
    last = small(materialise(last.select("payload_digest", "refers_to"), "warc-last"))  # written, so that both sides of the join are dealt anew and hot digests can be split
    return keys.join(last, "payload_digest").where(~F.col("page_id").eqNullSafe(F.col("refers_to"))).select("page_id", "payload_digest", "refers_to").distinct()


def _record_id(page_id, digest: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{digest}:{copy}')}>"


def _headers(record_type: str, row: dict, copy: int, length: int) -> bytes:
    digest = base64.b32encode(bytes.fromhex(row["payload_digest"])).decode()
    lines = ["WARC/1.1", f"WARC-Type: {record_type}", f"WARC-Record-ID: {_record_id(row['page_id'], row['payload_digest'], copy)}", "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}"]
    if row["url"]:
        lines.append("WARC-Target-URI: " + " ".join(row["url"].split()))
    if row["page_id"] is not None:
        lines.append(f"X-Page-Id: {row['page_id']}")
    lines.append(f"X-Payload-Length: {row['payload_bytes']}")
    if record_type == "revisit":
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_record_id(row['refers_to'], row['payload_digest'], 0)}"]
        lines += [f"X-Refers-To-Page-Id: {row['refers_to']}"] * (row["refers_to"] is not None)
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {length}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def write_archives(pages: DataFrame, out_uri: str, min_shared: int = MIN_SHARED, parts: int | None = None) -> DataFrame:
    """Writes pages (page_id, url, html) under out_uri; the written manifest: path, n_records, n_bytes."""
    digested = with_digests(pages)
    decided = small(materialise(revisits(digested, min_shared), "warc-revisits"))
    same = digested["page_id"].eqNullSafe(decided["page_id"]) & (digested["payload_digest"] == decided["payload_digest"])
    again = decided["payload_digest"].isNotNull()
    told = digested.join(decided, same, "left").select(
        digested["page_id"], "url", F.when(~again, F.col("html")).alias("html"), digested["payload_digest"], "payload_bytes", "refers_to"
    )
    rows = chunk_table(told)
    dealt = rows.repartition(parts or parts_for(pages.sparkSession), "page_id", "payload_digest").sortWithinPartitions("page_id", "payload_digest", "uid", "chunk_no")

    def run(batches):
        fs, base = pafs.FileSystem.from_uri(out_uri)
        attempt, path = f"{base}/.attempt-{uuid.uuid4().hex}", f"{base}/part-{TaskContext.get().partitionId():06d}.warc.gz"
        stream, n_records, key, copy, packer = None, 0, None, -1, None
        for batch in batches:
            columns = {c: batch.column(c) for c in _KINDS}
            for i in range(batch.num_rows):
                row = {c: v[i].as_py() for c, v in columns.items()}
                if (row["page_id"], row["payload_digest"]) != key:
                    key, copy = (row["page_id"], row["payload_digest"]), -1
                if stream is None:
                    fs.create_dir(base, recursive=True)
                    stream = fs.open_output_stream(attempt, compression=None)
                if row["chunk_no"] == 0:
                    copy += 1
                    n_records += 1
                    # a page of its own digest's largest id revisits itself where its row is repeated
                    again = row["refers_to"] is not None or row["payload_bytes"] >= min_shared and copy > 0
                    if again and row["refers_to"] is None:
                        row["refers_to"] = row["page_id"]
                    http = _HTTP.format(row["payload_bytes"]).encode()
                    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
                    stream.write(packer.compress(_headers("revisit" if again else "response", row, copy, len(http) + (0 if again else row["payload_bytes"])) + http))
                if not again:
                    stream.write(packer.compress(row["data"]))
                if again and row["chunk_no"] == 0 or not again and row["bytes_so_far"] == row["payload_bytes"]:
                    stream.write(packer.compress(b"\r\n\r\n") + packer.flush())
        if stream is not None:
            size = stream.tell()
            stream.close()
            fs.move(attempt, path)
            yield pa.RecordBatch.from_pydict({"path": [path], "n_records": pa.array([n_records], pa.int64()), "n_bytes": pa.array([size], pa.int64())})

    return materialise(dealt.mapInArrow(run, "path string, n_records long, n_bytes long"), "warc-manifest")


class _Members:
    """The bytes of a file of gzip members, read(n) and line() at a time; at most STEP bytes are inflated ahead."""

    STEP = 1 << 16

    def __init__(self, f):
        self.f, self.inflate, self.raw, self.held, self.at = f, zlib.decompressobj(31), b"", bytearray(), 0

    def _more(self) -> bool:
        while True:
            self.raw = self.raw or self.f.read(1 << 15)
            ended = not self.raw  # what is inflated already may still wait
            got = self.inflate.decompress(self.raw, self.STEP)
            self.raw = self.inflate.unconsumed_tail
            if self.inflate.eof:
                self.raw = self.inflate.unused_data
                self.inflate = zlib.decompressobj(31)
            if got:
                del self.held[: self.at]
                self.at = 0
                self.held += got
                return True
            if ended:
                return False

    def read(self, n: int) -> bytes:
        while len(self.held) - self.at < n and self._more():
            pass
        out = bytes(self.held[self.at : self.at + n])
        self.at += len(out)
        return out

    def line(self) -> bytes | None:
        seen = self.at
        while (end := self.held.find(b"\r\n", seen)) < 0:
            left = len(self.held) - self.at
            if not self._more():
                return None
            seen = max(self.at, self.at + left - 1)
        out = bytes(self.held[self.at : end])
        self.at = end + 2
        return out


def read_records(f):
    """Chunks of each record of an open archive: (headers, chunk number, bytes, digest so far, bytes so far, last)."""
    members = _Members(f)
    while (line := members.line()) is not None:
        if not line.startswith(b"WARC/"):
            continue
        headers = {}
        while line := members.line():
            name, _, value = line.decode().partition(": ")
            headers[name] = value
        left = int(headers["Content-Length"])
        while line := members.line():  # of the HTTP head
            left -= len(line) + 2
        left -= 2
        digest, total, k = hashlib.sha1(), 0, 0
        while True:
            data = members.read(min(CHUNK, left))
            digest.update(data)
            total, left = total + len(data), left - len(data)
            yield headers, k, data, digest.hexdigest(), total, not left
            k += 1
            if not left:
                break


def read_archives(manifest: DataFrame, out_uri: str, payloads: bool = True) -> DataFrame:
    """The chunked table of written archives with record_type and last; without payloads, its last chunks and no bytes."""
    schema = CHUNKS + ", record_type string, last boolean"

    def run(batches):
        fs, _ = pafs.FileSystem.from_uri(out_uri)
        kinds = [*_KINDS.values(), pa.string(), pa.bool_()]
        names = [*_KINDS, "record_type", "last"]
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with fs.open_input_file(path) as f:
                    held, size = [], 0
                    for n, (h, k, data, so_far, upto, last) in enumerate(read_records(f)):
                        if payloads or last:
                            page, refers = h.get("X-Page-Id"), h.get("X-Refers-To-Page-Id")
                            digest = base64.b32decode(h["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                            held.append((page and int(page), h.get("WARC-Target-URI"), digest, int(h["X-Payload-Length"]), n, k, data if payloads else None, so_far, upto, refers and int(refers), h["WARC-Type"], last))
                            size += len(data) if payloads else 200
                        if size > OUT_BYTES:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), kinds, strict=True)], names)
                            held, size = [], 0
                    if held:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), kinds, strict=True)], names)

    return manifest.select("path").repartition(parts_for(manifest.sparkSession), "path").mapInArrow(run, schema)


def op2_warc(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select(F.col("page_id").cast("long"), "url", "html")
    out_uri = work_path(spark, "warc")
    back = read_archives(write_archives(pages, out_uri), out_uri, payloads=False).where("last")
    response = F.col("record_type") == "response"
    return back.select(
        "page_id",
        F.when(response, F.col("bytes_so_far")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(response, F.col("digest_so_far")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
    )


OP2_SQL = """
WITH p AS (SELECT page_id, sha1(coalesce(html, '')) AS d, strlen(coalesce(html, ''))::BIGINT AS n FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY d) AS m FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
  CASE WHEN n >= 1000 AND page_id < m THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id < m THEN m END AS refers_to FROM g
"""
