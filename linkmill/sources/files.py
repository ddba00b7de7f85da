"""Files by way of Spark's file systems, so that a path may be of any scheme that the session can open: listing, small texts, fingerprints."""

from __future__ import annotations

import fnmatch
import hashlib
import json
import threading
from dataclasses import dataclass

from pyspark.sql import SparkSession

_LOCK = threading.Lock()


@dataclass(frozen=True)
class Found:
    path: str
    name: str
    size: int
    modified: int


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(str(path))
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, fs = _fs(spark, path)
    return fs.exists(at)


def list_files(spark: SparkSession, root: str, pattern: str = "*") -> list[Found]:
    """Files below root whose name fits the pattern, by path; those in folders that begin with `_` or `.` are left out."""
    at, fs = _fs(spark, root)
    if not fs.exists(at):
        return []
    base, out, it = fs.makeQualified(at).toString().rstrip("/"), [], fs.listFiles(at, True)
    while it.hasNext():
        f = it.next()
        path, name = f.getPath().toString(), f.getPath().getName()
        inner = path[len(base) :].split("/")[1:-1]
        if fnmatch.fnmatchcase(name, pattern) and not any(p.startswith(("_", ".")) for p in [*inner, name]):
            out.append(Found(path, name, f.getLen(), f.getModificationTime()))
    return sorted(out, key=lambda f: f.path)


def delete(spark: SparkSession, path: str) -> None:
    at, fs = _fs(spark, path)
    fs.delete(at, True)


def read_text(spark: SparkSession, path: str) -> str:
    at, fs = _fs(spark, path)
    stream = fs.open(at)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Whole or not at all: to a name beside it, then renamed over it."""
    at, fs = _fs(spark, path)
    part = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.tmp")
    stream = fs.create(part, True)
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()
    rename = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    over = spark._sc._gateway.new_array(rename, 1)
    over[0] = rename.OVERWRITE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(at).toUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(part), fs.makeQualified(at), over)


def append_line(spark: SparkSession, path: str, row: dict) -> None:
    """A JSON line at the end of a log, by one thread at a time; where a file system can't append, the log is written anew."""
    line = json.dumps(row, sort_keys=True, ensure_ascii=False) + "\n"
    with _LOCK:
        write_text(spark, path, (read_text(spark, path) if exists(spark, path) else "") + line)


def sampled_fingerprint(spark: SparkSession, path: str, sample: int = 1 << 20) -> dict:
    """Digest of a file's size, its header line and its first, middle and last blocks, read on the driver whatever its size.

    A folder that was written in parts has the digest of its parts'.
    """
    if sample <= 0:
        raise ValueError("the sample must have bytes")
    at, fs = _fs(spark, path)
    if fs.getFileStatus(at).isDirectory():
        parts = [sampled_fingerprint(spark, f.path, sample) for f in list_files(spark, path)]
        told = hashlib.sha256(json.dumps(sorted(p["input_fingerprint"] for p in parts)).encode()).hexdigest()
        return {"input_fingerprint": told, "file_size_bytes": sum(p["file_size_bytes"] for p in parts), "samples": len(parts)}
    size = fs.getFileStatus(at).getLen()
    places = sorted({0, max(0, size // 2 - sample // 2), max(0, size - sample)})
    digest, blocks = hashlib.sha256(b"%d" % size), []
    stream = fs.open(at)
    try:
        for k, place in enumerate(places):
            stream.seek(place)
            block = bytes(stream.readNBytes(min(sample, size - place)))
            if not k:
                header = block[: block.find(b"\n") + 1] or block
                digest.update(len(header).to_bytes(8, "big") + header)
            digest.update(place.to_bytes(8, "big") + len(block).to_bytes(8, "big") + block)
            blocks.append({"offset": place, "bytes": len(block)})
    finally:
        stream.close()
    return {"input_fingerprint": digest.hexdigest(), "file_size_bytes": size, "samples": blocks}


def combined_fingerprint(prints: dict[str, dict]) -> str:
    told = {k: v["input_fingerprint"] for k, v in prints.items()}
    return hashlib.sha256(json.dumps(told, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
