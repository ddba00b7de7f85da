"""Partitioned artifacts: what they hold, the manifests beside them, and which partitions can be kept.

A shard is a partition folder of a table (split, source, country), of any number of files. Its digest is computed where its files
lie: each file's SHA-256 by an executor, put together whatever their order. Manifests, one per shard, are a JSON list beside the table.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, fields
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkmill.sources import files
from linkmill.sources.sinks import json_safe

KEYS = ("split", "source", "country")
#: The digest of a shard without rows.
EMPTY = "empty"
STATUSES = ("pending", "running", "complete", "failed")


class ManifestError(ValueError):
    """A manifest or an inventory that can't be trusted."""


@dataclass(frozen=True)
class Manifest:
    """What a finished shard was made of and what it holds."""

    stage: str
    stage_version: str
    split: str | None
    source: str | None
    country: str | None
    shard_id: str
    input_rows: int
    output_rows: int
    config_hash: str
    code_commit: str
    input_fingerprint: str | None
    artifact_path: str
    artifact_size_bytes: int
    artifact_hash: str
    runtime_seconds: float = 0.0
    peak_ram_bytes: int | None = None
    peak_vram_bytes: int | None = None
    status: str = "complete"
    created_at: str = ""

    def __post_init__(self):
        if not self.created_at:
            object.__setattr__(self, "created_at", datetime.now(UTC).isoformat())
        missing = [n for n in ("stage", "stage_version", "shard_id", "config_hash", "code_commit", "artifact_path", "artifact_hash") if not getattr(self, n)]
        negative = [n for n in ("input_rows", "output_rows", "artifact_size_bytes", "runtime_seconds") if getattr(self, n) < 0]
        if missing or negative or self.status not in STATUSES:
            raise ManifestError("; ".join([f"{n} is missing" for n in missing] + [f"{n} is negative" for n in negative] + [f"status {self.status}"] * (self.status not in STATUSES)))

    @property
    def identity(self) -> tuple:
        return self.split, self.source, self.country


def manifest_path(root: str) -> str:
    return f"{root.rstrip('/')}/_manifests.json"


def load_manifests(spark: SparkSession, root: str) -> list[Manifest]:
    """Those beside a table; identities must be distinct. None where there is no list."""
    if not files.exists(spark, manifest_path(root)):
        return []
    try:
        known = {f.name for f in fields(Manifest)}
        out = [Manifest(**{k: v for k, v in m.items() if k in known}) for m in json.loads(files.read_text(spark, manifest_path(root)))]
    except (ValueError, TypeError, AttributeError) as e:
        raise ManifestError(f"{manifest_path(root)}: {e}") from e
    if len({m.identity for m in out}) < len(out):
        raise ManifestError(f"{manifest_path(root)}: repeated identities")
    return out


def save_manifests(spark: SparkSession, root: str, manifests: list[Manifest]) -> None:
    ordered = sorted(manifests, key=lambda m: tuple(x or "" for x in m.identity))
    files.write_text(spark, manifest_path(root), json.dumps(json_safe([asdict(m) for m in ordered]), indent=1, sort_keys=True) + "\n")


def _part(name: str):
    raw = F.regexp_extract(F.col("path"), rf"/{name}=([^/]*)/", 1)
    return F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))


def shards(spark: SparkSession, root: str, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """(split, source, country, n_files, artifact_size_bytes, artifact_hash) of the partition folders of a table."""
    schema = "split string, source string, country string, n_files long, artifact_size_bytes long, artifact_hash string"
    if not files.list_files(spark, root, "*.parquet"):
        return spark.createDataFrame([], schema)
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root)
    each = found.select(*[_part(k).alias(n) for k, n in zip(keys, KEYS, strict=True)], "length", F.sha2("content", 256).alias("sha"))
    mixed = [F.bit_xor(F.xxhash64(F.lit(i), "sha")) for i in range(4)]
    return each.groupBy(*KEYS).agg(
        F.count("*").alias("n_files"), F.sum("length").alias("artifact_size_bytes"), F.sha2(F.concat_ws("-", F.count("*").cast("string"), F.sum("length").cast("string"), *[F.hex(m) for m in mixed]), 256).alias("artifact_hash")
    )


def describe(spark: SparkSession, root: str, keys: tuple[str, ...] = KEYS) -> list[dict]:
    """One dict per shard of a table, with its rows: few, as a shard is a partition folder."""
    held = shards(spark, root, keys).collect()
    if not held:
        return []
    counts = spark.read.parquet(root).groupBy(*[F.col(k).cast("string").alias(n) for k, n in zip(keys, KEYS, strict=True)]).count().collect()
    rows = {(r.split, r.source, r.country): r["count"] for r in counts}
    return [r.asDict() | {"n_rows": rows.get((r.split, r.source, r.country), 0)} for r in held]


def check(manifests: list[Manifest], found: list[dict], stage: str, version: str, config_hash: str, inputs: dict[tuple, str]) -> dict[tuple, str]:
    """Why each shard can't be kept, empty if it can, by identity. inputs tells the fingerprint that each should have been made of."""
    there = {(s["split"], s["source"], s["country"]): s for s in found}
    told = {}
    for m in manifests:
        s, wrong = there.get(m.identity), []
        wrong += ["not complete"] * (m.status != "complete") + ["stage differs"] * (m.stage != stage or m.stage_version != version) + ["configuration differs"] * (m.config_hash != config_hash)
        wrong += ["inputs differ"] * (inputs.get(m.identity) != m.input_fingerprint)
        if s is None:
            wrong += ["missing"] * (m.artifact_hash != EMPTY)  # a shard of no rows has no folder
        elif (s["artifact_size_bytes"], s["n_rows"]) != (m.artifact_size_bytes, m.output_rows):
            wrong.append("size differs")
        elif s["artifact_hash"] != m.artifact_hash:
            wrong.append("corrupt")
        told[m.identity] = ", ".join(wrong)
    return told | {i: "no manifest" for i in there if i not in told}


def require(spark: SparkSession, root: str, stage: str, columns: tuple[str, ...] = (), keys: tuple[str, ...] = KEYS) -> list[Manifest]:
    """The manifests of a table that another stage reads, each shard checked for rows, size and digest, the table for columns."""
    manifests = load_manifests(spark, root)
    found = describe(spark, root, keys)
    mine = [m for m in manifests if m.stage == stage]
    if not mine:
        raise ManifestError(f"{root}: no shard of {stage}")
    told = check(mine, found, stage, mine[0].stage_version, mine[0].config_hash, {m.identity: m.input_fingerprint for m in mine})
    wrong = {"/".join(map(str, i)): w for i, w in told.items() if w}
    missing = [c for c in columns if c not in spark.read.parquet(root).columns]
    if wrong or missing:
        raise ManifestError(f"{root}: {wrong or ''} {'missing columns ' + ', '.join(missing) if missing else ''}".strip())
    return mine
