"""Readers: TSV under a verified contract, Parquet with partitions discovered by Spark, dataset discovery."""

from __future__ import annotations

import os
from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkmill.sources import files

SOURCE_COLUMNS = ("entity_id", "business_name", "business_address", "country")
TRUTH_COLUMNS = ("source1_entity_id", "matched_entity_ids")
FILES = {f"{split}_source{k}": f"{split}_source{k}.tsv" for split in ("train", "test") for k in (1, 2, 3)} | {"train_ground_truth": "train_ground_truth.tsv"}


class ContractError(ValueError):
    """An input that isn't what was agreed."""


def data_root(root: str | None = None, config_root: str | None = None) -> str:
    """The argument, LINKMILL_DATA_ROOT, the configuration's, or data/raw."""
    return str(root or os.environ.get("LINKMILL_DATA_ROOT") or config_root or "data/raw")


def discover(spark: SparkSession, root: str | None = None, config_root: str | None = None, names: dict[str, str] = FILES) -> dict[str, str]:
    """The path of each file, found once at any depth below the root, on any file system that Spark opens.

    A folder of a file's name stands for a file that was written in parts.
    """
    found: dict[str, set[str]] = {k: set() for k in names}
    wanted = {v: k for k, v in names.items()}
    for f in files.list_files(spark, data_root(root, config_root)):
        folder, name = f.path.rsplit("/", 2)[-2], f.name
        if name in wanted:
            found[wanted[name]].add(f.path)
        elif folder in wanted:
            found[wanted[folder]].add(f.path.rsplit("/", 1)[0])
    wrong = [f"{names[k]}: {len(v)} found" for k, v in found.items() if len(v) != 1]
    if wrong:
        raise ContractError("; ".join(wrong))
    return {k: v.pop() for k, v in found.items()}


def organizer_files(spark: SparkSession, root: str) -> list[str]:
    """Files below the root that seem to be a metric, a scorer or a submission check of whoever gave the data."""
    marks = ("metric", "scorer", "validate_submission")
    return [f.path for f in files.list_files(spark, root) if any(m in f.name.lower() for m in marks)]


def tsv(spark: SparkSession, path: str, columns: tuple[str, ...] = SOURCE_COLUMNS) -> DataFrame:
    """All columns as strings, never null, no quoting; the header must hold the columns in their order."""
    header = spark.read.text(str(path)).limit(1).collect()
    if not header or tuple(header[0][0].lstrip("﻿").split("\t")) != columns:
        raise ContractError(f"{path}: the header isn't {columns}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    rows = spark.read.schema(schema).options(sep="\t", header="true", quote="", enforceSchema="false", mode="FAILFAST").csv(str(path))
    return rows.select(*[F.coalesce(c, F.lit("")).alias(c) for c in columns])


def parquet(spark: SparkSession, *paths: str, merge: bool = False) -> DataFrame:
    return spark.read.option("mergeSchema", str(merge).lower()).parquet(*paths)


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def with_target_source(df: DataFrame) -> DataFrame:
    return df.withColumn("target_source", F.concat(F.lit("S"), F.substring("source", 7, 10)))


def select_inputs(df: DataFrame, **allowed: list) -> DataFrame:
    """Rows whose columns hold one of the allowed values; on partition columns this prunes folders."""
    for column, values in allowed.items():
        if values:
            df = df.where(F.col(column).isin(values))
    return df


def partition_shards(spark: SparkSession, root: str, folders: tuple[str, ...] = ("split", "source", "country"), shard: int | None = None, **allowed: list) -> DataFrame:
    """A partitioned table's rows of the folders allowed; with shard, of the file of that number in each folder.

    Only files that are wanted are opened; a table without them gives no rows.
    """
    whole = spark.read.parquet(root)
    if shard is None:
        return select_inputs(whole, **allowed)
    by_folder: dict[str, list[str]] = {}
    for f in files.list_files(spark, root, "*.parquet"):
        by_folder.setdefault(f.path.rsplit("/", 1)[0], []).append(f.path)
    chosen = [paths[shard] for paths in by_folder.values() if shard < len(paths)]
    some = spark.read.schema(whole.schema).option("basePath", root).parquet(*chosen) if chosen else whole.limit(0)
    return select_inputs(some, **allowed)


def file_contract(spark: SparkSession, paths: dict[str, str], columns: dict[str, tuple[str, ...]]) -> list[dict]:
    """Of each file by its logical name: path, size, time of change, columns with their types, rows; the header must be as told."""
    out = []
    for name, path in paths.items():
        rows = tsv(spark, path, columns[name])
        held = files.list_files(spark, path)
        out.append({
            "logical_name": name, "filename": path.rsplit("/", 1)[-1], "file_size_bytes": sum(f.size for f in held), "modified_at": datetime.fromtimestamp(max(f.modified for f in held) / 1000, UTC).isoformat(), "delimiter": "\t", "encoding": "utf-8",
            "columns": rows.columns, "inferred_dtypes": [t for _, t in rows.dtypes], "row_count": rows.count(),
        })
    return out
