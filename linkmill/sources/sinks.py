"""Writers: partitioned Parquet tables, and the values of JSON files and Markdown reports."""

from __future__ import annotations

import math
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkmill.operators import validate

ROW_GROUP_ROWS, ZSTD_LEVEL = 65_536, 3


def _writer(df: DataFrame):
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
    return w.option("parquet.compression.codec.zstd.level", ZSTD_LEVEL).option("parquet.block.row.count.limit", ROW_GROUP_ROWS)


def write_normalized(df: DataFrame, path: str, shard_rows: int = 300_000) -> None:
    """split / source / country folders, Zstd, at most shard_rows a file; only partitions that df holds are replaced."""
    _writer(df).option("maxRecordsPerFile", shard_rows).partitionBy("split", "source", "country").parquet(path)


def write_candidates(df: DataFrame, path: str, schema: T.StructType, split: str) -> None:
    """split / target_source / country folders of the columns of schema, in order of target and candidate within a file."""
    ordered = validate.conform(df, schema).withColumn("split", F.lit(split)).sortWithinPartitions("country", "target_source", "target_entity_id", "candidate_s1_entity_id")
    _writer(ordered).partitionBy("split", "target_source", "country").parquet(path)


def json_safe(x):
    if isinstance(x, dict):
        return {str(k): json_safe(v) for k, v in x.items()}
    if isinstance(x, (list, tuple)):
        return [json_safe(v) for v in x]
    if isinstance(x, float) and not math.isfinite(x):
        return None
    return x.isoformat() if isinstance(x, (datetime, date)) else x


def markdown_table(title: str, rows: list[dict]) -> str:
    names = list(rows[0]) if rows else []
    lines = [f"## {title}", "", "| " + " | ".join(names) + " |", "|" + "---|" * len(names)]
    return "\n".join(lines + ["| " + " | ".join(str(r[n]) for n in names) + " |" for r in rows]) + "\n"


def markdown_report(title: str, parts: dict) -> str:
    """A table for each part that is a list of rows, a line for each other."""
    out = [f"# {title}", ""]
    for name, value in parts.items():
        out.append(markdown_table(name, value) if isinstance(value, list) and value and isinstance(value[0], dict) else f"- {name}: {value}\n")
    return "\n".join(out)
