"""Helpers shared by the training-data operators: the word and line rules, Arrow batches, worker memory; written tables and size-checked joins come from linkmill.tables."""

from __future__ import annotations

import ctypes
import gc

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkmill.tables import BROADCAST_ROWS, materialise, shared_dir, small, work_path  # noqa: F401  for the operators

#: White space of the word and line rules, as a trim list and as a class of a regular expression.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c):
    """Lower-cases A-Z only. Pure ASCII texts take the quick path, on which lower() is the same."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def words(c):
    """Array of the words `[^\\x20\\x09-\\x0D]+`; null and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(c, F.lit("")), GAP, -1), "")


def parts_for(spark: SparkSession, least: int = 1) -> int:
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))


def with_field(schema: T.StructType, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*[f for f in schema.fields if f.name != name], T.StructField(name, kind)])


#: Rows and bytes of an Arrow batch that carries whole texts; the default of 10,000 rows holds tens of MB on both sides of the pipe,
#: and so do 1,000 rows that are long. A row that is longer is a batch of its own.
TEXT_ROWS, TEXT_BYTES = 1000, 4_000_000
_ROWS_KEY, _BYTES_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"


def text_batches(spark: SparkSession, rows: int = TEXT_ROWS) -> None:
    """Lowers the session's Arrow batches to `rows` rows, unless they are lower already, and to TEXT_BYTES, unless their bytes were set."""
    if spark.conf.get(_BYTES_KEY, None) is None:
        spark.conf.set(_BYTES_KEY, str(TEXT_BYTES))
    now = int(spark.conf.get(_ROWS_KEY))
    if now <= 0 or now > rows:
        spark.conf.set(_ROWS_KEY, str(rows))


_tidied = False


def tidy() -> None:
    """Gives memory that a Python worker no longer uses back to the system; workers are kept for later tasks."""
    import pyarrow as pa

    global _tidied
    if not _tidied:  # what was imported by then is for good, and costs 27 ms at each collection
        gc.freeze()
        _tidied = True
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass
