"""Tables written to the folder that driver and executors share: they cut lineage and survive lost executors."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a broadcast side at most; beyond it the join is shuffled and left to adaptive skew handling.
BROADCAST_ROWS = 500_000


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where that is unset and the master is local, a folder of this machine, else an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return "file://" + os.path.join(tempfile.gettempdir(), "checkpoints")


def run_folder(spark: SparkSession) -> str:
    """The folder of all tables that this application writes."""
    return f"{shared_dir(spark)}/linkmill-{spark.sparkContext.applicationId}"


def work_path(spark: SparkSession, name: str) -> str:
    """A new path in the run's folder; a repeated call never meets an older one's files."""
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def drop_written(spark: SparkSession) -> None:
    """Removes every table that this application wrote; results that read one must have been used up by then."""
    path = spark._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """df written as a table in the run's folder and read again."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(side: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Marks a written table for broadcast if its counted rows are within the limit, else leaves it as it is."""
    return F.broadcast(side) if side.count() <= limit else side
