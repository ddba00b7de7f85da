"""Shard ids without a task per group: rows are sorted by ranges, numbered within their partition, and offset by counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkmill.tables import materialise, small


def shard_ids(df: DataFrame, by: str, order: str, rows: int) -> DataFrame:
    """df with `shard`: floor(place / rows) by the place of each row in its group, in order of a unique column.

    The ranges cut groups of any size; only the counts of (partition, group) are scanned, of which there are fewer than
    partitions and groups together.
    """
    ranged = df.repartitionByRange(by, order).sortWithinPartitions(by, order)
    mark = F.monotonically_increasing_id()
    held = materialise(ranged.withColumn("_part", F.shiftright(mark, 33)).withColumn("_at", mark.bitwiseAND(F.lit((1 << 33) - 1))), "ranged")
    counts = held.groupBy(by, "_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    scan = Window.partitionBy(by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(scan), F.lit(0))).drop("_n").withColumnRenamed(by, "_by").withColumnRenamed("_part", "_of")
    offsets = small(materialise(offsets, "offsets"))
    joined = held.join(offsets, held[by].eqNullSafe(offsets["_by"]) & (held["_part"] == offsets["_of"]))
    place = F.col("_before") + F.col("_at") - F.col("_first")
    return joined.select(*df.columns, F.floor(place / rows).alias("shard"))
