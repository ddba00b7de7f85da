"""Resumable normalization as a file stream: each run takes the files that no earlier run took, then stops."""

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from linkmill.config import DEFAULTS
from linkmill.operators.normalize import normalize


def normalize_new_files(spark: SparkSession, source: str, out: str, checkpoint: str, config: dict = DEFAULTS["normalization"]) -> None:
    """Parquet files under source (entity_id, business_name, business_address, country) to Parquet by country; exactly once by the checkpoint."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("entity_id", "business_name", "business_address", "country")])
    rows = normalize(spark.readStream.schema(schema).parquet(source), config)
    rows.writeStream.option("checkpointLocation", checkpoint).option("path", out).partitionBy("country").trigger(availableNow=True).format("parquet").start().awaitTermination()
