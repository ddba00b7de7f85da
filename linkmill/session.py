"""Session with the settings the plans rely on."""

from pyspark.sql import SparkSession


def build_session(app: str = "linkmill", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | conf
    return builder.config(map=settings).getOrCreate()
