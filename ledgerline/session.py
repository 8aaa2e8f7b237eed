"""Session defaults used by tests, bench and scripts; a cluster brings its own session."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build(master: str = "local[8]", shuffle_partitions: int = 8, memory: str = "6g", **conf: str) -> SparkSession:
    """A local session with the defaults above; keyword arguments override by config name."""
    builder = SparkSession.builder.master(master).config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", memory)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
