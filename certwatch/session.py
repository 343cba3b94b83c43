"""Session settings the engine is designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # hash instead of sort for a shuffled join whose measured partitions are small
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # one extra JVM call per column expression while a plan is being built
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int, memory: str = "12g") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName("certwatch")
    local = {
        "spark.sql.shuffle.partitions": str(cores),
        # test tables are a few MB: let them keep one partition per core
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
        "spark.driver.memory": memory,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for k, v in {**SETTINGS, **local}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
