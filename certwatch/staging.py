"""Writing an intermediate result to shared storage and reading it back.

A staged table cuts lineage, survives the loss of any executor, and gives the
optimiser real sizes for the joins that follow. Its shuffle files go as soon as it is
written, and ``drop`` removes it after its last reader.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import AbstractContextManager, contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BY_FILES = "spark.sql.autoBroadcastJoinThreshold"
_BY_ROWS = "spark.sql.adaptive.autoBroadcastJoinThreshold"


@contextmanager
def _settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def measured_broadcasts(spark: SparkSession) -> AbstractContextManager[None]:
    """Inside, a join side is broadcast for the bytes of its rows that a shuffle has counted, not for those of its files.

    Columns that repeat are many times smaller in Parquet than in the driver's memory, where a broadcast is built.
    Sides that a plan broadcasts by name are not concerned.
    """
    limit = spark.conf.get(_BY_ROWS, None) or spark.conf.get(_BY_FILES)
    return _settings(spark, {_BY_FILES: "-1", _BY_ROWS: limit})


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` as the side of a join that is never broadcast: rows that grow with the data, in plans that run later, where files tell too little, or with several such joins."""
    return df.hint("merge")


@cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="certwatch-")


def staging_dir(spark: SparkSession) -> str:
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return _local_dir()


def stage(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    spark = df.sparkSession
    path = f"{staging_dir(spark).rstrip('/')}/certwatch-{label}-{uuid.uuid4().hex}"
    with _settings(spark, {_CLEANUP: "true"}):
        df.write.parquet(path, compression=compression)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def drop(*tables: DataFrame) -> None:
    """Remove staged tables that nothing will read any more, not even to make up for lost work."""
    for table in tables:
        context = table.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(table.staged_at)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
