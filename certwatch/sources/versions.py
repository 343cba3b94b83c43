"""Tables that live in immutable folders, and a log that names the ones that count.

A writer fills a new folder first and then appends one version to the log, so a run that fails
midway leaves the former version readable. A version names all its folders with the time they stand for:
dropping old ones, or finding out how old a table is, reads no data.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

_LOG = "version long, folder string, as_of timestamp_ntz"
_KEPT = 2  # versions whose folders stay, for readers that began before the last one


def _log(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(_LOG).parquet(f"{path}/versions")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _version(log: DataFrame, back: int = 0) -> list[Row]:
    versions = [r["version"] for r in log.select("version").distinct().orderBy(F.desc("version")).limit(back + 1).collect()]
    return log.where(F.col("version") == versions[back]).orderBy("as_of", "folder").collect() if len(versions) > back else []


def live_folders(spark: SparkSession, path: str) -> list[Row] | None:
    """(version, folder, as_of) of the last version's folders; None before the first version."""
    log = _log(spark, path)
    return None if log is None else [r for r in _version(log) if r["folder"]]


def new_folder() -> str:
    return f"data-{uuid.uuid4().hex}"


def publish(spark: SparkSession, path: str, folders: Sequence[tuple[str, datetime]]) -> None:
    """Make ``folders`` (name, as_of) the table, and remove those that neither this nor the former version names."""
    log = _log(spark, path)
    former = _version(log) if log is not None else []
    number = former[0]["version"] + 1 if former else 0
    rows = [(number, f, t) for f, t in folders] or [(number, None, None)]
    spark.createDataFrame(rows, _LOG).coalesce(1).write.mode("append").parquet(f"{path}/versions")
    stale = {r["folder"] for r in _version(_log(spark, path), _KEPT)} - {r["folder"] for r in former} - {f for f, _ in folders}
    context = spark.sparkContext
    for folder in stale - {None}:
        old = context._jvm.org.apache.hadoop.fs.Path(f"{path}/{folder}")
        old.getFileSystem(context._jsc.hadoopConfiguration()).delete(old, True)
