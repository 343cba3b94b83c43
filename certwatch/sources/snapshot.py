"""The certificate snapshot: written once per run, read by everything else.

Each snapshot is a folder of its own that the version log names once it is complete; a build that fails
leaves the former one in place.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession

from certwatch.config import Params
from certwatch.schema import STORED_SNAPSHOT_SCHEMA
from certwatch.sources import versions


def write_snapshot(df: DataFrame, path: str, cfg: Params) -> None:
    """Parquet, one folder per source, each file ordered by days left.

    Alerts (a few days left) and the candidate pool (90 days and more) then sit
    in different row groups, so either scan skips most of the other.
    """
    folder = versions.new_folder()
    (
        df.withColumn("snapshot_ts", cfg.as_of_ts)
        .sortWithinPartitions("sp_name", "days_to_expiration")
        .write.partitionBy("sp_name").parquet(f"{path}/{folder}")
    )
    versions.publish(df.sparkSession, path, [(folder, cfg.as_of_utc)])


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The stored snapshot; a missing path raises."""
    folders = versions.live_folders(spark, path)
    if not folders:
        raise FileNotFoundError(f"no snapshot at {path}")
    names = STORED_SNAPSHOT_SCHEMA.fieldNames()
    return spark.read.schema(STORED_SNAPSHOT_SCHEMA).parquet(f"{path}/{folders[0]['folder']}").select(*names)


def snapshot_is_fresh(spark: SparkSession, path: str, cfg: Params) -> bool:
    """By the version log alone, so that an empty snapshot can be fresh too."""
    folders = versions.live_folders(spark, path)
    return bool(folders) and folders[0]["as_of"] >= cfg.as_of_utc - timedelta(hours=cfg.snapshot_max_age_hours)


def get_or_build_snapshot(spark: SparkSession, path: str, build: Callable[[], DataFrame],
                          cfg: Params, force: bool = False) -> DataFrame:
    """Reuse a fresh snapshot; otherwise build and store a new one."""
    if force or not snapshot_is_fresh(spark, path, cfg):
        write_snapshot(build(), path, cfg)
    return read_snapshot(spark, path)
