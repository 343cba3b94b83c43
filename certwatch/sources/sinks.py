"""Writers for the alert table, the run summary and the reports.

Pipelines only return DataFrames; a dry run is one that leaves the alert table alone.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from certwatch.config import Params
from certwatch.operators.documents import latest_documents
from certwatch.sources import versions
from certwatch.staging import shuffled

_KEY = ("source", "upsert_key")


def read_alerts(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame] | None:
    """(documents, certificates) of the stored alert table, or None before its first version.

    The table is a series of batches, one per run; of documents with one key that of the last batch counts.
    """
    folders = versions.live_folders(spark, path)
    if folders is None:
        return None
    if not folders:
        raise ValueError(f"{path} has no batch left")

    def table(name: str) -> DataFrame:
        parts = [spark.read.parquet(f"{path}/{r['folder']}/{name}").withColumn("_batch", F.lit(i)) for i, r in enumerate(folders)]
        return reduce(DataFrame.unionByName, parts)

    documents, certificates = table("documents"), table("certificates")
    last = documents.groupBy(*_KEY).agg(F.max("_batch").alias("_batch"))
    documents = documents.join(shuffled(last), [*_KEY, "_batch"], "left_semi")
    certificates = certificates.join(
        shuffled(documents.select(*_KEY, "group_ord", "_batch")), [*_KEY, "group_ord", "_batch"], "left_semi")
    return documents.drop("_batch"), certificates.drop("_batch")


def write_alerts(documents: DataFrame, certificates: DataFrame, path: str, cfg: Params) -> None:
    """Add a run's documents and certificates to the alert table, as a batch, and drop batches past retention.

    Nothing stored is read or rewritten: what the batch brings again replaces its key when the table is read.
    """
    spark = documents.sparkSession
    folder = versions.new_folder()
    for name, table in (("documents", latest_documents(documents)), ("certificates", certificates)):
        # no folders per source: a run without alerts must leave a table with columns too
        table.sortWithinPartitions("source").write.parquet(f"{path}/{folder}/{name}")
    keep_after = cfg.as_of_utc - timedelta(hours=cfg.alert_retention_hours)
    kept = [(r["folder"], r["as_of"]) for r in versions.live_folders(spark, path) or () if r["as_of"] > keep_after]
    versions.publish(spark, path, [*kept, (folder, cfg.as_of_utc)])


def write_summary(df: DataFrame, path: str) -> None:
    """The one-row run summary as JSON."""
    df.coalesce(1).write.mode("overwrite").json(path)


def write_source_reports(report: DataFrame, rows_of: Mapping[str, int], path: str) -> None:
    """One folder per source slug, all from one job; slugs without rows (``rows_of``: slug to rows) get a file of no rows."""
    spark, quiet = report.sparkSession, "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    report.write.mode("overwrite").option(quiet, "false").partitionBy("source_slug").parquet(path)
    empty = [slug for slug, n in rows_of.items() if not n]
    if not empty:
        return
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    first = jvm.org.apache.hadoop.fs.Path(f"{path}/source_slug={empty[0]}")
    files = first.getFileSystem(conf)
    spark.createDataFrame([], report.drop("source_slug").schema).coalesce(1).write.option(quiet, "false").parquet(first.toString())
    for slug in empty[1:]:
        jvm.org.apache.hadoop.fs.FileUtil.copy(files, first, files, jvm.org.apache.hadoop.fs.Path(f"{path}/source_slug={slug}"), False, conf)


def write_report(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").parquet(path)
