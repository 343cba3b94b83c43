"""Acknowledgement flags, replica counts and the outcome status.

The lookups are plain equi-joins against distinct keys. Both tables grow with
the data and one plan looks up both, so they are sorted and merged whatever their
size, and the driver holds neither; Spark splits skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from certwatch.config import ACTION_REQUIRED, MATCHED_RENEWAL, MISSING_SERVICE, Params
from certwatch.functions.text import parse_triple, strip
from certwatch.sources.acknowledgements import scan_acks
from certwatch.staging import shuffled


def flag_acknowledged(alerts: DataFrame, acks: DataFrame, cfg: Params) -> DataFrame:
    """Adds ``acknowledged``; a certificate without a serial is never acknowledged.

    ``acknowledged_by`` stays NULL: only the fact is looked up, not the person.
    """
    pairs = scan_acks(acks, cfg).withColumn("_acked", F.lit(True))
    keyed = alerts.withColumn("_source", strip(F.col("sp_name"))).withColumn(
        "_serial", F.upper(strip(F.col("serial_number_upper"))))
    return (
        keyed.join(shuffled(pairs), (F.col("_source") == F.col("ack_source"))
                   & (F.col("_serial") == F.col("ack_serial")), "left")
        .withColumn("acknowledged", F.col("_acked").isNotNull())
        .withColumn("acknowledged_by", F.lit(None).cast("string"))
        .drop("_source", "_serial", "_acked", "ack_source", "ack_serial")
    )


def enrich_replicas(alerts: DataFrame, replicas: DataFrame, cfg: Params) -> DataFrame:
    """Adds ``triple`` and the replica counts of sources that have them; NULL means unknown."""
    counts = replicas.groupBy("cluster", "project", "service_name").agg(
        F.max(F.struct("total", "available")).alias("_replicas"))
    counted = [s.name for s in cfg.specs if s.needs_replicas]
    with_triple = alerts.withColumn("triple", parse_triple(F.col("sp_microservice_name")))
    t = F.col("triple")
    cond = (
        F.col("sp_name").isin(*counted)
        & (t["cluster"] == counts["cluster"]) & (t["project"] == counts["project"])
        & (t["service_name"] == counts["service_name"])
    )
    return with_triple.join(shuffled(counts), cond, "left").select(
        *with_triple.columns,
        F.col("_replicas.total").cast("int").alias("replicas_total"),
        F.col("_replicas.available").cast("int").alias("replicas_available"))


def replicas_unknown() -> Column:
    return F.col("replicas_total").isNull() & F.col("replicas_available").isNull()


def alert_status(df: DataFrame, cfg: Params) -> DataFrame:
    """Adds ``status`` and ``attention_required``.

    An acknowledgement outranks everything; unknown replicas outrank a renewal.
    """
    counted = [s.name for s in cfg.specs if s.needs_replicas]
    acked, renewed = F.col("acknowledged"), F.col("renewal").isNotNull()
    missing = F.col("sp_name").isin(*counted) & replicas_unknown()
    status = (
        F.when(acked, ACTION_REQUIRED).when(missing, MISSING_SERVICE)
        .when(renewed, MATCHED_RENEWAL).otherwise(ACTION_REQUIRED)
    )
    attention = ~acked & (missing | ~renewed)
    return df.withColumn("status", status).withColumn("attention_required", attention)
