"""Acknowledgements inside the lookback window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from certwatch.config import Params
from certwatch.functions.text import strip


def scan_acks(acks: DataFrame, cfg: Params) -> DataFrame:
    """Distinct (ack_source, ack_serial) pairs logged recently enough."""
    oldest = cfg.as_of_ts - F.make_dt_interval(days=F.lit(cfg.ignore_alert_lookback_days))
    return (
        acks.where(F.col("log_datetime") >= oldest)
        .select(strip(F.col("source")).alias("ack_source"),
                F.upper(strip(F.col("serial_number"))).alias("ack_serial"))
        .where((F.col("ack_source") != "") & (F.col("ack_serial") != ""))
        .distinct()
    )
