"""Counts over the flat alert certificates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from certwatch.config import ACTION_REQUIRED, MATCHED_RENEWAL, MISSING_SERVICE, Params
from certwatch.functions.report import source_slug, subject


def sources_dim(spark: SparkSession, cfg: Params) -> DataFrame:
    """(source_order, source) of the active sources, in report order."""
    active = [(i, s.name) for i, s in enumerate(cfg.specs) if s.name in cfg.active_sources]
    names = F.array(*[F.struct(F.lit(i).alias("source_order"), F.lit(n).alias("source")) for i, n in active])
    return spark.range(1).select(F.inline(names)) if active else spark.createDataFrame(
        [], "source_order int, source string")


def alert_counts_by_source(alerts: DataFrame, cfg: Params) -> DataFrame:
    counts = alerts.groupBy(F.col("sp_name").alias("source")).agg(F.count(F.lit(1)).alias("n"))
    return sources_dim(alerts.sparkSession, cfg).join(counts, "source", "left").select(
        "source", F.coalesce("n", F.lit(0)).alias("n_alerts"))


def run_summary_by_source(flat: DataFrame, cfg: Params) -> DataFrame:
    """Status counts per active source, zero where there is nothing."""
    counts = flat.groupBy("source").agg(
        F.count_if((F.col("status") == ACTION_REQUIRED) & ~F.col("acknowledged")).alias("action_required"),
        F.count_if(F.col("status") == MATCHED_RENEWAL).alias("matched_renewal"),
        F.count_if(F.col("status") == MISSING_SERVICE).alias("missing_service"),
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return (
        sources_dim(flat.sparkSession, cfg).join(counts, "source", "left")
        .select("source_order", "source", zero("action_required"), zero("matched_renewal"),
                zero("missing_service"))
        .withColumn("total_alerts", F.expr("action_required + matched_renewal + missing_service"))
    )


# fixed values: the settings that a run's summary names
_SETTINGS = (
    "alert_days_threshold", "alert_days_max", "log_date_staleness_days", "renewal_min_days", "renewal_score_threshold",
    "possible_match_score_threshold", "length_ratio_min", "max_possible_candidates", "max_possible_display",
    "ignore_alert_lookback_days", "environments", "active_sources", "consolidated_sources",
)


def settings_snapshot(cfg: Params) -> Column:
    """The settings used, as numbers and lists."""
    def value(v: object) -> Column:
        return F.array(*map(F.lit, v)).cast("array<string>") if isinstance(v, tuple) else F.lit(v)

    return F.struct(*[value(getattr(cfg, name)).alias(name) for name in _SETTINGS])


def run_summary(by_source: DataFrame, snapshot: DataFrame, cfg: Params, snapshot_path: str | None = None) -> DataFrame:
    """One row: totals, snapshot size and place, per-source rows and the settings used."""
    rows = snapshot.agg(F.count(F.lit(1)).alias("n")).scalar()
    per_source = F.struct("source_order", "source", "action_required", "matched_renewal",
                          "missing_service", "total_alerts")
    return by_source.agg(
        F.coalesce(F.sum("action_required"), F.lit(0)).alias("total_action_required"),
        F.coalesce(F.sum("matched_renewal"), F.lit(0)).alias("total_matched_renewal"),
        F.coalesce(F.sum("missing_service"), F.lit(0)).alias("total_missing_service"),
        # one element per source specification
        F.array_sort(F.collect_list(per_source)).alias("sources"),
    ).select(
        cfg.as_of_ts.alias("run_datetime"), F.lit(snapshot_path).cast("string").alias("snapshot_path"),
        rows.alias("snapshot_row_count"), "*", settings_snapshot(cfg).alias("settings_snapshot"))


def source_report_counts(flat: DataFrame, cfg: Params) -> DataFrame:
    """Counts shown on each source's report; acknowledged certificates are included here."""
    counts = flat.groupBy("source").agg(
        F.count_if(F.col("status") == ACTION_REQUIRED).alias("action_required"),
        F.count_if(F.col("status") == MATCHED_RENEWAL).alias("matched_renewal"),
        F.count_if(F.col("status") == MISSING_SERVICE).alias("missing_service"),
        F.count(F.lit(1)).alias("n_certs"),
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    day = F.date_format(cfg.as_of_ts, "yyyy-MM-dd")
    return (
        sources_dim(flat.sparkSession, cfg).join(counts, "source", "left")
        .select("source", source_slug(F.col("source")).alias("source_slug"),
                zero("action_required"), zero("matched_renewal"), zero("missing_service"), zero("n_certs"))
        .withColumn("subject", subject(F.col("source"), day, F.col("n_certs")))
    )


def report_snapshot(by_source: DataFrame) -> DataFrame:
    """Sources with open alerts. Missing-service certificates are not counted here, though
    they do appear in the action table."""
    return by_source.where("action_required > 0").select("source_order", "source", "action_required")
