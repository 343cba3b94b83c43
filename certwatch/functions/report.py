"""Values shown in the report tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def urgency(days: Column) -> Column:
    return (
        F.when(days <= 3, "critical").when(days <= 7, "high").when(days <= 30, "medium")
        .when(days.isNotNull(), "ok")
    )


def report_date(c: Column) -> Column:
    return F.coalesce(F.date_format(c, "yyyy-MM-dd"), F.lit("—"))


def csi_changed(match_csi: Column, alert_csi: Column) -> Column:
    return F.coalesce(match_csi != alert_csi, F.lit(False))


def status_warn(status: Column) -> Column:
    return F.coalesce(status != "Activated", F.lit(False))


def source_slug(source: Column) -> Column:
    return F.replace(F.lower(source), F.lit(" "), F.lit("_"))


def subject(source: Column, report_day: Column, n: Column) -> Column:
    noun = F.when(n == 1, " alert)").otherwise(" alerts)")
    return F.concat(source, F.lit(" Certificate Report — "), report_day,
                    F.lit(" ("), n.cast("string"), noun)
