"""Report tables, as data.

Lists without a bound (the occurrences of one certificate, the serials of one
DN) are child tables with a position instead of arrays, so a DN that a third of
the alerts share is still just rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from certwatch.config import MATCHED_RENEWAL, Params, SourceSpec, by_source
from certwatch.functions.report import csi_changed, report_date, source_slug, status_warn, urgency
from certwatch.operators.ranking import number_rows
from certwatch.staging import shuffled

_ORDER = ["sort1", "sort2", "source_rank", "group_ord", "id"]
_CERT = ["distinguished_name", "serial_number", "source"]


def source_summary(cfg: Params) -> Column:
    """One line describing the document's source details."""
    def line(spec: SourceSpec) -> str:
        pieces = (p if p.startswith("'") else f"coalesce(source_details.{p}, '—')" for p in spec.summary)
        return f"concat({', '.join(pieces)})"

    return by_source(cfg.specs, line, "source", "''")


def action_required(flat: DataFrame, cfg: Params) -> DataFrame:
    """Open certificates of the consolidated sources, with their report order."""
    days = F.coalesce(F.col("days_to_expiration"), F.lit(9999))
    csi = F.coalesce(F.col("doc_csi_id"), F.lit(999999))
    sort1, sort2 = {
        "days_to_expiration": (F.lpad(days.cast("string"), 19, "0"), F.col("source")),
        "source": (F.col("source"), F.lpad(days.cast("string"), 19, "0")),
        "csi_id": (F.lpad(csi.cast("string"), 19, "0"), F.lpad(days.cast("string"), 19, "0")),
    }[cfg.sort_mode]
    return (
        flat.where(F.col("attention_required") & ~F.col("acknowledged")
                   & F.col("source").isin(*cfg.consolidated_sources))
        .withColumn("sort1", sort1).withColumn("sort2", sort2)
    )


def has_action_required(flat: DataFrame, cfg: Params) -> DataFrame:
    open_now = F.col("attention_required") & ~F.col("acknowledged") & F.col("source").isin(
        *cfg.consolidated_sources)
    return flat.agg(F.coalesce(F.bool_or(open_now), F.lit(False)).alias("has_action_required"))


def action_table(flat: DataFrame, cfg: Params, ticket_details: DataFrame | None = None) -> DataFrame:
    """Table 1: one row per (DN, serial, source), the first occurrence in report order.

    ``ticket_details`` (id, text) optionally fills the ticket column.
    """
    rows = action_required(flat, cfg)
    order = F.struct(*_ORDER)
    shown = F.struct("id", "doc_csi_id", "days_to_expiration", "expiration_date")
    table = rows.groupBy(*_CERT).agg(
        F.min(order).alias("o"), F.min_by(shown, order).alias("c"),
        F.count(F.lit(1)).alias("n_occurrences"),
    ).select(*_CERT, "o.*", F.col("c.doc_csi_id").alias("csi_id"), "c.days_to_expiration",
             "c.expiration_date", "n_occurrences")
    numbered = number_rows(table, _ORDER)
    if ticket_details is not None:
        numbered = numbered.join(shuffled(ticket_details.select("id", F.col("text").alias("ticket"))), "id", "left")
    else:
        numbered = numbered.withColumn("ticket", F.lit(None).cast("string"))
    return numbered.select(
        "row_no", *_CERT, "csi_id", "days_to_expiration",
        urgency(F.col("days_to_expiration")).alias("urgency"),
        report_date(F.col("expiration_date")).alias("expiration"),
        F.coalesce("ticket", F.lit("N/A")).alias("ticket"), "n_occurrences")


def action_table_details(flat: DataFrame, cfg: Params) -> DataFrame:
    """Table 1's numbered source details: (DN, serial, source, item_no, summary)."""
    rows = action_required(flat, cfg).withColumn("summary", source_summary(cfg))
    slim = rows.select(*_CERT, *[c for c in _ORDER if c not in _CERT], "summary")
    return number_rows(slim, _ORDER, "item_no", per=_CERT).select(*_CERT, "item_no", "summary")


def possible_match_table(flat: DataFrame, cfg: Params) -> DataFrame:
    """Table 2: one row per cleaned DN that has possible matches, with up to three of them."""
    order = F.struct(*_ORDER)
    groups = action_required(flat, cfg).groupBy("dn_clean").agg(
        F.min(order).alias("o"),
        F.min_by(F.struct("distinguished_name", "doc_csi_id"), order).alias("first"),
        F.expr(f"min_by(possible_matches, struct({', '.join(_ORDER)})) "
               "FILTER (WHERE size(possible_matches) > 0)").alias("matches"),
    ).where("matches IS NOT NULL")
    flagged = F.transform(F.slice("matches", 1, 3), lambda m: m
                          .withField("csi_changed", csi_changed(m["csi_id"], F.col("first.doc_csi_id")))
                          .withField("status_warn", status_warn(m["ssl_cm_status"])))
    table = groups.select("dn_clean", "o.*", F.col("first.distinguished_name").alias("distinguished_name"),
                          F.col("first.doc_csi_id").alias("csi_id"), flagged.alias("matches"))
    return number_rows(table, _ORDER).select(
        "row_no", "dn_clean", "distinguished_name", "csi_id", "matches")


def possible_match_certificates(flat: DataFrame, cfg: Params) -> DataFrame:
    """Table 2's distinct expiring certificates per cleaned DN, numbered in report order."""
    cert = ["serial_number", "doc_csi_id", "days_to_expiration", "expiration_date"]
    rows = action_required(flat, cfg)
    shown = rows.where(F.size("possible_matches") > 0).select("dn_clean").distinct()
    distinct = rows.groupBy("dn_clean", *cert).agg(F.min(F.struct(*_ORDER)).alias("o")) \
        .join(shuffled(shown), "dn_clean", "left_semi").select("dn_clean", *cert, "o.*")
    return number_rows(distinct, _ORDER, "item_no", per=["dn_clean"]).select(
        "dn_clean", "item_no", "serial_number", F.col("doc_csi_id").alias("csi_id"),
        "days_to_expiration", urgency(F.col("days_to_expiration")).alias("urgency"),
        report_date(F.col("expiration_date")).alias("expiration"))


def source_report(flat: DataFrame, cfg: Params) -> DataFrame:
    """Every alert certificate of each active source, acknowledged ones included."""
    renewed = (F.col("status") == MATCHED_RENEWAL) & (F.col("renewed_distinguished_name") != "")
    kind = F.when(renewed, "renewal").when(F.col("acknowledged"), "acknowledged").otherwise("none")
    rows = flat.where(F.col("source").isin(*cfg.active_sources))
    return number_rows(rows, ["source", "group_ord", "id"], per=["source"]).select(
        "source", source_slug(F.col("source")).alias("source_slug"), "row_no", "source_details",
        source_summary(cfg).alias("summary"), "distinguished_name", "serial_number",
        "days_to_expiration", urgency(F.col("days_to_expiration")).alias("urgency"),
        report_date(F.col("expiration_date")).alias("expiration"),
        kind.alias("match_kind"), "similarity_score", "renewed_distinguished_name",
        "renewed_serial_number", "renewed_days_to_expiration",
        report_date(F.col("renewed_expiration_date")).alias("renewed_expiration"), "status")
