"""The daily run: snapshot to documents, summary and reports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from certwatch.config import Params
from certwatch.operators import documents, reports, summary
from certwatch.operators.matching import match_outcomes
from certwatch.operators.validation import validate
from certwatch.sources import sinks
from certwatch.staging import measured_broadcasts, stage


@dataclass(frozen=True)
class Run:
    """What one run produces. The matching has run and is staged; no table or report has been written."""

    flat: DataFrame
    rejected: DataFrame
    documents: DataFrame
    certificates: DataFrame
    summary_by_source: DataFrame
    summary: DataFrame


def assemble(certs: DataFrame, acks: DataFrame, replicas: DataFrame, cfg: Params) -> DataFrame:
    """Alert certificates with their outcome, staged: grouping them reads them twice."""
    outcomes = match_outcomes(certs, cfg)
    with measured_broadcasts(certs.sparkSession):
        return stage(documents.assemble_certificates(outcomes, acks, replicas, cfg), "assembled")


def alert_rows(certs: DataFrame, acks: DataFrame, replicas: DataFrame, cfg: Params) -> DataFrame:
    """Flat alert certificates with their documents, staged."""
    assembled = assemble(certs, acks, replicas, cfg)
    with measured_broadcasts(certs.sparkSession):
        return stage(documents.with_documents(assembled, cfg), "flat")


def run(certs: DataFrame, acks: DataFrame, replicas: DataFrame, cfg: Params, snapshot_path: str | None = None) -> Run:
    assembled = assemble(certs, acks, replicas, cfg)
    valid, rejected = validate(assembled)
    with measured_broadcasts(certs.sparkSession):
        flat = stage(documents.with_documents(valid, cfg), "flat")
    headers = documents.document_headers(flat, cfg)
    by_source = summary.run_summary_by_source(flat, cfg)
    stats = stage(documents.upsert_stats(headers, rejected), "stats")
    totals = summary.run_summary(by_source, certs, cfg, snapshot_path).withColumns(
        {name: stats.select(name).scalar() for name in stats.columns})
    return Run(flat, rejected, headers, documents.document_certificates(flat, cfg), by_source, totals)


def merged_alerts(result: Run, cfg: Params, alert_table: str) -> tuple[DataFrame, DataFrame]:
    """(documents, certificates) that the alert table will have after this run, without writing it."""
    docs, certificates = stage(result.documents, "documents"), result.certificates
    stored = sinks.read_alerts(docs.sparkSession, alert_table)
    if stored is None:
        existing, held = docs.limit(0), certificates.limit(0)
    else:
        existing, held = stored
    merged = stage(documents.upsert_alerts(documents.expire_alerts(existing, cfg), docs), "merged")
    return merged, documents.upsert_certificates(held, certificates, merged)


def publish(result: Run, cfg: Params, alert_table: str, report_dir: str, ticket_details: DataFrame | None = None,
            dry_run: bool = False) -> None:
    """Write the alert table, unless this is a dry run, and the quarantined rows, the summary and the reports."""
    if not dry_run:
        sinks.write_alerts(stage(result.documents, "documents"), result.certificates, alert_table, cfg)
    sinks.write_report(result.rejected, f"{report_dir}/quarantine")
    sinks.write_summary(result.summary, f"{report_dir}/summary")
    counts = stage(summary.source_report_counts(result.flat, cfg), "counts")
    # a row per source specification
    rows_of = {r["source_slug"]: r["n_certs"] for r in counts.select("source_slug", "n_certs").collect()}
    sinks.write_source_reports(reports.source_report(result.flat, cfg), rows_of, f"{report_dir}/by_source")
    sinks.write_report(counts, f"{report_dir}/source_counts")
    consolidated = f"{report_dir}/consolidated"
    sinks.write_report(reports.has_action_required(result.flat, cfg), f"{consolidated}/status")
    sinks.write_report(summary.report_snapshot(result.summary_by_source), f"{consolidated}/snapshot")
    sinks.write_report(reports.action_table(result.flat, cfg, ticket_details), f"{consolidated}/action_table")
    sinks.write_report(reports.action_table_details(result.flat, cfg), f"{consolidated}/action_table_details")
    sinks.write_report(reports.possible_match_table(result.flat, cfg), f"{consolidated}/possible_matches")
    sinks.write_report(reports.possible_match_certificates(result.flat, cfg),
                       f"{consolidated}/possible_match_certificates")
