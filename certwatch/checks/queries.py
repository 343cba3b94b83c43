"""One entry per operator: (spark, sf_dir) -> DataFrame of plain columns."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from certwatch.checks import fixtures as fx
from certwatch.functions import report, text
from certwatch.functions.scoring import indel_score, lcs_length, rounded
from certwatch.operators import documents, enrich, matching, reports, summary
from certwatch.operators.validation import validate
from certwatch.plans.run import alert_rows
from certwatch.sources import certificates, sinks, snapshot
from certwatch.staging import shuffled, stage, staging_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CFG = fx.fixture_params()


def _query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alert_rows(fx.snapshot(spark, sf_dir), fx.acks(spark, sf_dir), fx.replicas(spark, sf_dir), CFG)


def _eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    return certificates.scan_eligible(fx.certs(spark, sf_dir), CFG)


def _alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.extract_alerts(_eligible(spark, sf_dir), CFG)


def _joined(c: str | Column) -> Column:
    return F.array_join(c, "|")


@_query
def eligible_scan(spark, sf_dir):
    return _eligible(spark, sf_dir).select(
        "id", "sp_name", "days_to_expiration", "dn_clean", "serial_number_upper")


@_query
def flatten_documents(spark, sf_dir):
    """All 38 columns; moments as text."""
    flat = certificates.flatten_documents(fx.cert_docs(spark, sf_dir), CFG)
    return flat.select(*[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) if t == "timestamp" else F.col(c) for c, t in flat.dtypes])


@_query
def document_issues(spark, sf_dir):
    return certificates.document_issues(fx.cert_docs(spark, sf_dir))


@_query
def dn_clean(spark, sf_dir):
    return fx.raw_certs(spark, sf_dir).select(
        "id", text.dn_clean(F.col("distinguished_name"), CFG.noise_words).alias("dn_clean"))


@_query
def serial_norm(spark, sf_dir):
    return fx.raw_certs(spark, sf_dir).select(
        "id", text.serial_norm(F.col("sp_serial_number")).alias("serial_norm"))


@_query
def safe_casts(spark, sf_dir):
    raw = fx.raw_certs(spark, sf_dir)
    return raw.select(
        "id", text.safe_str(F.col("csi_raw")).alias("csi_text"),
        text.safe_bigint(F.col("csi_raw")).alias("csi_bigint"),
        text.safe_timestamp(F.col("expiration_date").cast("string")).cast("date").alias("expires"))


@_query
def report_date(spark, sf_dir):
    return fx.raw_certs(spark, sf_dir).select(
        "id", report.report_date(F.col("expiration_date")).alias("expiration"))


@_query
def urgency(spark, sf_dir):
    return fx.raw_certs(spark, sf_dir).select(
        "id", report.urgency(F.col("days_to_expiration")).alias("urgency"))


@_query
def split_instances(spark, sf_dir):
    items = text.split_list(F.col("sp_instance_name"))
    return fx.raw_certs(spark, sf_dir).select("id", items.alias("items")).select(
        "id", _joined("items").alias("instances"), F.size("items").cast("bigint").alias("n"))


@_query
def parse_san(spark, sf_dir):
    return fx.raw_certs(spark, sf_dir).select(
        "id", F.array_join(text.parse_san(F.col("sp_san_names")), "|").alias("san_names"))


@_query
def parse_triple(spark, sf_dir):
    return fx.raw_certs(spark, sf_dir).select(
        "id", text.parse_triple(F.col("sp_microservice_name")).alias("t")).select("id", "t.*")


@_query
def token_sort_ratio_pairs(spark, sf_dir):
    """Each certificate's similarity to the first certificate of its source and service, if any."""
    rows = _eligible(spark, sf_dir).where("dn_clean <> ''").select(
        "id", "sp_name", "sp_microservice_name", text.token_sorted(F.col("dn_clean")).alias("x"))
    first = rows.groupBy(F.col("sp_name").alias("_name"), F.col("sp_microservice_name").alias("_service")).agg(
        F.min("id").alias("first_id"), F.min_by("x", "id").alias("y"))
    total = F.length("x") + F.length("y")
    return (
        rows.join(first, F.col("sp_name").eqNullSafe(F.col("_name")) & F.col("sp_microservice_name").eqNullSafe(F.col("_service")))
        .withColumn("lcs", lcs_length("x", "y"))
        .select("id", "first_id", F.round(text.length_ratio(F.col("x"), F.col("y")), 6).alias("length_ratio"),
                rounded(indel_score(total, F.col("lcs"))).alias("score"))
    )


@_query
def alert_extract(spark, sf_dir):
    return _alerts(spark, sf_dir).select("id", "sp_name", "days_to_expiration")


@_query
def alert_counts_by_source(spark, sf_dir):
    return summary.alert_counts_by_source(_alerts(spark, sf_dir), CFG)


@_query
def renewal_candidates(spark, sf_dir):
    return matching.renewal_candidate_counts(fx.snapshot(spark, sf_dir), CFG)


@_query
def renewals(spark, sf_dir):
    r = F.col("renewal")
    return matching.find_renewals(fx.snapshot(spark, sf_dir), CFG).select(
        "id", "sp_name", r["cand_id"].alias("cand_id"), r["serial_number"].alias("renewed_serial"),
        r["days_to_expiration"].alias("renewed_days"),
        report.report_date(r["expiration_date"]).alias("renewed_expiration"),
        r["similarity_score"].alias("similarity_score"), r["csi_id"].alias("renewed_csi"),
        r["ssl_cm_status"].alias("renewed_status"))


@_query
def possible_matches(spark, sf_dir):
    m = F.col("match")
    return matching.find_possible_matches(fx.snapshot(spark, sf_dir), CFG).select(
        "id", F.col("rank").cast("bigint").alias("match_no"), m["cand_id"].alias("cand_id"),
        m["distinguished_name"].alias("match_dn"), m["serial_number"].alias("match_serial"),
        m["days_to_expiration"].alias("match_days"),
        report.report_date(m["expiration_date"]).alias("match_expiration"),
        m["similarity_score"].alias("similarity_score"), m["csi_id"].alias("match_csi"),
        m["ssl_cm_status"].alias("match_status"), m["source"].alias("match_source"))


@_query
def match_outcomes(spark, sf_dir):
    return matching.match_outcomes(fx.snapshot(spark, sf_dir), CFG).select(
        "id", "sp_name", F.col("renewal.cand_id").alias("renewal_id"),
        F.size("possible_matches").cast("bigint").alias("n_possible"),
        F.array_min(F.col("possible_matches.cand_id")).alias("lowest_possible"))


@_query
def numbered_hosts(spark, sf_dir):
    """Renewals and possible matches where all names resemble each other."""
    return matching.match_outcomes(fx.numbered_snapshot(spark, sf_dir), CFG).select(
        "id", "sp_name", F.col("renewal.cand_id").alias("renewal_id"), F.col("renewal.similarity_score").alias("similarity_score"),
        F.array_join(F.transform("possible_matches", lambda m: m["cand_id"].cast("string")), ",").alias("possible_ids"))


@_query
def ack_flags(spark, sf_dir):
    return enrich.flag_acknowledged(_alerts(spark, sf_dir), fx.acks(spark, sf_dir), CFG).select(
        "id", "acknowledged")


@_query
def replica_enrich(spark, sf_dir):
    return enrich.enrich_replicas(_alerts(spark, sf_dir), fx.replicas(spark, sf_dir), CFG).where(
        "sp_name = 'HashiCorp'").select("id", "triple.*", "replicas_total", "replicas_available",
                                        enrich.replicas_unknown().alias("replicas_unknown"))


@_query
def alert_status(spark, sf_dir):
    return _flat(spark, sf_dir).select("id", "status", "attention_required", "acknowledged")


@_query
def alert_documents(spark, sf_dir):
    flat = _flat(spark, sf_dir)
    return flat.where("id = group_ord").select(
        "source", _joined("group_key").alias("group_key"), "group_ord",
        F.col("doc_csi_id").alias("csi_id"), "n_certs")


@_query
def alert_documents_nested(spark, sf_dir):
    """Every document with each of its certificates."""
    flat = _flat(spark, sf_dir)
    key = ["source", "upsert_key", "group_ord", "log_datetime"]
    headers = documents.document_headers(flat, CFG).drop("source_details").withColumnRenamed("csi_id", "doc_csi_id")
    return documents.document_certificates(flat, CFG).join(shuffled(headers), key).select(
        "source", "group_ord", F.col("doc_csi_id").alias("csi_id"), "n_certs", _joined("upsert_key").alias("upsert_key"),
        "id", "distinguished_name", "days_to_expiration", report.report_date(F.col("expiration_date")).alias("expiration"),
        "serial_number", F.col("csi_id").alias("certificate_csi_id"), "attention_required", "status", "acknowledged",
        "similarity_score", "renewed_distinguished_name", "renewed_days_to_expiration",
        report.report_date(F.col("renewed_expiration_date")).alias("renewed_expiration"), "renewed_serial_number",
        F.date_format("log_datetime", "yyyy-MM-dd").alias("log_day"),
        F.size("possible_matches").cast("bigint").alias("n_possible"),
        F.array_min(F.col("possible_matches.cand_id")).alias("lowest_possible"))


@_query
def source_details(spark, sf_dir):
    d = F.col("source_details")
    lists, counts = ("instances", "san_names"), ("total", "available")
    plain = [f for f in ("source_type", *documents.details_fields(CFG.specs)) if f not in (*lists, "replicas")]
    return documents.document_summary(_flat(spark, sf_dir)).select(
        "source", "group_ord", *[d[f].alias(f) for f in plain], *[F.array_join(d[f], "|").alias(f) for f in lists],
        *[d["replicas"][c].alias(f"replicas_{c}") for c in counts])


def _docs(flat: DataFrame) -> DataFrame:
    return documents.document_summary(flat).withColumn("log_datetime", CFG.as_of_ts)


@_query
def upsert_alerts(spark, sf_dir):
    """A table holding yesterday's documents under their own and under retired keys."""
    new = stage(_docs(_flat(spark, sf_dir)), "docs")
    yesterday = CFG.as_of_ts - F.make_dt_interval(days=F.lit(1))
    retired = new.where("source <> 'SSG'").withColumn("upsert_key", F.array(
        F.concat(F.lit("old:"), _joined("upsert_key"))))
    existing = new.unionByName(retired).withColumn("log_datetime", yesterday)
    return documents.upsert_alerts(existing, new).select(
        "source", _joined("upsert_key").alias("upsert_key"), "group_ord", "csi_id", "n_certs",
        F.date_format("log_datetime", "yyyy-MM-dd").alias("log_day"))


@_query
def alert_table(spark, sf_dir):
    """Three runs into a stored alert table: one past retention by now, one half a day ago with the present keys and
    retired ones, and the present one; read back with the number of certificates each document has."""
    flat = _flat(spark, sf_dir)
    path = f"{staging_dir(spark)}/certwatch-alerts-{fx.fresh_name()}"
    other = flat.where("source <> 'SSG'")
    for hours, prefix, rows in ((48, "gone:", flat), (12, None, flat), (0, None, flat)):
        cfg = replace(CFG, as_of=CFG.as_of - timedelta(hours=hours))
        renamed = (rows if prefix else other).withColumn("upsert_key", F.array(F.concat(F.lit(prefix or "old:"), _joined("upsert_key"))))
        rows = renamed if hours == 48 else rows.unionByName(renamed) if hours else rows
        sinks.write_alerts(documents.document_headers(rows, cfg), documents.document_certificates(rows, cfg), path, cfg)
    docs, certificates = sinks.read_alerts(spark, path)
    key = ["source", "upsert_key", "group_ord"]
    return docs.join(shuffled(certificates.groupBy(*key).agg(F.count(F.lit(1)).alias("n_stored"))), key, "left").select(
        "source", _joined("upsert_key").alias("upsert_key"), "group_ord", "csi_id", "n_certs", "n_stored",
        F.date_format("log_datetime", "yyyy-MM-dd").alias("log_day"))


@_query
def source_report_files(spark, sf_dir):
    """The reports of all sources as they are written and read back, those without rows too."""
    only = CFG.consolidated_sources[:1]
    flat = _flat(spark, sf_dir)
    counts = summary.source_report_counts(flat.where(~F.col("source").isin(*only)), CFG).collect()
    path = f"{staging_dir(spark)}/certwatch-reports-{fx.fresh_name()}"
    sinks.write_source_reports(reports.source_report(flat.where(~F.col("source").isin(*only)), CFG),
                               {r["source_slug"]: r["n_certs"] for r in counts}, path)
    parts = [spark.read.parquet(f"{path}/source_slug={r['source_slug']}").agg(F.count(F.lit(1)).alias("n_rows"), F.max("row_no").alias("last_row"))
             .select(F.lit(r["source_slug"]).alias("source_slug"), "n_rows", F.col("last_row").cast("long").alias("last_row")) for r in counts]
    return reduce(DataFrame.unionByName, parts)


@_query
def expire_alerts(spark, sf_dir):
    """Documents aged 0 to 47 hours."""
    age = F.make_dt_interval(hours=(F.col("group_ord") % 48).cast("int"))
    docs = _docs(_flat(spark, sf_dir)).withColumn("log_datetime", CFG.as_of_ts - age)
    return documents.expire_alerts(docs, CFG).select(
        "source", _joined("upsert_key").alias("upsert_key"), "group_ord")


@_query
def upsert_stats(spark, sf_dir):
    flat = _flat(spark, sf_dir)
    _, rejected = validate(flat)
    return documents.upsert_stats(_docs(flat), rejected)


@_query
def run_summary_by_source(spark, sf_dir):
    return summary.run_summary_by_source(_flat(spark, sf_dir), CFG)


@_query
def run_summary_totals(spark, sf_dir):
    snap = fx.snapshot(spark, sf_dir)
    flat = alert_rows(snap, fx.acks(spark, sf_dir), fx.replicas(spark, sf_dir), CFG)
    used = F.col("settings_snapshot")
    return summary.run_summary(summary.run_summary_by_source(flat, CFG), snap, CFG, "the/snapshot").select(
        "snapshot_row_count", "total_action_required", "total_matched_renewal", "total_missing_service", "snapshot_path",
        F.date_format("run_datetime", "yyyy-MM-dd HH:mm:ss").alias("run_datetime"),
        F.expr("array_join(transform(sources, s -> concat_ws(':', s.source, s.action_required, s.matched_renewal, s.missing_service, "
               "s.total_alerts)), ';')").alias("sources"),
        used["renewal_score_threshold"].alias("renewal_score_threshold"), used["length_ratio_min"].alias("length_ratio_min"),
        (used["alert_days_max"] + 0).cast("bigint").alias("alert_days_max"), _joined(used["active_sources"]).alias("active_sources"),
        F.to_json(used["environments"]).alias("environments"))


@_query
def report_snapshot(spark, sf_dir):
    return summary.report_snapshot(summary.run_summary_by_source(_flat(spark, sf_dir), CFG))


@_query
def action_table(spark, sf_dir):
    return reports.action_table(_flat(spark, sf_dir), CFG, fx.tickets(spark, sf_dir))


@_query
def action_table_details(spark, sf_dir):
    return reports.action_table_details(_flat(spark, sf_dir), CFG)


@_query
def possible_match_table(spark, sf_dir):
    m = F.col("m")
    return reports.possible_match_table(_flat(spark, sf_dir), CFG).select(
        "row_no", "dn_clean", "distinguished_name", "csi_id", F.posexplode("matches").alias("i", "m")
    ).select("row_no", "dn_clean", "distinguished_name", "csi_id",
             (F.col("i") + 1).cast("bigint").alias("match_no"), m["distinguished_name"].alias("match_dn"),
             m["similarity_score"].alias("similarity_score"), m["csi_changed"].alias("csi_changed"),
             m["status_warn"].alias("status_warn"))


@_query
def possible_match_certificates(spark, sf_dir):
    return reports.possible_match_certificates(_flat(spark, sf_dir), CFG)


@_query
def source_report(spark, sf_dir):
    return reports.source_report(_flat(spark, sf_dir), CFG).drop("source_details")


@_query
def source_report_counts(spark, sf_dir):
    return summary.source_report_counts(_flat(spark, sf_dir), CFG)


@_query
def has_action_required(spark, sf_dir):
    return reports.has_action_required(_flat(spark, sf_dir), CFG)


@_query
def snapshot_roundtrip(spark, sf_dir):
    path = f"{staging_dir(spark)}/certwatch-roundtrip-{fx.fresh_name()}"
    snapshot.write_snapshot(_eligible(spark, sf_dir), path, CFG)
    return snapshot.read_snapshot(spark, path).select(
        "id", "sp_name", "days_to_expiration", "dn_clean", "serial_number_upper",
        report.report_date(F.col("expiration_date")).alias("expiration"))


@_query
def snapshot_reuse(spark, sf_dir):
    """The second call finds the first one's snapshot fresh and does not build."""
    path = f"{staging_dir(spark)}/certwatch-reuse-{fx.fresh_name()}"
    snapshot.get_or_build_snapshot(spark, path, lambda: _eligible(spark, sf_dir), CFG)
    reused = snapshot.get_or_build_snapshot(spark, path, lambda: spark.range(0), CFG)
    return reused.groupBy("sp_name").agg(
        F.count(F.lit(1)).alias("n"), F.min("days_to_expiration").alias("min_days"))


@_query
def quarantine(spark, sf_dir):
    """Certificates with some dates removed and some day counts negated."""
    broken = fx.certs(spark, sf_dir).withColumns({
        "expiration_date": F.when(F.col("id") % 53 != 0, F.col("expiration_date")),
        "days_to_expiration": F.when(F.col("id") % 59 == 0, F.lit(-1).cast("bigint"))
        .otherwise(F.col("days_to_expiration"))})
    _, rejected = validate(broken)
    return rejected.select("id", "reason")
