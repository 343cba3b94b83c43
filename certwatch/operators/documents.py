"""Alert certificates grouped into documents, and the stored alert table.

The flat form (one row per certificate, carrying its document's key, order and
details) is what every count and report works on. For storage it is split into
document headers and certificate rows: a document may hold any number of
certificates, so they are rows and not a list in one cell.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from certwatch.config import NO_KEYS, Params, SourceSpec, by_source, key_array
from certwatch.functions.text import parse_san, split_list
from certwatch.operators.enrich import alert_status, enrich_replicas, flag_acknowledged
from certwatch.schema import DETAILS_FIELDS
from certwatch.staging import shuffled


def details_fields(specs: Sequence[SourceSpec]) -> dict[str, str]:
    """Name and SQL type of every detail field of these sources."""
    own = {name: spec.detail_types.get(name, "string") for spec in specs for name in spec.details}
    return DETAILS_FIELDS | {name: kind for name, kind in own.items() if name not in DETAILS_FIELDS}


def source_details(cfg: Params) -> Column:
    """The row's source-specific details as one tagged struct."""
    kinds = details_fields(cfg.specs)

    def details_of(spec: SourceSpec) -> str:
        tag = spec.name.replace("'", r"\'")
        fields = [f"'source_type', '{tag}'"] + [
            f"'{name}', CAST({spec.details.get(name, 'NULL')} AS {kind})" for name, kind in kinds.items()]
        return f"named_struct({', '.join(fields)})"

    return by_source(cfg.specs, details_of, "sp_name", "NULL")


def _null_safe(parts: Column) -> Column:
    """Array of keys as an array without NULLs, so that plain equality groups NULLs together."""
    return F.transform(parts, lambda p: F.coalesce(F.concat(F.lit("="), p), F.lit("-")))


def group_key(cfg: Params) -> Column:
    return _null_safe(by_source(cfg.specs, lambda s: key_array(s.group_keys), "sp_name", NO_KEYS))


def _upsert_key(cfg: Params) -> Column:
    def parts(spec: SourceSpec) -> str:
        named = ("_rep.serial_number" if k == "first_serial" else f"_rep.source_details.{k}"
                 for k in spec.upsert_keys)
        return f"array({', '.join(named)})"

    return _null_safe(by_source(cfg.specs, parts, "source", NO_KEYS))


def assemble_certificates(outcomes: DataFrame, acks: DataFrame, replicas: DataFrame,
                          cfg: Params) -> DataFrame:
    """Match outcomes plus acknowledgement, replicas and status, in output form."""
    df = enrich_replicas(flag_acknowledged(outcomes, acks, cfg), replicas, cfg)
    df = alert_status(df.drop("status"), cfg).withColumns({
        "instances": split_list(F.col("sp_instance_name")), "san_names": parse_san(F.col("sp_san_names"))})
    rank = by_source(cfg.specs, lambda s: str(s.process_rank), "sp_name", str(len(cfg.specs)))
    r = F.col("renewal")
    return df.select(
        "id",
        F.col("sp_name").alias("source"),
        rank.alias("source_rank"),
        group_key(cfg).alias("group_key"),
        F.coalesce("distinguished_name", F.lit("")).alias("distinguished_name"),
        F.coalesce("dn_clean", F.lit("")).alias("dn_clean"),
        F.coalesce("days_to_expiration", F.lit(0)).alias("days_to_expiration"),
        "expiration_date",
        F.coalesce("serial_number_upper", F.lit("")).alias("serial_number"),
        F.col("csi_application_id").alias("csi_id"),
        "attention_required", "status", "acknowledged", "acknowledged_by",
        r["similarity_score"].alias("similarity_score"),
        r["distinguished_name"].alias("renewed_distinguished_name"),
        r["days_to_expiration"].alias("renewed_days_to_expiration"),
        r["expiration_date"].alias("renewed_expiration_date"),
        r["serial_number"].alias("renewed_serial_number"),
        "possible_matches",
        source_details(cfg).alias("source_details"),
    )


def with_documents(certificates: DataFrame, cfg: Params) -> DataFrame:
    """Adds each certificate's document: ``group_ord`` (first certificate's id), the first
    certificate's ``doc_csi_id`` and ``source_details``, ``n_certs`` and ``upsert_key``."""
    key = ["source", "group_key"]
    docs = certificates.groupBy(*key).agg(
        F.min("id").alias("group_ord"),
        F.count(F.lit(1)).alias("n_certs"),
        F.min_by(F.struct("csi_id", "serial_number", "source_details"), "id").alias("_rep"),
    ).select(*key, "group_ord", "n_certs",
             F.col("_rep.csi_id").alias("doc_csi_id"),
             _upsert_key(cfg).alias("upsert_key"),
             F.col("_rep.source_details").alias("source_details"))
    return certificates.drop("source_details").join(shuffled(docs), key)


def alert_certificates(outcomes: DataFrame, acks: DataFrame, replicas: DataFrame,
                       cfg: Params) -> DataFrame:
    """The flat form: one row per alert certificate with its outcome and document."""
    return with_documents(assemble_certificates(outcomes, acks, replicas, cfg), cfg)


_DOCUMENT = ("source", "upsert_key", "group_ord", "log_datetime")
_CERTIFICATE = (
    "id", "distinguished_name", "days_to_expiration", "expiration_date", "serial_number", "csi_id",
    "attention_required", "status", "similarity_score", "renewed_distinguished_name",
    "renewed_days_to_expiration", "renewed_expiration_date", "renewed_serial_number",
    "possible_matches", "acknowledged", "acknowledged_by",
)


def document_summary(flat: DataFrame) -> DataFrame:
    """(source, group_ord, csi_id, n_certs): the documents without their certificates."""
    return flat.where(F.col("id") == F.col("group_ord")).select(
        "source", "group_ord", F.col("doc_csi_id").alias("csi_id"), "n_certs",
        "source_details", "upsert_key")


def document_headers(flat: DataFrame, cfg: Params) -> DataFrame:
    """The stored form of a document, without its certificates."""
    return document_summary(flat).withColumn("log_datetime", cfg.as_of_ts)


def document_certificates(flat: DataFrame, cfg: Params) -> DataFrame:
    """The stored certificates: their document's key, then the certificate. A document's
    first-seen order is that of ``id``."""
    return flat.select(*_DOCUMENT[:-1], *_CERTIFICATE).withColumn("log_datetime", cfg.as_of_ts)


def latest_documents(new: DataFrame) -> DataFrame:
    """Documents that survive within one run: for equal upsert keys the last one wins."""
    key = ["source", "upsert_key"]
    last = new.groupBy(*key).agg(F.max("group_ord").alias("group_ord"))
    return new.join(shuffled(last), [*key, "group_ord"], "left_semi")


def upsert_alerts(existing: DataFrame, new: DataFrame) -> DataFrame:
    """The alert table after replacing, by key, what ``new`` brings again."""
    key = ["source", "upsert_key"]
    replaced = new.select(*key).distinct()
    kept = existing.join(shuffled(replaced), key, "left_anti")
    return kept.unionByName(latest_documents(new).select(*existing.columns))


def upsert_certificates(existing: DataFrame, new: DataFrame, documents: DataFrame) -> DataFrame:
    """The certificates of the alert table, given its ``documents`` after the upsert."""
    rewritten = new.select("source", "upsert_key").distinct()
    kept = existing.join(shuffled(rewritten), ["source", "upsert_key"], "left_anti")
    return kept.unionByName(new.select(*existing.columns)).join(
        shuffled(documents.select(*_DOCUMENT)), [*_DOCUMENT], "left_semi")


def expire_alerts(df: DataFrame, cfg: Params) -> DataFrame:
    """Alerts younger than the retention period."""
    keep_after = cfg.as_of_ts - F.make_dt_interval(secs=F.lit(cfg.alert_retention_hours * 3600))
    return df.where(F.col("log_datetime") > keep_after)


def upsert_stats(new: DataFrame, rejected: DataFrame) -> DataFrame:
    """One row: documents written, rows rejected, documents overwritten inside the run."""
    docs = new.select("source", "upsert_key", "group_ord").distinct()
    keys = docs.groupBy("source", "upsert_key").agg(F.count(F.lit(1)).alias("n"))
    errors = rejected.agg(F.count(F.lit(1)).alias("n")).scalar()
    return keys.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("upserted"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("collisions"),
    ).withColumn("errors", errors)
