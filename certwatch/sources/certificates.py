"""Reading certificate records: eligibility filter and document flattening."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from certwatch.config import STATUS_VALID, Params
from certwatch.functions.text import conform, dn_clean, safe_bigint, safe_str, safe_timestamp
from certwatch.schema import KEYED_SNAPSHOT_SCHEMA, SOURCE_PROPERTIES


def scan_eligible(certs: DataFrame, cfg: Params) -> DataFrame:
    """Valid, in a wanted environment and source, inside the load window, recently logged.

    Plain comparisons on stored columns, so the Parquet reader can skip row groups.
    """
    oldest = cfg.as_of_ts - F.make_dt_interval(days=F.lit(cfg.log_date_staleness_days))
    cond = (
        (F.col("status") == STATUS_VALID)
        & F.col("sp_environment").isin(*cfg.environments)
        & (F.col("days_to_expiration") >= cfg.alert_days_min)
        & (F.col("days_to_expiration") < cfg.alert_days_max)
        & (F.col("log_date") >= oldest)
    )
    if cfg.active_sources:
        cond = cond & F.col("sp_name").isin(*cfg.active_sources)
    return certs.where(cond)


def add_computed(df: DataFrame, cfg: Params) -> DataFrame:
    """``dn_clean`` and ``serial_number_upper``."""
    return df.withColumn("dn_clean", dn_clean(F.col("distinguished_name"), cfg.noise_words)).withColumn(
        "serial_number_upper", F.upper("sp_serial_number"))


_DATES, _NUMBERS = ("start_date", "expiration_date", "log_date"), ("csi_application_id", "days_to_expiration")


def _text(name: str) -> Column:
    return F.try_variant_get("v", f"$.{name}", "string")


def _bigint(name: str) -> Column:
    """A whole number; a JSON number with decimals is cut to its whole part, quoted text is not."""
    kind = F.schema_of_variant(F.try_variant_get("v", f"$.{name}", "variant"))
    return F.when(kind == "STRING", safe_bigint(_text(name))).otherwise(
        F.try_variant_get("v", f"$.{name}", "decimal(38,10)").try_cast("bigint"))


def _parsed(docs: DataFrame, doc: str | Column) -> DataFrame:
    """(id, v): the document as a variant, parsed once; NULL where it is no JSON object."""
    column = F.col(doc) if isinstance(doc, str) else doc
    parsed = docs.select("id", column.alias("d"))
    kind = dict(parsed.dtypes)["d"]
    if kind == "string":
        is_object = F.startswith(F.ltrim("d", F.lit(" \t\r\n")), F.lit("{"))
        return parsed.select("id", F.when(is_object, F.try_parse_json("d")).alias("v"))
    return parsed.select("id", (F.col("d") if kind == "variant" else F.to_variant_object("d")).alias("v"))


def flatten_documents(docs: DataFrame, cfg: Params, doc: str | Column = "doc") -> DataFrame:
    """(id, JSON text or struct) to (id, 37 snapshot columns); malformed values become NULL.

    Documents that cannot be read have no row here; ``document_issues`` names them.
    """
    # a generator, as a filter would be pushed below the parsing and repeat it
    readable = _parsed(docs, doc).select("id", F.explode(F.array_compact(F.array("v"))).alias("v"))
    flat = readable.select(
        "id",
        safe_str(_text("distinguished_name")).alias("distinguished_name"),
        safe_timestamp(_text("start_date")).alias("start_date"),
        safe_timestamp(_text("expiration_date")).alias("expiration_date"),
        _bigint("csi_application_id").alias("csi_application_id"),
        safe_str(_text("status")).alias("status"),
        _bigint("days_to_expiration").alias("days_to_expiration"),
        safe_timestamp(_text("log_date")).alias("log_date"),
        *[safe_str(_text(f"source_properties.{p}")).alias(f"sp_{p}") for p in SOURCE_PROPERTIES],
    )
    return to_snapshot(flat, cfg)


def document_issues(docs: DataFrame, doc: str | Column = "doc") -> DataFrame:
    """(id, reason, kept): documents that cannot be read, and those whose dates or numbers cannot, with their fields.

    The latter are kept, with NULL there.
    """
    values = [(n, safe_timestamp(_text(n))) for n in _DATES] + [(n, _bigint(n)) for n in _NUMBERS]
    lost = F.array_compact(F.array(*[F.when(safe_str(_text(n)).isNotNull() & v.isNull(), F.lit(n)) for n, v in values]))
    checked = _parsed(docs, doc).select("id", F.col("v").isNotNull().alias("kept"), lost.alias("lost"))
    reason = F.when(~F.col("kept"), "unreadable document").when(
        F.size("lost") > 0, F.concat(F.lit("malformed "), F.array_join("lost", ", ")))
    return checked.select("id", "kept", F.explode(F.array_compact(F.array(reason))).alias("reason")).select("id", "reason", "kept")


def to_snapshot(flat: DataFrame, cfg: Params) -> DataFrame:
    """Conform flattened rows to (id, 37 snapshot columns) and compute the derived two."""
    return conform(add_computed(flat, cfg), KEYED_SNAPSHOT_SCHEMA)
