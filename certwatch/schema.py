"""Explicit schemas; nothing in the engine infers types from data."""

from __future__ import annotations

from pyspark.sql import types as T

# Properties nested under source_properties, each flattened to sp_<name>.
SOURCE_PROPERTIES = (
    "name", "serial_number", "certificate_type", "certificate_owner", "certificate_name",
    "owner_email", "support_group", "support_group_email", "application_manager",
    "l3_application_head", "l4_application_head", "environment", "evolven_host",
    "evolven_path", "ssg_domain", "ssg_url_in", "ssg_url_out", "internal_ssg_domain",
    "ssg_url", "san_names", "instance_name", "microservice_name", "openshift_namespace",
    "openshift_container", "ssl_cm_region", "ssl_cm_sector", "ssl_cm_status", "lob_domain",
)

_S, _L, _TS = T.StringType(), T.LongType(), T.TimestampType()

SNAPSHOT_SCHEMA = T.StructType(
    [
        T.StructField("distinguished_name", _S),
        T.StructField("start_date", _TS),
        T.StructField("expiration_date", _TS),
        T.StructField("csi_application_id", _L),
        T.StructField("status", _S),
        T.StructField("days_to_expiration", _L),
        T.StructField("log_date", _TS),
    ]
    + [T.StructField(f"sp_{p}", _S) for p in SOURCE_PROPERTIES]
    + [T.StructField("dn_clean", _S), T.StructField("serial_number_upper", _S)]
)

# In the engine every row also has its stable order; the stored form adds the build time.
KEYED_SNAPSHOT_SCHEMA = T.StructType([T.StructField("id", _L)] + SNAPSHOT_SCHEMA.fields)
STORED_SNAPSHOT_SCHEMA = T.StructType(
    KEYED_SNAPSHOT_SCHEMA.fields + [T.StructField("snapshot_ts", _TS)])

ACK_SCHEMA = T.StructType(
    [T.StructField(n, _S) for n in ("source", "serial_number", "distinguished_name", "user")]
    + [T.StructField("log_datetime", _TS)]
)

REPLICA_SCHEMA = T.StructType(
    [T.StructField(n, _S) for n in ("cluster", "project", "service_name")]
    + [T.StructField(n, T.IntegerType()) for n in ("total", "available")]
)

# Detail shapes of the known sources, told apart by source_type; specifications may add fields.
DETAILS_FIELDS: dict[str, str] = {
    "domain": "string", "internal_domain": "string", "service_name": "string",
    "url": "string", "url_in": "string", "url_out": "string",
    "instances": "array<string>",
    "cluster": "string", "project": "string",
    "replicas": "struct<total:int,available:int>",
    "host": "string", "path": "string",
    "certificate_owner": "string", "support_group_email": "string",
    "san_names": "array<string>",
    "status": "string",
}
