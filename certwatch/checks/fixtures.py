"""Certificate tables derived from the generic ``orders`` and ``customer`` tables.

Used by tests, bench and the driver entry. The SQL runs unchanged on Spark and
on DuckDB, so the oracle works on the same rows.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from certwatch.config import Params
from certwatch.functions.text import safe_bigint, safe_str
from certwatch.sources.certificates import scan_eligible, to_snapshot
from certwatch.staging import measured_broadcasts, stage

AS_OF = datetime(2024, 6, 1)
_TASK_ROWS = 100_000

CERTS_SQL = r"""
WITH base AS (
  SELECT o.o_orderkey AS id, o.o_custkey AS ck, o.o_orderstatus AS st, c.c_mktsegment AS seg, c.c_nationkey AS nk,
         CASE WHEN o.o_orderkey % 7 = 0 THEN (o.o_custkey + 1) % 6 ELSE o.o_custkey % 6 END AS src,
         CASE WHEN o.o_orderkey % 11 = 0 THEN o.o_orderkey % 8 ELSE (o.o_orderkey * 37 + o.o_custkey * 11) % 1200 END AS dte,
         substr(md5(CAST(o.o_custkey AS STRING)), 1, 10) AS h,
         substr(md5(CAST(o.o_orderkey AS STRING)), 1, 12) AS sn
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)
SELECT id,
  CASE WHEN id % 97 = 0 THEN 'CN=prod.corp.net,O=Acme'
       WHEN id % 5 = 0 THEN h || '_' || seg || '.svc'
       WHEN id % 5 = 1 THEN 'O=Acme,cn=' || h || '-' || lower(seg) || '.prod.net,C=US'
       WHEN id % 5 = 2 THEN 'CN=' || lower(seg) || '.' || h || '.uat.corp,O=Acme'
       WHEN id % 5 = 3 THEN 'CN=' || h || '.' || seg || '-v2.com,O=Acme'
       ELSE 'CN=' || h || '.' || seg || '-archive-node.com,O=Acme' END AS distinguished_name,
  DATE '2024-06-01' + CAST(dte AS INT) AS expiration_date,
  CASE WHEN id % 13 = 0 THEN 'null' WHEN id % 17 = 0 THEN '12.7' ELSE ' ' || CAST(nk * 100 + ck % 4 AS STRING) END AS csi_raw,
  CASE st WHEN 'F' THEN 'Valid' WHEN 'O' THEN 'Valid' ELSE CASE WHEN id % 3 = 0 THEN 'Expired' ELSE 'Valid' END END AS status,
  CAST(dte AS BIGINT) AS days_to_expiration,
  DATE '2024-06-01' - CAST(id % 10 AS INT) AS log_date,
  CASE src WHEN 0 THEN 'SSG' WHEN 1 THEN 'AKAMAI' WHEN 2 THEN 'HashiCorp' WHEN 3 THEN 'SSL Tracker' WHEN 4 THEN 'Evolven' ELSE 'APIGEE' END AS sp_name,
  CASE WHEN id % 101 = 0 THEN NULL WHEN id % 2 = 0 THEN upper(sn) ELSE sn END AS sp_serial_number,
  CASE WHEN id % 23 = 0 THEN 'DEV' WHEN id % 2 = 0 THEN 'PROD' ELSE 'Production' END AS sp_environment,
  'gw' || CAST(nk AS STRING) || '.example.net' AS sp_ssg_domain,
  CASE WHEN id % 29 = 0 THEN NULL WHEN id % 31 = 0 THEN h ELSE 'cl' || CAST(nk % 5 AS STRING) || '_proj' || CAST(nk AS STRING) || '_dep_' || CAST(ck AS STRING) END AS sp_microservice_name,
  CASE WHEN id % 4 = 0 THEN NULL ELSE 'int' || CAST(nk AS STRING) END AS sp_internal_ssg_domain,
  'ns' || CAST(nk AS STRING) AS sp_openshift_namespace,
  'host' || CAST(ck % 40 AS STRING) AS sp_evolven_host,
  '/opt/' || lower(seg) AS sp_evolven_path,
  CASE WHEN id % 6 = 0 THEN 'null' ELSE 'i' || CAST(ck AS STRING) || ', i' || CAST(id % 3 AS STRING) || ',' END AS sp_instance_name,
  CASE WHEN id % 9 = 0 THEN h || '.a.com, ' || h || '.b.com' WHEN id % 9 = 1 THEN NULL ELSE '[''' || h || '.a.com'', ''' || h || '.b.com'']' END AS sp_san_names,
  CASE WHEN id % 8 = 0 THEN 'Pending' ELSE 'Activated' END AS sp_ssl_cm_status,
  CASE WHEN id % 3 > 0 THEN 'owner ' || CAST(ck % 50 AS STRING) END AS sp_certificate_owner,
  CASE WHEN id % 5 > 0 THEN 'team' || CAST(nk AS STRING) || '@example.net' END AS sp_support_group_email,
  'https://gw' || CAST(nk AS STRING) || '.example.net/' || CAST(ck AS STRING) AS sp_ssg_url,
  CASE WHEN id % 2 = 0 THEN 'in' || CAST(nk AS STRING) || '.example.net' END AS sp_ssg_url_in,
  CASE WHEN id % 7 = 0 THEN ' null ' ELSE 'out' || CAST(nk AS STRING) || '.example.net' END AS sp_ssg_url_out
FROM base
"""

# hosts whose names differ in a number only
NUMBERED_SQL = r"""
SELECT c_custkey AS id, 'CN=node-' || lpad(CAST(c_custkey AS STRING), 7, '0') || '.grid.site,O=Acme' AS distinguished_name,
  DATE '2024-06-01' + CAST(c_custkey % 7 + 1 + CASE WHEN c_custkey % 8 = 0 THEN 0 ELSE 90 + c_custkey % 500 END AS INT) AS expiration_date,
  CAST(c_nationkey AS STRING) AS csi_raw, 'Valid' AS status,
  CAST(c_custkey % 7 + 1 + CASE WHEN c_custkey % 8 = 0 THEN 0 ELSE 90 + c_custkey % 500 END AS BIGINT) AS days_to_expiration,
  DATE '2024-06-01' AS log_date, CASE WHEN c_nationkey % 3 = 0 THEN 'Evolven' ELSE 'SSG' END AS sp_name,
  'sn' || CAST(c_custkey % 1000 AS STRING) AS sp_serial_number, 'PROD' AS sp_environment,
  'gw' || CAST(c_nationkey % 2 AS STRING) AS sp_ssg_domain, CAST(NULL AS STRING) AS sp_microservice_name,
  CAST(NULL AS STRING) AS sp_internal_ssg_domain, CAST(NULL AS STRING) AS sp_openshift_namespace,
  'host' || CAST(c_nationkey AS STRING) AS sp_evolven_host, CAST(NULL AS STRING) AS sp_evolven_path,
  CAST(NULL AS STRING) AS sp_instance_name, CAST(NULL AS STRING) AS sp_san_names, 'Activated' AS sp_ssl_cm_status,
  CAST(NULL AS STRING) AS sp_certificate_owner, CAST(NULL AS STRING) AS sp_support_group_email, CAST(NULL AS STRING) AS sp_ssg_url,
  CAST(NULL AS STRING) AS sp_ssg_url_in, CAST(NULL AS STRING) AS sp_ssg_url_out
FROM customer
"""

ACKS_SQL = """
SELECT sp_name AS source,
       CASE WHEN id % 2 = 0 THEN lower(sp_serial_number) ELSE ' ' || sp_serial_number END AS serial_number,
       DATE '2024-06-01' - CAST(id % 14 AS INT) AS log_date,
       'user' || CAST(id % 5 AS STRING) AS ack_user
FROM certs WHERE days_to_expiration <= 7 AND id % 3 = 0
"""

REPLICAS_SQL = """
SELECT DISTINCT split_part(sp_microservice_name, '_', 1) AS cluster,
       split_part(sp_microservice_name, '_', 2) AS project,
       substr(sp_microservice_name, length(split_part(sp_microservice_name, '_', 1))
              + length(split_part(sp_microservice_name, '_', 2)) + 3) AS service_name,
       CAST(length(sp_microservice_name) % 4 + 1 AS INT) AS total,
       CAST(length(sp_microservice_name) % 3 AS INT) AS available
FROM certs
WHERE sp_name = 'HashiCorp' AND sp_microservice_name LIKE 'cl%' AND sp_microservice_name NOT LIKE '%3'
"""

TICKETS_SQL = """
SELECT DISTINCT id, CASE WHEN id % 2 = 0 THEN 'T-' || CAST(id % 1000 AS STRING) END AS text FROM certs WHERE id % 3 > 0
"""

# some documents are cut short, or no object; dates and numbers come in several forms
CERT_DOCS_SQL = """
SELECT id, CASE WHEN id % 83 = 0 THEN substr(d, 1, length(d) - 5) WHEN id % 89 = 0 THEN '[1, 2]' ELSE d END AS doc
FROM (SELECT id, '{"distinguished_name":"' || distinguished_name || '","csi_application_id":'
  || CASE WHEN id % 3 = 0 THEN CAST(id % 500 AS STRING) WHEN id % 7 = 0 THEN CAST(id % 500 AS STRING) || '.625' ELSE '"' || csi_raw || '"' END
  || CASE id % 4 WHEN 0 THEN ',"start_date":"2023-06-0' || CAST(id % 9 + 1 AS STRING) || 'T08:30:00"'
       WHEN 1 THEN ',"start_date":"2023-01-15"' WHEN 2 THEN ',"start_date":"soon"' ELSE ',"start_date":null' END
  || ',"expiration_date":"' || CAST(expiration_date AS STRING) || '","log_date":"' || CAST(log_date AS STRING) || 'T23:59:59","status":"'
  || status || '","days_to_expiration":'
  || CASE id % 5 WHEN 0 THEN '"' || CAST(days_to_expiration AS STRING) || '"' WHEN 1 THEN CAST(days_to_expiration AS STRING) || '.75'
       WHEN 2 THEN '"' || CAST(days_to_expiration AS STRING) || ' days"' ELSE CAST(days_to_expiration AS STRING) END
  || ',"source_properties":{"name":"' || sp_name || '","instance_name":'
  || CASE WHEN id % 5 = 0 THEN CAST(id AS STRING) ELSE '"' || sp_instance_name || '"' END
  || CASE WHEN id % 4 = 0 THEN '' ELSE ',"environment":" ' || sp_environment || ' "' END
  || coalesce(',"serial_number":"' || sp_serial_number || '"', '') || coalesce(',"microservice_name":"' || sp_microservice_name || '"', '')
  || coalesce(',"san_names":"' || sp_san_names || '"', ',"san_names":null') || coalesce(',"internal_ssg_domain":"' || sp_internal_ssg_domain || '"', '')
  || ',"ssg_domain":"' || sp_ssg_domain || '","openshift_namespace":"' || sp_openshift_namespace || '","evolven_host":"' || sp_evolven_host
  || '","evolven_path":"' || sp_evolven_path || '","ssl_cm_status":"' || sp_ssl_cm_status || '","ssg_url":"' || sp_ssg_url || '"'
  || coalesce(',"certificate_owner":"' || sp_certificate_owner || '"', '') || coalesce(',"support_group_email":"' || sp_support_group_email || '"', '')
  || coalesce(',"ssg_url_in":"' || sp_ssg_url_in || '"', '') || coalesce(',"ssg_url_out":"' || sp_ssg_url_out || '"', '') || '}}' AS d
FROM certs) AS whole
"""


def fixture_params(**overrides) -> Params:
    return Params(as_of=AS_OF, **overrides)


def fresh_name() -> str:
    return uuid.uuid4().hex


def _tasks(df: DataFrame) -> int:
    """So many that every core has work and none gets more than about _TASK_ROWS: a row becomes far more than its bytes in the file."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // _TASK_ROWS))


def raw_certs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived ``certs`` view as the SQL leaves it."""
    orders, customer = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("orders", "customer"))
    n = _tasks(orders)
    if n == spark.sparkContext.defaultParallelism:
        orders = orders.repartition(n)
    else:
        # dealt alike, so that the join keeps these tasks whatever the size of either table; Spark takes no fewer than its setting
        n = max(n, int(spark.conf.get("spark.sql.shuffle.partitions")))
        orders, customer = orders.repartition(n, "o_custkey"), customer.repartition(n, "c_custkey").hint("shuffle_hash")
    return spark.sql(
        CERTS_SQL.replace("FROM orders o JOIN customer c", "FROM {orders} o JOIN {customer} c"),
        orders=orders, customer=customer)


def certs(spark: SparkSession, sf_dir: str, cfg: Params | None = None) -> DataFrame:
    """``certs`` in snapshot form: (id, 37 columns)."""
    return _flattened(raw_certs(spark, sf_dir), cfg or fixture_params())


def numbered_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The eligible ones of the numbered hosts."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    customer = customer.repartition(_tasks(customer))
    raw = spark.sql(NUMBERED_SQL.replace("FROM customer", "FROM {customer}"), customer=customer)
    with measured_broadcasts(spark):
        return stage(scan_eligible(_flattened(raw, fixture_params()), fixture_params()), "snapshot")


def _flattened(raw: DataFrame, cfg: Params) -> DataFrame:
    text = [c for c in raw.columns if c.startswith("sp_")] + ["distinguished_name", "status"]
    flat = raw.withColumn("csi_application_id", safe_bigint(safe_str(F.col("csi_raw")))).withColumns(
        {c: safe_str(F.col(c)) for c in text})
    return to_snapshot(flat, cfg)


def snapshot(spark: SparkSession, sf_dir: str, cfg: Params | None = None) -> DataFrame:
    """The eligible certificates, written once and read back like a real run does."""
    cfg = cfg or fixture_params()
    with measured_broadcasts(spark):
        return stage(scan_eligible(certs(spark, sf_dir, cfg), cfg), "snapshot")


def _derived(sql: str, source: DataFrame) -> DataFrame:
    template = sql.replace("{", "{{").replace("}", "}}").replace("FROM certs", "FROM {certs}")
    return source.sparkSession.sql(template, certs=source)


def acks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived(ACKS_SQL, raw_certs(spark, sf_dir)).select(
        "source", "serial_number", F.lit(None).cast("string").alias("distinguished_name"),
        F.col("ack_user").alias("user"), F.col("log_date").cast("timestamp").alias("log_datetime"))


def replicas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived(REPLICAS_SQL, raw_certs(spark, sf_dir))


def tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived(TICKETS_SQL, raw_certs(spark, sf_dir))


def cert_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived(CERT_DOCS_SQL, raw_certs(spark, sf_dir))
