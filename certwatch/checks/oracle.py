"""DuckDB SQL computing the same answers the slow, obvious way.

The views are the driver's tables. One WITH block builds the certificate tables
and each stage of the run; every query is a final SELECT over it. Similarity is
computed for every pair of distinct strings that Levenshtein distance does not
already rule out (it never exceeds the insert/delete distance).
"""

from __future__ import annotations

import json

from certwatch.checks.fixtures import ACKS_SQL, CERT_DOCS_SQL, CERTS_SQL, NUMBERED_SQL, REPLICAS_SQL, TICKETS_SQL
from certwatch.config import DEFAULT_ENVIRONMENTS, DEFAULT_NOISE_WORDS
from certwatch.schema import SOURCE_PROPERTIES


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _safe(c: str) -> str:
    return f"CASE WHEN lower(trim({c})) IN ('null', '') THEN NULL ELSE trim({c}) END"


def _bigint(c: str) -> str:
    return f"CASE WHEN regexp_full_match(trim({c}), '[+-]?[0-9]+') THEN CAST(trim({c}) AS BIGINT) END"


def _dn_clean(c: str) -> str:
    noise = "|".join(DEFAULT_NOISE_WORDS)
    cn = f"coalesce(nullif(regexp_extract({c}, '(?i)CN=([^,]+)', 1), ''), {c})"
    return (f"trim(regexp_replace(regexp_replace(regexp_replace(lower({cn}), '[.\\-_]', ' ', 'g'), "
            f"'\\b(?:{noise})\\b', ' ', 'g'), '\\s+', ' ', 'g'))")


def _lcs(x: str, y: str) -> str:
    """Longest common subsequence of two strings of at most 126 characters."""
    full = f"((1::HUGEINT << length({x})) - 1)"
    mask = (f"list_sum(list_transform(range(length({x})), lambda i: "
            f"CASE WHEN substr({x}, CAST(i + 1 AS BIGINT), 1) = c THEN (1::HUGEINT << CAST(i AS INT)) ELSE 0::HUGEINT END))::HUGEINT")
    masks = f"list_transform(string_split({y}, ''), lambda c: {mask})"
    step = f"lambda v, m: ((v + (v & m)) | (v - (v & m))) & {full}"
    return f"(length({x}) - bit_count(list_reduce({masks}, {step}, {full})))"


def _day(c: str) -> str:
    return f"coalesce(strftime({c}, '%Y-%m-%d'), '—')"


_URGENCY = ("CASE WHEN days_to_expiration <= 3 THEN 'critical' WHEN days_to_expiration <= 7 THEN 'high' "
            "WHEN days_to_expiration <= 30 THEN 'medium' WHEN days_to_expiration IS NOT NULL THEN 'ok' END")
_SOURCES = ("SSG", "AKAMAI", "HashiCorp", "SSL Tracker", "Evolven", "APIGEE")
_TEXT = ("distinguished_name", "status", "sp_name", "sp_serial_number", "sp_environment", "sp_ssg_domain",
         "sp_microservice_name", "sp_internal_ssg_domain", "sp_openshift_namespace", "sp_evolven_host",
         "sp_evolven_path", "sp_instance_name", "sp_san_names", "sp_ssl_cm_status", "sp_certificate_owner",
         "sp_support_group_email", "sp_ssg_url", "sp_ssg_url_in", "sp_ssg_url_out")


def _whole(name: str) -> str:
    """A whole number of a document; numbers are cut, quoted ones are not."""
    text = f"doc->>'$.{name}'"
    return (f"CASE WHEN json_type(doc, '$.{name}') = 'VARCHAR' THEN {_bigint(_safe(text))} "
            f"ELSE CAST(trunc(TRY_CAST({text} AS DOUBLE)) AS BIGINT) END")


def _property(name: str) -> str:
    return f"doc->>'$.source_properties.{name}'"


def _wild(*keys: str) -> str:
    return " AND ".join(f"(a.{k} IS NULL OR c.{k} = a.{k})" for k in keys)


_SAME_KEYS = f"""CASE a.sp_name
  WHEN 'SSG' THEN {_wild('sp_ssg_domain', 'sp_microservice_name', 'sp_internal_ssg_domain')}
  WHEN 'HashiCorp' THEN {_wild('sp_openshift_namespace', 'sp_microservice_name')}
  WHEN 'Evolven' THEN {_wild('sp_evolven_host', 'sp_evolven_path')}
  WHEN 'APIGEE' THEN {_wild('sp_evolven_host', 'sp_evolven_path', 'sp_ssg_domain')}
  ELSE {_wild('sp_serial_number')} END"""


def _key(*parts: str) -> str:
    return " || '|' || ".join(f"coalesce('=' || {p}, '-')" for p in parts)


_GROUP_KEY = f"""CASE sp_name
  WHEN 'SSG' THEN {_key('sp_ssg_domain', 'sp_microservice_name', 'sp_internal_ssg_domain')}
  WHEN 'HashiCorp' THEN {_key('sp_openshift_namespace', 'sp_microservice_name')}
  WHEN 'Evolven' THEN {_key('sp_evolven_host', 'sp_evolven_path', 'sp_instance_name')}
  WHEN 'APIGEE' THEN {_key('sp_evolven_host', 'sp_evolven_path', 'sp_ssg_domain')}
  ELSE {_key('sp_serial_number')} END"""


def _part(i: int) -> str:
    """Part i of the service name, split into at most three."""
    third = ("substr(sp_microservice_name, length(split_part(sp_microservice_name, '_', 1)) "
             "+ length(split_part(sp_microservice_name, '_', 2)) + 3)")
    text = third if i == 3 else f"split_part(sp_microservice_name, '_', {i})"
    return (f"CASE WHEN sp_microservice_name IS NULL OR len(string_split(sp_microservice_name, '_')) < {i} "
            f"THEN 'unknown' ELSE {text} END")


def _known(c: str) -> str:
    return f"nullif({c}, 'unknown')"


def _only(value: str, *sources: str) -> str:
    """A detail that these sources have."""
    return f"CASE WHEN sp_name IN {_in(sources)} THEN {value} END"


_ITEMS = """array_to_string(list_filter(list_transform(string_split(coalesce(sp_instance_name, ''), ','),
    lambda p: trim(p)), lambda p: p <> ''), '|')"""

_CTES: dict[str, str] = {
    "certs": CERTS_SQL,
    "snap": f"""
SELECT id, expiration_date, days_to_expiration, log_date,
  {_bigint(_safe('csi_raw'))} AS csi,
  {', '.join(f'{_safe(c)} AS {c}' for c in _TEXT)},
  {_dn_clean(_safe('distinguished_name'))} AS dn_clean,
  upper({_safe('sp_serial_number')}) AS serial
FROM certs""",
    "elig": f"""
SELECT *, array_to_string(list_sort(string_split(dn_clean, ' ')), ' ') AS sorted FROM snap
WHERE status = 'Valid' AND sp_environment IN {_in(DEFAULT_ENVIRONMENTS)} AND sp_name IN {_in(_SOURCES)}
  AND days_to_expiration >= 1 AND days_to_expiration < 1095 AND log_date >= DATE '2024-06-01' - 7""",
    "alerts": f"""
SELECT *, {_GROUP_KEY} AS group_key,
  {_part(1)} AS cluster, {_part(2)} AS project, {_part(3)} AS service_name
FROM elig WHERE days_to_expiration BETWEEN 0 AND 7""",
    "pool": "SELECT * FROM elig WHERE days_to_expiration >= 90 AND serial IS NOT NULL AND dn_clean <> ''",
    "close": """
SELECT x, y FROM (SELECT DISTINCT sorted AS x FROM alerts WHERE dn_clean <> '') p,
  (SELECT DISTINCT sorted AS y FROM pool) q
WHERE abs(length(x) - length(y)) * 10 <= length(x) + length(y)
  AND levenshtein(x, y) * 10 <= length(x) + length(y)""",
    "pairs": f"""
SELECT x, y, 200.0 * lcs / (length(x) + length(y)) AS score
FROM (SELECT x, y, {_lcs('x', 'y')} AS lcs FROM close)
WHERE 200 * lcs >= 90 * (length(x) + length(y))
  AND least(length(x), length(y)) * 10 >= 6 * greatest(length(x), length(y))""",
    "scored": f"""
SELECT a.id, c.id AS cand_id, c.distinguished_name AS cand_dn, c.serial AS cand_serial,
  c.days_to_expiration AS cand_days, c.expiration_date AS cand_exp, c.csi AS cand_csi,
  c.sp_ssl_cm_status AS cand_status, c.sp_name AS cand_source, c.dn_clean AS cand_clean,
  a.dn_clean AS own_clean, p.score, a.sp_name = c.sp_name AND ({_SAME_KEYS}) AS same_keys
FROM alerts a JOIN pairs p ON p.x = a.sorted JOIN pool c ON c.sorted = p.y
WHERE c.serial <> coalesce(a.serial, '')""",
    "renewals": """
SELECT * FROM scored WHERE same_keys
QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, cand_id) = 1""",
    "possibles": """
SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, cand_id) AS match_no FROM scored
WHERE cand_clean <> own_clean AND id NOT IN (SELECT id FROM renewals)
QUALIFY match_no <= 3""",
    "acks": ACKS_SQL,
    "ackset": """
SELECT DISTINCT trim(source) AS source, upper(trim(serial_number)) AS serial FROM acks
WHERE log_date >= DATE '2024-06-01' - 7 AND trim(serial_number) <> ''""",
    "replicas": REPLICAS_SQL,
    "states": """
SELECT a.*, k.serial IS NOT NULL AS acknowledged, r.total, r.available,
  n.cand_id IS NOT NULL AS renewed, n.cand_dn, n.cand_serial, n.cand_days, n.cand_exp,
  round_even(n.score, 2)::DOUBLE AS score
FROM alerts a
LEFT JOIN ackset k ON k.source = trim(a.sp_name) AND k.serial = trim(a.serial)
LEFT JOIN replicas r ON a.sp_name = 'HashiCorp' AND r.cluster = a.cluster AND r.project = a.project
  AND r.service_name = a.service_name
LEFT JOIN renewals n ON n.id = a.id""",
    "outcomes": """
SELECT *, CASE WHEN acknowledged THEN 'Action Required'
    WHEN sp_name = 'HashiCorp' AND total IS NULL AND available IS NULL THEN 'Missing Service'
    WHEN renewed THEN 'Matched Renewal' ELSE 'Action Required' END AS outcome,
  NOT acknowledged AND (NOT renewed OR (sp_name = 'HashiCorp' AND total IS NULL AND available IS NULL)) AS attention,
  min(id) OVER (PARTITION BY sp_name, group_key) AS group_ord,
  count(*) OVER (PARTITION BY sp_name, group_key) AS n_certs
FROM states""",
    "flat": f"""
SELECT o.*, d.csi AS doc_csi, coalesce(o.serial, '') AS serial_number,
  CASE o.sp_name WHEN 'SSG' THEN 0 WHEN 'HashiCorp' THEN 1 WHEN 'Evolven' THEN 2 WHEN 'APIGEE' THEN 3
    WHEN 'AKAMAI' THEN 4 ELSE 5 END AS source_rank,
  CASE o.sp_name
    WHEN 'SSG' THEN {_key('d.sp_ssg_domain', 'd.sp_microservice_name', 'd.sp_internal_ssg_domain')}
    WHEN 'HashiCorp' THEN {_key(_known('d.cluster'), _known('d.project'), _known('d.service_name'))}
    WHEN 'Evolven' THEN {_key('d.sp_evolven_host', 'd.sp_evolven_path')}
    WHEN 'APIGEE' THEN {_key('d.sp_evolven_host', 'd.sp_evolven_path', 'd.sp_ssg_domain')}
    ELSE '=' || coalesce(d.serial, '') END AS upsert_key,
  CASE o.sp_name
    WHEN 'SSG' THEN coalesce(d.sp_microservice_name, '—') || ' @ ' || coalesce(d.sp_ssg_domain, '—')
    WHEN 'HashiCorp' THEN coalesce({_known('d.cluster')}, '—') || '/' || coalesce({_known('d.project')}, '—')
      || '/' || coalesce({_known('d.service_name')}, '—')
    WHEN 'Evolven' THEN coalesce(d.sp_evolven_host, '—') || coalesce(d.sp_evolven_path, '—')
    WHEN 'APIGEE' THEN coalesce(d.sp_ssg_domain, '—') || ' — ' || coalesce(d.sp_evolven_host, '—')
    WHEN 'AKAMAI' THEN 'Owner: ' || coalesce(d.sp_certificate_owner, '—')
    ELSE 'Status: ' || coalesce(d.sp_ssl_cm_status, '—') END AS summary
FROM outcomes o JOIN alerts d ON d.id = o.group_ord""",
    "docs": """
SELECT sp_name AS source, upsert_key, group_key, group_ord, doc_csi AS csi_id, n_certs
FROM flat WHERE id = group_ord""",
    "by_source": f"""
SELECT s.source_order, s.source,
  count(*) FILTER (WHERE outcome = 'Action Required' AND NOT acknowledged) AS action_required,
  count(*) FILTER (WHERE outcome = 'Matched Renewal') AS matched_renewal,
  count(*) FILTER (WHERE outcome = 'Missing Service') AS missing_service
FROM (VALUES {', '.join(f"({i}, '{s}')" for i, s in enumerate(_SOURCES))}) s(source_order, source)
LEFT JOIN flat ON flat.sp_name = s.source GROUP BY ALL""",
    "open_rows": """
SELECT *, row_number() OVER (ORDER BY days_to_expiration, sp_name, source_rank, group_ord, id) AS pos
FROM flat WHERE attention AND NOT acknowledged""",
    "table1": """
SELECT *, count(*) OVER w AS n_occurrences, row_number() OVER (
    PARTITION BY distinguished_name, serial_number, sp_name ORDER BY pos) AS item_no
FROM open_rows WINDOW w AS (PARTITION BY distinguished_name, serial_number, sp_name)""",
    "table2": """
SELECT dn_clean, min(pos) AS pos, arg_min_null(distinguished_name, pos) AS distinguished_name,
  arg_min_null(doc_csi, pos) AS csi_id,
  arg_min(id, pos) FILTER (WHERE id IN (SELECT id FROM possibles)) AS match_from
FROM open_rows GROUP BY dn_clean HAVING match_from IS NOT NULL""",
    "cert_docs": CERT_DOCS_SQL,
    "tickets": TICKETS_SQL,
}

_MATERIALIZED = {"elig", "alerts", "pool", "pairs", "scored", "renewals", "possibles", "flat", "open_rows"}


def with_tables(select: str, **instead: str) -> str:
    ctes = ",\n".join(
        f"{name} AS {'MATERIALIZED ' if name in _MATERIALIZED else ''}({sql})" for name, sql in (_CTES | instead).items())
    return f"WITH {ctes}\n{select}"


_LATEST = "(SELECT * FROM docs QUALIFY row_number() OVER (PARTITION BY source, upsert_key ORDER BY group_ord DESC) = 1)"
_SELECTS: dict[str, str] = {
    "eligible_scan": "SELECT id, sp_name, days_to_expiration, dn_clean, serial AS serial_number_upper FROM elig",
    "flatten_documents": f"""
SELECT id, {_safe("doc->>'$.distinguished_name'")} AS distinguished_name,
  {', '.join(f"strftime(TRY_CAST(doc->>'$.{c}' AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS {c}" for c in ('start_date', 'expiration_date', 'log_date'))},
  {', '.join(f"{_whole(c)} AS {c}" for c in ('csi_application_id', 'days_to_expiration'))}, {_safe("doc->>'$.status'")} AS status,
  {', '.join(f"{_safe(_property(p))} AS sp_{p}" for p in SOURCE_PROPERTIES)},
  {_dn_clean(_safe("doc->>'$.distinguished_name'"))} AS dn_clean, upper({_safe(_property('serial_number'))}) AS serial_number_upper
FROM (SELECT * FROM cert_docs WHERE json_valid(doc) AND doc LIKE '{{%')""",
    "document_issues": f"""
SELECT id, 'unreadable document' AS reason, false AS kept FROM cert_docs WHERE NOT json_valid(doc) OR doc NOT LIKE '{{%'
UNION ALL
SELECT id, 'malformed ' || array_to_string(lost, ', '), true FROM (
  SELECT id, list_filter([CASE WHEN TRY_CAST(doc->>'$.start_date' AS TIMESTAMP) IS NULL AND doc->>'$.start_date' <> '' THEN 'start_date' END,
    CASE WHEN {_whole('csi_application_id')} IS NULL AND {_safe("doc->>'$.csi_application_id'")} <> '' THEN 'csi_application_id' END,
    CASE WHEN {_whole('days_to_expiration')} IS NULL AND {_safe("doc->>'$.days_to_expiration'")} <> '' THEN 'days_to_expiration' END],
    lambda x: x IS NOT NULL) AS lost
  FROM (SELECT * FROM cert_docs WHERE json_valid(doc) AND doc LIKE '{{%')) WHERE len(lost) > 0""",
    "dn_clean": f"SELECT id, {_dn_clean('distinguished_name')} AS dn_clean FROM certs",
    "serial_norm": f"SELECT id, upper({_safe('sp_serial_number')}) AS serial_norm FROM certs",
    "safe_casts": f"""
SELECT id, {_safe('csi_raw')} AS csi_text, {_bigint('csi_raw')} AS csi_bigint,
  CAST(CAST(expiration_date AS VARCHAR) AS DATE) AS expires FROM certs""",
    "report_date": f"SELECT id, {_day('expiration_date')} AS expiration FROM certs",
    "urgency": f"SELECT id, {_URGENCY} AS urgency FROM certs",
    "split_instances": f"""
SELECT id, array_to_string(list_filter(list_transform(string_split({_safe('sp_instance_name')}, ','),
    lambda p: trim(p)), lambda p: p <> ''), '|') AS instances,
  coalesce(len(list_filter(string_split({_safe('sp_instance_name')}, ','), lambda p: trim(p) <> '')), 0)::BIGINT AS n
FROM certs WHERE {_safe('sp_instance_name')} IS NOT NULL
UNION ALL SELECT id, '', 0 FROM certs WHERE {_safe('sp_instance_name')} IS NULL""",
    "parse_san": """
SELECT id, array_to_string(coalesce(regexp_extract_all(sp_san_names, '[A-Za-z0-9.-]+'), []), '|') AS san_names
FROM certs""",
    "parse_triple": f"""
SELECT id, {_part(1)} AS cluster, {_part(2)} AS project, {_part(3)} AS service_name FROM certs""",
    "token_sort_ratio_pairs": f"""
SELECT id, first_id, lr AS length_ratio, round_even(200.0 * lcs / (length(x) + length(y)), 2)::DOUBLE AS score
FROM (SELECT a.id, c.id AS first_id, a.sorted AS x, c.sorted AS y, {_lcs('a.sorted', 'c.sorted')} AS lcs,
    round(least(length(a.sorted), length(c.sorted)) / greatest(length(a.sorted), length(c.sorted)), 6) AS lr
  FROM elig a JOIN (SELECT sp_name, sp_microservice_name, min(id) AS id FROM elig WHERE dn_clean <> '' GROUP BY ALL) f
    ON f.sp_name IS NOT DISTINCT FROM a.sp_name AND f.sp_microservice_name IS NOT DISTINCT FROM a.sp_microservice_name
  JOIN elig c ON c.id = f.id
  WHERE a.dn_clean <> '')""",
    "alert_extract": "SELECT id, sp_name, days_to_expiration FROM alerts",
    "alert_counts_by_source": f"""
SELECT s.source, count(a.id) AS n_alerts
FROM (VALUES {', '.join(f"('{s}')" for s in _SOURCES)}) s(source)
LEFT JOIN alerts a ON a.sp_name = s.source GROUP BY s.source""",
    "renewal_candidates": f"""
SELECT a.id, a.sp_name, count(c.id) AS n_candidates
FROM alerts a LEFT JOIN pool c ON c.sp_name = a.sp_name AND c.serial <> coalesce(a.serial, '') AND a.dn_clean <> ''
  AND ({_SAME_KEYS})
  AND least(length(a.dn_clean), length(c.dn_clean)) * 10 >= 6 * greatest(length(a.dn_clean), length(c.dn_clean))
GROUP BY a.id, a.sp_name""",
    "renewals": f"""
SELECT r.id, a.sp_name, cand_id, cand_serial AS renewed_serial, cand_days AS renewed_days,
  {_day('cand_exp')} AS renewed_expiration, round_even(score, 2)::DOUBLE AS similarity_score,
  cand_csi AS renewed_csi, cand_status AS renewed_status
FROM renewals r JOIN alerts a USING (id)""",
    "possible_matches": f"""
SELECT p.id, match_no, cand_id, cand_dn AS match_dn, cand_serial AS match_serial, cand_days AS match_days,
  {_day('cand_exp')} AS match_expiration, round_even(score, 2)::DOUBLE AS similarity_score,
  cand_csi AS match_csi, cand_status AS match_status, cand_source AS match_source
FROM possibles p""",
    "match_outcomes": """
SELECT a.id, a.sp_name, r.cand_id AS renewal_id, count(p.cand_id) AS n_possible, min(p.cand_id) AS lowest_possible
FROM alerts a LEFT JOIN renewals r USING (id) LEFT JOIN possibles p USING (id)
GROUP BY a.id, a.sp_name, r.cand_id""",
    "ack_flags": "SELECT id, acknowledged FROM states",
    "replica_enrich": f"""
SELECT id, cluster, project, service_name, total AS replicas_total, available AS replicas_available,
  total IS NULL AND available IS NULL AS replicas_unknown
FROM states WHERE sp_name = 'HashiCorp'""",
    "alert_status": "SELECT id, outcome AS status, attention AS attention_required, acknowledged FROM outcomes",
    "alert_documents": "SELECT source, group_key, group_ord, csi_id, n_certs FROM docs",
    "alert_documents_nested": f"""
SELECT sp_name AS source, group_ord, doc_csi AS csi_id, n_certs, upsert_key, id,
  coalesce(distinguished_name, '') AS distinguished_name, days_to_expiration, {_day('expiration_date')} AS expiration,
  serial_number, csi AS certificate_csi_id, attention AS attention_required, outcome AS status, acknowledged,
  score AS similarity_score, cand_dn AS renewed_distinguished_name, cand_days AS renewed_days_to_expiration,
  {_day('cand_exp')} AS renewed_expiration, cand_serial AS renewed_serial_number, '2024-06-01' AS log_day,
  coalesce(p.n, 0) AS n_possible, p.lowest AS lowest_possible
FROM flat LEFT JOIN (SELECT id AS own, count(*) AS n, min(cand_id) AS lowest FROM possibles GROUP BY id) p ON p.own = id""",
    "source_details": f"""
SELECT sp_name AS source, id AS group_ord, sp_name AS source_type,
  {_only('sp_ssg_domain', 'SSG', 'APIGEE')} AS domain, {_only('sp_internal_ssg_domain', 'SSG')} AS internal_domain,
  CASE sp_name WHEN 'SSG' THEN sp_microservice_name WHEN 'HashiCorp' THEN {_known('service_name')} END AS service_name,
  {_only('sp_ssg_url', 'SSG')} AS url, {_only('sp_ssg_url_in', 'SSG', 'APIGEE')} AS url_in,
  {_only('sp_ssg_url_out', 'SSG', 'APIGEE')} AS url_out,
  {_only(_ITEMS, 'SSG', 'Evolven')} AS instances,
  {_only(_known('cluster'), 'HashiCorp')} AS cluster, {_only(_known('project'), 'HashiCorp')} AS project,
  {_only('total', 'HashiCorp')} AS replicas_total, {_only('available', 'HashiCorp')} AS replicas_available,
  {_only('sp_evolven_host', 'Evolven', 'APIGEE')} AS host, {_only('sp_evolven_path', 'Evolven', 'APIGEE')} AS path,
  {_only('sp_certificate_owner', 'AKAMAI')} AS certificate_owner,
  {_only('sp_support_group_email', 'AKAMAI')} AS support_group_email,
  {_only("array_to_string(coalesce(regexp_extract_all(sp_san_names, '[A-Za-z0-9.-]+'), []), '|')", 'AKAMAI')} AS san_names,
  {_only('sp_ssl_cm_status', 'SSL Tracker')} AS status
FROM flat WHERE id = group_ord""",
    "upsert_alerts": """
SELECT source, upsert_key, group_ord, csi_id, n_certs, CAST('2024-06-01' AS VARCHAR) AS log_day FROM docs
QUALIFY row_number() OVER (PARTITION BY source, upsert_key ORDER BY group_ord DESC) = 1
UNION ALL
SELECT source, 'old:' || upsert_key, group_ord, csi_id, n_certs, '2024-05-31' FROM docs WHERE source <> 'SSG'""",
    "alert_table": f"""
SELECT source, upsert_key, group_ord, csi_id, n_certs, n_certs AS n_stored, CAST('2024-06-01' AS VARCHAR) AS log_day FROM {_LATEST}
UNION ALL
SELECT source, 'old:' || upsert_key, group_ord, csi_id, n_certs, n_certs, '2024-05-31' FROM {_LATEST} WHERE source <> 'SSG'""",
    "source_report_files": f"""
SELECT replace(lower(s.source), ' ', '_') AS source_slug, count(flat.id) AS n_rows,
  CASE WHEN count(flat.id) > 0 THEN count(flat.id) END AS last_row
FROM (VALUES {', '.join(f"('{s}')" for s in _SOURCES)}) s(source)
LEFT JOIN flat ON flat.sp_name = s.source AND s.source <> '{_SOURCES[0]}' GROUP BY s.source""",
    "expire_alerts": """
SELECT source, upsert_key, group_ord FROM docs WHERE group_ord % 48 < 24""",
    "upsert_stats": """
SELECT count(*) AS upserted, count(*) - count(DISTINCT source || upsert_key) AS collisions, 0::BIGINT AS errors FROM docs""",
    "run_summary_by_source": """
SELECT *, action_required + matched_renewal + missing_service AS total_alerts FROM by_source""",
    "run_summary_totals": f"""
SELECT (SELECT count(*) FROM elig) AS snapshot_row_count, sum(action_required)::BIGINT AS total_action_required,
  sum(matched_renewal)::BIGINT AS total_matched_renewal, sum(missing_service)::BIGINT AS total_missing_service,
  'the/snapshot' AS snapshot_path, '2024-06-01 00:00:00' AS run_datetime,
  string_agg(source || ':' || action_required || ':' || matched_renewal || ':' || missing_service || ':'
    || (action_required + matched_renewal + missing_service), ';' ORDER BY source_order) AS sources,
  90.0::DOUBLE AS renewal_score_threshold, 0.6::DOUBLE AS length_ratio_min, 1095::BIGINT AS alert_days_max,
  '{'|'.join(_SOURCES)}' AS active_sources, '{json.dumps(list(DEFAULT_ENVIRONMENTS), separators=(",", ":"))}' AS environments
FROM by_source""",
    "report_snapshot": "SELECT source_order, source, action_required FROM by_source WHERE action_required > 0",
    "action_table": f"""
SELECT row_number() OVER (ORDER BY pos) AS row_no, distinguished_name, serial_number, sp_name AS source,
  doc_csi AS csi_id, days_to_expiration, {_URGENCY} AS urgency, {_day('expiration_date')} AS expiration,
  coalesce(k.text, 'N/A') AS ticket, n_occurrences
FROM table1 LEFT JOIN tickets k USING (id) WHERE item_no = 1""",
    "action_table_details": """
SELECT distinguished_name, serial_number, sp_name AS source, item_no, summary FROM table1""",
    "possible_match_table": f"""
SELECT t.row_no, t.dn_clean, t.distinguished_name, t.csi_id, p.match_no, p.cand_dn AS match_dn,
  round_even(p.score, 2)::DOUBLE AS similarity_score,
  coalesce(p.cand_csi <> t.csi_id, false) AS csi_changed, coalesce(p.cand_status <> 'Activated', false) AS status_warn
FROM (SELECT *, row_number() OVER (ORDER BY pos) AS row_no FROM table2) t JOIN possibles p ON p.id = t.match_from""",
    "possible_match_certificates": f"""
SELECT dn_clean, row_number() OVER (PARTITION BY dn_clean ORDER BY pos) AS item_no, serial_number, csi_id,
  days_to_expiration, {_URGENCY} AS urgency, {_day('expiration_date')} AS expiration
FROM (SELECT dn_clean, serial_number, doc_csi AS csi_id, days_to_expiration, expiration_date, min(pos) AS pos
  FROM open_rows WHERE dn_clean IN (SELECT dn_clean FROM table2) GROUP BY ALL)""",
    "source_report": f"""
SELECT sp_name AS source, replace(lower(sp_name), ' ', '_') AS source_slug,
  row_number() OVER (PARTITION BY sp_name ORDER BY group_ord, id) AS row_no, summary, distinguished_name,
  serial_number, days_to_expiration, {_URGENCY} AS urgency, {_day('expiration_date')} AS expiration,
  CASE WHEN outcome = 'Matched Renewal' THEN 'renewal' WHEN acknowledged THEN 'acknowledged' ELSE 'none' END AS match_kind,
  score AS similarity_score, cand_dn AS renewed_distinguished_name, cand_serial AS renewed_serial_number,
  cand_days AS renewed_days_to_expiration, {_day('cand_exp')} AS renewed_expiration, outcome AS status
FROM flat""",
    "source_report_counts": f"""
SELECT s.source, replace(lower(s.source), ' ', '_') AS source_slug,
  count(*) FILTER (WHERE outcome = 'Action Required') AS action_required,
  count(*) FILTER (WHERE outcome = 'Matched Renewal') AS matched_renewal,
  count(*) FILTER (WHERE outcome = 'Missing Service') AS missing_service,
  count(flat.id) AS n_certs,
  s.source || ' Certificate Report — 2024-06-01 (' || count(flat.id)
    || CASE WHEN count(flat.id) = 1 THEN ' alert)' ELSE ' alerts)' END AS subject
FROM (VALUES {', '.join(f"('{s}')" for s in _SOURCES)}) s(source)
LEFT JOIN flat ON flat.sp_name = s.source GROUP BY s.source""",
    "has_action_required": """
SELECT coalesce(bool_or(attention AND NOT acknowledged), false) AS has_action_required FROM flat""",
    "snapshot_roundtrip": f"""
SELECT id, sp_name, days_to_expiration, dn_clean, serial AS serial_number_upper, {_day('expiration_date')} AS expiration
FROM elig""",
    "snapshot_reuse": """
SELECT sp_name, count(*) AS n, min(days_to_expiration) AS min_days FROM elig GROUP BY sp_name""",
    "quarantine": """
SELECT id, CASE WHEN id % 59 = 0 THEN 'negative days_to_expiration' ELSE 'missing expiration_date' END AS reason
FROM snap WHERE id % 59 = 0 OR id % 53 = 0""",
}


def oracle_sql() -> dict[str, str]:
    return {name: with_tables(sql) for name, sql in _SELECTS.items()} | {"numbered_hosts": with_tables("""
SELECT a.id, a.sp_name, any_value(r.cand_id) AS renewal_id, any_value(round_even(r.score, 2))::DOUBLE AS similarity_score,
  coalesce(string_agg(p.cand_id::VARCHAR, ',' ORDER BY p.match_no), '') AS possible_ids
FROM alerts a LEFT JOIN renewals r USING (id) LEFT JOIN possibles p USING (id) GROUP BY a.id, a.sp_name""", certs=NUMBERED_SQL)}
