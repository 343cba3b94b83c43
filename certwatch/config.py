"""Run parameters and the per-source specification table.

Nothing in the package reads the clock: every relative-time rule is evaluated
against ``Params.as_of``, so a re-run of an old day gives the same answer.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Status vocabulary.
STATUS_VALID = "Valid"
ACTION_REQUIRED = "Action Required"
MATCHED_RENEWAL = "Matched Renewal"
MISSING_SERVICE = "Missing Service"
UNKNOWN = "unknown"

# Defaults of the list-valued settings.
DEFAULT_ENVIRONMENTS = ("PROD", "prod", "PRODUCTION", "Production", "production")
DEFAULT_NOISE_WORDS = (
    "corp", "chase", "net", "com", "prod", "dev", "uat", "stg",
    "internal", "ext", "external", "svc", "service", "app",
)
TABLE1_SORT_MODES = ("days_to_expiration", "source", "csi_id")


@dataclass(frozen=True)
class SourceSpec:
    """Everything the engine needs to know about one inventory source.

    Adding a source means adding one of these to ``Params.specs``; every
    operator evaluates all specs in a single pass over the data. Expressions
    are Spark SQL.
    """

    name: str
    group_keys: tuple[str, ...]
    match_keys: tuple[str, ...]
    # document fields that identify the stored alert; "first_serial" is the
    # serial number of the document's first certificate
    upsert_keys: tuple[str, ...]
    # detail field -> expression over the snapshot columns and the parsed
    # columns instances, san_names, triple, replicas_total, replicas_available
    details: dict[str, str] = field(hash=False)
    # one line for the reports: text pieces and detail field names, in order
    summary: tuple[str, ...]
    process_rank: int
    needs_replicas: bool = False
    # SQL types of detail fields that no other source has; string where not given
    detail_types: dict[str, str] = field(default_factory=dict, hash=False)


# Listed in report order; process_rank is the order documents are produced in.
DEFAULT_SPECS: tuple[SourceSpec, ...] = (
    SourceSpec(
        "SSG",
        group_keys=("sp_ssg_domain", "sp_microservice_name", "sp_internal_ssg_domain"),
        match_keys=("sp_ssg_domain", "sp_microservice_name", "sp_internal_ssg_domain"),
        upsert_keys=("domain", "service_name", "internal_domain"),
        details={
            "domain": "sp_ssg_domain", "internal_domain": "sp_internal_ssg_domain",
            "service_name": "sp_microservice_name", "url": "sp_ssg_url",
            "url_in": "sp_ssg_url_in", "url_out": "sp_ssg_url_out", "instances": "instances",
        },
        summary=("service_name", "' @ '", "domain"),
        process_rank=0,
    ),
    SourceSpec(
        "AKAMAI",
        group_keys=("sp_serial_number",),
        match_keys=("sp_serial_number",),
        upsert_keys=("first_serial",),
        details={
            "certificate_owner": "sp_certificate_owner",
            "support_group_email": "sp_support_group_email", "san_names": "san_names",
        },
        summary=("'Owner: '", "certificate_owner"),
        process_rank=4,
    ),
    SourceSpec(
        "HashiCorp",
        group_keys=("sp_openshift_namespace", "sp_microservice_name"),
        match_keys=("sp_openshift_namespace", "sp_microservice_name"),
        upsert_keys=("cluster", "project", "service_name"),
        details={
            "cluster": f"nullif(triple.cluster, '{UNKNOWN}')",
            "project": f"nullif(triple.project, '{UNKNOWN}')",
            "service_name": f"nullif(triple.service_name, '{UNKNOWN}')",
            "replicas": "named_struct('total', replicas_total, 'available', replicas_available)",
        },
        summary=("cluster", "'/'", "project", "'/'", "service_name"),
        process_rank=1,
        needs_replicas=True,
    ),
    SourceSpec(
        "SSL Tracker",
        group_keys=("sp_serial_number",),
        match_keys=("sp_serial_number",),
        upsert_keys=("first_serial",),
        details={"status": "sp_ssl_cm_status"},
        summary=("'Status: '", "status"),
        process_rank=5,
    ),
    SourceSpec(
        "Evolven",
        group_keys=("sp_evolven_host", "sp_evolven_path", "sp_instance_name"),
        match_keys=("sp_evolven_host", "sp_evolven_path"),
        upsert_keys=("host", "path"),
        details={"host": "sp_evolven_host", "path": "sp_evolven_path", "instances": "instances"},
        summary=("host", "path"),
        process_rank=2,
    ),
    SourceSpec(
        "APIGEE",
        group_keys=("sp_evolven_host", "sp_evolven_path", "sp_ssg_domain"),
        match_keys=("sp_evolven_host", "sp_evolven_path", "sp_ssg_domain"),
        upsert_keys=("host", "path", "domain"),
        details={
            "domain": "sp_ssg_domain", "host": "sp_evolven_host", "path": "sp_evolven_path",
            "url_in": "sp_ssg_url_in", "url_out": "sp_ssg_url_out",
        },
        summary=("domain", "' — '", "host"),
        process_rank=3,
    ),
)

_ALL_SOURCES = tuple(s.name for s in DEFAULT_SPECS)


@dataclass(frozen=True)
class Params:
    as_of: datetime
    alert_days_min: int = 1
    alert_days_max: int = 1095
    log_date_staleness_days: int = 7
    alert_days_threshold: int = 7
    renewal_min_days: int = 90
    renewal_score_threshold: float = 90.0
    possible_match_score_threshold: float = 90.0
    max_possible_candidates: int = 6
    max_possible_display: int = 3
    length_ratio_min: float = 0.6
    ignore_alert_lookback_days: int = 7
    snapshot_max_age_hours: float = 2.0
    alert_retention_hours: float = 24.0
    table1_sort_by: str = "days_to_expiration"
    # False restores the older rule that lets a duplicate DN match itself
    exclude_same_dn: bool = True
    active_sources: tuple[str, ...] = _ALL_SOURCES
    requested_sources: tuple[str, ...] = ()
    consolidated_sources: tuple[str, ...] = _ALL_SOURCES
    environments: tuple[str, ...] = DEFAULT_ENVIRONMENTS
    noise_words: tuple[str, ...] = DEFAULT_NOISE_WORDS
    specs: tuple[SourceSpec, ...] = field(default=DEFAULT_SPECS, repr=False)
    # a join key above this many rows is spread over several tasks
    hot_key_rows: int = 200_000

    def __post_init__(self) -> None:
        for name in ("renewal_score_threshold", "possible_match_score_threshold"):
            if not 0.0 <= getattr(self, name) <= 100.0:
                raise ValueError(f"{name} must be in [0, 100]")
        if not 0.0 <= self.length_ratio_min <= 1.0:
            raise ValueError("length_ratio_min must be in [0, 1]")

    @property
    def as_of_ts(self) -> Column:
        return F.to_timestamp(F.lit(str(self.as_of_utc)))

    @property
    def as_of_utc(self) -> datetime:
        """``as_of`` in UTC without a zone; a value without a zone is taken as UTC."""
        return self.as_of.astimezone(UTC).replace(tzinfo=None) if self.as_of.tzinfo else self.as_of

    @property
    def possible_k(self) -> int:
        """Matches kept per alert; the collector always takes at least one."""
        return max(0, min(max(1, self.max_possible_candidates), self.max_possible_display))

    @property
    def run_sources(self) -> tuple[str, ...]:
        """Sources processed this run: active, narrowed by an optional request."""
        wanted = set(self.requested_sources) or set(self.active_sources)
        return tuple(s for s in self.active_sources if s in wanted)

    @property
    def sort_mode(self) -> str:
        known = self.table1_sort_by in TABLE1_SORT_MODES
        return self.table1_sort_by if known else "days_to_expiration"


def by_source(specs: Sequence[SourceSpec], value: Callable[[SourceSpec], str],
              source: str, default: str) -> Column:
    """One CASE over the source name, a branch per spec; values are SQL text."""
    branches = " ".join(
        "WHEN '{}' THEN {}".format(s.name.replace("'", r"\'"), value(s)) for s in specs)
    return F.expr(f"CASE {source} {branches} ELSE {default} END" if specs else default)


NO_KEYS = "CAST(array() AS array<string>)"


def key_array(columns: Sequence[str]) -> str:
    """SQL array of key columns, empty values as NULL."""
    return "array({})".format(", ".join(f"nullif({c}, '')" for c in columns))
