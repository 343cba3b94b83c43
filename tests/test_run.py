"""The run end to end on the smallest derived tables."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from certwatch.checks import fixtures as fx
from certwatch.config import DEFAULT_SPECS, Params, SourceSpec
from certwatch.operators import documents, enrich, reports, summary
from certwatch.operators.ranking import number_rows
from certwatch.operators.validation import validate
from certwatch.plans.run import Run, merged_alerts, publish, run
from certwatch.schema import SNAPSHOT_SCHEMA
from certwatch.sources import sinks, snapshot

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def result(spark, cfg):
    return run(fx.snapshot(spark, SF), fx.acks(spark, SF), fx.replicas(spark, SF), cfg)


def test_schema_width():
    assert len(SNAPSHOT_SCHEMA) == 37


def test_parameters_are_checked(cfg):
    with pytest.raises(ValueError):
        replace(cfg, renewal_score_threshold=-1.0)
    assert replace(cfg, renewal_score_threshold=0.0, possible_match_score_threshold=0.0).possible_k == cfg.possible_k
    assert replace(cfg, table1_sort_by="nonsense").sort_mode == "days_to_expiration"


def test_status_rules(spark, cfg):
    df = spark.createDataFrame(
        [("SSG", True, "r", None), ("SSG", False, "r", None), ("SSG", False, None, None),
         ("HashiCorp", False, "r", None), ("HashiCorp", False, "r", 2), ("HashiCorp", True, None, None)],
        "sp_name string, acknowledged boolean, renewal string, replicas_total int",
    ).withColumn("replicas_available", F.lit(None).cast("int"))
    got = [(r["status"], r["attention_required"]) for r in enrich.alert_status(df, cfg).collect()]
    assert got == [("Action Required", False), ("Matched Renewal", False), ("Action Required", True),
                   ("Missing Service", True), ("Matched Renewal", False), ("Action Required", False)]


def test_acknowledgement_lookup(spark, cfg):
    acks = spark.createDataFrame(
        [(" SSG ", " ab ", "2024-05-26"), ("SSG", "old", "2024-05-01"), ("SSG", "", "2024-06-01")],
        "source string, serial_number string, day string",
    ).withColumn("log_datetime", F.to_timestamp("day"))
    alerts = spark.createDataFrame(
        [("SSG", "AB"), ("AKAMAI", "AB"), ("SSG", "OLD"), ("SSG", None), ("SSG", "")],
        "sp_name string, serial_number_upper string")
    got = {(r["sp_name"], r["serial_number_upper"]): r["acknowledged"]
           for r in enrich.flag_acknowledged(alerts, acks, cfg).collect()}
    assert got == {("SSG", "AB"): True, ("AKAMAI", "AB"): False, ("SSG", "OLD"): False,
                   ("SSG", None): False, ("SSG", ""): False}


def test_documents_hold_every_certificate(result, cfg):
    per_document = result.certificates.groupBy("source", "upsert_key", "group_ord").agg(F.count("*").alias("n"))
    assert sorted(map(str, per_document.collect())) == sorted(map(str, result.documents.select(
        "source", "upsert_key", "group_ord", F.col("n_certs").alias("n")).collect()))
    assert result.certificates.select("id").distinct().count() == result.flat.count()
    assert result.rejected.count() == 0


def test_upsert_is_idempotent(result):
    docs = result.documents
    once = documents.latest_documents(docs)
    twice = documents.upsert_alerts(once, docs)
    key = ["source", "upsert_key", "group_ord"]
    assert sorted(map(str, once.select(*key).collect())) == sorted(map(str, twice.select(*key).collect()))
    assert once.select("source", "upsert_key").distinct().count() == once.count()


def test_publish_twice(result, cfg, spark, tmp_path):
    for _ in range(2):
        publish(result, cfg, str(tmp_path / "alerts"), str(tmp_path / "reports"))
    stored, certificates = sinks.read_alerts(spark, str(tmp_path / "alerts"))
    assert stored.count() == documents.latest_documents(result.documents).count()
    assert certificates.count() == stored.agg(F.sum("n_certs")).first()[0]
    assert certificates.select("id").distinct().count() == certificates.count()
    written = spark.read.json(str(tmp_path / "reports/summary")).collect()
    assert [(r["upserted"], r["errors"]) for r in written] == [(result.documents.count(), 0)]
    assert {p.name for p in (tmp_path / "reports/consolidated").iterdir()} == {
        "snapshot", "status", "action_table", "action_table_details", "possible_matches",
        "possible_match_certificates"}
    assert spark.read.parquet(str(tmp_path / "reports/quarantine")).count() == 0
    later = replace(cfg, as_of=cfg.as_of.replace(day=3))  # all stored alerts have expired by then
    empty = Run(*(getattr(result, f).limit(0) for f in ("flat", "rejected", "documents", "certificates")),
                result.summary_by_source, result.summary)
    assert [t.count() for t in merged_alerts(empty, later, str(tmp_path / "alerts"))] == [0, 0]


def test_dry_run_writes_reports_of_every_source(result, cfg, spark, tmp_path):
    only = Run(result.flat.where("source = 'SSG'"), result.rejected, result.documents, result.certificates,
               result.summary_by_source, result.summary)
    tickets = reports.action_required(only.flat, cfg).select("id", F.lit("T-1").alias("text"))
    publish(only, cfg, str(tmp_path / "alerts"), str(tmp_path / "reports"), tickets, dry_run=True)
    assert not (tmp_path / "alerts").exists()
    slugs = {p.name for p in (tmp_path / "reports/by_source").iterdir()}
    assert len(slugs) == len(cfg.active_sources)
    for slug in slugs:
        rows = spark.read.parquet(str(tmp_path / "reports/by_source" / slug))
        assert (rows.count() > 0) == (slug == "source_slug=ssg") and "summary" in rows.columns
    table = spark.read.parquet(str(tmp_path / "reports/consolidated/action_table"))
    assert [r[0] for r in table.select("ticket").distinct().collect()] == ["T-1"]


def test_summary_zero_fills(result, cfg):
    only = summary.run_summary_by_source(result.flat.where("source = 'SSG'"), cfg).collect()
    assert [r["source"] for r in sorted(only)] == list(cfg.active_sources)
    assert sum(r["total_alerts"] for r in only if r["source"] != "SSG") == 0


@pytest.mark.parametrize("mode", ["days_to_expiration", "source", "csi_id", "other"])
def test_action_table_order(result, cfg, mode):
    cfg = replace(cfg, table1_sort_by=mode)
    rows = reports.action_table(result.flat, cfg).orderBy("row_no").collect()
    assert [r["row_no"] for r in rows] == list(range(1, len(rows) + 1))
    csi = lambda r: 999999 if r["csi_id"] is None else r["csi_id"]
    key = {"source": lambda r: (r["source"], r["days_to_expiration"]),
           "csi_id": lambda r: (csi(r), r["days_to_expiration"])}.get(
        mode, lambda r: (r["days_to_expiration"], r["source"]))
    assert [key(r) for r in rows] == sorted(key(r) for r in rows)


def test_ticket_details(result, cfg, spark):
    open_rows = reports.action_required(result.flat, cfg)
    tickets = open_rows.select("id", F.lit("T-1").alias("text"))
    assert reports.action_table(result.flat, cfg, tickets).where("ticket = 'T-1'").count() == \
        reports.action_table(result.flat, cfg).count()


def test_repeated_certificates_are_numbered(result, cfg):
    copies = result.flat.unionByName(result.flat.withColumn("group_ord", F.col("group_ord") + 1_000_000))
    table = reports.action_table(copies, cfg)
    details = reports.action_table_details(copies, cfg)
    assert table.count() == reports.action_table(result.flat, cfg).count()
    assert table.agg(F.sum("n_occurrences")).first()[0] == details.count()
    per_cert = details.groupBy("distinguished_name", "serial_number", "source").agg(
        F.min("item_no").alias("lo"), F.max("item_no").alias("hi"), F.count("*").alias("n"))
    assert per_cert.where("lo <> 1 OR hi <> n").count() == 0


def test_number_rows_with_a_hot_key(spark):
    df = spark.range(3000).select((F.col("id") % 3 == 0).cast("int").alias("k"), (-F.col("id")).alias("v"))
    rows = number_rows(df, ["v"], "n", per=["k"]).collect()
    for k in (0, 1):
        ordered = sorted((r["v"], r["n"]) for r in rows if r["k"] == k)
        assert [n for _, n in ordered] == list(range(1, len(ordered) + 1))


def test_validation(spark):
    df = spark.createDataFrame([(1, 5, "2024-01-01"), (2, -1, "2024-01-01"), (3, 5, None)],
                               "id int, days_to_expiration bigint, day string")
    valid, rejected = validate(df.withColumn("expiration_date", F.to_timestamp("day")))
    assert [r["id"] for r in valid.collect()] == [1]
    assert {r["id"]: r["reason"] for r in rejected.collect()} == {
        2: "negative days_to_expiration", 3: "missing expiration_date"}


def test_snapshot_lifecycle(spark, cfg, tmp_path):
    path = str(tmp_path / "snap")
    built = []

    def build():
        built.append(1)
        return fx.certs(spark, SF)

    assert not snapshot.snapshot_is_fresh(spark, path, cfg)
    first = snapshot.get_or_build_snapshot(spark, path, build, cfg)
    again = snapshot.get_or_build_snapshot(spark, path, build, cfg)
    assert first.count() == again.count() == 1500 and len(built) == 1
    later = Params(as_of=cfg.as_of.replace(hour=3))
    snapshot.get_or_build_snapshot(spark, path, build, later)
    assert len(built) == 2
    snapshot.get_or_build_snapshot(spark, path, build, later, force=True)
    assert len(built) == 3
    with pytest.raises(Exception):
        snapshot.read_snapshot(spark, str(tmp_path / "absent")).count()


def test_a_failing_build_leaves_the_snapshot(spark, cfg, tmp_path):
    path = str(tmp_path / "snap")
    empty = snapshot.get_or_build_snapshot(spark, path, lambda: fx.certs(spark, SF).limit(0), cfg)
    assert empty.count() == 0 and snapshot.snapshot_is_fresh(spark, path, cfg)
    later = replace(cfg, as_of=cfg.as_of.replace(hour=9))
    assert not snapshot.snapshot_is_fresh(spark, path, later)
    stored = snapshot.get_or_build_snapshot(spark, path, lambda: fx.certs(spark, SF), later)
    with pytest.raises(Exception):
        broken = fx.certs(spark, SF).withColumn("days_to_expiration", F.raise_error(F.lit("no source")).cast("bigint"))
        snapshot.get_or_build_snapshot(spark, path, lambda: broken, later, force=True)
    assert snapshot.read_snapshot(spark, path).count() == stored.count() == 1500
    for _ in range(3):
        snapshot.write_snapshot(fx.certs(spark, SF), path, later)
    # what the last two versions do not name is removed, all but the folder that the failed build left
    assert len([p for p in (tmp_path / "snap").iterdir() if p.name.startswith("data-")]) == 3


def test_a_run_writes_what_it_brings(result, cfg, spark, tmp_path):
    """A run with a hundredth of the documents adds a hundredth, and expiry only names fewer folders."""
    path, size = tmp_path / "alerts", lambda: {p.name: sum(f.stat().st_size for f in p.rglob("*.parquet")) for p in path.glob("data-*")}
    docs, certificates = documents.latest_documents(result.documents), result.certificates
    sinks.write_alerts(docs, certificates, str(path), cfg)
    before = size()
    some = docs.orderBy("group_ord").limit(2)
    later = replace(cfg, as_of=cfg.as_of.replace(hour=1))
    sinks.write_alerts(some.withColumn("csi_id", F.lit(-5).cast("bigint")), certificates.join(
        some.select("source", "upsert_key"), ["source", "upsert_key"], "left_semi").select(*certificates.columns), str(path), later)
    after = size()
    assert all(after[k] == n for k, n in before.items()) and len(after) == 2
    stored, held = sinks.read_alerts(spark, str(path))
    assert stored.count() == docs.count() and stored.where("csi_id = -5").count() == 2
    assert held.count() == stored.agg(F.sum("n_certs")).first()[0]
    sinks.write_alerts(some, certificates.limit(0), str(path), replace(cfg, as_of=cfg.as_of.replace(day=2, hour=0, minute=30)))
    assert sinks.read_alerts(spark, str(path))[0].count() == 2  # the first run has expired


def test_adding_a_source_needs_only_a_spec(spark, cfg):
    name = "Ann's Vault"
    extra = SourceSpec(name, ("sp_lob_domain",), ("sp_lob_domain",), ("lob",),
                       {"lob": "sp_lob_domain", "days": "days_to_expiration"}, ("'Vault: '", "lob"), process_rank=6,
                       detail_types={"days": "bigint"})
    cfg = replace(cfg, specs=(*DEFAULT_SPECS, extra), active_sources=(name,), consolidated_sources=(name,))
    certs = fx.certs(spark, SF).where("days_to_expiration < 200").withColumn("sp_name", F.lit(name)).withColumn(
        "sp_lob_domain", F.lit("lob"))
    out = run(certs, fx.acks(spark, SF), fx.replicas(spark, SF), cfg)
    stored = out.documents.collect()
    assert [(r["upsert_key"], r["source_details"]["lob"]) for r in stored] == [(["=lob"], "lob")]
    assert isinstance(stored[0]["source_details"]["days"], int) and stored[0]["source_details"]["source_type"] == name
    assert reports.action_table_details(out.flat, cfg).first()["summary"] == "Vault: lob"


def test_fixture_tasks_grow_with_the_rows(spark, monkeypatch):
    """No task gets more rows because the table has more, nor because the other table is small enough to broadcast."""
    monkeypatch.setattr(fx, "_TASK_ROWS", 100)
    for table in (fx.raw_certs(spark, "/root/testdata/sf0.001"), fx.cert_docs(spark, "/root/testdata/sf0.001")):
        sizes = [r["n"] for r in table.groupBy(F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()]
        assert sum(sizes) == 1500 and len(sizes) >= 12 and max(sizes) <= 300
