"""What the driver holds while tables are staged."""

import re

from pyspark.sql import functions as F

from certwatch.checks import fixtures as fx
from certwatch.checks import queries
from certwatch.operators import matching, similarity
from certwatch.plans import run as plans
from certwatch.staging import measured_broadcasts, stage

SF_DIR = "/root/testdata/sf0.001"
BY_FILES, BY_ROWS = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"


def test_a_small_file_of_large_rows_is_not_broadcast(spark):
    """100,000 rows of 400 bytes that repeat: a few KB of Parquet, 40 MB on the driver."""
    wide = stage(spark.range(100_000).select("id", F.repeat(F.lit("x"), 400).alias("text")), "wide")
    few = stage(spark.range(200), "few")
    with measured_broadcasts(spark):
        joined = spark.range(300_000).join(wide, "id")
        assert len(joined.select("id", "text").tail(1)) == 1
        assert "BroadcastExchange" not in joined._jdf.queryExecution().executedPlan().toString()
        # what is small by its rows still is
        small = wide.join(few, "id")
        assert len(small.collect()) == 200
        assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()


def test_matching_stages_by_measured_sizes(spark, cfg, monkeypatch):
    seen, before = [], (spark.conf.get(BY_FILES), spark.conf.get(BY_ROWS, None))

    def watched(df, label, compression=None):
        seen.append((spark.conf.get(BY_FILES), spark.conf.get(BY_ROWS)))
        return stage(df, label, compression)

    snapshot = fx.snapshot(spark, SF_DIR)
    monkeypatch.setattr(matching, "stage", watched)
    matching.match_outcomes(snapshot, cfg)
    assert len(seen) > 10 and set(seen) == {("-1", before[0])}
    assert (spark.conf.get(BY_FILES), spark.conf.get(BY_ROWS, None)) == before


def test_tables_that_grow_with_alerts_are_not_broadcast(spark, monkeypatch):
    """Neither keys, documents nor numbers per certificate, however small their files."""
    flat = queries._flat(spark, SF_DIR)
    monkeypatch.setattr(queries, "_flat", lambda *_: flat)
    for name in ("action_table_details", "alert_documents_nested", "alert_table", "possible_match_certificates", "upsert_alerts"):
        plan = queries.QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastExchange" not in plan and "SortMergeJoin" in plan, name


def test_matching_merges_every_side_that_grows(spark, cfg, monkeypatch):
    """No join of the matching is left to sizes; the table of key combinations is the only one broadcast."""
    joins = []

    def watched(df, label, compression=None):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        joins.extend(line for line in plan.splitlines() if re.search(r"\bJoin \w+", line))
        return stage(df, label, compression)

    for snapshot in (fx.snapshot(spark, SF_DIR), fx.numbered_snapshot(spark, SF_DIR)):
        monkeypatch.setattr(matching, "stage", watched)
        monkeypatch.setattr(similarity, "stage", watched)
        matching.match_outcomes(snapshot, cfg)
        monkeypatch.undo()
    assert len(joins) > 20 and [line for line in joins if "strategy=" not in line] == []
    assert all("sp_name" in line and "forall" in line for line in joins if "strategy=broadcast" in line)


def test_flat_rows_are_staged_without_a_broadcast(spark, cfg, monkeypatch):
    """Acknowledgements, replicas and documents grow with the data; together they would fill the driver."""
    snapshot, joins, plans_seen = fx.snapshot(spark, SF_DIR), [], []
    outcomes = matching.match_outcomes(snapshot, cfg)

    def watched(df, label, compression=None):
        execution = df._jdf.queryExecution()
        joins.extend(line for line in execution.optimizedPlan().toString().splitlines()
                     if re.search(r"\bJoin \w+", line) and "o_custkey" not in line)
        plans_seen.append(execution.executedPlan().toString())
        return stage(df, label, compression)

    monkeypatch.setattr(plans, "match_outcomes", lambda *_: outcomes)
    monkeypatch.setattr(plans, "stage", watched)
    flat = plans.alert_rows(snapshot, fx.acks(spark, SF_DIR), fx.replicas(spark, SF_DIR), cfg)
    assert flat.count() == outcomes.count() > 0
    assert len(joins) == 3 and [line for line in joins if "strategy=merge" not in line] == []
    assert not any("BroadcastHashJoin" in p for p in plans_seen)
