import datetime as dt

import pytest
from pyspark.sql import functions as F

from certwatch.functions import report, text
from certwatch.functions.scoring import rounded, token_sort_ratio


def evaluate(spark, expr, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["out"] for r in df.select("i", expr(F.col("v")).alias("out")).orderBy("i").collect()]


def test_safe_str(spark):
    got = evaluate(spark, text.safe_str, [None, "null", " NULL ", "", "  x ", " y "])
    assert got == [None, None, None, None, "x", "y"]
    floats = evaluate(spark, lambda c: text.safe_str(c, floating=True), [float("nan"), 1.5, None], "double")
    assert floats == [None, "1.5", None]


def test_safe_bigint(spark):
    assert evaluate(spark, text.safe_bigint, ["12", " 12 ", "12.7", "abc", None]) == [12, 12, None, None, None]
    assert evaluate(spark, text.safe_bigint, [12.7, float("nan")], "double") == [12, None]


def test_safe_timestamp(spark):
    got = evaluate(spark, lambda c: text.safe_timestamp(c).cast("timestamp_ntz"),
                   ["2024-06-01 10:00:00", "2024-06-01T12:00:00+02:00", "soon", None])
    assert got == [dt.datetime(2024, 6, 1, 10), dt.datetime(2024, 6, 1, 10), None, None]


@pytest.mark.parametrize("raw, clean", [
    ("CN=api.orders.shop.corp.net", "api orders shop"),
    ("O=Acme,cn=Foo_Bar-PROD.netapp,C=US", "foo bar netapp"),
    ("CN=,O=z", "cn=,o=z"),
    ("CN=prod.corp.net", ""),
    ("plain host.com", "plain host"),
    (None, None),
])
def test_dn_clean(spark, cfg, raw, clean):
    assert evaluate(spark, lambda c: text.dn_clean(c, cfg.noise_words), [raw]) == [clean]


def test_dn_clean_multiword_noise_keeps_list_order(spark):
    assert evaluate(spark, lambda c: text.dn_clean(c, ["x", "a b"]), ["CN=a x b", "CN=a b c"]) == ["a b", "c"]


def test_serial_norm(spark):
    assert evaluate(spark, text.serial_norm, [" ab1 ", "null", "", None]) == ["AB1", None, None, None]


def test_split_list(spark):
    got = evaluate(spark, text.split_list, ["a, b,", "null", None, "7", " , "])
    assert got == [["a", "b"], [], [], ["7"], []]


def test_parse_san(spark):
    cases = {
        "['a.example.com', 'b.example.com']": ["a.example.com", "b.example.com"],
        "['a', None, '']": ["a"],
        "['a',]": ["a"],
        "[u'a', \"b,c\"]": ["a", "b,c"],
        "[]": [],
        "'quoted.com'": ["quoted.com"],
        "a,b": ["a", "b"],
        "[a.com, b.com]": ["[a.com", "b.com]"],
        "'x', y": ["x", "y"],
        "a": ["a"],
        "null": [],
        None: [],
    }
    assert evaluate(spark, text.parse_san, list(cases)) == list(cases.values())


def test_parse_triple(spark):
    got = evaluate(spark, lambda c: text.parse_triple(c), ["cl_proj_dep_x", "a_b", "a", "null", None])
    assert [tuple(r) for r in got] == [
        ("cl", "proj", "dep_x"), ("a", "b", "unknown"), ("a", "unknown", "unknown"),
        ("unknown",) * 3, ("unknown",) * 3]


def test_pair_scores(spark):
    df = spark.createDataFrame(
        [("b a", "a b"), ("abcd", "abce"), ("crsfsvc", "163242crsfsvcprodsecret"), ("", "x"), ("", "")],
        "a string, b string")
    rows = df.select(
        F.round(text.length_ratio(F.col("a"), F.col("b")), 3).alias("ratio"),
        rounded(token_sort_ratio(F.col("a"), F.col("b"))).alias("score")).collect()
    assert [r["ratio"] for r in rows] == [1.0, 1.0, 0.304, 0.0, 0.0]
    assert [r["score"] for r in rows[:2]] == [100.0, 75.0]
    assert rows[3]["score"] == 0.0


def test_rounding_takes_ties_to_even(spark):
    assert evaluate(spark, rounded, [90.625, 96.875, 93.333333], "double") == [90.62, 96.88, 93.33]


def test_report_values(spark):
    assert evaluate(spark, report.urgency, [0, 3, 4, 7, 8, 30, 31, None], "bigint") == [
        "critical", "critical", "high", "high", "medium", "medium", "ok", None]
    assert evaluate(spark, report.report_date, [dt.date(2024, 6, 1), None], "date") == ["2024-06-01", "—"]
    assert evaluate(spark, report.status_warn, ["Pending", "Activated", None]) == [True, False, False]
    assert evaluate(spark, lambda c: report.csi_changed(c, F.lit(1)), [None, 2, 1], "bigint") == [False, True, False]
    assert evaluate(spark, report.source_slug, ["SSL Tracker"]) == ["ssl_tracker"]


def test_json_numbers_and_quoted_numbers(spark, cfg):
    from certwatch.sources.certificates import flatten_documents

    docs = [(1, '{"days_to_expiration":5.0,"csi_application_id":12.7}'), (2, '{"days_to_expiration":"12.7","csi_application_id":"8"}'),
            (3, '{"days_to_expiration":-3.9,"csi_application_id":7}'), (4, '{"days_to_expiration":"x"}'), (5, '{"days_to')]
    flat = flatten_documents(spark.createDataFrame(docs, "id int, doc string"), cfg)
    got = {r["id"]: (r["days_to_expiration"], r["csi_application_id"]) for r in flat.collect()}
    assert got == {1: (5, 12), 2: (None, 8), 3: (-3, 7), 4: (None, None)}


def test_documents_that_cannot_be_read_are_named(spark):
    from certwatch.sources.certificates import document_issues

    docs = [(1, '{"start_date":"2024-01-01","log_date":null,"days_to_expiration":3}'), (2, '{"days_to'), (3, None), (4, "[]"), (5, '"x"'), (6, ""),
            (7, '{"start_date":"soon","days_to_expiration":"3.5","csi_application_id":" null "}'), (8, "{}")]
    got = {r["id"]: (r["reason"], r["kept"]) for r in document_issues(spark.createDataFrame(docs, "id int, doc string")).collect()}
    assert got == {i: ("unreadable document", False) for i in (2, 3, 4, 5, 6)} | {7: ("malformed start_date, days_to_expiration", True)}
    struct = spark.sql("SELECT 1 AS id, named_struct('start_date', 'soon', 'source_properties', named_struct('name', 'SSG')) AS doc")
    assert [r["reason"] for r in document_issues(struct).collect()] == ["malformed start_date"]


def test_as_of_is_converted_to_utc():
    from datetime import datetime, timedelta, timezone

    from certwatch.config import Params

    local = datetime(2024, 6, 1, tzinfo=timezone(timedelta(hours=-5)))
    assert Params(as_of=local).as_of_utc == datetime(2024, 6, 1, 5)
