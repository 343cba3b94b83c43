"""The pipeline's stages against the operators' plain versions, on the smallest table."""

import re

import pandas as pd

import corpus_pipeline
from certwatch.llm import personal_data
from certwatch.staging import stage
from test_operators import ODD_TEXTS, SF, hits, joined


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, items = docs.columns, [(r.item_id, r.text) for r in pd.read_parquet(f"{SF}/benchmark.parquet").itertuples()]
    for name, function in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = stage(function(spark, docs, SF), name)
        if name != "packing":
            assert docs.columns == columns
            after = {r["doc_id"]: r["text"] for r in docs.collect()}
        if name == "near_duplicates":
            assert set(after) == {c for _, _, c in joined(list(before.items()), 5, 80)}
        if name == "decontamination":
            kept = {d for d, t in before.items() for n, h, _ in [hits(t, items)] if not (h > 0 and 20 * h >= n)}
            assert set(after) == kept
        if name == "personal_data":
            assert set(after) == set(before)
            assert not any(personal_data.base_spans(t or "") for t in after.values())
            assert all(after[d] == t for d, t in before.items() if not re.search("[0-9@]", t or ""))
    assert {r[0] for r in docs.select("doc_id").distinct().collect()} == set(after)
    assert docs.groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").count() == 0


def test_stages_take_odd_rows(spark, docs_of):
    rows = docs_of(ODD_TEXTS)
    for docs in (rows, rows.limit(0)):
        for name, function in corpus_pipeline.STAGES:
            docs = stage(function(spark, docs, SF), name)
        docs.count()


def test_only_linked_rows_go_as_near_duplicates(spark, docs_of):
    words = [f"w{i}" for i in range(400)]
    one, two, three = (" ".join(words[i:i + 100]) for i in (0, 100, 200))
    near = f"{one} more"
    rows = [(5, one), (5, two), (5, two), (3, near), (None, three), (None, f"{three} more"), (None, three), (9, f"{three} again"),
            (7, "short"), (7, "other"), (None, None), (None, None), (None, "x"), (None, f"{words[300]} {' '.join(words[300:])}"), (8, "")]
    want = {(5, two), (3, near), (9, f"{three} again"), (7, "short"), (7, "other"), (None, None), (None, "x"), rows[13], (8, "")}
    for order in (rows, rows[::-1]):
        kept = corpus_pipeline.keep_one_of_near_duplicates(spark, docs_of(order).repartition(3), SF)
        assert kept.columns == docs_of(order).columns
        got = [(r["doc_id"], r["text"]) for r in kept.collect()]
        assert len(got) == len(want) and set(got) == want
