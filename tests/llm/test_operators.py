"""The operators against plain versions, on the smallest tables and on hand-made edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from certwatch.llm import (chat, decontamination, licences, ngram_join, packing, personal_data, queries, token_files,
                           toxicity, url_rules, vector_index)

SF = "/root/testdata/sf0.001"
LOW = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
ODD_TEXTS = [(1, None), (2, ""), (3, " \n "), (4, "One."), (4, "One."), (5, "don't <|endoftext|> ÀÉ ×÷ 12a.3 'S"), (None, "null id"),
             (6, "word " * 30_000), (7, "Ünïcode ΑΣ Σ ñ " * 50), (8, "\t\r\x1c\x00 x")]


def documents():
    return pd.read_parquet(f"{SF}/documents.parquet")


def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.tokenizer_file())


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def rows(df):
    return [tuple(r) for r in df.collect()]


# --- 1 ---

def hits(text, items, window=13):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    w, hit, found = word.findall((text or "").translate(LOW)), set(), set()
    for name, item in items:
        v = word.findall((item or "").translate(LOW))
        m = min(window, len(v))
        windows = {tuple(v[i:i + m]) for i in range(len(v) - m + 1)} if m else set()
        for i in range(len(w) - m + 1) if m else ():
            if tuple(w[i:i + m]) in windows:
                hit.update(range(i, i + m))
                found.add(name)
    return len(w), len(hit), found


def test_decontamination_finds_all_occurrences(spark, docs_of):
    rng = random.Random(1)
    vocabulary = ["a", "b", "cc", "É", "d1"]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 2, 5, 13, 14, 30])))) for i in range(12)]
    items += [(0, "a b"), (None, "cc cc cc"), (99, None), (98, "..")]
    texts = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(80)))) for i in range(40)]
    texts += [(100 + i, f"zz {t.upper() if t else ''}!zz, {t}") for i, (_, t) in enumerate(items)] + ODD_TEXTS
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.find_passages(docs_of(texts), bench).select("doc_id", "passages").collect()
    want = [(d, *hits(t, items)) for d, t in texts]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    flat = [(r[0], r[1]["n_words"], sum(s["end"] - s["start"] for s in r[1]["spans"]), r[1]["item_ids"]) for r in got]
    assert sorted(flat, key=key) == sorted([(d, n, h, sorted(f - {None})) for d, n, h, f in want], key=key)
    assert decontamination.find_passages(docs_of([]), bench).count() == 0
    none = decontamination.find_passages(docs_of(texts), bench.limit(0))
    assert none.where(decontamination.is_contaminated()).count() == 0


def test_decontamination_in_several_blocks(spark, docs_of, monkeypatch):
    items = [(i, " ".join(f"w{i}x{k}" for k in range(20))) for i in range(9)]
    texts = [(i, f"start {items[i][1]} middle {items[(i + 1) % 9][1]}") for i in range(9)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(decontamination, "_BLOCK_BYTES", 300)
    got = decontamination.find_passages(docs_of(texts), bench).orderBy("doc_id").collect()
    assert [r["passages"]["item_ids"] for r in got] == [sorted({i, (i + 1) % 9}) for i in range(9)]
    assert all(len(r["passages"]["spans"]) == 2 for r in got)


def test_new_columns_never_replace_others(spark, docs_of):
    docs = docs_of(ODD_TEXTS).selectExpr("*", "1 as passages", "2 as base_spans", "3 as sentence_numbers", "4 as licences", "5 as _left", "6 as _score")
    bench = spark.createDataFrame([(1, "one")], "item_id int, text string")
    for out, new in ((decontamination.find_passages(docs, bench), ["_passages"]), (toxicity.score(docs, toxicity.Model(None, None, None, 0.5)), ["__score"]),
                     (personal_data.find_spans(docs), ["_base_spans", "_spans"]), (licences.scan(docs), ["_sentence_numbers", "_licences"])):
        assert out.columns == [*docs.columns, *new]
        kept = [r for r in out.select("passages", "base_spans", "sentence_numbers", "licences", "_left", "_score").distinct().collect()]
        assert [tuple(r) for r in kept] == [(1, 2, 3, 4, 5, 6)]


def test_benchmark_in_blocks_with_string_ids(spark, docs_of, monkeypatch):
    monkeypatch.setattr(decontamination, "_BLOCK_BYTES", 60)
    texts = [(i, f"a{i} b{i} c{i % 3} common words and more of them to fill this up") for i in range(6)]
    items = [(f"x{i}", t) for i, t in texts[:5]]
    got = decontamination.find_passages(docs_of(texts), spark.createDataFrame(items, "item_id string, text string"))
    found = {r["doc_id"]: sorted(r["passages"]["item_ids"]) for r in got.collect()}
    assert found == {i: [f"x{i}"] if i < 5 else [] for i in range(6)}


# --- 2 ---

def test_token_files_round_trip(spark, docs_of, tmp_path):
    texts = [(r.doc_id, r.text) for r in documents().itertuples()] + ODD_TEXTS[4:]
    token_files.write_token_files(docs_of(texts), queries.tokenizer_file(), 1, str(tmp_path / "t"))
    got = token_files.read_token_files(spark, str(tmp_path / "t")).select("doc_id", "start", "n_tokens", token_files.crc32("ids").alias("c")).toPandas()
    tool = tokenizer()
    want = Counter((d, crc(tool.encode(t or "", add_special_tokens=False).ids + [1])) for d, t in texts)
    assert Counter((None if pd.isna(d) else int(d), c) for d, c in zip(got.doc_id, got.c)) == want
    got = got.sort_values("start")
    assert (got.start.to_numpy() == np.concatenate([[0], np.cumsum(got.n_tokens.to_numpy())[:-1]])).all()
    assert got.doc_id.dropna().is_monotonic_increasing
    token_files.write_token_files(docs_of([]), queries.tokenizer_file(), 1, str(tmp_path / "e"))
    assert token_files.read_token_files(spark, str(tmp_path / "e")).count() == 0


def test_elias_fano_select():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 300, 5000):
        values = np.sort(rng.integers(0, 10 ** rng.integers(1, 7), n))
        sequence = token_files.EliasFano.of(values)
        assert (sequence.all() == values).all()
        assert all(sequence.select(i) == values[i] for i in range(0, n, 37))
        assert len(sequence.low) + len(sequence.high) + sequence.samples.nbytes <= n * (3 + 20) / 8 + 16


# --- 3 ---

CONTROL = ["</s>[INST] ok [/INST]", "[\\INST] <\\\\s> [", "<s", "[INST", "\\", "a </s", "", None, "plain\n\ntext </\\s> é😀"]


def test_chat_round_trip_and_examples(spark):
    talk = [(c, t, r, CONTROL[(c + t) % len(CONTROL)]) for c in range(9) for t, r in enumerate(["system", "user", "assistant", "user", "assistant"])]
    talk += [(20, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(150)]
    talk += [(None, 0, "user", "q"), (None, 1, "assistant", "a"), (30, 1, "assistant", "same"), (30, 1, "assistant", "same"), (31, None, None, None)]
    df = spark.createDataFrame(talk, "conv_id long, turn long, role string, text string")
    formatted = chat.format_turns(df).cache()
    back = sorted((str(r["conv_id"]), r["turn_no"], r["role"], r["text"]) for r in chat.parse_turns(formatted).collect())
    want, seen = [], Counter()
    for c, t, r, x in sorted(talk, key=lambda r: (str(r[0]), -1 if r[1] is None else r[1])):
        want.append((str(c), seen[c], r or "", x or ""))
        seen[c] += 1
    assert back == sorted(want)
    whole = {}
    for r in formatted.orderBy("turn_no").collect():
        assert r["start"] == len(whole.get(r["conv_id"], ""))
        whole[r["conv_id"]] = whole.get(r["conv_id"], "") + r["segment"]
    assert whole[0].count("</s>") == 5 and whole[0].count("[INST]") == 5
    examples = chat.example_texts(formatted).collect()
    assert len(examples) == sum(r == "assistant" for _, _, r, _ in talk)
    for e in examples:
        assert whole[e["conv_id"]].startswith(e["text"]) and e["text"].endswith("</s>")
        assert e["loss_end"] == len(e["text"]) - 4
    last = max((e for e in examples if e["conv_id"] == 20), key=lambda e: e["example_no"])
    assert last["text"][last["loss_start"]:last["loss_end"]] == "turn 149"
    assert chat.format_turns(df.limit(0)).count() == 0


def test_chat_digests(spark):
    got = {r["conv_id"]: r for r in queries.op3_chat(spark, SF).collect()}
    talk = pd.read_parquet(f"{SF}/conversations.parquet").sort_values(["conv_id", "turn"])
    assert len(got) == talk.conv_id.nunique() + 1
    for name, own in talk.groupby("conv_id"):
        text = "".join(f"{r.role}\n{r.text or ''}\n" for r in own.itertuples())
        reply = "".join(r.text or "" for r in own.itertuples() if r.role == "assistant")
        assert got[name]["turns_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert (got[name]["loss_chars"], got[name]["loss_sha256"]) == (len(reply), hashlib.sha256(reply.encode()).hexdigest())
    assert got[-7]["loss_chars"] == len("</s>[INST] ok [/INST]")


# --- 4 ---

def test_toxicity_on_held_out_rows(spark):
    got = queries.op4_toxicity(spark, "/root/testdata/sf0.01").toPandas()
    assert got.score.between(0, 1).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    own = got.merge(pd.read_parquet("/root/testdata/sf0.01/labels.parquet"), on="doc_id")
    own = own[own.held_out]
    bad, good = own[own.toxic == 1].score.to_numpy(), own[own.toxic == 0].score.to_numpy()
    assert ((bad[:, None] > good) + 0.5 * (bad[:, None] == good)).mean() > 0.85


def test_toxicity_edges(spark, docs_of):
    labels = spark.createDataFrame([(1, None), (2, 1), (2, 1), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs_of(ODD_TEXTS), labels)
    scored = toxicity.score(docs_of(ODD_TEXTS), model, out="toxicity")
    assert scored.count() == len(ODD_TEXTS) and scored.where("toxicity is null").count() == 0
    assert toxicity.fit(docs_of([]), labels.limit(0)).share == 0
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 3))
    chance = 1 / (1 + np.exp(-3 * x[:, 0] * x[:, 1]))
    y = (rng.random(4000) < chance).astype(float)
    trees = toxicity.BoostedTrees().fit(x[:3000], y[:3000])
    steps = toxicity.Isotonic(trees.margin(x[:3000]), y[:3000])
    assert (np.diff(steps(np.sort(trees.margin(x)))) >= 0).all()
    right = ((trees.margin(x[3000:]) > 0) == (y[3000:] > 0.5)).mean()
    assert right > ((chance[3000:] > 0.5) == (y[3000:] > 0.5)).mean() - 0.08


def test_toxicity_sample_is_bounded_with_repeated_ids(spark, docs_of, monkeypatch):
    hot = next(i for i in range(1, 100) if not spark.range(i, i + 1).where(toxicity.held_out(F.col("id"))).count())
    docs = docs_of([(hot, f"text {i % 300}") for i in range(1200)])
    labels = spark.createDataFrame([(hot, 1), (hot, 0), (hot, 0)], "doc_id long, toxic int")
    seen = []

    class Trees(toxicity.BoostedTrees):
        def fit(self, x, y):
            seen.append((len(x), int(y.sum())))
            return super().fit(x, y)

    monkeypatch.setattr(toxicity, "BoostedTrees", Trees)
    toxicity.fit(docs, labels)
    toxicity.fit(docs, labels, sample_rows=100)
    fitted = sum(r["part"] in (4, 5, 6) for r in spark.range(300).select(
        F.pmod(F.xxhash64(F.concat(F.lit("text "), F.col("id").cast("string"))), F.lit(8)).alias("part")).collect())
    assert seen[0] == (3 * fitted, fitted) and seen[1][0] <= 100


# --- 5 ---

def joined(texts, width, percent):
    sets = []
    for _, t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW))
        sets.append({tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set())
    component = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                old, new = component[i], component[j]
                component = [new if c == old else c for c in component]
    least = {}
    for (d, _), c in zip(texts, component):
        least[c] = min(x for x in (least.get(c), d) if x is not None) if least.get(c) is not None or d is not None else None
    return sorted(((d, len(s), least[c]) for (d, _), s, c in zip(texts, sets, component)), key=str)


@pytest.mark.parametrize("width,percent", [(4, 85), (5, 80)])
def test_near_duplicates_lose_no_link(docs_of, width, percent):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    texts = list(ODD_TEXTS[:5]) + [(None, "same words here for nobody at all")] * 2
    passage = " ".join(rng.choices(words, k=60))
    for g in range(12):
        base = rng.choices(words, k=rng.choice([3, 8, 12, 20, 60, 200]))
        for c in range(8):
            own = list(base)
            for _ in range(rng.randrange(4)):
                own[rng.randrange(len(own))] = rng.choice(words)
            texts.append((1000 + 10 * g + c, " ".join(own[rng.randrange(2):]) + (f" {passage}" if g % 3 == 0 else "")))
    got = sorted(rows(ngram_join.near_duplicates(docs_of(texts), width, percent)), key=str)
    assert got == joined(texts, width, percent)


def test_near_duplicates_over_many_blocks_and_shares(docs_of, monkeypatch):
    monkeypatch.setattr(ngram_join, "_SEARCHED", 500)
    monkeypatch.setattr(ngram_join, "_ASKED", 1)
    rng = random.Random(8)
    words = [f"w{i}" for i in range(300)]
    passage, texts = rng.choices(words, k=90), []
    for g in range(25):
        own = rng.choices(words, k=rng.choice([10, 40, 150]))
        for c in range(6):  # each follows its predecessor, so that some link through others only
            own[rng.randrange(len(own))] = rng.choice(words)
            texts.append((100 * g + c, " ".join(own + passage)))
    assert sorted(rows(ngram_join.near_duplicates(docs_of(texts), 4, 85)), key=str) == joined(texts, 4, 85)


def test_near_duplicates_list_no_pairs(docs_of, monkeypatch):
    """A family of copies about the threshold: what is staged grows with its documents, not with their pairs."""
    staged = []

    def counted(df, label):
        out = kept(df, label)
        staged[-1][label] = max(staged[-1].get(label, 0), out.count())
        return out

    kept = ngram_join.stage
    monkeypatch.setattr(ngram_join, "stage", counted)
    rng = random.Random(4)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    texts = []
    for i in range(240):
        own = list(base)
        for j in rng.sample(range(120), 2):
            own[j] = f"x{rng.randrange(10**9)}"
        texts.append((i, " ".join(own)))
    for n in (60, 120, 240):
        staged.append({})
        assert sorted(rows(ngram_join.near_duplicates(docs_of(texts[:n]), 5, 80)), key=str) == joined(texts[:n], 5, 80)
    assert staged[2]["asks"] > 0
    for before, after in zip(staged, staged[1:]):
        assert all(after[label] <= 2.5 * n + 50 for label, n in before.items())


def test_near_duplicates_ask_no_block_for_copies_or_unlike_sets(docs_of, monkeypatch):
    """Copies of one text fill many blocks, and other texts have empty parts in common: neither has to be asked for."""
    staged = {}

    def counted(df, label):
        out = kept(df, label)
        staged[label] = out.count()
        return out

    kept = ngram_join.stage
    monkeypatch.setattr(ngram_join, "stage", counted)
    monkeypatch.setattr(ngram_join, "_SEARCHED", 500)
    rng = random.Random(6)
    base = [f"w{i}" for i in range(120)]
    texts = [(0, " ".join(base))]
    for i in range(1, 100):
        own = list(base)
        own[rng.randrange(120)] = f"x{i}"
        texts.append((i, " ".join(own)))
    texts += [(1000 + i, " ".join(f"y{rng.randrange(10**9)}" for _ in range(rng.randrange(55, 75)))) for i in range(300)]
    assert sorted(rows(ngram_join.near_duplicates(docs_of(texts), 5, 80)), key=str) == joined(texts, 5, 80)
    assert staged["asks"] <= 20 and staged["enough"] <= 99 * 200


def test_near_duplicates_of_nothing(docs_of):
    assert ngram_join.near_duplicates(docs_of([])).count() == 0


def test_t_occurrence_counts_exactly():
    rng = np.random.default_rng(5)
    for _ in range(50):
        query = np.unique(rng.integers(0, 60, 40).astype(np.uint64))
        sets = [np.unique(np.concatenate([query[rng.random(len(query)) < rng.random()], rng.integers(0, 90, rng.integers(1, 20)).astype(np.uint64)])) for _ in range(30)]
        got = ngram_join.Lists(sets).search(query, 80)
        want = [i for i, s in enumerate(sets) if 100 * len(np.intersect1d(query, s)) >= 80 * len(np.union1d(query, s))]
        assert got.tolist() == want


# --- 6 ---

def test_licences(docs_of):
    full = "\n".join(s.capitalize() + "." for s in licences.SENTENCES[8:12])
    texts = [(10, f"x.\nLicensed under the Apache License, Version 2.0.\nReleased under the MIT License."), (11, full),
             (12, full.rsplit("\n", 1)[0]), (13, "Licensed under the Apache License, Version 3.0."), *ODD_TEXTS]
    got = licences.scan(docs_of(texts)).select("doc_id", "licences").collect()
    named = {r[0]: r[1] for r in got}
    assert named[10] == ["Apache-2.0", "MIT"] and named[11] == ["BSD-3-Clause"] and named[12] == ["BSD-2-Clause"]
    assert named[13] == [] and named[1] == [] and len(got) == len(texts)
    assert licences.scan(docs_of([])).count() == 0


def test_licences_named_in_one_line(docs_of):
    cases = [("This project is licensed under the MIT License.", "MIT"), ("Licensed under the MIT license", "MIT"),
             ("// SPDX-License-Identifier: MIT", "MIT"), ("# SPDX-License-Identifier: GPL-2.0-only\nint x;", "GPL-2.0"),
             ("/* SPDX-License-Identifier: LGPL-3.0-or-later */", "LGPL-3.0"), ("The code is released under the terms of the ISC licence.", "ISC"),
             ("This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not", "MPL-2.0"),
             ("This is free and unencumbered software released into the public domain.\n\nAnyone is free", "Unlicense"),
             ("Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, "
              "provided that the above\ncopyright notice and this permission notice appear in all copies.", "ISC"),
             ("This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\n"
              "License as published by the Free Software Foundation; either\nversion 2.1 of the License, or (at your option) any later version.", "LGPL-2.1"),
             ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
              "by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.", "GPL-2.0"),
             ("Distributed under the GNU Affero General Public License v3.0.", "AGPL-3.0"), ("Released under the 3-Clause BSD License.", "BSD-3-Clause"),
             ("Licensed under CC0 1.0 Universal.", "CC0-1.0"), ("Published under the Creative Commons Attribution-ShareAlike 4.0 International License.", "CC-BY-SA-4.0"),
             ("We were not licensed under the MIT License until now, they said.", None), ("A permit under the MIT rule.", None)]
    got = {r[0]: r[1] for r in licences.scan(docs_of([(i, t) for i, (t, _) in enumerate(cases)])).select("doc_id", "licences").collect()}
    assert got == {i: [name] if name else [] for i, (_, name) in enumerate(cases)}


def test_licences_own_wording_wrapped_and_unwrapped(docs_of):
    bsd = Path("/usr/share/common-licenses/BSD").read_text()
    apache, gpl = (Path(f"/usr/share/common-licenses/{n}").read_text() for n in ("Apache-2.0", "GPL-3"))
    apache_header = apache[apache.index("   Copyright [yyyy]"):]
    gpl_header = gpl[gpl.index("    This program is free software: you"):gpl.index("Also add information")]
    mit = """Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
    two = bsd[:bsd.index("3. Neither")] + bsd[bsd.index("THIS SOFTWARE"):]
    four = bsd.replace("3. Neither", "3. All advertising materials mentioning features or use of this software\n"
                       "   must display the following acknowledgement: This product includes software.\n4. Neither")
    cases = [(bsd, ["BSD-3-Clause"]), (two, ["BSD-2-Clause"]), (four, ["BSD-4-Clause"]), (bsd + bsd, ["BSD-3-Clause"]),
             (bsd.replace("the University nor", "A. B. Co., Inc. nor"), ["BSD-3-Clause"]), (mit, ["MIT"]),
             (apache, ["Apache-2.0"]), (apache_header, ["Apache-2.0"]), (gpl, ["GPL-3.0"]), (gpl_header, ["GPL-3.0"]),
             (gpl_header.replace("version 3", "version 2"), ["GPL-2.0"]), (gpl_header.replace("version 3", "version 1"), []), (bsd.replace("documentation", "papers"), [])]
    layouts = (lambda t: t, lambda t: " ".join(t.split()), lambda t: t.replace("\n", "\r\n"),
               lambda t: "\n\n".join(" ".join(p.split()) for p in re.split(r"\n\s*\n", t)),
               lambda t: "".join(f" * {line}\n" for line in t.split("\n")), lambda t: "".join(f"# {line}\n" for line in t.split("\n")))
    texts = [(100 * i + k, layout(text)) for i, (text, _) in enumerate(cases) for k, layout in enumerate(layouts)]
    for doc_id, found in rows(licences.scan(docs_of(texts)).select("doc_id", "licences")):
        assert found == cases[doc_id // 100][1], (doc_id, dict(texts)[doc_id][:200])


# --- 7 ---

def test_vector_search_recall_and_edges(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(20, 16))
    vectors = [(i, (centres[i % 20] * rng.uniform(0.5, 2) + 0.1 * rng.normal(size=16)).tolist()) for i in range(1500)]
    vectors += [(2000 + i, vectors[0][1]) for i in range(60)]
    odd = [(3000, None), (3020, [0.0] * 16), (3040, [float("nan")] + [1.0] * 15), (3060, [None] + [1.0] * 15), (3080, []),
           (3100, [1.0, 2.0]), (3120, [2.0, 1.0]), (None, [1.0] * 16)]
    df = spark.createDataFrame(vectors + odd, "vec_id long, embedding array<double>")
    index = vector_index.build_index(df, 20, shard_rows=400).cache()
    assert index.count() > 3
    got = vector_index.search(index, df.where("vec_id % 20 = 0"), 20, block_rows=30).toPandas()
    ids, matrix = np.array([i for i, _ in vectors]), np.array([v for _, v in vectors])
    hit = total = 0
    for i, v in zip(ids, matrix):
        if i % 20 == 0:
            score = matrix @ v
            score[ids == i] = -np.inf
            best = ids[np.lexsort((ids, -np.round(score, 9)))[:20]]
            own = got[got.query_id == i].sort_values("rank")
            assert own["rank"].tolist() == list(range(1, 21))
            hit, total = hit + len(set(best) & set(own.vec_id)), total + 20
    assert hit / total >= 0.9
    assert got[got.query_id.isin([3100, 3120])].vec_id.tolist() == [3120, 3100]
    assert not got.query_id.isin([3000, 3020, 3040, 3060, 3080]).any()
    assert vector_index.search(vector_index.build_index(df.limit(0), 20), df.limit(0), 20).count() == 0


# --- 8 ---

def test_packing_places_every_token_once(spark, docs_of):
    texts = [(r.doc_id, r.text) for r in documents().itertuples()] + ODD_TEXTS
    pieces = packing.cut_pieces(docs_of(texts), queries.tokenizer_file(), 0, 256)
    packed = packing.pack(pieces.drop("ids"), 256)
    got, tool = packed.toPandas(), tokenizer()
    want = Counter()
    for d, t in texts:
        ids = tool.encode(t or "", add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), 256)):
            want[(d, k, at, len(ids[at:at + 256]), crc(ids[at:at + 256]))] += 1
    assert Counter((None if pd.isna(r.doc_id) else int(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got.itertuples()) == want
    for _, own in got.sort_values("offset").groupby("sequence_id"):
        assert own.offset.tolist() == [0, *np.cumsum(own.length)[:-1]] and own.length.sum() <= 256
    assert got.sequence_id.nunique() <= np.ceil(got.length.sum() / 256) * 1.02 + 1
    back = packing.read_sequences(packing.sequences(packing.pack(pieces, 256))).toPandas()
    assert Counter((None if pd.isna(r.doc_id) else int(r.doc_id), r.piece, r.start, r.length, crc(r.ids)) for r in back.itertuples()) == want
    assert (back.ids_crc32 == [crc(i) for i in back.ids]).all()
    for _, own in back.sort_values("offset").groupby("sequence_id"):
        assert own.offset.tolist() == [0, *np.cumsum(own.length)[:-1]] and own.length.sum() <= 256
    assert back.sequence_id.nunique() == got.sequence_id.nunique()
    assert packing.pack(packing.cut_pieces(docs_of([]), queries.tokenizer_file(), 0, 256).drop("ids"), 256).count() == 0


def test_dominance_reduction_is_optimal():
    rng = random.Random(4)

    def best(lengths, size):
        """Fewest sequences, by trying the sets that can hold the longest piece."""
        if not lengths:
            return 0
        first, rest, out = lengths[0], lengths[1:], len(lengths)
        for mask in range(1 << len(rest)):
            chosen = [x for i, x in enumerate(rest) if mask >> i & 1]
            if first + sum(chosen) <= size:
                out = min(out, 1 + best([x for i, x in enumerate(rest) if not mask >> i & 1], size))
        return out

    for _ in range(60):
        size = rng.choice([6, 10, 13])
        lengths = sorted((rng.randint(1, size) for _ in range(rng.randint(1, 6))), reverse=True)
        plan = packing._Plan(np.bincount(lengths, minlength=size + 1), size)
        plan.reduce()
        left = [x for x in range(size, 0, -1) for _ in range(int(plan.counts[x]))]
        assert sum(t for t, _ in plan.patterns) + best(left, size) == best(lengths, size)


def test_plan_grows_with_lengths_not_with_pieces():
    rng = random.Random(6)
    for least in (1, 300, 600):
        counts = np.zeros(2049, np.int64)
        for x in [1400, 600, *(rng.randint(least, 2048) for _ in range(30))]:
            counts[x] += rng.randint(1, 100_000)
        patterns = packing.plan_sequences(counts, 2048)
        assert len(patterns) <= 6 * np.count_nonzero(counts)
        assert (sum(t * np.bincount(x, minlength=2049) for t, x in patterns) == counts).all()
    counts = np.zeros(2049, np.int64)
    counts[[1400, 600]] = 1_000_000
    assert packing.plan_sequences(counts, 2048) == [(1_000_000, [1400, 600])]


def test_plans_of_few_lengths_in_any_numbers():
    rng = random.Random(7)
    for _ in range(3000):
        size = rng.choice([7, 64, 500, 2048])
        counts = np.zeros(size + 1, np.int64)
        for _ in range(rng.randint(1, 12)):
            counts[rng.randint(1, size)] += rng.choice([1, 2, 3, 300, 26_020, 10 ** 9])
        patterns = packing.plan_sequences(counts, size)
        assert (sum(t * np.bincount(x, minlength=size + 1) for t, x in patterns) == counts).all()
        assert all(t > 0 and sum(x) <= size for t, x in patterns)
    counts = np.zeros(2049, np.int64)
    counts[1101], counts[167] = 26_020, 293
    assert sum(t for t, _ in packing.plan_sequences(counts, 2048)) == 26_020


# --- 9 ---

PATTERNS = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))


def plain_spans(text):
    out = []
    for kind, pattern in PATTERNS:
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
            luhn = sum(x - 9 * (x > 9) for x in doubled) % 10 == 0
            if {"email": True, "ip": kind == "ip" and all(int(p) < 256 for p in m.group().split(".")),
                    "card": 13 <= len(digits) <= 19 and luhn, "phone": 9 <= len(digits) <= 15}[kind]:
                out.append((kind, *m.span()))
    return out


def test_patterns_match_plain_regexes():
    rng = random.Random(6)
    parts = ["a@b.c", "@", "x.y@z", ".", "1.2.3.4", "300.1.1.1", "4111111111111111", "4111 1111-1111 1111", "+1 (555) 123-4567", "+", "0", " ", "-", "@d.e", "..", "é", "\n", "1.2.3"]
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randrange(9)))
        assert personal_data.base_spans(text) == plain_spans(text)


def test_crf_adds_spans_and_redaction_removes_them(docs_of):
    texts = [(20, "ñ call (555) 234-9876, or bob@intranet and a.b@c.org"), (21, "in 2024 page 12 of 345678"), *ODD_TEXTS]
    found = personal_data.find_spans(docs_of(texts), names=("own_base", "own"))
    got = {r[0]: r for r in found.select("doc_id", "own_base", "own", personal_data.redacted(F.col("text"), F.col("own")).alias("t")).collect()}
    assert [(s["kind"], texts[0][1][s["start"]:s["end"]]) for s in got[20][2]] == [
        ("email", "bob@intranet"), ("email", "a.b@c.org"), ("phone", "(555) 234-9876")]
    assert got[20][3] == "ñ call [phone], or [email] and [email]"
    assert got[21][2] == [] and got[21][3] == texts[1][1] and got[1][2] == [] and got[1][3] is None
    assert personal_data.find_spans(docs_of([]), names=("own_base", "own")).count() == 0


def test_viterbi_finds_the_best_path():
    crf, rng = personal_data.Crf(), np.random.default_rng(1)
    crf.emit, crf.move = rng.normal(size=crf.emit.shape), rng.normal(size=crf.move.shape)
    sizes = np.array([1, 4, 2, 3])
    x = rng.integers(0, 2, (10, len(crf.emit))).astype(float)
    got, at = crf.decode(x, sizes), 0
    for n in sizes:
        score = x[at:at + n] @ crf.emit
        paths = np.array(np.meshgrid(*[range(score.shape[1])] * n, indexing="ij")).reshape(n, -1).T
        value = [score[np.arange(n), p].sum() + sum(crf.move[a, b] for a, b in zip(p, p[1:])) for p in paths]
        assert got[at:at + n].tolist() == paths[int(np.argmax(value))].tolist()
        at += n


def test_personal_data_query(spark):
    got = {r["doc_id"]: r for r in queries.op9_personal_data(spark, SF).collect()}
    for r in documents().itertuples():
        base = plain_spans(r.text or "")
        digest = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert got[r.doc_id]["base_sha256"] == hashlib.sha256(digest.encode()).hexdigest()
        assert set(digest.split(",")) - {""} <= set(got[r.doc_id]["spans"].split(","))


# --- 10 ---

def test_url_rules_nested_and_odd(spark):
    rules = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "deep.example.net", "/en/x"), ("allow", "Example.NET", "/"),
             ("block", None, "/"), ("block", "", "/"), ("block", "a", "/"), ("allow", "a", "/")]
    hosts = ["net", "xnet", "example.net", "deep.example.net", "b.deep.example.net", "example.net.", "a", "net.a", ""]
    urls = [f"http://{h}{p}" for h in hosts for p in ("", "/", "/en/", "/en/xy?q#f", "?/en/", "/de")] + [None, "", "no scheme/en/", "HTTP://EXAMPLE.NET/en/", "a://b://net/"]
    pages = spark.createDataFrame([(i, u, "old") for i, u in enumerate(urls)] * 2, "page_id long, url string, rule string")
    got = url_rules.judge(pages, spark.createDataFrame(rules, "verdict string, host string, path string")).collect()
    assert len(got) == 2 * len(urls)
    for r in got:
        m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", urls[r["page_id"]] or "")
        host, path = (m[1].translate(LOW), m[2]) if m else ("", "")
        fit = [(len(h + p), len(h), v == "block", h + p, v) for v, h, p in rules
               if h and (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p)]
        want = max(fit, default=None)
        assert (r["host"], r["path"]) == (host, path)
        assert r["verdict"] == (want[4] if want else "allow") and (r["rule"] or "").lower() == (want[3].lower() if want else "")
    assert url_rules.judge(pages.limit(0), spark.createDataFrame(rules, "verdict string, host string, path string")).count() == 0
