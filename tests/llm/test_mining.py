"""Spelling variants, collocations and quality rules against plain versions."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa

from certwatch.llm import collocations, quality_rules, queries, spelling
from test_operators import ODD_TEXTS, SF, documents

LOW = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


# --- 11 ---

def counted(texts):
    seen = Counter()
    for doc_id, text in texts:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            seen[run] += 1
    return {w: n for w, n in seen.items() if len(w) >= 5 and n >= 3}


def edits(word, letters):
    for i in range(len(word) + 1):
        for c in letters:
            yield word[:i] + c + word[i:]
        if i < len(word):
            yield word[:i] + word[i + 1:]
            for c in letters:
                yield word[:i] + c + word[i + 1:]


def grouped(words):
    letters = sorted({c for w in words for c in w})
    near = {w: {e for e in edits(w, letters) if e in words and e != w} for w in words}
    forms = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        if best and words[best] >= 2 * n:
            forms[w] = best
    out = {}
    for w, n in words.items():
        root = w
        while root in forms:
            root = forms[root]
        out[w] = (n, forms.get(w), words.get(forms.get(w)), len(near[w]), root)
    return out


def as_dict(df):
    return {r["word"]: (r["n"], r["form"], r["form_n"], r["n_near"], r["root"]) for r in df.collect()}


def test_spelling_of_documents(spark):
    d = documents()
    want = grouped(counted(zip(d.doc_id, d.text)))
    assert as_dict(queries.op11_spelling(spark, SF)) == want
    assert any(v[4] != k for k, v in want.items())


def test_spelling_over_many_cells(spark, monkeypatch):
    """Words of few letters lie close together and so cross the bounds of many small cells."""
    monkeypatch.setattr(spelling, "CELL_WORDS", 40)
    monkeypatch.setattr(spelling, "SAMPLE_WORDS", 400)
    rng = random.Random(5)
    words = {"".join(rng.choice("abcdé") for _ in range(rng.choice((5, 6, 7)))): rng.randrange(1, 100) for _ in range(1500)}
    words |= {"a" * 300: 9, "a" * 301: 4, "a" * 150 + "b" + "a" * 150: 3}
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(7)
    assert as_dict(spelling.group_variants(df)) == grouped(words)
    assert len(spelling._cells(df)) == 3


def test_spelling_edges(spark, docs_of):
    texts = [*ODD_TEXTS, *[(None, "Straße ÀÉÎÕÜ straße " * 40)] * 2, (9, "x" * 100_000 + " " + "x" * 100_000 + "," + "X" * 100_000)]
    assert as_dict(spelling.group_variants(spelling.count_words(docs_of(texts)))) == grouped(counted(texts))
    assert spelling.group_variants(spelling.count_words(docs_of([]))).count() == 0


def test_forms_are_followed_to_the_end(spark):
    words = {"abcde" + "f" * k: 3 * 2 ** k for k in range(12)}
    got = as_dict(spelling.group_variants(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert got == grouped(words) and {v[4] for v in got.values()} == {"abcde" + "f" * 11}


def test_check_sums():
    rng = np.random.default_rng(0)
    data = rng.integers(0, 256, 3000).astype(np.uint8)
    starts = np.array([0, 5, 5, 100, 200, 2000])
    sizes = np.array([5, 0, 64, 65, 1000, 1])
    before = np.array([zlib.crc32(b"%d:" % i) for i in range(6)], np.uint32)
    want = [zlib.crc32(b"%d:" % i + data[s:s + n].tobytes()) for i, (s, n) in enumerate(zip(starts, sizes))]
    assert spelling._check_sums(data, starts, sizes, before).tolist() == want


# --- 12 ---

def phrases_of(docs):
    f, n = defaultdict(Counter), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, 5):
                for i in range(len(w) - m + 1):
                    f[lang][tuple(w[i:i + m])] += 1
    return f, n


def best_phrases(docs, least, kept=2000):
    f, n = phrases_of(docs)
    out = []
    for lang, own in f.items():
        candidates = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in candidates.items():
            s, _, k = min((2_000_000 * a // (own[p[:k]] + own[p[k:]]), k, k) for k in range(1, len(p)))
            if not any(len(q) > len(p) and 100 * b >= 80 * a and any(q[i:i + len(p)] == p for i in range(len(q)))
                       for q, b in candidates.items()):
                rows.append((-s, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(rows)[:kept], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def mined(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def test_collocations_of_documents(spark):
    d = documents()
    assert mined(queries.op12_collocations(spark, SF)) == best_phrases(zip(d.text, d.lang), 30)


def test_collocations_with_extended_prefixes(spark):
    """Groups of few suffixes, so that prefixes of one, two and three words are extended; ties and overlaps."""
    rng = random.Random(3)
    docs = [(" ".join(rng.choice(["a", "a", "b", "c", "A", "dé", "e,", "f\n"]) for _ in range(200)), rng.choice(["en", None, "x y"]))
            for _ in range(30)] + [("a a a a a a a", "en")] * 50
    df = spark.createDataFrame(docs, "text string, lang string").repartition(5)
    f, n = phrases_of(docs)
    want = sorted((lang, " ".join(p), a) for lang, own in f.items() for p, a in own.items() if a >= 7)
    for size in (40, 1000, 1 << 20):
        found, totals = collocations.count_phrases(df, 7, size)
        assert sorted((r["lang"], r["phrase"], r["f"]) for r in found.collect()) == want
        assert {r["lang"]: r["n"] for r in totals.collect()} == n
    assert mined(collocations.collocations(df, 7, 20)) == best_phrases(docs, 7, 20)


def test_collocations_edges(spark, docs_of):
    texts = [(t, "x") for _, t in ODD_TEXTS]
    assert mined(collocations.collocations(docs_of(ODD_TEXTS).drop("lang").selectExpr("*", "'x' as lang"), 2)) == best_phrases(texts, 2)
    empty = spark.createDataFrame([], "text string, lang string, rank int, n int")
    assert collocations.collocations(empty).count() == 0
    assert collocations.collocations(spark.createDataFrame([(None, None), ("", "en"), (" . ", None)], "text string, lang string"), 1).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    a, l, r = 2 ** 61 - 1, 2 ** 61 + 5, 2 ** 62 - 3
    df = spark.createDataFrame([(a, l, r)], "a long, l long, r long")
    assert df.select(collocations.score(df.a, df.l, df.r)).first()[0] == 2_000_000 * a // (l + r)


# --- 13 ---

def statistics(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    runs = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    hit = {i + k for i in range(len(w) - 2) if runs[tuple(w[i:i + 3])] > 1 for k in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


def path_length(trees, x):
    """The mean depth at which a row ends, tree by tree."""
    total = 0.0
    for feature, cut, left, path in trees:
        node = 0
        while feature[node] >= 0:
            node = left[node] + int(x[feature[node]] > cut[node])
        total += path[node]
    return total / len(trees)


def test_quality_rules_of_documents(spark):
    d = documents()
    got = {r["doc_id"]: r for r in queries.op13_quality_rules(spark, SF).collect()}
    assert len(got) == len(d)
    model = quality_rules.fit(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    for doc_id, text in zip(d.doc_id, d.text):
        want, r = statistics(text), got[doc_id]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        raw = np.frombuffer((text or "").encode(), np.uint8)
        x = quality_rules.features(quality_rules.count(raw, np.array([0, len(raw)])))[0]
        anomaly = 2 ** (-path_length(model.forest.trees, x) / float(quality_rules._mean_depth(model.forest.rows)))
        assert abs(anomaly - r["anomaly"]) < 1e-9
        assert (r["base_failed"], r["kept"]) == (failed, not failed and r["anomaly"] <= model.threshold)


def test_quality_rules_tell_good_from_bad(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.op13_quality_rules(spark, sf).toPandas().merge(pd.read_parquet(f"{sf}/labels.parquet"), on="doc_id")
    passed = got[~got.base_failed]
    assert passed[passed.quality == 1].kept.mean() > 0.98
    assert passed[passed.quality == 0].kept.mean() < 0.1


def test_quality_rules_edges(spark, docs_of):
    docs = docs_of(ODD_TEXTS).selectExpr("*", "'mine' as kept", "1 as _N_WORDS", "2 as n_words")
    labels = spark.createDataFrame([(1, None), (None, 1), (6, 1), (6, 1), (7, 0)], "doc_id long, quality int")
    out = quality_rules.judge(docs, quality_rules.fit(docs, labels)).collect()
    assert len(out) == len(ODD_TEXTS)
    for r in out:
        want = statistics(r["text"])
        assert (r["__n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["kept"] == "mine" and r["n_words"] == 2 and not (r["base_failed"] and r["_kept"])
    none = quality_rules.fit(docs_of([]), labels.limit(0))
    assert none.forest is None and quality_rules.judge(docs_of([]), none).count() == 0
    text = "one two three. " * 3 + " ".join(f"w{i}" for i in range(100))
    assert quality_rules.judge(docs_of([(1, text)]), none).first()["kept"]


def test_isolation_forest_and_threshold():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 3))
    far = np.array([[9.0, 9, 0], [0, -9, -9]])
    forest = quality_rules.IsolationForest(x, np.concatenate([x, far]), seed=3)
    assert forest.score(far).min() > np.quantile(forest.score(x), 0.99)
    good, bad = np.arange(1000) / 1000, np.array([0.2, 0.9955, 0.9991, 0.9999])
    cut = quality_rules.best_threshold(good, bad, 0.005)
    assert (good > cut).mean() <= 0.005 and (bad > cut).sum() == 3
    assert quality_rules.best_threshold(np.zeros(0), np.zeros(0)) == 1.0


def test_quality_sample_is_bounded(spark, docs_of):
    docs = docs_of([(1, f"{i} " * (60 + i % 50)) for i in range(500)])
    labels = spark.createDataFrame([(1, 1), (1, 0)], "doc_id long, quality int")
    seen = []

    class Forest(quality_rules.IsolationForest):
        def __init__(self, x, others, **more):
            seen.append(len(others))
            super().__init__(x, others, **more)

    kept, quality_rules.IsolationForest = quality_rules.IsolationForest, Forest
    try:
        docs = docs.selectExpr("doc_id", "concat(text, array_join(transform(sequence(1, 60), i -> concat('w', i, text)), ' ')) as text")
        quality_rules.fit(docs, labels, sample_rows=40)
    finally:
        quality_rules.IsolationForest = kept
    assert not seen or max(seen) <= 40


def test_collocations_number_few_suffixes_at_once():
    """A block's suffixes are sent in several batches, each of whole parts."""
    text = " ".join(f"w{i * 7919 % 150_001}" for i in range(150_000))
    batch = pa.RecordBatch.from_pydict({"text": [text], "lang": ["en"]}, pa.schema([("text", pa.string()), ("lang", pa.string())]))
    sent = [b.to_pydict() for b in collocations._parted([], 64)(iter([batch]))]
    suffixes = [[len(t) // 4 for t in b["times"]] for b in sent]
    assert len(sent) > 1 and max(map(sum, suffixes)) <= collocations._AT_ONCE + max(map(max, suffixes))
    assert sum(sum(np.frombuffer(t, "<i4").sum() for t in b["times"]) for b in sent) == 150_000
    assert len({g for b in sent for g in b["group"]}) == sum(len(b["group"]) for b in sent) == 64


def test_quality_rules_learn_from_every_labelled_row(spark):
    """The threshold is that of all labelled rows of the second half, and trees draw from all of the first."""
    def words(seed: int) -> str:
        return " ".join(f"w{(seed * 31 + i) * 7919 % 997}" for i in range(60 + seed % 17))

    n = 22_000
    docs = spark.createDataFrame([(i, words(i % 400) + (" ### $$$" * 9 if i % 5 == 0 else "")) for i in range(n)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "int(doc_id % 5 <> 0) as quality")
    model = quality_rules.fit(docs, labels)
    judged = quality_rules.judge(docs.join(labels, "doc_id"), model).where("not base_failed")
    rows = judged.selectExpr("pmod(xxhash64(doc_id), 2) = 1 as second", "quality", "anomaly").distinct().toPandas()
    every = judged.selectExpr("pmod(xxhash64(doc_id), 2) = 1 as second", "quality", "ceil(anomaly * 65536) / 65536 as cell").where("second").toPandas()
    assert len(every) > 10_500 and len(rows) > 100
    good, bad = (every.cell[every.quality == q].to_numpy(float) for q in (1, 0))
    assert model.threshold == quality_rules.best_threshold(good, bad)
    draws = {tuple(t[0]) + tuple(t[1]) for t in model.forest.trees}
    assert len(draws) > 50 and model.forest.rows == 256
