import random

import pytest
from pyspark.sql import functions as F
from test_scoring import lcs_table

from certwatch.operators import similarity
from certwatch.operators.similarity import signatures, similar_pairs, with_bags
from certwatch.operators.skew import spread_hot_keys


def mutate(rng: random.Random, s: str, edits: int) -> str:
    for _ in range(edits):
        p = rng.randrange(len(s) + 1)
        s = s[:p] + rng.choice("ab1 ") + s[p:] if rng.random() < 0.5 else s[:p] + s[p + 1:]
    return " ".join(sorted(s.split()))


def corpus(seed: int) -> tuple[list[str], list[str]]:
    rng = random.Random(seed)
    word = lambda n: "".join(rng.choice("abcdef0123456789") for _ in range(n))
    hot = ["household", "archive node", "machinery"]
    base = []
    for _ in range(60):
        shape = rng.random()
        if shape < 0.3:
            tokens = [word(10), rng.choice(hot)]
        elif shape < 0.5:
            tokens = [rng.choice(hot), rng.choice(hot), rng.choice("abc")]
        elif shape < 0.7:
            tokens = [word(rng.randint(1, 4))]
        else:
            tokens = [word(rng.randint(3, 20)) for _ in range(rng.randint(1, 5))]
        base.append(" ".join(sorted(" ".join(tokens).split())))
    near = [mutate(rng, s, rng.randint(1, 6)) for s in base for _ in range(4)]
    xs = sorted({s for s in base + rng.sample(near, 20) if s})
    ys = sorted({s for s in near + rng.sample(base, 20) + ["é" * 70 + "x" * 30, "é" * 70 + "x" * 28] if s})
    return xs + ["é" * 69 + "x" * 30], ys


@pytest.mark.parametrize("threshold, ratio, hot_rows, pairs", [
    (90.0, 0.6, 200_000, 1 << 30), (95.0, 0.6, 200_000, 500), (100.0, 0.6, 200_000, 1 << 30), (80.0, 0.9, 3, 20),
    (70.0, 0.0, 10, 1 << 30), (66.0, 0.6, 10, 100), (50.0, 0.6, 200_000, 1 << 30), (90.0, 0.6, 1, 1),
])
def test_equals_brute_force(spark, monkeypatch, threshold, ratio, hot_rows, pairs):
    monkeypatch.setattr(similarity, "_PAIRS", pairs)
    xs, ys = corpus(int(threshold))
    want = set()
    for x in xs:
        for y in ys:
            total, lcs = len(x) + len(y), lcs_table(x, y)
            if 200 * lcs >= threshold * total and min(len(x), len(y)) / max(len(x), len(y)) >= ratio:
                want.add((x, y, round(200 * lcs / total, 6)))
    sig = signatures(with_bags(spark.createDataFrame([(y,) for y in ys], "y string"), "y"), threshold)
    got = similar_pairs(spark.createDataFrame([(x,) for x in xs], "x string"), sig, threshold, ratio, hot_rows)
    rows = [(r["x"], r["y"], round(r["score"], 6)) for r in got.collect()]
    assert len(rows) == len(set(rows))
    assert set(rows) == want
    assert want


def test_plan_has_no_nested_loop(spark):
    xs = spark.createDataFrame([("a b",)], "x string")
    ys = spark.createDataFrame([("a b",)], "y string")
    sig = signatures(with_bags(ys, "y"), 90.0)
    plan = similar_pairs(xs, sig, 90.0, 0.6, 1000)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_every_pair_of_a_hot_key_meets_once(spark):
    left = spark.range(700).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("key"),
                                   F.col("id").alias("a"))
    right = spark.range(300).select(F.when(F.col("id") % 2 > 0, "hot").otherwise(F.col("id").cast("string")).alias("key"),
                                    F.col("id").alias("b"))
    for hot_rows, pairs in ((10, 50), (1000, 50), (10, 1 << 30), (1000, 1 << 30)):
        x, y = spread_hot_keys(left, right, ["key"], hot_rows, pairs)
        got = x.join(y, ["key", "salt"])
        assert got.count() == got.distinct().count() == left.join(right, "key").count()
        if (hot_rows, pairs) == (10, 50):
            assert got.groupBy("key", "salt").count().agg(F.max("count")).first()[0] < 500


def test_words_that_all_share_make_few_strings_meet(spark, monkeypatch):
    """Random names before one word; of all pairs of them few meet in the join, and none because of the word."""
    rng, met, joined = random.Random(5), [], similarity._joined

    def counted(left, right, bounds, hot_rows, on):
        met.append(left.join(right, [*on, "key"]).count())
        return joined(left, right, bounds, hot_rows, on)

    monkeypatch.setattr(similarity, "_joined", counted)
    names = ["".join(rng.choice("abcdef0123456789") for _ in range(10)) for _ in range(800)]
    xs, ys = ([" ".join(sorted([n, "machinery"])) for n in part] for part in (names[:200], names))
    sig = signatures(with_bags(spark.createDataFrame([(y,) for y in ys], "y string"), "y"), 90.0)
    got = similar_pairs(spark.createDataFrame([(x,) for x in xs], "x string"), sig, 90.0, 0.6, 200_000)
    assert {r["x"] for r in got.where("x = y").collect()} == set(xs)
    assert met[0] < 0.15 * len(xs) * len(ys)


def test_neighbours_and_the_search_beyond_them_make_all_pairs(spark):
    xs, ys = corpus(90)
    left, right = spark.createDataFrame([(x,) for x in xs], "x string"), with_bags(spark.createDataFrame([(y,) for y in ys], "y string"), "y")
    whole = {tuple(r) for r in similar_pairs(left, right, 90.0, 0.6, 200_000).collect()}
    near = {tuple(r) for r in similarity.neighbours(left, right, 90.0, 0.6).collect()}
    beyond = {tuple(r) for r in similar_pairs(left, right, 90.0, 0.6, 200_000, beyond=True).collect()}
    assert near | beyond == whole == {tuple(r) for r in similarity.pairs_by_length(left, right, 90.0, 0.6, 200_000).collect()}
    assert near and beyond and len(beyond) < len(whole)
