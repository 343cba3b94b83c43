"""Exact similarity join between two sets of distinct strings.

Finds every pair (x, y) whose token-sort score reaches a threshold t, with no
nested loop and no all-pairs group. Strings arrive token-sorted, so the score
is the Indel similarity and ``score >= t`` means at most

    d = floor((1 - t/100) · (len x + len y))

single-character insertions and deletions turn y into x.

Candidates come from an equi-join. The characters are dealt to classes by their code points. An edit
is of one character, so the edits between the parts of x and y that consist of one class only add up to d at most
over the classes. With about (d + 1) / 2 classes some class has one edit at most: there the parts are equal, or equal
once a character is left out of one of them. y contributes the part of each class and what is left of it without
each of its characters, x the same. Every class holds a share of all that tells strings apart, wherever it stands,
so words that half the table shares do no harm.

Inside the join, before a pair is ever materialised, it must also satisfy the
length bound and two bag bounds: each string carries 128 parity bits over its
(character, occurrence) set, one edit flips exactly one of them, so more than
d differing bits rule the pair out; and 128 over its pairs of neighbouring characters,
of which one edit flips three at most. What is left goes to the LCS.

A string that brings a bound of its own (``least``: it has enough candidates of that score already) meets
only those that can still reach it, by their lengths and bags. ``neighbours`` finds such candidates first:
strings that are equal once a character is left out of either or both. Where so few edits are allowed that these are
all there can be, the pair is not searched again.

Groups (equal ``on``) so small on one side that comparing all is less work than making keys, as most key groups
of renewals are, meet by their lengths alone: ``pairs_by_length``.

For t <= 66.7 a string may be shorter than its number of edits. There the
keys are single (character, occurrence) elements: a pair
sharing a common subsequence of length c shares c of them, so the first
``len - c + 1`` in any common order must meet. At t = 0 pairs without a character in common score 0 and
count too; ``strangers`` lists them.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from certwatch.functions.scoring import indel_score, lcs_length, meets, string_bits, with_class_keys
from certwatch.operators.skew import spread_hot_keys
from certwatch.staging import shuffled, stage

_EPS = 1e-9
_BUILD_ROWS = 500_000
_PAIRS = 200_000_000  # row pairs of one key that a task may compare
_BUCKETS = 1 << 16
_BITS = ("bag0", "bag1", "two0", "two1")


def with_bags(df: DataFrame, s: str) -> DataFrame:
    """Adds the length and the parity bits of column ``s``."""
    return df.withColumn("_b", string_bits(F.col(s))).select(
        *df.columns, F.length(s).alias(f"{s}_len"), *[F.col("_b")[b].alias(f"{s}_{b}") for b in _BITS])


def _keyed(df: DataFrame, s: str, own: tuple[int, ...], shorter: int) -> DataFrame:
    """The rows of ``df`` once per ``key`` of string ``s``, instead of ``d``, the most edits it may be apart."""
    kept = [c for c in df.columns if c != "d"]
    schema = StructType([*[df.schema[c] for c in kept], StructField("keys", ArrayType(LongType()))])
    keyed = df.select(*kept, F.col("d").cast("int").alias("d")).mapInArrow(with_class_keys(s, own, shorter), schema)
    return keyed.select(*kept, F.explode("keys").alias("key"))


def _partners(xs: DataFrame, ys: DataFrame, threshold: float, ratio_min: float) -> Column:
    """An array (n, d): the lengths n of ys that some x can match, and the most edits that any x can be apart."""
    x_lens, y_lens = ([r[0] for r in df.select(F.length(s)).distinct().collect()] for df, s in ((xs, "x"), (ys, "y")))
    most = {n: max((d for m in x_lens if min(m, n) / max(m, n) >= ratio_min
                    for d in [math.floor((m + n) * ((100.0 - threshold) / 100.0) + _EPS)] if abs(m - n) <= d), default=None)
            for n in y_lens}
    found = [{"n": n, "d": d} for n, d in sorted(most.items()) if d is not None]
    return F.from_json(F.lit(json.dumps(found)), "array<struct<n:int, d:int>>")


def elements(strings: DataFrame, s: str, threshold: float) -> DataFrame:
    """Low-threshold signature: the leading (character, occurrence) elements."""
    keep = F.col(f"{s}_len") - F.ceil(F.col(f"{s}_len") * (threshold / (200.0 - threshold)) - _EPS) + 1
    # higher occurrence numbers are rarer, so they lead the common order
    ordered = F.expr(
        f"array_sort(flatten(transform(array_distinct("
        f"transform(sequence(1, length({s})), i -> substring({s}, i, 1))), c -> "
        f"transform(sequence(1, length({s}) - length(replace({s}, c, ''))), "
        "k -> struct(-k AS k, c AS c)))))"
    )
    return (
        strings.withColumn("e", F.explode(F.slice(ordered, F.lit(1), keep.cast("int"))))
        .withColumn("key", F.concat_ws("", F.col("e.k"), F.col("e.c")))
        .drop("e")
    )


def _in_ratio(ratio_min: float) -> Column:
    return F.least("x_len", "y_len") / F.greatest("x_len", "y_len") >= ratio_min


def _edits(threshold: Column, x_len: Column, y_len: Column) -> Column:
    return F.floor((x_len + y_len) * ((100.0 - threshold) / 100.0) + _EPS)


def _beyond_neighbours(d: Column, x_len: Column, y_len: Column) -> Column:
    """Whether strings of these lengths, d edits apart at most, may be none of the ``neighbours``."""
    apart = F.abs(x_len - y_len)
    return (apart > 1) | (d > F.lit(3) - apart)


def _flips(*bits: str) -> Column:
    first, second = (F.bit_count(F.col(f"x_{b}").bitwiseXOR(F.col(f"y_{b}"))) for b in bits)
    return first + second


def _bounds(threshold: Column, ratio_min: float, beyond: bool = False) -> Column:
    lengths = F.col("x_len"), F.col("y_len")
    d = _edits(threshold, *lengths)
    bounds = (
        (F.abs(F.col("x_len") - F.col("y_len")) <= d)
        & _in_ratio(ratio_min)
        & (_flips("bag0", "bag1") <= d) & (_flips("two0", "two1") <= 3 * d)
    )
    return bounds & _beyond_neighbours(d, *lengths) if beyond else bounds


def signatures(ys: DataFrame, threshold: float) -> DataFrame:
    """What ``similar_pairs`` needs of the candidate strings (from ``with_bags``): elements are staged, classes are made there."""
    return ys if by_classes(threshold) else stage(elements(ys, "y", threshold), "keys")


def by_classes(threshold: float) -> bool:
    return threshold * 3 > 200


def key_load(left: DataFrame, right: DataFrame, on: Sequence[str] = ()) -> tuple[int, int, int]:
    """(rows of ``right``, a bound for its rows of one join key, a bound for the row pairs of one key), by buckets of keys."""
    def loads(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(F.pmod(F.xxhash64(*on, "key"), F.lit(_BUCKETS)).alias("bucket")).agg(F.count(F.lit(1)).alias(name))

    load = loads(right, "r").join(shuffled(loads(left, "l")), "bucket", "left").agg(
        F.sum("r").alias("rows"), F.max("r").alias("largest"), F.max(F.col("r") * F.coalesce("l", F.lit(0))).alias("pairs")).first()
    return load["rows"] or 0, load["largest"] or 0, load["pairs"] or 0


def _limit(xs: DataFrame, threshold: float) -> Column:
    return F.greatest("least", F.lit(threshold)) if "least" in xs.columns else F.lit(threshold)


def _reachable(xs: DataFrame, partners: Column, threshold: float, ratio_min: float, beyond: bool) -> Column:
    """Those of ``partners`` whose lengths x can still match."""
    x_len = F.length("x")

    def reached(p: Column) -> Column:
        d = _edits(_limit(xs, threshold), x_len, p["n"])
        met = (F.abs(x_len - p["n"]) <= d) & (F.least(x_len, p["n"]) / F.greatest(x_len, p["n"]) >= ratio_min)
        return met & _beyond_neighbours(d, x_len, p["n"]) if beyond else met

    return F.filter(partners, reached)


def similar_pairs(xs: DataFrame, sig: DataFrame, threshold: float, ratio_min: float,
                  hot_rows: int, on: Sequence[str] = (), beyond: bool = False) -> DataFrame:
    """(*on, x, y, score) for all pairs that agree on ``on`` and score at least the threshold.

    ``xs`` holds distinct (*on, x) and maybe ``least``, a score below which x needs no pairs; ``sig`` comes from
    ``signatures`` at the same threshold. Strings are token-sorted and not empty; x = y is included. With ``beyond``
    pairs are left out that only ``neighbours`` can be, given their lengths.
    """
    bounds = _bounds(_limit(xs, threshold), ratio_min, beyond)
    left = with_bags(xs, "x")
    if by_classes(threshold):
        partners = _partners(xs, sig, threshold, ratio_min)
        left = _keyed(left.withColumn("d", F.explode(F.array_distinct(
            F.transform(_reachable(xs, partners, threshold, ratio_min, beyond), lambda p: p["d"])))), "x", (0, 1), 0)
        right = _keyed(sig.withColumn("d", F.get(F.filter(partners, lambda p: p["n"] == F.col("y_len")), F.lit(0))["d"]).where("d IS NOT NULL"), "y", (0,), 1)
    else:
        left, right = elements(left, "x", threshold), sig
    return _scored(_joined(left, right, bounds, hot_rows, on).distinct(), threshold, on)


def pairs_by_length(xs: DataFrame, ys: DataFrame, threshold: float, ratio_min: float,
                    hot_rows: int, on: Sequence[str] = ()) -> DataFrame:
    """The same pairs, where every x meets every y of a length that it can match: for small groups."""
    partners = _partners(xs, ys, threshold, ratio_min)
    left = with_bags(xs, "x").withColumn("key", F.explode(F.transform(
        _reachable(xs, partners, threshold, ratio_min, False), lambda p: p["n"])))
    pairs = _joined(left, ys.withColumn("key", F.col("y_len")), _bounds(_limit(xs, threshold), ratio_min), hot_rows, on)
    return _scored(pairs, threshold, on)


def _joined(left: DataFrame, right: DataFrame, bounds: Column, hot_rows: int, on: Sequence[str]) -> DataFrame:
    """(*on, x, y, lengths) of the rows that agree on ``on`` and ``key`` within ``bounds``."""
    rows, largest, most = key_load(left, right, on)
    keys = [*on, "key"]
    # the work of a key is the product of both sides' rows
    if largest > hot_rows or most > _PAIRS:
        left, right = spread_hot_keys(left, right, keys, hot_rows, _PAIRS)
        keys = [*keys, "salt"]
    # Work here goes with matches per key, not bytes, so partitions are set by row count and kept.
    # A partition holds about _BUILD_ROWS, a hot key's cell hot_rows.
    n = max(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // _BUILD_ROWS))
    return left.repartition(n, *keys).join(shuffled(right.repartition(n, *keys)), keys).where(bounds).select(
        *on, "x", "y", "x_len", "y_len")


def _scored(pairs: DataFrame, threshold: float, on: Sequence[str]) -> DataFrame:
    return _above(pairs.withColumn("lcs", lcs_length("x", "y")), threshold, on)


def _above(pairs: DataFrame, threshold: float, on: Sequence[str]) -> DataFrame:
    total = F.col("x_len") + F.col("y_len")
    return pairs.where(meets(total, F.col("lcs"), threshold)).select(
        *on, "x", "y", indel_score(total, F.col("lcs")).alias("score"))


def _shortened(strings: DataFrame, s: str, on: Sequence[str]) -> DataFrame:
    """(*on, s, s_len, s_out, key): each string itself and without each of its characters, by hash; s_out is the place left out, or 0."""
    keys = F.expr(f"concat(array(xxhash64({s})), transform(sequence(1, length({s})), "
                  f"i -> xxhash64(concat(substring({s}, 1, i - 1), substring({s}, i + 1)))))")
    # of equal neighbouring characters the first is left out
    rows = strings.select(*on, s, F.length(s).alias(f"{s}_len"), F.posexplode(keys).alias(f"{s}_out", "key"))
    return rows.where((F.col(f"{s}_out") < 2) | (F.substring(s, F.col(f"{s}_out") - 1, F.lit(1)) != F.substring(s, F.col(f"{s}_out"), F.lit(1))))


def neighbours(xs: DataFrame, ys: DataFrame, threshold: float, ratio_min: float, on: Sequence[str] = ()) -> DataFrame:
    """(*on, x, y, score) of the pairs that are equal without a character of either or both, and score the threshold.

    A key is shared by strings of one place for a character, so the pairs of a string grow with its length and
    alphabet, not with the number of strings.
    """
    def rest(s: str) -> Column:
        out = F.col(f"{s}_out")
        return F.when(out == 0, F.col(s)).otherwise(F.concat(F.substring(s, F.lit(1), out - 1), F.substring(F.col(s), out + 1, F.col(f"{s}_len"))))

    pairs = _shortened(xs, "x", on).join(shuffled(_shortened(ys, "y", on)), [*on, "key"]).where(
        _in_ratio(ratio_min) & (rest("x") == rest("y"))).select(*on, "x", "y", "x_len", "y_len").distinct()
    # all but a character of the longer string are common, unless the two are equal
    lcs = F.when(F.col("x") == F.col("y"), F.col("x_len")).otherwise(F.greatest("x_len", "y_len") - 1)
    return _above(pairs.withColumn("lcs", lcs), threshold, on)


def strangers(xs: DataFrame, ys: DataFrame, ratio_min: float, on: Sequence[str] = ()) -> DataFrame:
    """(*on, x, y, score = 0) of the pairs without a common character."""
    longest = ys.agg(F.max(F.length("y")).alias("n")).scalar()
    n = F.length("x")
    low = F.greatest(F.lit(1), F.floor(n * ratio_min).cast("int"))
    high = F.least(longest, F.ceil(n / ratio_min).cast("int")) if ratio_min else longest
    lengths = F.when(low <= high, F.sequence(low, F.greatest(low, high)))
    left = xs.select(*on, "x", n.alias("x_len"), F.explode(lengths).alias("y_len"))
    right = ys.select(*on, "y", F.length("y").alias("y_len"))
    return left.join(right, [*on, "y_len"]).where(_in_ratio(ratio_min)).where(
        ~F.arrays_overlap(F.split("x", ""), F.split("y", ""))).select(*on, "x", "y", F.lit(0.0).alias("score"))
