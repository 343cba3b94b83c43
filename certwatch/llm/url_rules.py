"""URL rules by a sort-merge range join over reversed hosts.

A host's key is its labels in reverse, each followed by a dot: ``blog.example.net``
is ``net.example.blog.``. A host rule covers exactly the keys that start with its
own, one interval. Pages and rules are cut at the same boundaries (from a
bounded sample, which decides the balance only), a rule goes to every range its
interval meets, and each sorted range is swept once with a stack of the rules
that are open. Pages of one host differ in path and so fall into many ranges.

Null urls and urls without ``://`` have empty host and path and meet no rule, as do
rules without a host. Of fitting rules the longest wins, then the longer
host, then ``block``. Repeated rows are judged each; an empty rule table
decides nothing.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SAMPLED_PER_RANGE = 100
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), _CAPITALS, _SMALL)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def _assign(bounds: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([bisect_right(bounds, k) for k in keys], pa.int32())],
                names=[*batch.schema.names, "range"])

    return run


class _OpenRules:
    """The rules of one host while the sweep is inside its interval."""

    def __init__(self, key: str):
        self.key, self.end = key, key[:-1] + "/"  # "/" is the character after "."
        self.paths: dict[str, tuple[str, str]] = {}

    def add(self, path: str, rule: str, verdict: str) -> None:
        known = self.paths.get(path)
        self.paths[path] = max(known, (rule, verdict), key=lambda r: r[1] == "block") if known else (rule, verdict)

    def longest(self, path: str) -> tuple[int, int, str, str] | None:
        for size in sorted({len(p) for p in self.paths}, reverse=True):
            found = self.paths.get(path[:size]) if size <= len(path) else None
            if found:
                return (len(self.key) + size, len(self.key), *found)
        return None


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    stack: list[_OpenRules] = []
    current = None
    for batch in batches:
        ids, rules, verdicts = [], [], []
        rows = zip(*(batch.column(c).to_pylist() for c in ("range", "key", "row", "host_key", "path", "rule", "verdict")))
        for range_, key, row, host, path, rule, verdict in rows:
            if range_ != current:
                stack, current = [], range_
            while stack and stack[-1].end <= key:
                stack.pop()
            if rule is not None:
                if not stack or stack[-1].key != key:
                    stack.append(_OpenRules(key))
                stack[-1].add(path, rule, verdict)
                continue
            best = max((f for o in stack if host.startswith(o.key) and (f := o.longest(path))), default=None)
            ids.append(row)
            rules.append(best[2] if best else None)
            verdicts.append(best[3] if best else None)
        if ids:
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, batch.schema.field("row").type), pa.array(rules, pa.string()), pa.array(verdicts, pa.string())],
                names=["row", "rule", "verdict"])


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule and verdict; ``rules`` has verdict, host and path.

    Columns of ``pages`` with one of these names are replaced.
    """
    spark = pages.sparkSession
    added = ("host", "path", "rule", "verdict")
    kept = [c for c in pages.columns if c.lower() not in added]
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("page"),
                        host_of(F.col(f"`{url}`")).alias("host"), path_of(F.col(f"`{url}`")).alias("path"))
    row = F.struct("page", "host", "path")
    keyed = rows.select(row.alias("row"), host_key(F.col("host")).alias("host_key"), "path").withColumn(
        "key", F.concat("host_key", F.lit("/"), "path", F.lit("/"), F.hex(F.xxhash64("row"))))

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sample = sorted(r[0] for r in keyed.select("key").orderBy(F.xxhash64("key")).limit(_SAMPLED_PER_RANGE * n).collect())
    bounds = sorted({sample[i * len(sample) // n] for i in range(1, n)}) if sample else []

    named = rules.where(F.length("host") > 0).select(
        host_key(F.translate("host", _CAPITALS, _SMALL)).alias("key"), F.coalesce("path", F.lit("")).alias("path"),
        F.col("host").alias("host"), "verdict")
    last = named.select("*", F.concat(F.expr("substring(key, 1, length(key) - 1)"), F.lit("/")).alias("end"))
    first_range = last.mapInArrow(_assign(bounds), "key string, path string, host string, verdict string, end string, range int")
    spans = first_range.select(F.col("end").alias("key"), F.col("key").alias("start"), "path", "host", "verdict",
                               F.col("range").alias("from")).mapInArrow(
        _assign(bounds), "key string, start string, path string, host string, verdict string, `from` int, range int")
    kind = keyed.schema["row"].dataType
    rule_rows = spans.select(
        F.explode(F.sequence("from", "range")).alias("range"), F.col("start").alias("key"), F.lit(0).alias("kind"),
        F.lit(None).cast(kind).alias("row"), F.lit(None).cast("string").alias("host_key"), "path",
        F.concat("host", "path").alias("rule"), "verdict")
    fields = ", ".join(f"{c} {t}" for c, t in keyed.dtypes)
    page_rows = keyed.mapInArrow(_assign(bounds), f"{fields}, range int").select(
        "range", "key", F.lit(1).alias("kind"), "row", "host_key", "path",
        F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    swept = (rule_rows.unionByName(page_rows).repartition("range").sortWithinPartitions("range", "key", "kind")
             .mapInArrow(_sweep, f"row {keyed.schema['row'].dataType.simpleString()}, rule string, verdict string"))
    return swept.select("row.page.*", "row.host", "row.path", "rule",
                        F.coalesce("verdict", F.lit(default)).alias("verdict"))
