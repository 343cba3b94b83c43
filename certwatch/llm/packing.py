"""Best-fit packing of documents into sequences, after dominance reduction.

Only lengths matter for the plan, and there are at most ``size`` of them: the plan
is made from the number of pieces of each length, whatever their number. A set of
lengths is fixed as a sequence when it provably dominates every other set that
could hold its longest member (Martello and Toth); the rest goes best-fit in
decreasing order. Each slot of the plan is an interval of ranks, so pieces
find their sequence by the rank within their length. ``sequences`` brings the ids together,
and ``read_sequences`` finds every piece in them again.

Null text is an empty document of its end id only. Repeated rows are packed
each. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from certwatch.llm.batches import slices
from certwatch.llm.vocabulary import encoder
from certwatch.staging import stage

_PIECES = "doc_id long, row_key long, part int, piece int, nth long, start long, length int, ids_crc32 long, ids binary"
_SMALL_ROWS = 1 << 20  # rows of a few numbers that may be broadcast; more are shuffled


def _cut(path: str, end_id: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(path)
        end = np.array([end_id], tool.dtype)
        seen = np.zeros(size + 1, np.int64)
        for rows, data, offsets in slices(batches, "text"):
            out: dict[str, list] = {k: [] for k in ("doc_id", "row_key", "part", "piece", "nth", "start", "length", "ids_crc32", "ids")}
            known = (rows.column(c).to_pylist() for c in ("doc_id", "row_key", "part"))
            for doc_id, key, place, own in zip(*known, tool.encode(data, offsets)):
                ids = np.concatenate([own, end]).astype("<u4")
                for piece, at in enumerate(range(0, len(ids), size)):
                    part = ids[at:at + size]
                    seen[len(part)] += 1
                    for name, value in zip(out, (doc_id, key, place, piece, int(seen[len(part)]), at, len(part),
                                                     zlib.crc32(part.tobytes()), part.astype(tool.dtype).tobytes())):
                        out[name].append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["doc_id"], pa.int64()), pa.array(out["row_key"], pa.int64()), pa.array(out["part"], pa.int32()),
                 pa.array(out["piece"], pa.int32()), pa.array(out["nth"], pa.int64()), pa.array(out["start"], pa.int64()),
                 pa.array(out["length"], pa.int32()), pa.array(out["ids_crc32"], pa.int64()),
                 pa.array(out["ids"], pa.binary())], names=list(out))

    return run


def cut_pieces(docs: DataFrame, tokenizer: str, end_id: int, size: int) -> DataFrame:
    """(doc_id, row_key, part, piece, nth, start, length, ids_crc32, ids) of all documents, staged.

    A piece is the ``nth`` of its length in its partition of the documents, ``part``. ``ids`` are in the narrowest unsigned words for the vocabulary; the CRC is over 32-bit words.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       F.monotonically_increasing_id().alias("row_key"), F.spark_partition_id().alias("part"))
    return stage(rows.mapInArrow(_cut(tokenizer, end_id, size), _PIECES), "pieces", "zstd")


class _Plan:
    """Sequences by pattern: (number of such sequences, lengths in it)."""

    def __init__(self, counts: np.ndarray, size: int):
        self.counts, self.size, self.patterns = counts.astype(np.int64).copy(), size, []

    def fix(self, lengths: tuple[int, ...], times: int) -> None:
        self.patterns.append((times, list(lengths)))
        for x in lengths:
            self.counts[x] -= times

    def _left(self, taken: tuple[int, ...]) -> np.ndarray:
        left = self.counts.copy()
        for x in taken:
            left[x] -= 1
        return left

    def _smallest(self, left: np.ndarray, k: int) -> int:
        """The sum of the k shortest pieces, or more than any sequence holds."""
        total = 0
        for x in np.flatnonzero(left > 0).tolist():
            take = min(k, int(left[x]))
            total, k = total + take * x, k - take
            if k == 0:
                return total
        return self.size + 1

    def dominating(self, longest: int) -> tuple[int, ...] | None:
        """A set with one ``longest`` that dominates all others that hold it, if one is found."""
        room, left = self.size - longest, self._left((longest,))
        if self._smallest(left, 1) > room:
            return (longest,)
        fitting = np.flatnonzero(left[:room + 1] > 0)
        best = int(fitting[-1])
        if best == room or self._smallest(left, 2) > room:
            return (longest, best)
        pair = self._best_pair(left, fitting, room)
        if best >= sum(pair):
            return (longest, best) if self._smallest(left, 3) > room else None
        first, second = pair
        half = fitting[fitting <= room // 2]
        if first == best and self._smallest(left, 3) > room and (len(half) == 0 or half[-1] <= second):
            return (longest, first, second)
        return None

    def _best_pair(self, left: np.ndarray, fitting: np.ndarray, room: int) -> tuple[int, int]:
        partner = np.searchsorted(fitting, room - fitting, side="right") - 1
        sums = np.where(partner >= 0, fitting + fitting[partner], -1)
        alone = (partner >= 0) & (fitting[partner] == fitting) & (left[fitting] < 2)
        lower = np.where(alone & (partner > 0), fitting + fitting[partner - 1], -1)
        sums = np.where(alone, lower, sums)
        k = int(np.lexsort((fitting, sums))[-1])
        if sums[k] < 0:
            return (0, 0)
        other = int(sums[k]) - int(fitting[k])
        return max(int(fitting[k]), other), min(int(fitting[k]), other)

    def reduce(self) -> None:
        """Fix dominating sets until none is found."""
        changed = True
        while changed:
            changed = False
            for longest in np.flatnonzero(self.counts > 0)[::-1].tolist():
                while self.counts[longest] > 0:
                    found = self.dominating(longest)
                    if found is None:
                        break
                    # fewer pieces leave other sets fewer choices, so the proof holds while the set has its own
                    uses = {x: found.count(x) for x in found}
                    self.fix(found, min(int(self.counts[x]) // n for x, n in uses.items()))
                    changed = True

    def best_fit(self) -> None:
        """Longest first, each into the fullest sequence that has room."""
        open_: dict[int, list[tuple[int, list[int]]]] = {}
        for x in np.flatnonzero(self.counts > 0)[::-1].tolist():
            todo = int(self.counts[x])
            while todo:
                rooms = [r for r in open_ if r >= x and open_[r]]
                room = min(rooms, default=None)
                times, held = open_[room].pop() if room is not None else ((todo * x + self.size - 1) // self.size + 1, [])
                room = self.size if room is None else room
                each = min(room // x, todo)
                use = min(times, todo // each)
                if held and use < times:
                    open_[room].append((times - use, held))
                open_.setdefault(room - each * x, []).append((use, held + [x] * each))
                todo -= use * each
            self.counts[x] = 0
        self.patterns += [p for group in open_.values() for p in group]


def plan_sequences(counts: np.ndarray, size: int) -> list[tuple[int, list[int]]]:
    """Patterns for ``counts[length]`` pieces of each length up to ``size``.

    A fixed set leaves fewer of some member than it takes, and best fit opens or splits groups of equal
    sequences, so that the patterns grow with the lengths in use and hardly with the pieces.
    """
    plan = _Plan(counts, size)
    plan.reduce()
    plan.best_fit()
    return plan.patterns


def _slots(spark: SparkSession, patterns: list[tuple[int, list[int]]]) -> DataFrame:
    """(length, first, last, sequence, offset): the ranks each slot of the plan takes."""
    rows, sequence = [], 0
    taken: dict[int, int] = {}
    for times, lengths in patterns:
        offset = 0
        for x in lengths:
            first = taken.get(x, 0) + 1
            taken[x] = first + times - 1
            rows.append((x, first, taken[x], sequence, offset))
            offset += x
        sequence += times
    return spark.createDataFrame(rows, "length int, first long, last long, sequence long, offset long")


def pack(pieces: DataFrame, size: int) -> DataFrame:
    """``pieces``, a staged table of ``cut_pieces``, with sequence_id and offset.

    The plan and its slots depend on ``size`` and the set of lengths, so the former is made on the driver. Slots and
    the number of pieces in earlier partitions are broadcast where they have at most 2^20 rows.
    """
    spark = pieces.sparkSession
    found = stage(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "lengths")
    counts = np.zeros(size + 1, np.int64)
    for row in found.groupBy("length").agg(F.sum("n").alias("n")).collect():
        counts[row["length"]] = row["n"]
    slots = _slots(spark, plan_sequences(counts, size)).withColumnRenamed("length", "_length")
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = found.select(F.col("part").alias("_part"), F.col("length").alias("_own"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"))
    rank = F.col("nth") + F.col("_before")
    placed = (pieces.join(_where_small(before, found.count()), (F.col("part") == F.col("_part")) & (F.col("length") == F.col("_own")))
              .withColumn("_rank", rank)
              .join(_where_small(slots, slots.count()), (F.col("length") == F.col("_length")) & F.col("_rank").between(F.col("first"), F.col("last"))))
    return placed.select(*pieces.columns, (F.col("sequence") + F.col("_rank") - F.col("first")).alias("sequence_id"), "offset")


def _where_small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= _SMALL_ROWS else df


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, pieces, ids): the packed sequences themselves, each of at most one size; pieces are in their order."""
    fields = ("doc_id", "row_key", "piece", "start", "length")
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", *fields, "ids"))).alias("parts"))
    return parts.select("sequence_id", F.transform("parts", lambda p: F.struct(*[p[f].alias(f) for f in fields])).alias("pieces"),
                        F.expr("aggregate(parts, cast('' as binary), (all, p) -> concat(all, p.ids))").alias("ids"))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: dict[str, list] = {k: [] for k in ("doc_id", "row_key", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "ids")}
        for name, pieces, raw in zip(*(batch.column(c).to_pylist() for c in ("sequence_id", "pieces", "ids"))):
            ids = np.frombuffer(raw, f"<u{len(raw) // sum(p['length'] for p in pieces)}").astype("<u4")
            at = 0
            for p in pieces:
                own = ids[at:at + p["length"]]
                for column, value in zip(out, (p["doc_id"], p["row_key"], p["piece"], p["start"], len(own), zlib.crc32(own.tobytes()), name, at, own)):
                    out[column].append(value)
                at += len(own)
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds)], names=list(out))


def read_sequences(written: DataFrame) -> DataFrame:
    """A row per piece of ``sequences``: where it lies, how long it is there, its ids and their CRC over 32-bit words."""
    return written.mapInArrow(_read, "doc_id long, row_key long, piece int, start long, length long, ids_crc32 long, "
                                     "sequence_id long, offset long, ids array<int>")
