"""Benchmark passages in documents, by Wu-Manber search over words.

Every window of consecutive benchmark words is a pattern. Patterns of one length
share the tables of that search: a shift table by block of two words that says how
far a window may move, buckets of patterns by the hash of their last block,
and a direct comparison of the words. Documents are cut into lanes whose windows
move together, so that a step of the search is one array operation.

Null text has no words. Rows keep their number and columns; repeated rows are
judged each. Items without words or with a null id: the former never occur, the
latter mark words but are not listed. Repeated item ids count once. Where the name of the new column
is taken, it gets underscores before it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from certwatch.llm.batches import free_name, mix, ranges, slices, word_bounds, word_hashes
from certwatch.staging import drop, stage

_TABLE_BITS = 18
_LANE = 256
_BLOCK_BYTES = 8 << 20
_COMPARED = 1 << 15
_WORD_BYTES = np.array(
    [b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 0 for b in range(256)],
    np.uint8)


class _Words:
    """The words of some texts: their bytes back to back, and a hash of each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        low = _WORD_BYTES[data]
        starts, ends, self.per_text = word_bounds(low > 0, offsets)
        self.hashes = word_hashes(low, starts, ends)
        self.sizes = ends - starts
        self.bytes = low[low > 0]
        self.at = np.cumsum(self.sizes) - self.sizes

    def blocks(self) -> np.ndarray:
        """The hash of words i and i + 1."""
        return mix(self.hashes[:-1] * np.uint64(3) + self.hashes[1:])


class _Patterns:
    """Wu-Manber tables for patterns of ``length`` words."""

    def __init__(self, length: int, words: _Words, firsts: np.ndarray, owners: np.ndarray):
        self.length, self.block = length, min(2, length)
        keys = words.blocks() if self.block == 2 else words.hashes
        text = [words.bytes[words.at[f]:words.at[f + length - 1] + words.sizes[f + length - 1]].tobytes()
                + words.sizes[f:f + length].tobytes() for f in firsts.tolist()]
        different: dict[bytes, int] = {}
        which = np.array([different.setdefault(t, len(different)) for t in text])
        _, keep = np.unique(which, return_index=True)
        first = firsts[keep]
        last_key = keys[first + length - self.block]
        order = np.argsort(last_key, kind="stable")
        self.suffix, self.prefix = last_key[order], keys[first[order]]
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        by_pattern = np.argsort(place[which], kind="stable")
        self.owners = owners[by_pattern]
        self.owner_at = np.searchsorted(place[which][by_pattern], np.arange(len(order) + 1))
        self.sizes = words.sizes[first[order][:, None] + np.arange(length)]
        total = self.sizes.sum(axis=1)
        self.at = np.cumsum(total) - total
        self.bytes = words.bytes[ranges(words.at[first[order]], total)]
        reach = length - self.block
        self.shift = np.full(1 << _TABLE_BITS, reach + 1, np.uint8 if reach < 255 else np.int64)
        for back in range(reach, -1, -1):
            slots = (keys[first + reach - back] & np.uint64((1 << _TABLE_BITS) - 1)).astype(np.int64)
            self.shift[slots] = np.minimum(self.shift[slots], back)

    def find(self, words: _Words) -> tuple[np.ndarray, np.ndarray]:
        """(first word, pattern) of every occurrence in one text after the other."""
        per_text = words.per_text
        firsts = np.cumsum(per_text) - per_text
        usable = per_text >= self.length
        lanes = np.where(usable, (per_text - self.length) // _LANE + 1, 0)
        begin = np.repeat(firsts, lanes) + (ranges(np.zeros(len(lanes), np.int64), lanes)) * _LANE
        end = np.minimum(begin + _LANE, np.repeat(firsts + per_text - self.length + 1, lanes))
        if len(begin) == 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        keys = words.blocks() if self.block == 2 else words.hashes
        reach, mask = self.length - self.block, np.uint64((1 << _TABLE_BITS) - 1)
        met = []
        while len(begin):
            moves = self.shift[(keys[begin + reach] & mask).astype(np.int64)].astype(np.int64)
            met.append(begin[moves == 0])
            begin = begin + np.maximum(moves, 1)
            on = begin < end
            begin, end = begin[on], end[on]
        return self._confirm(words, keys, np.concatenate(met))

    def _confirm(self, words: _Words, keys: np.ndarray, met: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        suffix = keys[met + self.length - self.block]
        low, high = np.searchsorted(self.suffix, suffix), np.searchsorted(self.suffix, suffix, side="right")
        starts, patterns = np.repeat(met, high - low), ranges(low, high - low)
        same = self.prefix[patterns] == keys[starts]
        starts, patterns = starts[same], patterns[same]
        good = [np.zeros(0, np.int64)]
        for at in range(0, len(starts), _COMPARED):
            s, p = starts[at:at + _COMPARED], patterns[at:at + _COMPARED]
            ok = (words.sizes[s[:, None] + np.arange(self.length)] == self.sizes[p]).all(axis=1)
            s, p, which = s[ok], p[ok], np.flatnonzero(ok) + at
            total = self.sizes[p].sum(axis=1)
            if len(s):
                equal = words.bytes[ranges(words.at[s], total)] == self.bytes[ranges(self.at[p], total)]
                good.append(which[np.logical_and.reduceat(equal, np.cumsum(total) - total)])
        chosen = np.concatenate(good)
        return starts[chosen], patterns[chosen]


class _Searcher:
    def __init__(self, texts: list[str], window: int):
        raw = [(t or "").encode() for t in texts]
        data = np.frombuffer(b"".join(raw), np.uint8)
        words = _Words(data, np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64))
        per_text = words.per_text
        base = np.cumsum(per_text) - per_text
        self.patterns = []
        for length in sorted({min(int(n), window) for n in per_text if n}):
            own = (per_text >= window) if length == window else (per_text == length)
            items = np.flatnonzero(own)
            number = per_text[items] - length + 1
            firsts = np.repeat(base[items], number) + ranges(np.zeros(len(items), np.int64), number)
            self.patterns.append(_Patterns(length, words, firsts, np.repeat(items, number)))

    def find(self, words: _Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first word, words, item) of every occurrence."""
        parts = []
        for own in self.patterns:
            starts, which = own.find(words)
            sizes = own.owner_at[which + 1] - own.owner_at[which]
            parts.append((np.repeat(starts, sizes), np.full(int(sizes.sum()), own.length),
                          own.owners[ranges(own.owner_at[which], sizes)]))
        return tuple(np.concatenate([p[k] for p in parts]).astype(np.int64) for k in range(3)) if parts \
            else (np.zeros(0, np.int64),) * 3


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _search(searcher: _Searcher, item_ids: list[list], id_type: pa.DataType, text: str, out: str):
    hit_type = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                          ("item_ids", pa.list_(id_type))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches, text):
            words = _Words(data, offsets)
            firsts = np.cumsum(words.per_text) - words.per_text
            start, size, item = searcher.find(words)
            doc = np.searchsorted(firsts, start, side="right") - 1
            earlier = rows.column(out).to_pylist()
            hits = [{"n_words": int(n), "spans": (e or {}).get("spans") or [], "item_ids": (e or {}).get("item_ids") or []}
                    for n, e in zip(words.per_text, earlier)]
            order = np.argsort(doc, kind="stable")
            docs, at = np.unique(doc[order], return_index=True)
            for d, own in zip(docs.tolist(), np.split(order, at[1:])):
                begin = start[own] - firsts[d]
                pairs = set(zip(begin.tolist(), (begin + size[own]).tolist()))
                pairs |= {(s["start"], s["end"]) for s in hits[d]["spans"]}
                hits[d]["spans"] = [{"start": a, "end": b} for a, b in _merged(list(pairs))]
                found = {i for k in set(item[own].tolist()) for i in item_ids[k]}
                hits[d]["item_ids"] = sorted(found | set(hits[d]["item_ids"]))
            columns = [pa.array(hits, hit_type) if name == out else rows.column(i)
                       for i, name in enumerate(rows.schema.names)]
            yield pa.RecordBatch.from_arrays(columns, names=rows.schema.names)

    return run


def find_passages(docs: DataFrame, benchmark: DataFrame, window: int = 13, text: str = "text",
                  out: str = "passages") -> DataFrame:
    """``docs`` with ``out``: n_words, the hit word ranges (start, end exclusive) and the item_ids.

    item_ids are whole numbers or else strings, as in ``benchmark``. It is searched in blocks of about 8 MB of
    different texts; each block is one more pass over the same rows, without a shuffle. Only one block's tables, some
    13 times its text, are on the driver and in the tasks at a time: between blocks the rows are staged.
    """
    id_kind = "bigint" if dict(benchmark.dtypes)["item_id"] in ("tinyint", "smallint", "int", "bigint") else "string"
    out = free_name(docs, out)
    items = (benchmark.select(F.col("item_id").cast(id_kind).alias("item_id"), F.col("text"))
             .where(F.col("text").isNotNull())
             .groupBy("text").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids")))
    size = items.agg(F.sum(F.octet_length("text") + 8 * F.size("item_ids"))).first()[0] or 0
    blocks = -(-size // _BLOCK_BYTES) or 1
    kind = f"struct<n_words:bigint,spans:array<struct<start:bigint,end:bigint>>,item_ids:array<{id_kind}>>"
    found = docs.withColumn(out, F.lit(None).cast(kind))
    for k in range(blocks):
        block = items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == k).collect()
        searcher = _Searcher([r["text"] for r in block], window)
        search = _search(searcher, [r["item_ids"] for r in block], pa.int64() if id_kind == "bigint" else pa.string(), text, out)
        before, found = found, found.mapInArrow(search, found.schema)
        if k < blocks - 1:
            found = stage(found, "passages")
            if k:
                drop(before)
    return found


def n_hit(passages: str = "passages") -> Column:
    """Words inside any occurrence."""
    return F.aggregate(F.col(passages)["spans"], F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def is_contaminated(passages: str = "passages", one_in: int = 20) -> Column:
    """At least one hit word in ``one_in``."""
    hit = n_hit(passages)
    return (hit > 0) & (hit * one_in >= F.col(passages)["n_words"])
