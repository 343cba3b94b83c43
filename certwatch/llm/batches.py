"""Arrow batches of texts as byte arrays, and what tasks keep for their process."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 19


def per_process(key: tuple, make: Callable[[], object]) -> object:
    """``make()``, kept for as long as the Python worker lives."""
    kept = vars(sys).setdefault("_certwatch_llm", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]


def slices(batches: Iterator[pa.RecordBatch], column: str,
           limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, UTF-8 bytes, offsets) with at most ``limit`` bytes of text, or one longer text.

    A null text is an empty one.
    """
    for batch in batches:
        texts = pc.fill_null(batch.column(column), "").cast(pa.large_string())
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        lo = 0
        while lo < len(sizes):
            before = ends[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, before + limit, side="right")))
            part = pa.concat_arrays([texts.slice(lo, hi - lo)])
            _, offsets, data = part.buffers()
            offsets = np.frombuffer(offsets, np.int64)[part.offset:part.offset + len(part) + 1]
            data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
            yield batch.slice(lo, hi - lo), data[offsets[0]:offsets[-1]], offsets - offsets[0]
            lo = hi


def word_bounds(is_word: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, byte after the last) of each maximal run, and the number of runs per text."""
    n = len(is_word)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets) - 1, np.int64)
    inner = offsets[1:-1][offsets[1:-1] < n]
    first = is_word.copy()
    first[1:] &= ~is_word[:-1]
    first[inner] = is_word[inner]
    last = is_word.copy()
    last[:-1] &= ~is_word[1:]
    cut = inner[inner > 0] - 1
    last[cut] = is_word[cut]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.diff(np.searchsorted(starts, offsets))


_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    kept = per_process(("powers",), dict)
    if len(kept.get("up", ())) < n:
        size = max(n, SLICE_BYTES + 1)
        for name, base in (("up", _ODD), ("down", _INVERSE)):
            out = np.full(size, base, np.uint64)
            out[0] = 1
            kept[name] = np.multiply.accumulate(out)
    return kept["up"], kept["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range, from prefix sums of a polynomial."""
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start+1, … of every range, one after the other."""
    total = int(sizes.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    before = np.cumsum(sizes) - sizes
    return np.arange(total) + np.repeat(starts - before, sizes)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores until no column has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def keep_only(df: DataFrame, *columns: str) -> DataFrame:
    """Just these columns, so that no other column of any name is in the way."""
    return df.select(*[F.col(f"`{c}`") for c in columns])
