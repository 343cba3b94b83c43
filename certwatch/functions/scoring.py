"""Token-sort similarity.

Spark has Levenshtein but no longest common subsequence, so that one integer
per pair comes from an Arrow-batched UDF; everything around it is built in.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from certwatch.functions.text import token_sorted

_WORD = 64
_CELLS = 1 << 20  # characters of the shorter strings compared at once


def _code_points(strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points plus one of all strings, end to end, and each string's length; 0 is free for padding."""
    joined = "".join(strings).encode("utf-32-le", "surrogatepass")
    sizes = np.fromiter(map(len, strings), np.int64, len(strings))
    return np.frombuffer(joined, "<u4").astype(np.uint32) + np.uint32(1), sizes


def _padded(codes: np.ndarray, ends: np.ndarray, sizes: np.ndarray, rows: np.ndarray, width: int) -> np.ndarray:
    """The strings numbered ``rows`` as a matrix of ``width`` columns."""
    own = sizes[rows]
    column = np.arange(int(own.sum())) - np.repeat(np.cumsum(own) - own, own)
    out = np.zeros((len(rows), width), np.uint32)
    out[np.repeat(np.arange(len(rows)), own), column] = codes[np.repeat(ends[rows] - own, own) + column]
    return out


def _lcs_rows(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bit-parallel LCS (Hyyrö 2004) of each row of a with that row of b; a's width is a multiple of 64."""
    v = np.full((len(a), a.shape[1] // _WORD), np.iinfo(np.uint64).max, np.uint64)
    for j in range(b.shape[1]):
        ch = b[:, j:j + 1]
        m = np.packbits((a == ch) & (ch != 0), axis=1, bitorder="little").view("<u8")
        u = v & m
        total = v + u
        carry = total < v
        while v.shape[1] > 1 and carry[:, :-1].any():  # into the next word, seldom further
            step = carry[:, :-1].astype(np.uint64)
            carry = np.zeros_like(carry)
            total[:, 1:] += step
            carry[:, 1:] = (total[:, 1:] == 0) & (step == 1)
        v = total | (v - u)
    # bits beyond the string never match, so they stay set and do not count
    return np.bitwise_count(~v).sum(axis=1).astype(np.int32)


def lcs_batch(a: pd.Series, b: pd.Series) -> pd.Series:
    """Length of the longest common subsequence of each pair, at any length of the strings."""
    n = len(a)
    out = np.zeros(n, np.int32)
    codes, sizes = _code_points([*a, *b])
    ends = np.cumsum(sizes)
    first = np.arange(n)
    swap = sizes[:n] > sizes[n:]
    short, long_ = np.where(swap, first + n, first), np.where(swap, first, first + n)
    words = -(-sizes[short] // _WORD)
    order = np.lexsort((sizes[long_], words))
    order = order[words[order] > 0]
    at = 0
    while at < len(order):
        width = int(words[order[at]]) * _WORD
        same = int(np.searchsorted(words[order], words[order[at]], side="right"))
        rows = order[at:min(same, at + max(1, _CELLS // width))]
        # one group's longer strings may differ much in length, the matrix is cut with them
        fit = np.arange(1, len(rows) + 1) * sizes[long_[rows]] <= 4 * _CELLS
        rows = rows[:max(1, int(fit.sum()))]
        out[rows] = _lcs_rows(_padded(codes, ends, sizes, short[rows], width),
                              _padded(codes, ends, sizes, long_[rows], int(sizes[long_[rows]].max())))
        at += len(rows)
    return pd.Series(out)


def bag_batch(text: pd.Series) -> pd.DataFrame:
    """128 parity bits over each string's (character, occurrence number) set.

    Inserting or deleting one character adds or removes one element of the set
    and so flips exactly one bit. Work and memory go with the characters, not
    with the longest string.
    """
    codes, sizes = _code_points(text.tolist())
    out = np.zeros((2, len(sizes)), np.uint64)
    if len(codes):
        row = np.repeat(np.arange(len(sizes)), sizes)
        order = np.lexsort((codes, row))
        codes, index = codes[order].astype(np.int64), np.arange(len(order))
        new = np.ones(len(codes), bool)
        new[1:] = (codes[1:] != codes[:-1]) | (row[1:] != row[:-1])
        occurrence = index - np.maximum.accumulate(np.where(new, index, 0))
        bit = np.uint64(1) << ((codes * 11 + occurrence) % _WORD).astype(np.uint64)
        filled = np.flatnonzero(sizes)
        starts = (np.cumsum(sizes) - sizes)[filled]
        for w in (0, 1):
            out[w, filled] = np.bitwise_xor.reduceat(np.where(codes % 2 == w, bit, np.uint64(0)), starts)
    return pd.DataFrame({"bag0": out[0].view(np.int64), "bag1": out[1].view(np.int64)})


def _pair_bits(codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """128 parity bits over each string's pairs of neighbouring characters.

    Inserting or deleting one character adds and removes three pairs at most, each of which flips one bit.
    """
    out = np.zeros((2, len(sizes)), np.uint64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    inner = row[1:] == row[:-1]
    if inner.any():
        first, second = codes[:-1][inner].astype(np.uint64), codes[1:][inner].astype(np.uint64)
        mixed = (first << np.uint64(32) | second) * np.uint64(0x9E3779B97F4A7C15)
        place = (mixed ^ mixed >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(57)
        bit = np.uint64(1) << place % np.uint64(_WORD)
        pairs = np.maximum(sizes - 1, 0)
        filled = np.flatnonzero(pairs)
        starts = (np.cumsum(pairs) - pairs)[filled]
        for w in (0, 1):
            out[w, filled] = np.bitwise_xor.reduceat(np.where(place // np.uint64(_WORD) == w, bit, np.uint64(0)), starts)
    return out


def bits_batch(text: pd.Series) -> pd.DataFrame:
    """The parity bits of each string's characters and of its pairs of neighbouring characters."""
    two = _pair_bits(*_code_points(text.tolist()))
    return bag_batch(text).assign(two0=two[0].view(np.int64), two1=two[1].view(np.int64))


_BASE, _BACK = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _part_keys(codes: np.ndarray, row: np.ndarray, n: int, salt: int, one_edit: bool, own: tuple[int, ...],
               shorter: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row, key) of the parts ``codes`` of n strings, and with ``one_edit`` of each part without each of its characters.

    A key is the part's polynomial hash modulo 2^64, and a mark. Of equal neighbouring characters one is left out.
    """
    sizes = np.bincount(row, minlength=n)
    starts = np.cumsum(sizes) - sizes
    place = np.arange(len(codes)) - starts[row]
    powers = np.ones(int(sizes.max(initial=0)) + 1, np.uint64)
    powers[1:] = _BASE
    terms = codes.astype(np.uint64) * np.multiply.accumulate(powers)[place]
    before = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
    whole = before[starts + sizes] - before[starts]

    def marked(value: np.ndarray, mark: int) -> np.ndarray:
        offset = np.uint64((2 * salt + mark + 1) * 0xD6E8FEB86659FD93 % (1 << _WORD))
        mixed = (value + offset) * np.uint64(0xFF51AFD7ED558CCD)
        return mixed ^ mixed >> np.uint64(31)

    out = [(np.arange(n), marked(whole, mark)) for mark in (own if one_edit else (0,))]
    if one_edit and len(codes):
        kept = np.ones(len(codes), bool)
        kept[1:] = (codes[1:] != codes[:-1]) | (row[1:] != row[:-1])
        at, of = np.flatnonzero(kept), row[kept]
        left = before[at] - before[starts[of]]
        out.append((of, marked(left + (whole[of] - left - terms[at]) * _BACK, shorter)))
    return out


def class_keys(strings: list[str], edits: np.ndarray, own: tuple[int, ...], shorter: int) -> pa.ListArray:
    """The keys under which strings meet that are ``edits`` insertions and deletions apart at most.

    Characters are dealt to (edits + 2) div 2 classes by code point. The edits of all classes add up to the whole, so in some
    class there is one at most, or in the last one, if edits are even, none: every class before allows one. Parts meet as they are
    or without one character of either side: x under mark 0 and y under mark 1, where the other's whole part is.
    """
    rows, keys = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for d in np.unique(edits):
        here = np.flatnonzero(edits == d)
        codes, sizes = _code_points([strings[i] for i in here])
        row = np.repeat(np.arange(len(here)), sizes)
        classes = (int(d) + 2) // 2
        for i in range(classes):
            mine = codes % classes == i
            for of, key in _part_keys(codes[mine], row[mine], len(here), int(d) * classes + i, 2 * i < d, own, shorter):
                rows.append(here[of])
                keys.append(key)
    row, key = np.concatenate(rows), np.concatenate(keys)
    offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(strings)))])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(key[np.argsort(row, kind="stable")].view(np.int64)))


def with_class_keys(s: str, own: tuple[int, ...], shorter: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Replaces the last column, the edits that string ``s`` may be apart, by its keys."""
    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            edits = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            keys = class_keys(batch.column(s).to_pylist(), edits, own, shorter)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], keys], [*batch.schema.names[:-1], "keys"])

    return batches


# ship the code with the job, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
lcs_length = pandas_udf(IntegerType())(lcs_batch)
string_bits = pandas_udf(
    StructType([StructField(name, LongType()) for name in ("bag0", "bag1", "two0", "two1")]))(bits_batch)


def indel_score(total: Column, lcs: Column) -> Column:
    """100 · 2·LCS / (la + lb), as double."""
    return F.lit(100.0) * (F.lit(2) * lcs) / total


def meets(total: Column, lcs: Column, threshold: float) -> Column:
    """score >= threshold on integers, so that an exact tie is kept."""
    return F.lit(200.0) * lcs >= F.lit(float(threshold)) * total


def rounded(score: Column) -> Column:
    """Two decimals, ties to even; apply only after the threshold test."""
    return F.bround(score, 2)


def token_sort_ratio(a: Column, b: Column) -> Column:
    """Similarity 0–100 of two non-NULL strings after sorting their tokens."""
    sa, sb = token_sorted(a), token_sorted(b)
    total = F.length(sa) + F.length(sb)
    return F.when(total == 0, F.lit(100.0)).otherwise(
        indel_score(F.greatest(total, F.lit(1)), lcs_length(sa, sb))
    )
