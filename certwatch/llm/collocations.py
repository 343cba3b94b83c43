"""Collocations: phrases of up to four words that occur far more often than their parts suggest.

All counts come from suffix trees that end at four words, built as ERA builds them. Every word position
begins a suffix, cut off after four words or where its piece of text ends. Suffixes are partitioned
vertically: the subtree of a prefix, at first one word, is built in one group, and prefixes share groups
so that a group holds about half of ``GROUP_SUFFIXES``. A prefix of more than a quarter of that is
replaced by its extensions with one more word, and so on up to four words. A task sends, for each block of
text and group, its different suffixes with their numbers and the words they use. A group merges these,
sorts them, and reads the count of each node from the total of the leaves below it. Nodes above an extended
prefix are in several groups and summed.

Which prefixes are extended is a bitmap of at most 16 MB, the same in all tasks; where two
prefixes share a bit, one is extended needlessly.

A phrase's score is that of its weakest cut. A phrase that lies inside a longer candidate nearly as frequent
goes; it is enough to look at candidates one word longer, as each longer one holds such a one.

Texts are lower-cased (A-Z) and split into pieces at ``.,;:!?`` and line ends, and those into words at blanks
and tabs. A null text is empty, a null language is ``und``. Repeated rows count each. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from certwatch.llm.batches import mix, slices, word_bounds, word_hashes
from certwatch.staging import stage

WORDS, LEAST, KEPT, COVERED = 4, 30, 2000, 80
GROUP_SUFFIXES = 1 << 20
_BLOCK_BYTES = 4 << 20
_AT_ONCE = 1 << 16  # suffixes numbered at a time
_MOST_BITS = 27

_LOW = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_ENDS_PIECE = np.isin(np.arange(256), [*b".,;:!?", 10, 11, 12, 13])
_IS_WORD = ~_ENDS_PIECE & ~np.isin(np.arange(256), (32, 9))


class _Block:
    """The suffixes of some texts: word numbers in columns, 0 after the end, and the language of each."""

    def __init__(self, langs: list[str], data: np.ndarray, offsets: np.ndarray):
        starts, ends, per_text = word_bounds(_IS_WORD[data], offsets)
        stops = np.zeros(len(data) + 1, np.int32)
        np.cumsum(_ENDS_PIECE[data], out=stops[1:])
        text = np.repeat(np.arange(len(per_text)), per_text)
        follows = (text[1:] == text[:-1]) & (stops[starts[1:]] == stops[ends[:-1]]) if len(starts) else np.zeros(0, bool)
        sizes = ends - starts
        low = _LOW[data][_IS_WORD[data]]
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [
            None, pa.py_buffer(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)), pa.py_buffer(low)]).dictionary_encode()
        self.words = words.dictionary
        numbers = words.indices.to_numpy() + np.int32(1)
        self.columns = np.zeros((WORDS, len(numbers)), np.int32)
        on = np.ones(len(numbers), bool)
        for k in range(min(WORDS, len(numbers))):
            if k:
                on = on[:-1] & follows[k - 1:]
            self.columns[k, :len(on)] = np.where(on, numbers[k:], 0)
        self.langs = sorted(set(langs))
        known = {x: i for i, x in enumerate(self.langs)}
        self.lang = np.array([known[x] for x in langs], np.int64)[text]
        _, at, bytes_ = self.words.buffers()
        at = np.frombuffer(at, np.int64)[self.words.offset:self.words.offset + len(self.words) + 1] if len(self.words) else np.zeros(1, np.int64)
        bytes_ = np.frombuffer(bytes_, np.uint8) if bytes_ is not None and len(self.words) else np.zeros(0, np.uint8)
        self.word_hash = np.concatenate([np.zeros(1, np.uint64), word_hashes(bytes_, at[:-1], at[1:])])
        raw = [x.encode() for x in self.langs]
        ends = np.cumsum([len(x) for x in raw]).astype(np.int64)
        self.lang_hash = word_hashes(np.frombuffer(b"".join(raw), np.uint8), ends - [len(x) for x in raw], ends)

    def longer(self, key: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
        """The keys of the prefixes of k + 1 words of the suffixes ``at``, from those of k words."""
        return mix(key ^ (self.word_hash[self.columns[k, at]] + np.uint64(k)))

    def routed(self, hot: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(words in the prefix, its key) of each suffix: prefixes in ``hot`` are extended."""
        at = np.arange(self.columns.shape[1])
        words, key = np.ones(len(at), np.int64), self.longer(mix(self.lang_hash + np.uint64(1))[self.lang], at, 0)
        for k, bits in enumerate(hot, start=1):
            at = at[_is_set(bits, key[at])]
            key[at] = self.longer(key[at], at, k)
            words[at] = k + 1
        return words, key


def _is_set(bits: np.ndarray, key: np.ndarray) -> np.ndarray:
    place = key & np.uint64(64 * len(bits) - 1)
    return (bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[_Block]:
    for rows, data, offsets in slices(batches, "text", _BLOCK_BYTES):
        yield _Block(rows.column("lang").to_pylist(), data, offsets)


def _count_prefixes(hot: list[np.ndarray]):
    """(lang, key, n) of prefixes one word longer than those in the last of ``hot``; of all words without it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            words, key = block.routed(hot)
            at = np.flatnonzero(words == len(hot) + 1)
            keys, first, n = np.unique(key[at], return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(block.langs, pa.string()).take(pa.array(block.lang[at[first]])), pa.array(keys.view(np.int64)), pa.array(n)],
                names=["lang", "key", "n"])

    return run


def _bitmap(counts: DataFrame, most: int, total: int) -> np.ndarray:
    """The keys that more than ``most`` suffixes have, at most total / most of them."""
    size = 1 << min(_MOST_BITS, max(14, (64 * total // most).bit_length()))
    place = F.col("key").bitwiseAND(F.lit(size - 1))
    words = (counts.where(F.col("n") > most).select(F.shiftright(place, 6).alias("word"), place.bitwiseAND(F.lit(63)).cast("int").alias("bit"))
             .groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).collect())
    out = np.zeros(size >> 6, np.int64)
    for row in words:
        out[row["word"]] = row["bits"]
    return out.view(np.uint64)


def _parted(hot: list[np.ndarray], groups: int):
    """A row per block, group, language and prefix length: the words in use, the suffixes and how often each occurs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            prefix, key = block.routed(hot)
            group = (key % np.uint64(groups)).astype(np.int64)
            kind = (group * len(block.langs) + block.lang) * (WORDS + 1) + prefix
            order = np.lexsort([*_pairs(block.columns), kind])
            kind, columns = kind[order], block.columns[:, order]
            new = np.ones(len(kind), bool)
            new[1:] = (kind[1:] != kind[:-1]) | (columns[:, 1:] != columns[:, :-1]).any(axis=0)
            first = np.flatnonzero(new)
            times = np.diff(np.append(first, len(kind))).astype("<i4")
            kind, suffixes = kind[first], columns[:, first].T
            del order, columns, new, first
            spaced = pc.binary_join_element_wise(block.words, pa.scalar(b"", pa.large_binary()), pa.scalar(b" ", pa.large_binary()))
            begins = np.flatnonzero(np.append(True, kind[1:] != kind[:-1])) if len(kind) else np.zeros(0, np.int64)
            # whole parts, but never many suffixes at once unless one part has them
            while len(begins):
                end = int(np.searchsorted(begins, begins[0] + _AT_ONCE, side="right"))
                stop = int(begins[end]) if end < len(begins) else len(kind)
                own = slice(int(begins[0]), stop)
                yield _rows(block, spaced, kind[own], suffixes[own], times[own])
                begins = begins[end:]

    return run


def _rows(block: _Block, spaced: pa.Array, kind: np.ndarray, suffixes: np.ndarray, times: np.ndarray) -> pa.RecordBatch:
    """A row for each part: its suffixes lie together, and ``kind`` tells group, language and prefix length."""
    kinds, at = np.unique(kind, return_index=True)
    ends = np.append(at, len(kind))
    part = np.repeat(np.arange(len(kinds)), np.diff(ends))
    # each part has its own numbers for the words it uses, from 1
    every = part[:, None] * (len(block.words) + 1) + suffixes
    used, which = np.unique(every[suffixes > 0], return_inverse=True)
    owner = used // (len(block.words) + 1)
    begin = np.searchsorted(owner, np.arange(len(kinds) + 1))
    small = np.zeros(suffixes.shape, np.int32)
    small[suffixes > 0] = which - begin[owner[which]] + 1
    dtype = np.dtype("<u2" if small.max() < 1 << 16 else "<u4")
    text = pa.concat_arrays([spaced.take(pa.array(used % (len(block.words) + 1) - 1))])
    _, letter_ends, letters = text.buffers()
    return pa.RecordBatch.from_arrays(
        [pa.array(kinds // (len(block.langs) * (WORDS + 1))),
         pa.array(block.langs, pa.string()).take(pa.array(kinds // (WORDS + 1) % len(block.langs))), pa.array(kinds % (WORDS + 1)),
         _binary(np.frombuffer(letter_ends, np.int64)[begin], letters),
         pa.array(np.full(len(kinds), dtype.itemsize)),
         _binary(ends * WORDS * dtype.itemsize, pa.py_buffer(small.astype(dtype))),
         _binary(ends * times.itemsize, pa.py_buffer(times))],
        names=["group", "lang", "prefix", "words", "width", "suffixes", "times"])


def _pairs(columns: np.ndarray) -> list[np.ndarray]:
    """Sort keys for suffixes, the last one first."""
    return [columns[k].astype(np.int64) << 32 | columns[k + 1] for k in (2, 0)]


def _binary(ends: np.ndarray, data: pa.Buffer) -> pa.Array:
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int64)), data]).cast(pa.binary())


def _subtrees(least: int):
    """The nodes of one group's trees that ``least`` suffixes have, and all that other groups may have too."""
    def run(table: pa.Table) -> pa.Table:
        parts: dict[tuple[str, int], list[int]] = {}
        for i, key in enumerate(zip(table.column("lang").to_pylist(), table.column("prefix").to_pylist())):
            parts.setdefault(key, []).append(i)
        found = [_nodes(table.take(rows), lang, prefix, least) for (lang, prefix), rows in sorted(parts.items())]
        return pa.concat_tables(found)

    return run


def _nodes(table: pa.Table, lang: str, prefix: int, least: int) -> pa.Table:
    split = pc.split_pattern(table.column("words").cast(pa.large_binary()).combine_chunks(), b" ")
    # a word is followed by a blank, so the last item is empty
    before = np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy().astype(np.int64) - 1)])
    every = split.flatten()
    words = every.filter(pc.greater(pc.binary_length(every), 0)).dictionary_encode()
    del split, every
    numbers = np.concatenate([np.zeros(1, np.int32), words.indices.to_numpy() + np.int32(1)])
    columns = []
    for i, (width, own) in enumerate(zip(table.column("width").to_pylist(), table.column("suffixes").to_pylist())):
        small = np.frombuffer(own, f"<u{width}").reshape(-1, WORDS)
        columns.append(numbers[np.where(small > 0, small + before[i], 0)])
    suffixes = np.concatenate(columns)
    del columns
    times = np.concatenate([np.frombuffer(t, "<i4") for t in table.column("times").to_pylist()]).astype(np.int64)
    order = np.lexsort(_pairs(suffixes.T))
    suffixes, times = suffixes[order], times[order]
    begins = np.zeros(len(suffixes), bool)
    begins[0] = True
    out = []
    for k in range(WORDS):
        begins[1:] |= suffixes[1:, k] != suffixes[:-1, k]
        first = np.flatnonzero(begins)
        totals = np.add.reduceat(times, first)
        good = (suffixes[first, k] > 0) & ((totals >= least) | (k + 1 < prefix))
        first, totals = first[good], totals[good]
        taken = [words.dictionary.take(pa.array(suffixes[first, i] - 1)).cast(pa.string()) for i in range(k + 1)]
        phrases = pc.binary_join_element_wise(*taken, " ")
        out.append(pa.table({"lang": pa.array([lang] * len(first), pa.string()), "phrase": phrases,
                             "size": pa.array(np.full(len(first), k + 1, np.int32)), "f": pa.array(totals)}))
    return pa.concat_tables(out)


def count_phrases(docs: DataFrame, least: int = LEAST, group_suffixes: int = GROUP_SUFFIXES) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, f) of the phrases of up to four words that occur ``least`` times, and (lang, n), staged.

    ``docs`` has text and lang.
    """
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text"))
    hot: list[np.ndarray] = []
    n, total = None, 0
    while len(hot) < WORDS - 1:
        counts = rows.mapInArrow(_count_prefixes(hot), "lang string, key long, n long").groupBy("lang", "key").agg(F.sum("n").alias("n"))
        counts = stage(counts, "prefixes")
        if not hot:
            n = stage(counts.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
            total = n.agg(F.sum("n")).first()[0] or 0
        bits = _bitmap(counts, group_suffixes // 4, total)
        if not bits.any():
            break
        hot.append(bits)
    groups = max(1, -(-2 * total // group_suffixes))
    parts = rows.mapInArrow(_parted(hot, groups), "group long, lang string, prefix long, words binary, width long, suffixes binary, times binary")
    nodes = parts.groupBy("group").applyInArrow(_subtrees(least), "lang string, phrase string, size int, f long")
    return stage(nodes.groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f")).where(F.col("f") >= least), "phrases"), n


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(2000000 a / (l + r)), exact for any 64-bit counts."""
    wide = [x.cast("decimal(19,0)") for x in (a, left, right)]
    return F.call_function("div", F.lit(2_000_000).cast("decimal(7,0)") * wide[0], wide[1] + wide[2])


def collocations(docs: DataFrame, least: int = LEAST, kept: int = KEPT, covered: int = COVERED) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``kept`` phrases of two to four words."""
    phrases, totals = count_phrases(docs, least)
    candidates = phrases.where("size > 1").withColumnRenamed("f", "a")
    part = F.split("phrase", " ")
    cuts = candidates.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")).select(
        "*", F.array_join(F.slice(part, F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice(part, F.col("k") + 1, F.lit(WORDS)), " ").alias("rest"))

    def counted(name: str, of: str) -> DataFrame:
        return phrases.select(F.col("lang").alias(f"_{of}_lang"), F.col("phrase").alias(f"_{of}"), F.col("f").alias(name))

    weighed = (cuts.join(counted("l", "first"), (F.col("lang") == F.col("_first_lang")) & (F.col("first") == F.col("_first")))
               .join(counted("r", "rest"), (F.col("lang") == F.col("_rest_lang")) & (F.col("rest") == F.col("_rest"))))
    weakest = weighed.groupBy("lang", "phrase", "a").agg(F.min(F.struct(
        score(F.col("a"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r")).alias("cut"))
    inside = candidates.where("size > 2").select("lang", "a", F.explode(F.array(
        F.array_join(F.slice(part, F.lit(1), F.col("size") - 1), " "), F.array_join(F.slice(part, 2, WORDS), " "))).alias("inner"))
    longer = inside.groupBy(F.col("lang").alias("_lang"), "inner").agg(F.max("a").alias("longer"))
    alone = weakest.join(longer, (F.col("lang") == F.col("_lang")) & (F.col("phrase") == F.col("inner")), "left").where(
        F.col("longer").isNull() | (F.col("longer").cast("decimal(19,0)") * 100 < F.col("a").cast("decimal(19,0)") * covered))
    best_first = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = alone.select("lang", "phrase", "a", F.col("cut")["score"].alias("score"), F.col("cut")["l"].alias("l"), F.col("cut")["r"].alias("r")).withColumn(
        "rank", F.row_number().over(best_first)).where(F.col("rank") <= kept)
    return ranked.join(totals.withColumnRenamed("lang", "_lang"), F.col("lang") == F.col("_lang")).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
