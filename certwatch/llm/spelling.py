"""Spelling variants: frequent words one edit apart, found by k-d trees over letter counts.

One inserted or deleted letter changes a word's letter counts by 1 in all, one replaced letter
by at most 2. So words are points, one number per letter, and near words are within an L1
distance of two: ``near_words`` searches each length and each length with the next one. A tree over
a bounded sample of each length's points cuts space into cells, of about ``CELL_WORDS`` words. Every word
is held by its cell and asks each cell that its range reaches. In a cell, all words that ask go down a k-d
tree together; a box that is too far from a word ends its search there. What reaches a leaf within
the distance is verified letter by letter.

Counts above ``_MOST_OF_LETTER`` are taken as that many, which only shortens distances. Words of
equal letter counts cannot be told apart by a tree: a cell holds all of them.

Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, of which only A-Z are lower-cased. A null text
has none, a null doc_id is written as an empty one. Repeated rows count each. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from certwatch.llm.batches import keep_only, ranges, slices, word_bounds
from certwatch.staging import stage

LEAST_LETTERS, LEAST_COUNT = 5, 3
CELL_WORDS = 1 << 15  # words of one length and cell, about
SAMPLE_WORDS = 1 << 17  # points from which cells are cut, about; 97 bytes each
_ERASED_ONE_IN = 97
_LEAF = 64
_MOST_OF_LETTER = 6
_LONG = 64  # bytes above which check sums are taken word by word
_PAIRS = 1 << 18  # pairs verified at once

_LOW = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_IS_LETTER = np.array([65 <= b <= 90 or 97 <= b <= 122 or b == 0xC3 for b in range(256)])
# a number for each letter: a-z, then U+00C0 to U+00FF
_NUMBER = np.zeros(256, np.uint8)
_NUMBER[97:123] = np.arange(26)
_NUMBER[0xC0:] = np.arange(26, 90)
_LETTERS = 90


def _crc_table() -> np.ndarray:
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, (out >> 1) ^ np.uint32(0xEDB88320), out >> 1).astype(np.uint32)
    return out


CRC_TABLE = _crc_table()


def _check_sums(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, before: np.ndarray) -> np.ndarray:
    """crc32 of each byte range, carried on from the sums ``before``."""
    state = ~before
    at = np.flatnonzero(sizes <= _LONG)
    for k in range(int(sizes[at].max(initial=0))):
        at = at[sizes[at] > k]
        state[at] = CRC_TABLE[(state[at] ^ data[starts[at] + k]) & 255] ^ (state[at] >> np.uint32(8))
    for i in np.flatnonzero(sizes > _LONG).tolist():
        state[i] = ~np.uint32(zlib.crc32(data[starts[i]:starts[i] + sizes[i]].tobytes(), int(before[i])))
    return ~state


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in slices(batches, "text"):
        letters = _IS_LETTER[data]
        letters[1:] |= data[:-1] == 0xC3
        starts, ends, per_text = word_bounds(letters, offsets)
        low, sizes = _LOW[data], ends - starts
        ids = ["" if i is None else str(i) for i in rows.column("doc_id").to_pylist()]
        before = np.repeat(np.array([zlib.crc32(f"{i}:".encode()) for i in ids], np.uint32), per_text)
        sums = _check_sums(low, starts, sizes, before)
        erased = sums % _ERASED_ONE_IN == 0
        whole, total = np.flatnonzero(~erased), np.cumsum(sizes[~erased])
        words = pa.LargeStringArray.from_buffers(
            len(whole), pa.py_buffer(np.concatenate([[0], total]).astype(np.int64)), pa.py_buffer(low[ranges(starts[whole], sizes[whole])]))
        shorter = []
        for i in np.flatnonzero(erased).tolist():
            word = low[starts[i]:ends[i]].tobytes().decode()
            gone = int(sums[i]) % len(word)
            shorter.append(word[:gone] + word[gone + 1:])
        found = pa.concat_arrays([words, pa.array(shorter, pa.large_string())])
        found = found.filter(pc.greater_equal(pc.utf8_length(found), LEAST_LETTERS))
        counts = found.value_counts()
        yield pa.RecordBatch.from_arrays([counts.field(0).cast(pa.string()), counts.field(1).cast(pa.int64())], names=["word", "n"])


def count_words(docs: DataFrame, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words of at least five letters that occur ``least_count`` times, staged.

    A run goes without one letter, as a misspelling, where the crc32 of ``<doc_id>:<run>`` is divisible by 97.
    """
    found = keep_only(docs, "doc_id", "text").mapInArrow(_count_words, "word string, n long")
    return stage(found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count), "words")


def _letters(words: list[str]) -> np.ndarray:
    """Words of one length as a matrix of Latin-1 bytes."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def _points(letters: np.ndarray) -> np.ndarray:
    """How often each word has each letter."""
    n = len(letters)
    places = _NUMBER[letters].astype(np.int64) + np.arange(n)[:, None] * _LETTERS
    return np.minimum(np.bincount(places.ravel(), minlength=n * _LETTERS), _MOST_OF_LETTER).astype(np.uint8).reshape(n, _LETTERS)


def _split(points: np.ndarray) -> tuple[int, int] | None:
    """(letter, count): the split nearest to the middle, None if all points are equal."""
    best, at = None, len(points)
    for letter in np.flatnonzero(points.max(axis=0) > points.min(axis=0)).tolist():
        below = np.cumsum(np.bincount(points[:, letter]))[:-1]
        uneven = np.where(below > 0, np.abs(2 * below - len(points)), len(points) + 1)
        k = int(uneven.argmin())
        if uneven[k] < at:
            best, at = (letter, k), int(uneven[k])
    return best


class Cells:
    """A tree of splits: inner nodes (letter, count, low child, high child), leaves (-1, cell, 0, 0)."""

    def __init__(self, points: np.ndarray, cells: int):
        self.nodes: list[tuple[int, int, int, int]] = [(-1, 0, 0, 0)]
        self.count = 1
        open_ = [(0, points, cells)]
        while open_:
            node, own, wanted = open_.pop()
            split = _split(own) if wanted > 1 and len(own) > 1 else None
            if split is None:
                continue
            letter, count = split
            low = own[:, letter] <= count
            self.nodes[node] = (letter, count, len(self.nodes), len(self.nodes) + 1)
            for part in (own[low], own[~low]):
                open_.append((len(self.nodes), part, round(wanted * len(part) / len(own))))
                self.nodes.append((-1, 0, 0, 0))
        leaves = [i for i, node in enumerate(self.nodes) if node[0] < 0]
        self.count = len(leaves)
        for cell, i in enumerate(leaves):
            self.nodes[i] = (-1, cell, 0, 0)

    def reached(self, points: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
        """(point, cell) for every cell within ``distance`` of a point; with 0 the one that holds it."""
        found = []
        open_ = [(0, np.arange(len(points)), np.zeros((len(points), 0), np.int64), ())]
        while open_:
            node, who, away, letters = open_.pop()
            if len(who) == 0:
                continue
            letter, count, low, high = self.nodes[node]
            if letter < 0:
                found.append((who, np.full(len(who), count)))
                continue
            own = points[who, letter].astype(np.int64)
            column = letters.index(letter) if letter in letters else len(letters)
            if column == len(letters):
                letters, away = (*letters, letter), np.concatenate([away, np.zeros((len(who), 1), np.int64)], axis=1)
            # the low side ends at count, the high side begins after it
            for child, beyond in ((low, own - count), (high, count + 1 - own)):
                further = away.copy()
                further[:, column] = np.maximum(further[:, column], beyond)
                near = further.sum(axis=1) <= distance
                open_.append((child, who[near], further[near], letters))
        return tuple(np.concatenate([f[k] for f in found]) for k in (0, 1)) if found else (np.zeros(0, np.int64),) * 2


def _cells(words: DataFrame) -> dict[int, Cells]:
    """The cells of each length that has more words than one cell should hold, from a sample of them all."""
    sizes = words.groupBy(F.length("word").alias("letters")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CELL_WORDS).collect()
    n = {r["letters"]: r["n"] for r in sizes}
    if not n:
        return {}
    one_in = max(1, sum(n.values()) // SAMPLE_WORDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for letters, own in _by_length(batch.column("word").to_pylist()):
                points = _points(_letters(own))
                yield pa.RecordBatch.from_arrays([pa.array([letters] * len(own)), pa.array([p.tobytes() for p in points])],
                                                 names=["letters", "point"])

    sample = (words.where(F.length("word").isin(list(n)) & (F.pmod(F.xxhash64("word"), F.lit(one_in)) == 0)).select("word")
              .mapInArrow(run, "letters long, point binary").toPandas())
    out = {}
    for letters, own in sample.groupby("letters"):
        points = np.frombuffer(b"".join(sorted(own["point"])), np.uint8).reshape(-1, _LETTERS)
        out[int(letters)] = Cells(points, -(-n[int(letters)] // CELL_WORDS))
    return out


def _by_length(words: list[str]) -> Iterator[tuple[int, list[str]]]:
    groups: dict[int, list[str]] = {}
    for word in words:
        groups.setdefault(len(word), []).append(word)
    yield from sorted(groups.items())


def _dealt(cells: dict[int, Cells]):
    """Each word to the cell that holds it (asks 0), to those of its length from there on and to those of the next length."""
    one = Cells(np.zeros((0, _LETTERS), np.uint8), 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_of = dict(zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()))
            for letters, words in _by_length(list(n_of)):
                points, own = _points(_letters(words)), cells.get(letters, one)
                order, home = own.reached(points, 0)
                held = np.empty(len(words), np.int64)
                held[order] = home
                who, cell = own.reached(points, 2)
                later = cell > held[who]
                next_who, next_cell = cells.get(letters + 1, one).reached(points, 1)
                every = [(np.arange(len(words)), held, letters, 0), (who[later], cell[later], letters, letters),
                         (next_who, next_cell, letters + 1, letters)]
                for at, place, length, asks in every:
                    chosen = [words[i] for i in at.tolist()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), length)), pa.array(place), pa.array(np.full(len(at), asks)), pa.array(chosen, pa.string()),
                         pa.array([n_of[w] for w in chosen], pa.int64())], names=["letters", "cell", "asks", "word", "n"])

    return run


class Tree:
    """A k-d tree over letter counts written in unary, so that a distance is a number of bits that differ."""

    def __init__(self, points: np.ndarray, most: np.ndarray):
        self.most = most
        codes = self.coded(points)
        self.order = np.arange(len(points))
        self.nodes: dict[tuple[int, int], tuple[int | None, np.ndarray, np.ndarray]] = {}  # by span: middle, bits all have, bits any has
        open_ = [(0, len(points))]
        while open_:
            first, end = open_.pop()
            own = self.order[first:end]
            low, high = np.bitwise_and.reduce(codes[own], axis=0), np.bitwise_or.reduce(codes[own], axis=0)
            split = _split(points[own]) if end - first > _LEAF else None
            if split is None:
                self.nodes[first, end] = (None, low, high)
                continue
            above = points[own, split[0]] > split[1]
            self.order[first:end] = np.concatenate([own[~above], own[above]])
            middle = first + int((~above).sum())
            self.nodes[first, end] = (middle, low, high)
            open_ += [(first, middle), (middle, end)]
        self.codes = codes[self.order]

    def coded(self, points: np.ndarray) -> np.ndarray:
        """A bit per letter and count up to the most any word here has, as 64-bit words."""
        letter = np.repeat(np.arange(len(self.most)), self.most)
        rank = np.arange(len(letter)) - np.repeat(np.cumsum(self.most) - self.most, self.most)
        bits = np.packbits(points[:, letter] > rank, axis=1)
        out = np.zeros((len(points), -(-max(1, bits.shape[1]) // 8) * 8), np.uint8)
        out[:, :bits.shape[1]] = bits
        return out.view(np.uint64)

    def within(self, points: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(asking point, held point) within the distance, in parts."""
        asked = self.coded(points)
        open_ = [((0, len(self.order)), np.arange(len(points)))]
        while open_:
            (first, end), who = open_.pop()
            middle, low, high = self.nodes[first, end]
            own = asked[who]
            away = np.bitwise_count((low & ~own) | (own & ~high)).sum(axis=1, dtype=np.int64)
            who = who[away <= distance]
            if len(who) == 0:
                continue
            if middle is not None:
                open_ += [((first, middle), who), ((middle, end), who)]
                continue
            step = max(1, _PAIRS // (end - first))
            for lo in range(0, len(who), step):
                some = who[lo:lo + step]
                apart = np.bitwise_count(asked[some][:, None, :] ^ self.codes[None, first:end, :]).sum(axis=2, dtype=np.int64)
                i, j = np.nonzero(apart <= distance)
                yield some[i], self.order[first + j]


def one_edit(shorter: np.ndarray, longer: np.ndarray) -> np.ndarray:
    """Whether each pair of rows differs by exactly one letter, replaced (equal lengths) or inserted."""
    if shorter.shape[1] == longer.shape[1]:
        return (shorter != longer).sum(axis=1) == 1
    front = np.cumprod(shorter == longer[:, :-1], axis=1).sum(axis=1)
    back = np.cumprod((shorter == longer[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return front + back >= shorter.shape[1]


def _search(table: pa.Table) -> pa.Table:
    """The near pairs of one cell, each once: held words with one another and with those that ask."""
    asks = table.column("asks").to_numpy()
    words, n = table.column("word").to_pylist(), table.column("n").to_numpy()
    held = np.flatnonzero(asks == 0)
    left, right = [], []
    if len(held):
        own = _letters([words[i] for i in held.tolist()])
        points = _points(own)
        groups = [(held, own, points, 2)]
        for length in np.unique(asks[asks > 0]).tolist():
            at = np.flatnonzero(asks == length)
            other = _letters([words[i] for i in at.tolist()])
            groups.append((at, other, _points(other), 2 if length == own.shape[1] else 1))
        most = np.max([g[2].max(axis=0) for g in groups], axis=0)
        tree = Tree(points, most)
        for at, other, own_points, distance in groups:
            for i, j in tree.within(own_points, distance):
                if at is held:
                    i, j = i[i < j], j[i < j]
                ok = one_edit(other[i], own[j])
                left.append(at[i[ok]]), right.append(held[j[ok]])
    a = np.concatenate([*left, np.zeros(0, np.int64)]).astype(np.int64)
    b = np.concatenate([*right, np.zeros(0, np.int64)]).astype(np.int64)
    column = table.column("word")
    return pa.table({"a": column.take(pa.array(a)), "a_n": pa.array(n[a]), "b": column.take(pa.array(b)), "b_n": pa.array(n[b])})


def near_words(words: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n): each pair of ``words`` (word, n), all different, that one edit sets apart, once."""
    dealt = keep_only(words, "word", "n").mapInArrow(_dealt(_cells(words)), "letters long, cell long, asks long, word string, n long")
    return dealt.groupBy("letters", "cell").applyInArrow(_search, "a string, a_n long, b string, b_n long")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of each word of ``forms`` (word, form): forms are followed in steps that double each round.

    A form occurs at least twice as often as its word, so chains are short and never closed.
    """
    now, left = forms.select("word", F.col("form").alias("root")), None
    while left != 0:
        on = now.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        now = stage(now.join(on, F.col("root") == F.col("_word"), "left").select(
            "word", F.coalesce("_root", "root").alias("root"), F.col("_root").isNotNull().alias("moved")), "roots")
        left = now.where("moved").count()
    return now.select("word", "root")


def group_variants(words: DataFrame) -> DataFrame:
    """(word, n, form, form_n, n_near, root) of each of ``words`` (word, n).

    ``form`` is the near word of largest n, of equal ones the first in code-point order, if that is at least twice
    the word's own; ``root`` is where following forms ends.
    """
    both = near_words(words).select(F.inline(F.array(F.struct("a", "b", "b_n"), F.struct(
        F.col("b").alias("a"), F.col("a").alias("b"), F.col("a_n").alias("b_n")))))
    best = F.min(F.struct((-F.col("b_n")).alias("less"), F.col("b").alias("near")))
    near = both.groupBy(F.col("a").alias("_word")).agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    has_form = -F.col("best")["less"] >= 2 * F.col("n")
    known = stage(words.select("word", "n").join(near, F.col("word") == F.col("_word"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has_form, F.col("best")["near"]).alias("form"), F.when(has_form, -F.col("best")["less"]).alias("form_n")), "forms")
    roots = _roots(known.where(F.col("form").isNotNull())).withColumnRenamed("word", "_word")
    return known.join(roots, F.col("word") == F.col("_word"), "left").select(
        "word", "n", "form", "form_n", "n_near", F.coalesce("root", "word").alias("root"))
