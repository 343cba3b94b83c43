"""Quality rules: plain limits, then an isolation forest on the rules' statistics.

Each text becomes a few counts: words, characters, symbols, repeated lines, repeated runs of
words and others. Two limits on them fail a text at once. For the rest a forest of random
splits judges: rows that few splits set apart are unlike good ones (Liu, Ting and Zhou). Path
lengths count labelled good rows, and the score from which a text goes is set on other
labelled rows: as many bad ones as can be caught while at most ``MOST_LOST`` of the good go.
All labelled rows take part: half of them in the threshold, to ``1 / CELLS`` of a score, and of the
other half each tree draws its own few, as the method has it.

Words are what lies between ASCII white space. Words, lines and runs are compared by 64-bit
hashes within their text. Null and empty texts have no words and fail. Repeated rows are judged each.
Labels with a null id or quality are left out, equal ones count once. Without good labelled
rows that pass the limits, no text goes but those that fail these. Other columns stay as they
are; a new column whose name is taken gets underscores before it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from certwatch.llm.batches import free_name, mix, slices, word_bounds, word_hashes
from certwatch.staging import drop, stage

MOST_LOST = 0.005  # of the good labelled rows
TREES, TREE_ROWS = 100, 256
CELLS = 1 << 16  # steps of the threshold
_SEED = 13
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_different")

_BYTES = np.arange(256)
_IS_WORD = ~np.isin(_BYTES, (32, 9, 10, 11, 12, 13))
_IS_SYMBOL = np.isin(_BYTES, [ord(c) for c in "#*$%&|<>"])
_STARTS = (_BYTES & 0xC0) != 0x80  # bytes that begin a code point


def count(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of ``STATISTICS`` for each text of a UTF-8 array."""
    n = len(offsets) - 1

    def total(flags: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(flags)])[offsets])

    def of_texts(owners: np.ndarray) -> np.ndarray:
        return np.bincount(owners, minlength=n)

    def keyed(hashes: np.ndarray, owners: np.ndarray) -> np.ndarray:
        return mix(hashes ^ mix(owners.astype(np.uint64) + np.uint64(1)))

    is_word = _IS_WORD[data]
    starts, ends, per_text = word_bounds(is_word, offsets)
    owner = np.repeat(np.arange(n), per_text)
    hashes = word_hashes(data, starts, ends)
    _, first = np.unique(keyed(hashes, owner), return_index=True)

    with np.errstate(over="ignore"):
        runs = mix(mix(hashes[:-2] * np.uint64(3) + hashes[1:-1]) * np.uint64(5) + hashes[2:])
    inside = np.flatnonzero(owner[:-2] == owner[2:])
    _, which, often = np.unique(keyed(runs[inside], owner[inside]), return_inverse=True, return_counts=True)
    again = inside[often[which] > 1]
    repeated = np.zeros(len(owner), bool)
    for k in range(3):
        repeated[again + k] = True

    begins, stops, per_line = word_bounds(data != 10, offsets)
    words_before = np.concatenate([[0], np.cumsum(is_word)])
    full = words_before[stops] > words_before[begins]
    line_owner = np.repeat(np.arange(n), per_line)[full]
    _, first_line = np.unique(keyed(word_hashes(data, begins[full], stops[full]), line_owner), return_index=True)
    lines = of_texts(line_owner)
    return np.stack([
        per_text, total(is_word & _STARTS[data]), total(_IS_SYMBOL[data]), lines - of_texts(line_owner[first_line]),
        of_texts(owner[repeated]), lines, of_texts(owner[first])], axis=1)


def base_failed(counts: np.ndarray) -> np.ndarray:
    """Fewer than 50 words, or more than half of them in runs of three that are repeated."""
    words, repeated = counts[:, 0], counts[:, 4]
    return (words < 50) | (100 * repeated > 50 * words)


def features(counts: np.ndarray) -> np.ndarray:
    words, chars, symbols, dup_lines, repeated, lines, different = counts.T.astype(float)
    words, lines = np.maximum(words, 1), np.maximum(lines, 1)
    # longer texts repeat more of their words, so these are taken in proportion to a power of length
    return np.stack([chars / words, np.log1p(50 * symbols / words), dup_lines / lines, repeated / words, different / words ** 0.75],
                    axis=1)


def _mean_depth(n: np.ndarray | int) -> np.ndarray:
    """The average path of an unsuccessful search in a binary tree of n rows."""
    n = np.asarray(n, float)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma) - 2 * (n - 1) / np.maximum(n, 1), n - 1).clip(0)


class IsolationForest:
    """Trees of random splits, as flat arrays: feature (-1 in a leaf), cut, left child (right is next), path length.

    Only rows of ``x`` count for path lengths. Splits are drawn from the range of ``x`` and ``others`` together, so
    that values which no row of ``x`` has can be split off too.
    """

    def __init__(self, x: np.ndarray, others: np.ndarray, trees: int = TREES, rows: int = TREE_ROWS, seed: int = _SEED):
        rng = np.random.default_rng(seed)
        self.rows = min(rows, len(x))
        self.limit = max(1, int(np.ceil(np.log2(max(2, self.rows)))))

        def some(of: np.ndarray) -> np.ndarray:
            return of[rng.choice(len(of), min(rows, len(of)), replace=False)]

        self.trees = [self._grow(some(x), some(others), rng) for _ in range(trees)]

    @classmethod
    def of_draws(cls, draws: list[tuple[np.ndarray, np.ndarray]], rows: int, seed: int = _SEED) -> IsolationForest:
        """A tree of each (rows of ``x``, rows of ``others``) that were drawn for it, ``rows`` of ``x`` each."""
        forest = cls.__new__(cls)
        forest.rows, forest.limit = rows, max(1, int(np.ceil(np.log2(max(2, rows)))))
        rng = np.random.default_rng(seed)
        forest.trees = [forest._grow(own, near, rng) for own, near in draws]
        return forest

    def _grow(self, x: np.ndarray, others: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, ...]:
        feature, cut, left, path = [-1], [0.0], [0], [0.0]
        open_ = [(0, x, others, 0)]
        while open_:
            node, own, near, depth = open_.pop()
            path[node] = depth + float(_mean_depth(len(own)))
            if depth == self.limit or len(own) == 0:
                continue
            both = np.concatenate([own, near])
            low, high = both.min(axis=0), both.max(axis=0)
            uneven = np.flatnonzero(high > low)
            if len(uneven) == 0:
                continue
            k = int(rng.choice(uneven))
            feature[node], cut[node], left[node] = k, float(rng.uniform(low[k], high[k])), len(feature)
            for above in (False, True):
                open_.append((len(feature), own[(own[:, k] > cut[node]) == above], near[(near[:, k] > cut[node]) == above], depth + 1))
                feature.append(-1), cut.append(0.0), left.append(0), path.append(0.0)
        return np.array(feature), np.array(cut), np.array(left), np.array(path)

    def score(self, x: np.ndarray) -> np.ndarray:
        """From 0 to 1, higher the sooner random splits set a row apart."""
        total = np.zeros(len(x))
        every = np.arange(len(x))
        for feature, cut, left, path in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.limit):
                inner = feature[node] >= 0
                node = np.where(inner, left[node] + (x[every, feature[node]] > cut[node]), node)
            total += path[node]
        return 2.0 ** (-total / len(self.trees) / max(float(_mean_depth(self.rows)), 1e-9))


def best_threshold(good: np.ndarray, bad: np.ndarray, most_lost: float = MOST_LOST,
                   n_good: np.ndarray | None = None, n_bad: np.ndarray | None = None) -> float:
    """The score above which most bad rows and at most ``most_lost`` of the good ones are; of equal ones the highest.

    ``n_good`` and ``n_bad`` are the rows of each score, if not one.
    """
    cuts = np.unique(np.concatenate([good, bad, [1.0]]))[::-1]

    def above(scores: np.ndarray, n: np.ndarray | None) -> np.ndarray:
        order = np.argsort(scores)
        up_to = np.concatenate([[0], np.cumsum(np.ones(len(scores), np.int64) if n is None else n[order])])
        return (up_to[-1] - up_to[np.searchsorted(scores[order], cuts, side="right")]) / max(1, up_to[-1])

    lost, caught = above(good, n_good), above(bad, n_bad)
    return float(cuts[np.argmax(np.where(lost <= most_lost, caught - lost, -1.0))])


class Model:
    def __init__(self, forest: IsolationForest | None, threshold: float):
        self.forest, self.threshold = forest, threshold

    def score(self, counts: np.ndarray) -> np.ndarray:
        return self.forest.score(features(counts)) if self.forest else np.zeros(len(counts))


def _count_rows(text: str, others: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches, text):
            yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in others), *map(pa.array, count(data, offsets).T)],
                                             names=[*others, *STATISTICS])

    return run


def _counts(rows: pa.RecordBatch) -> np.ndarray:
    return np.stack([rows.column(c).to_numpy() for c in STATISTICS], axis=1)


def _drawn(share: float, share_good: float):
    """(tree, others, draw, statistics): the rows each tree may draw, of the good ones and of all, by a hash of tree and row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            key, good = rows.column("row").to_numpy().view(np.uint64), rows.column("quality").to_numpy() == 1
            for tree in range(TREES):
                for others, of, part in ((0, good, share_good), (1, np.ones(len(good), bool), share)):
                    draw = mix(key ^ mix(np.array([2 * tree + others + 1], np.uint64))) >> np.uint64(1)
                    at = pa.array(np.flatnonzero(of & (draw <= part * 2.0 ** 63)))
                    if len(at):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(at), tree, np.int32)), pa.array(np.full(len(at), others, np.int32)),
                             pa.array(draw.view(np.int64)).take(at), *(rows.column(c).take(at) for c in STATISTICS)],
                            names=["tree", "others", "draw", *STATISTICS])

    return run


def _cells(forest: IsolationForest):
    """(cell, quality): the least step of the threshold that keeps each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            cell = np.ceil(forest.score(features(_counts(rows))) * CELLS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(cell), rows.column("quality")], names=["cell", "quality"])

    return run


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = TREE_ROWS, text: str = "text") -> Model:
    """Learn from all labelled rows; each tree draws ``sample_rows`` of the good ones and of all.

    Only statistics are joined with labels, and only the draws and a count per step of the threshold reach the driver.
    """
    labelled = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("quality")).distinct()
    kinds = ", ".join(f"{c} long" for c in STATISTICS)
    texts = docs.select("doc_id", F.col(f"`{text}`").alias("text")).where(F.col("doc_id").isNotNull())
    counted = texts.mapInArrow(_count_rows("text", ("doc_id",)), f"doc_id {dict(texts.dtypes)['doc_id']}, {kinds}")
    passed = (F.col("n_words") >= 50) & (100 * F.col("n_repeat_words") <= 50 * F.col("n_words"))
    known = stage(counted.where(passed).join(labelled, F.col("doc_id") == F.col("_id"))
                  .select(F.xxhash64("_id").alias("hash"), "quality", *STATISTICS).distinct(), "statistics")
    first_half = F.pmod("hash", F.lit(2)) == 0
    grown = known.where(first_half).select(F.xxhash64(*known.columns).alias("row"), "quality", *STATISTICS)
    sizes = grown.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("quality") == 1).alias("n_good")).first()
    if not sizes["n_good"]:
        drop(known)
        return Model(None, 1.0)
    # eight deviations more than a tree takes, so that it has them all but surely
    most = sample_rows + 8 * sample_rows ** 0.5 + 16
    draws = grown.mapInArrow(_drawn(min(1.0, most / sizes["n"]), min(1.0, most / sizes["n_good"])),
                             f"tree int, others int, draw long, {kinds}").toPandas().sort_values(["tree", "others", "draw", *STATISTICS])
    sets: dict[tuple[int, int], np.ndarray] = {
        key: features(rows[list(STATISTICS)].to_numpy(np.int64)[:sample_rows]) for key, rows in draws.groupby(["tree", "others"])}
    none = np.zeros((0, features(np.zeros((1, len(STATISTICS)), np.int64)).shape[1]))
    forest = IsolationForest.of_draws([(sets.get((t, 0), none), sets.get((t, 1), none)) for t in range(TREES)],
                                      min(sample_rows, sizes["n_good"]))
    cells = (known.where(~first_half).mapInArrow(_cells(forest), "cell long, quality int").groupBy("cell")
             .agg(F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("quality") == 0).alias("bad")).toPandas())
    drop(known)
    score, n_good, n_bad = cells["cell"].to_numpy(np.int64) / CELLS, cells["good"].to_numpy(np.int64), cells["bad"].to_numpy(np.int64)
    return Model(forest, best_threshold(score, score, n_good=n_good, n_bad=n_bad))


def _judge(model: Model, text: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches, text):
            counts = count(data, offsets)
            failed, score = base_failed(counts), model.score(counts)
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, *map(pa.array, counts.T), pa.array(failed), pa.array(~failed & (score <= model.threshold)),
                 pa.array(score)], names=names)

    return run


def judge(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with the statistics of each whole text, base_failed, kept and anomaly (the forest's score)."""
    new = {}
    for name, kind in {**dict.fromkeys(STATISTICS, "long"), "base_failed": "boolean", "kept": "boolean", "anomaly": "double"}.items():
        new[free_name(docs, name)] = kind
    fields = ", ".join(f"`{c}` {t}" for c, t in [*docs.dtypes, *new.items()])
    return docs.mapInArrow(_judge(model, text, [*docs.columns, *new]), fields)
