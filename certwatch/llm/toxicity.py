"""Toxicity scores: gradient-boosted trees over dense features, isotonic calibration.

Texts become a few numbers: densities of lexicon terms, such terms near a
second-person word, capitals, punctuation, obfuscated words. The lexicon (whole
words and their first 4 to 6 bytes) is learned from one half of a bounded sample of
the labelled rows, trees and calibration from the other half, so that the trees see the
lexicon as strangers do. Rows that are held out never reach the sample.

Null text is empty text; an empty text gets a score too. A null doc_id is not
held out. Labels that are null are left out; repeated labels count each. Without
labels of both kinds every score is the share of toxic labels, 0 if there are none. Where the name of the
score's column is taken, it gets underscores before it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from certwatch.llm.batches import free_name, mix, slices, word_bounds, word_hashes
from certwatch.staging import stage

SAMPLE_ROWS = 40_000  # of the labelled rows, at most
_PREFIXES = (4, 5, 6)
_LEAST_DOCS = 6
_LEAST_WEIGHT = 1.5
_NEAR = 5
# fixed values: second-person words of the four languages
_SECOND_PERSON = ("you", "your", "yours", "u", "du", "dich", "dir", "dein", "ihr", "tu", "te", "toi", "vous", "votre",
                  "usted", "ti", "tus")
_LOW = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_KIND = np.array([1 if 97 <= b <= 122 or b >= 128 else 2 if 48 <= b <= 57 else 3 if 65 <= b <= 90
                  else 0 if b in (9, 10, 11, 12, 13, 32) else 4 for b in range(256)], np.uint8)
FEATURES = ("words", "hits", "hit_share", "weight", "weight_share", "strongest", "strong_share", "near_second_person",
            "capitals", "capital_words", "punctuation", "exclamations", "obfuscated", "word_length")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


class _Text:
    """Words of a batch of texts, the text of each, and hashes of words and prefixes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.low, self.kind = _LOW[data], _KIND[data]
        letters = (self.kind != 0) & (self.kind != 4)
        self.starts, self.ends, self.per_text = word_bounds(letters, offsets)
        self.doc = np.repeat(np.arange(len(self.per_text)), self.per_text)

    def terms(self) -> list[np.ndarray]:
        """One array of term hashes per kind of term; a word too short for a prefix has 0."""
        out = [word_hashes(self.low, self.starts, self.ends)]
        for size in _PREFIXES:
            hashes = mix(word_hashes(self.low, self.starts, np.minimum(self.starts + size, self.ends)) + np.uint64(size))
            out.append(np.where(self.ends - self.starts > size, hashes, np.uint64(0)))
        return out


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, toxic, clean): documents of this batch that hold a term, each term once per document."""
    for rows, data, offsets in slices(batches, "text"):
        text, toxic = _Text(data, offsets), rows.column("toxic").to_numpy(zero_copy_only=False)
        for terms in text.terms():
            once = np.unique(np.stack([terms, text.doc.astype(np.uint64)]), axis=1) if len(terms) else np.zeros((2, 0), np.uint64)
            once = once[:, once[0] > 0]
            term, which = np.unique(once[0], return_inverse=True)
            bad = toxic[once[1].astype(np.int64)] == 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(term.view(np.int64)), pa.array(np.bincount(which[bad], minlength=len(term))),
                 pa.array(np.bincount(which[~bad], minlength=len(term)))], names=["term", "toxic", "clean"])


class Lexicon:
    def __init__(self, terms: np.ndarray, weights: np.ndarray):
        order = np.argsort(terms)
        self.terms, self.weights = terms[order], weights[order]
        raw = [w.encode() for w in _SECOND_PERSON]
        data = np.frombuffer(b"".join(raw), np.uint8)
        ends = np.cumsum([len(w) for w in raw])
        self.second = np.sort(word_hashes(data, ends - [len(w) for w in raw], ends))

    def weight(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.terms):
            return np.zeros(len(hashes))
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        return np.where(self.terms[at] == hashes, self.weights[at], 0.0)

    def features(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """One row of FEATURES per text."""
        text, n = _Text(data, offsets), len(offsets) - 1
        terms, sizes = text.terms(), np.diff(offsets)
        weight = np.max([self.weight(t) for t in terms], axis=0) if len(text.doc) else np.zeros(0)
        second = np.isin(terms[0], self.second)
        total = np.concatenate([[0], np.cumsum(second)])
        last = np.cumsum(text.per_text)
        first = np.repeat(last - text.per_text, text.per_text)
        place = np.arange(len(text.doc))
        near = total[np.minimum(place + _NEAR + 1, np.repeat(last, text.per_text))] - total[np.maximum(place - _NEAR, first)]

        def per_text(values: np.ndarray) -> np.ndarray:
            return np.bincount(text.doc, weights=values, minlength=n)

        def per_byte(flags: np.ndarray) -> np.ndarray:
            return np.diff(np.concatenate([[0], np.cumsum(flags)])[offsets])

        hit = weight > 0
        words, chars = np.maximum(text.per_text, 1), np.maximum(sizes, 1)
        strongest = np.zeros(n)
        np.maximum.at(strongest, text.doc[hit], weight[hit])
        capital = text.kind == 3
        capital_at = np.concatenate([[0], np.cumsum(capital)])
        lengths = text.ends - text.starts
        shout = (capital_at[text.ends] - capital_at[text.starts] == lengths) & (lengths > 2)
        inner = np.zeros(len(text.kind), bool)  # a sign or digit between two letters
        if len(inner) > 2:
            letter = (text.kind == 1) | (text.kind == 3)
            inner[1:-1] = letter[:-2] & letter[2:] & ((text.kind[1:-1] == 4) | (text.kind[1:-1] == 2))
        return np.stack([
            np.log1p(text.per_text), per_text(hit), per_text(hit) / words, per_text(weight), per_text(weight) / words,
            strongest, per_text(weight > 3) / words, per_text(hit & (near > 0)), per_byte(capital) / chars,
            per_text(shout) / words, per_byte(text.kind == 4) / chars, per_byte(data == 33) / chars,
            per_byte(inner) / words, per_text(lengths) / words], axis=1)


class BoostedTrees:
    """Logistic boosting with trees of fixed depth on quantile bins."""

    def __init__(self, rounds: int = 60, depth: int = 3, rate: float = 0.15, bins: int = 48):
        self.rounds, self.depth, self.rate, self.bins = rounds, depth, rate, bins
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.base = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T)], axis=1)
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base = float(np.log(share / (1 - share)))
        score = np.full(len(y), self.base)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            tree, leaf = self._tree(binned, cuts, y - p, np.maximum(p * (1 - p), 1e-6))
            self.trees.append(tree)
            score += tree[2][leaf]
        return self

    def _tree(self, binned, cuts, gradient, curvature):
        nodes = (1 << self.depth) - 1
        feature, cut = np.zeros(nodes, np.int64), np.full(nodes, np.inf)
        node = np.zeros(len(gradient), np.int64)
        width = self.bins + 1
        for level in range(self.depth):
            first, count = (1 << level) - 1, 1 << level
            best = np.zeros(count)
            where = np.zeros(count, np.int64)
            for f in range(binned.shape[1]):
                cell = (node - first) * width + binned[:, f]
                g = np.bincount(cell, gradient, count * width).reshape(count, width).cumsum(axis=1)
                h = np.bincount(cell, curvature, count * width).reshape(count, width).cumsum(axis=1)
                left, right = g[:, :-1], g[:, -1:] - g[:, :-1]
                hl, hr = h[:, :-1], h[:, -1:] - h[:, :-1]
                gain = left ** 2 / (hl + 1) + right ** 2 / (hr + 1) - g[:, -1:] ** 2 / (h[:, -1:] + 1)
                gain[(hl < 1) | (hr < 1)] = 0
                gain = gain[:, :len(cuts[f])]
                if gain.shape[1] == 0:
                    continue
                at = gain.argmax(axis=1)
                better = gain[np.arange(count), at] > best + 1e-9
                best[better], where[better] = gain[np.arange(count), at][better], at[better]
                feature[first:first + count][better] = f
                cut[first:first + count][better] = cuts[f][at[better]]
            bins_left = np.where(best > 0, where, width)
            own = node - first
            node = 2 * node + 1 + (binned[np.arange(len(node)), feature[node]] > bins_left[own])
        leaf = node - nodes
        g = np.bincount(leaf, gradient, 1 << self.depth)
        h = np.bincount(leaf, curvature, 1 << self.depth)
        return (feature, cut, self.rate * g / (h + 1)), leaf

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > cut[node])
            out += value[node - len(feature)]
        return out


class Isotonic:
    """The non-decreasing function nearest to the labels, pooled from adjacent violators; linear between the margins seen."""

    def __init__(self, margin: np.ndarray, y: np.ndarray):
        order = np.argsort(margin, kind="stable")
        self.at, first, count = np.unique(margin[order], return_index=True, return_counts=True)
        blocks: list[list[float]] = []
        for total, n in zip(np.add.reduceat(y[order].astype(float), first), count.tolist()):
            blocks.append([total, n, 1])
            while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
                last = blocks.pop()
                blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
        # one clean and one toxic row more per block keep scores off 0 and 1
        self.value = np.concatenate([np.full(k, (t + 0.02) / (n + 0.2)) for t, n, k in blocks])

    def __call__(self, margin: np.ndarray) -> np.ndarray:
        # a small share of the margin itself keeps the order within one step
        return np.clip(0.98 * np.interp(margin, self.at, self.value) + 0.02 / (1 + np.exp(-margin)), 0, 1)


class Model:
    def __init__(self, lexicon: Lexicon, trees: BoostedTrees | None, calibrate: Isotonic | None, share: float):
        self.lexicon, self.trees, self.calibrate, self.share = lexicon, trees, calibrate, share

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if self.trees is None:
            return np.full(len(offsets) - 1, self.share)
        return self.calibrate(self.trees.margin(self.lexicon.features(data, offsets)))


def _features(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches, "text"):
            x = lexicon.features(data, offsets)
            yield pa.RecordBatch.from_arrays(
                [rows.column("part"), rows.column("toxic"), pa.array(list(x), pa.list_(pa.float64()))],
                names=["part", "toxic", "x"])

    return run


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn from at most ``sample_rows`` labelled rows that are not held out.

    The sample is the rows with the least hash of doc_id, and so small that it is broadcast. Where ids
    repeat, each label counts once for each different text of its id, and of these
    the least hashes of id and text are taken.
    """
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    same = Window.partitionBy("_id", "toxic").orderBy("_id")
    sample = known.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("toxic")).orderBy(
        F.xxhash64("_id"), "toxic").limit(sample_rows).withColumn("_nth", F.row_number().over(same))
    keys = ["_id", "toxic", "_nth", "_text"]
    met = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("_id")).withColumn(
        "_text", F.xxhash64(F.coalesce("text", F.lit(""))))
    chosen = stage(met.select(*keys).distinct().orderBy(F.xxhash64("_id", "_text"), *keys).limit(sample_rows), "sample")
    rows = met.join(F.broadcast(chosen), keys, "left_semi").dropDuplicates(keys).select(
        "text", "toxic", F.pmod("_text", F.lit(8)).cast("int").alias("part"))
    # copies fall into one part and count once for the lexicon
    counts = (rows.where(F.col("part") < 4).dropDuplicates(["text"]).select("text", "toxic")
              .mapInArrow(_count_terms, "term long, toxic long, clean long")
              .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))
    total = rows.where(F.col("part") < 4).dropDuplicates(["text"]).groupBy("toxic").count().collect()
    n = {r["toxic"]: r["count"] for r in total}
    ratio = F.log((F.col("toxic") + 0.5) / (n.get(1, 0) + 1)) - F.log((F.col("clean") + 0.5) / (n.get(0, 0) + 1))
    found = counts.where(F.col("toxic") >= _LEAST_DOCS).withColumn("weight", ratio).where(
        F.col("weight") >= _LEAST_WEIGHT).select("term", "weight").toPandas()
    lexicon = Lexicon(found["term"].to_numpy(np.int64).view(np.uint64), found["weight"].to_numpy(float))
    table = rows.where(F.col("part") >= 4).select("part", "toxic", "text").mapInArrow(
        _features(lexicon), "part int, toxic int, x array<double>").toPandas()
    y, part = table["toxic"].to_numpy(float), table["part"].to_numpy()
    share = (n.get(1, 0) + float(y.sum())) / max(1, sum(n.values()) + len(y))
    fitting, held = part < 7, part == 7
    if not 0 < y[fitting].sum() < fitting.sum():
        return Model(lexicon, None, None, share)
    x = np.stack(table["x"].to_numpy())
    order = np.lexsort([*x.T, y, part])  # sums of floats depend on it
    x, y, fitting, held = x[order], y[order], fitting[order], held[order]
    trees = BoostedTrees().fit(x[fitting], y[fitting])
    if not 0 < y[held].sum() < held.sum():
        held = fitting
    return Model(lexicon, trees, Isotonic(trees.margin(x[held]), y[held]), share)


def _score(model: Model, text: str, out: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches, text):
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(model.score(data, offsets), pa.float64())],
                                             names=[*rows.schema.names, out])

    return run


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with a toxicity score from 0 to 1 of each whole text."""
    out = free_name(docs, out)
    fields = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes)
    return docs.mapInArrow(_score(model, text, out), f"{fields}, `{out}` double")
