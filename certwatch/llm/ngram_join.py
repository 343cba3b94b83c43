"""Near-duplicate classes by the Jaccard similarity of word shingles, exact.

Two documents link when ``100 * |A and B| >= percent * |A or B|`` for their sets of
distinct shingles. The result is each document's component over these links.

* Documents with equal sets are one class; only classes are compared.
* Linked sets differ in few shingles, at most d for their sizes. A set is dealt by
  hash into k > d parts, so two linked sets have at least k - d parts in common.
  The hash of each part is the set's signature; sets meet where signatures are
  equal. A passage that many documents share fills no part on its own.
* A set that has fewer signatures in common with others than a link takes is left out. Each set is first
  compared with one other, the likeliest centre of a family of copies. What that joins are clusters, and
  from then on only signatures that sets of different clusters have count.
* The larger of two linked sets asks; of its signatures, all but as many as a link has to spare, the most common
  ones, are near. Each link has a near signature in common, so the components of sets
  with near signatures in common hold all links, and are what has to be searched.
* Components are cut into blocks of about a million shingles, like sets together. A set asks each block
  in which it has enough signatures in common with sets of other clusters: at most one row per set and block,
  whatever the number of pairs, and none among copies of one text, however many. The sets of a block form inverted lists and are searched by T-occurrence: the
  short lists of a query's shingles are merged, counting; sets that could still reach the needed
  overlap T are probed in the long lists by binary search (DivideSkip).
* A block reports the links that join what it had not joined yet, so no pairs are listed.

Words are what lies between ASCII white space, A-Z in lower case. A document of fewer
words than a shingle has the whole sequence as its one shingle; one without words, or
with null text, has none and links with nothing. Shingles and sets are compared by 64-bit
hashes. Null ids take part but name no component unless no member has an id; equal rows are
one class. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from certwatch.llm.batches import mix, ranges, slices, word_bounds, word_hashes
from certwatch.staging import drop, stage

_SPACES = (32, 9, 10, 11, 12, 13)
_LOW = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_IS_WORD = ~np.isin(np.arange(256), _SPACES)
_LEVELS = np.unique(np.round(4 * 2 ** (np.arange(80) / 2)).astype(np.int64))
# parts beyond the least number, so that empty parts need no signature, which all sets with that part empty would have
_SPARES = 1 + 3 * _LEVELS // 10
_SEARCHED = 1 << 20  # shingles in one local index, about
_ASKED = 16  # times as many shingles may ask it in one task
_SMALL_ROWS = 1 << 20  # rows of a few numbers that may be broadcast; more are shuffled
_HELD, _ASKS = 1, 2


def _sets(data: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    starts, ends, per_text = word_bounds(_IS_WORD[data], offsets)
    words = word_hashes(_LOW[data], starts, ends)
    rolled = np.zeros(len(words), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            rolled[:max(0, len(words) - k)] += mix(words[k:] + np.uint64(k + 1))
    rolled = mix(rolled)
    last = np.cumsum(per_text)
    out = []
    for first, end in zip((last - per_text).tolist(), last.tolist()):
        if end - first >= width:
            out.append(np.unique(rolled[first:end - width + 1]))
        elif end > first:
            tagged = mix(words[first:end] + np.arange(1, end - first + 1).astype(np.uint64))
            out.append(mix(np.array([tagged.sum() + np.uint64(end - first)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _class_of(members: np.ndarray) -> int:
    return int(mix(np.array([mix(members).sum() + np.uint64(len(members))], np.uint64)).view(np.int64)[0])


def _levels(size: int, percent: int) -> np.ndarray:
    """Which numbers of parts a set is dealt into: for any partner, the larger one's number is among them.

    The number of the larger one is the least that leaves a part alike, besides spare ones, wherever they differ.
    """
    low, high = np.searchsorted(_LEVELS - 1 - _SPARES, [2 * (100 - percent) * n // (100 + percent) for n in (size, 100 * size // percent)])
    return np.arange(low, high + 1)


def _signatures(members: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signature, number of parts, empty parts without a signature) of a set.

    The number of parts is negative where it is not the one for the set's own size.
    """
    size = len(members)
    if (100 - percent) * (size + 100 * size // percent) < 100 + percent:
        return (np.zeros(0, np.int64),) * 3  # a different set is never near enough
    found, parts, hidden = [], [], []
    mixed = mix(members + np.uint64(1))
    for level in _levels(size, percent):
        k, spare = _LEVELS[level], _SPARES[level]
        part = ((members >> np.uint64(32)) * np.uint64(k)) >> np.uint64(32)
        first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        sums = np.add.reduceat(mixed, first)
        place = part[first]
        empty = int(k) - len(first)
        if empty > spare:
            hollow = np.setdiff1d(np.arange(k, dtype=np.uint64), place)
            sums, place = np.concatenate([sums, np.zeros(empty, np.uint64)]), np.concatenate([place, hollow])
        found.append(mix(sums + mix(place + np.uint64(k) * np.uint64(1 << 20))).view(np.int64))
        parts.append(np.full(len(sums), -k if found[1:] else k))
        hidden.append(np.full(len(sums), min(empty, spare)))
    return np.concatenate(found), np.concatenate(parts), np.concatenate(hidden)


def _classes(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches, "text"):
            sets = _sets(data, offsets, width)
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), rows.column("key"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([_class_of(s) if len(s) else None for s in sets], pa.int64())],
                names=["doc_id", "key", "n_shingles", "class"])

    return run


def _signature_rows(width: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # copies within this task are sent once
        for _, data, offsets in slices(batches, "text"):
            signatures, classes, sizes, parts, hidden = [], [], [], [], []
            for members in _sets(data, offsets, width):
                name = _class_of(members)
                if len(members) and name not in seen:
                    seen.add(name)
                    own, dealt, empty = _signatures(members, percent)
                    signatures.append(own)
                    parts.append(dealt)
                    hidden.append(empty)
                    classes.append(np.full(len(own), name))
                    sizes.append(np.full(len(own), len(members)))
            if signatures:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(signatures)), pa.array(np.concatenate(classes)),
                     pa.array(np.concatenate(sizes).astype(np.int32)), pa.array(np.concatenate(parts).astype(np.int32)),
                     pa.array(np.concatenate(hidden).astype(np.int32))],
                    names=["signature", "class", "size", "parts", "hidden"])

    return run


def _set_rows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, offsets in slices(batches, "text"):
            sets = [s for s in _sets(data, offsets, width) if len(s)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([_class_of(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                names=["class", "members"])

    return run


class Lists:
    """The inverted lists of some sets: for each shingle, in order, the sets that hold it."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets])
        values = np.concatenate(sets)
        order = np.argsort(values, kind="stable")
        self.owners = np.repeat(np.arange(len(sets)), self.sizes)[order]
        self.shingles, self.firsts = np.unique(values[order], return_index=True)
        self.lengths = np.diff(np.append(self.firsts, len(values)))

    def search(self, query: np.ndarray, percent: int) -> np.ndarray:
        """Which sets link with ``query``."""
        at = np.minimum(np.searchsorted(self.shingles, query), len(self.shingles) - 1)
        lists = at[self.shingles[at] == query]
        needed = -(-percent * (len(query) + self.sizes) // (100 + percent))
        # a set shares no more than it or the query holds
        least = int(needed[needed <= np.minimum(self.sizes, len(query))].min(initial=len(query) + 1))
        if len(lists) < least:
            return np.zeros(0, np.int64)
        lists = lists[np.argsort(self.lengths[lists], kind="stable")]
        # DivideSkip: the more often T is asked for and the shorter the lists, the fewer are merged
        n_long = min(least - 1, int(least / (0.01 * np.log2(2 + int(self.lengths[lists[-1]])) + 1)))
        short, long_ = lists[:len(lists) - n_long], lists[len(lists) - n_long:]
        counts = np.bincount(self.owners[ranges(self.firsts[short], self.lengths[short])], minlength=len(self.sizes))
        alive = np.flatnonzero((counts >= needed - n_long) & (counts > 0))
        for one in long_.tolist() if len(alive) else ():
            own = self.owners[self.firsts[one]:self.firsts[one] + self.lengths[one]]
            place = np.minimum(np.searchsorted(own, alive), len(own) - 1)
            counts[alive] += own[place] == alive
        return alive[counts[alive] >= needed[alive]]


class _Forest:
    """Which names are joined so far."""

    def __init__(self):
        self.above: dict[int, int] = {}

    def root(self, name: int) -> int:
        while (up := self.above.get(name, name)) != name:
            self.above[name] = self.above.get(up, up)
            name = up
        return name

    def join(self, a: int, b: int) -> bool:
        """False if they were joined already."""
        a, b = self.root(a), self.root(b)
        self.above[a] = b
        return a != b


def _search(percent: int):
    """The links found in each block, but for those that close a circle there."""
    def batch_of(found: list[tuple[int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, names, sets, asking, lists, forest = None, [], [], [], None, _Forest()

        def ask(name: int, members: np.ndarray) -> list[tuple[int, int]]:
            return [(names[i], name) for i in lists.search(members, percent).tolist() if forest.join(names[i], name)]

        def ask_held() -> list[tuple[int, int]]:
            nonlocal lists
            if sets and lists is None:
                lists = Lists(sets)
            out = [link for i in asking for link in ask(names[i], sets[i])]
            asking.clear()
            return out

        for batch in batches:
            found: list[tuple[int, int]] = []
            rows = zip(*(batch.column(c).to_pylist() for c in ("block", "share", "role", "class", "members")))
            for block, share, role, name, members in rows:
                if (block, share) != current:
                    found += ask_held()
                    current, names, sets, asking, lists, forest = (block, share), [], [], [], None, _Forest()
                members = np.frombuffer(members, np.uint64)
                if role & _HELD:  # those come first
                    if role & _ASKS:
                        asking.append(len(names))
                    names.append(name)
                    sets.append(members)
                else:
                    found += ask_held()
                    found += ask(name, members) if sets else []
            if found:
                yield batch_of(found)
        if found := ask_held():
            yield batch_of(found)

    return run


def _where_small(df: DataFrame) -> DataFrame:
    """``df``, a staged table of a few numbers per row, broadcast if it has at most 2^20 rows."""
    return F.broadcast(df) if df.count() <= _SMALL_ROWS else df


def _sets_of(wanted: DataFrame, rows: DataFrame, chosen: DataFrame, width: int) -> DataFrame:
    """(class, members) of the ``wanted`` classes, some of them more than once, and of a few others.

    A bitmap of the wanted rows' keys, of at most 16 MB, passes over the texts, so that
    those need no shuffle; where it fills up, more sets come along.
    """
    keys = chosen.join(wanted.distinct(), F.col("class") == F.col("_wanted"), "left_semi").select("key")
    n = keys.count()
    words = 1 << max(14, min(20, (n // 4).bit_length()))

    def word(key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(words))

    bit = F.shiftright(F.xxhash64("key"), 40).bitwiseAND(63).cast("int")
    one = F.expr("shiftleft(1L, cast(shiftright(xxhash64(key), 40) & 63 as int))")
    bitmap = keys.groupBy(word(F.col("key")).alias("_word")).agg(F.bit_or(one).alias("_bits"))
    kept = rows.join(F.broadcast(bitmap), word(F.col("key")) == F.col("_word")).where(F.getbit("_bits", bit) == 1)
    return kept.select("text").mapInArrow(_set_rows(width), "class long, members binary")


def _links(asks: DataFrame, placed: DataFrame, rows: DataFrame, chosen: DataFrame, width: int, percent: int,
           share: int) -> DataFrame:
    """The links of each of ``asks`` (class, size, block) with the sets that ``placed`` (class, block) has there, staged.

    Where many ask one block, they are dealt into shares of about ``share`` shingles, each of which has the block's
    lists. A set that both is in a share and asks it is sent there once.
    """
    shares = asks.groupBy("block").agg(F.ceil(F.sum("size") / share).cast("int").alias("shares")).select(
        F.col("block").alias("_block"), "shares")
    held = placed.join(shares, F.col("block") == F.col("_block")).select(
        "block", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), F.lit(_HELD).alias("role"), "class")
    asked = asks.join(shares, F.col("block") == F.col("_block")).select(
        "block", F.pmod(F.xxhash64("class"), F.col("shares")).cast("int").alias("share"), F.lit(_ASKS).alias("role"), "class")
    both = stage(held.unionByName(asked).groupBy("block", "share", "class").agg(F.bit_or("role").alias("role")), "asked")
    known = _sets_of(both.select(F.col("class").alias("_wanted")), rows, chosen, width).withColumnRenamed("class", "_class")
    met = known.join(_where_small(both), F.col("class") == F.col("_class")).drop("_class")
    links = stage(met.repartition("block", "share").sortWithinPartitions("block", "share", F.col("role") == _ASKS, "class")
                  .mapInArrow(_search(percent), "a long, b long"), "links")
    drop(both)
    return links


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node each node of ``edges`` (a, b) reaches, by large and small stars."""
    def stars(pairs: DataFrame, large: bool) -> DataFrame:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else pairs.select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("_a"), F.least("a", "m").alias("m"))
        joined = both.join(least, F.col("a") == F.col("_a"))
        if large:
            return joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        up = joined.select("b", "m").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return up.unionByName(joined.select("a", F.col("m").alias("b")).where("a <> b")).distinct()

    now = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "stars")
    while True:
        # done when every node has one centre, and no centre has another
        centres = now.select(F.col("b").alias("_b")).distinct()
        open_ = now.groupBy("a").agg(F.count(F.lit(1)).alias("n")).join(centres, F.col("a") == F.col("_b"), "left").where("n > 1 or _b is not null")
        if open_.isEmpty():
            break
        next_ = stage(stars(stars(now, True), False), "stars")
        drop(now)
        now = next_
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row of ``docs`` (doc_id, text)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn(
        "key", F.coalesce("doc_id", F.xxhash64("text")))
    classes = stage(rows.mapInArrow(_classes(width), "doc_id long, key long, n_shingles long, class long"), "classes")

    met = rows.select("text").mapInArrow(
        _signature_rows(width, percent), "signature long, class long, size int, parts int, hidden int")
    at = Window.partitionBy("signature")
    shared = stage(met.withColumns({"low": F.min("class").over(at), "high": F.max("class").over(at)})
                   .where("low < high").drop("low", "high").distinct(), "shared")
    enough = stage(_enough(shared, percent), "enough")
    drop(shared)
    common = stage(_with_widths(enough), "common")
    drop(enough)
    chosen = classes.where(F.col("class").isNotNull()).groupBy("class").agg(F.min("key").alias("key"))
    leaders = stage(_leaders(common), "leaders")
    led = _links(leaders, leaders.select(F.col("block").alias("class"), "block").distinct(), rows, chosen, width, percent, _SEARCHED)
    clusters = stage(components(led), "clusters")
    kept = stage(_with_widths(_enough(_between(common, clusters), percent)), "kept")
    drop(common, leaders)
    asking = stage(_asking(kept, percent), "asking")
    near = asking.where("near").select(F.col("signature").alias("_signature")).distinct()
    edges = kept.join(near, F.col("signature") == F.col("_signature"), "left_semi").where("class <> low").select(
        F.col("class").alias("a"), F.col("low").alias("b")).distinct()
    sets = stage(_members(kept, components(edges)), "sets")
    placed = stage(_placed(sets), "placed")
    drop(sets)
    asks = stage(_asks(asking, kept, placed), "asks")
    drop(kept, asking)

    links = _links(asks, placed, rows, chosen, width, percent, _ASKED * _SEARCHED)
    drop(asks, placed)
    final = components(links.unionByName(led))

    named = (classes.where(F.col("class").isNotNull()).groupBy("class").agg(F.min("doc_id").alias("least"))
             .join(final, F.col("class") == F.col("node"), "left")
             .select("class", "least", F.coalesce("component", "class").alias("component")))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    by_class = named.join(least, "component").select(F.col("class").alias("_class"), "component_id")
    return classes.join(by_class, F.col("class") == F.col("_class"), "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def _differ(size: Column, percent: int) -> Column:
    """The most shingles in which a set of this size differs from one that it links with and that is not larger."""
    return F.floor(2 * (100 - percent) * size / (100 + percent))


def _enough(shared: DataFrame, percent: int) -> DataFrame:
    """The rows of sets that share as many signatures at one number of parts as a link takes.

    At k parts the larger of two sets has at most the size whose number of parts is k, and differs in at most
    k - 1 shingles less the spare parts; only empty parts may have no signature.
    """
    parts = F.abs("parts")
    differ = F.least(_differ(F.floor(100 * F.col("size") / percent), percent), parts - 2 - F.floor(3 * parts / 10))
    own = Window.partitionBy("class", "parts")
    return shared.withColumn("_n", F.count(F.lit(1)).over(own)).where(F.col("_n") >= parts - differ - F.col("hidden")).drop("_n")


def _with_widths(rows: DataFrame) -> DataFrame:
    """``rows`` with width (how many sets have the signature) and low (the least of them), where these are two and one may ask."""
    widths = rows.groupBy(F.col("signature").alias("_signature")).agg(
        F.count(F.lit(1)).alias("width"), F.min("class").alias("low"), F.max("parts").alias("_parts")).where("width > 1 and _parts > 0")
    return rows.join(widths, F.col("signature") == F.col("_signature")).drop("_signature", "_parts")


def _leaders(common: DataFrame) -> DataFrame:
    """(class, size, block): the set, named by block, that a set is compared with first.

    A text of which others are copies has all its signatures in common with them, a copy only those of the parts
    left as they were. So sets are ranked by how many share a signature of theirs on average; of the first one of
    each of its signatures, a set takes the one that it meets most often.
    """
    ranks = common.where("parts > 0").groupBy(F.col("class").alias("_class")).agg((F.sum("width") / F.max("parts")).alias("rank"))
    firsts = common.join(ranks, F.col("class") == F.col("_class"), "left").groupBy(F.col("signature").alias("_signature")).agg(
        F.max(F.struct(F.coalesce("rank", F.lit(0.0)).alias("rank"), "class")).alias("first"))
    met = common.join(firsts, F.col("signature") == F.col("_signature")).groupBy("class", "first").agg(
        F.max("size").alias("size"), F.count(F.lit(1)).alias("n"))
    return met.where(F.col("class") != F.col("first.class")).groupBy("class").agg(
        F.max("size").alias("size"), F.max(F.struct("n", "first")).alias("_best")).select(
        "class", "size", F.col("_best.first.class").alias("block"))


def _between(common: DataFrame, clusters: DataFrame) -> DataFrame:
    """The rows of ``common``, without width and low, whose signature is one of sets of different ``clusters``
    (node, component), with the set's cluster and whether it is alone there."""
    named = common.drop("width", "low").join(clusters, F.col("class") == F.col("node"), "left").withColumn(
        "cluster", F.coalesce("component", "class")).withColumn("alone", F.col("component").isNull()).drop("node", "component")
    mixed = named.groupBy(F.col("signature").alias("_signature")).agg(
        F.min("cluster").alias("_low"), F.max("cluster").alias("_high")).where("_low < _high").select("_signature")
    return named.join(mixed, F.col("signature") == F.col("_signature"), "left_semi")


def _asking(kept: DataFrame, percent: int) -> DataFrame:
    """(class, size, cluster, signature, needed, near) of the sets that may be the larger ones of links: ``needed`` signatures at
    their own number of parts are in common with each. So up to needed - 1, the widest, may be left out: ``near`` is false.
    """
    own = Window.partitionBy("class")
    return (kept.where("parts > 0").withColumn("needed", F.col("parts") - _differ(F.col("size"), percent) - F.col("hidden"))
            .withColumns({"_all": F.count(F.lit(1)).over(own), "_nth": F.row_number().over(own.orderBy("width", "signature"))})
            .where("_all >= needed").select("class", "size", "cluster", "signature", "needed", (F.expr("_nth <= _all - needed + 1")).alias("near")))


def _members(kept: DataFrame, trees: DataFrame) -> DataFrame:
    """(class, size, cluster, component, leader) of each set of ``trees`` (node, component); leader is its cluster, or where
    it is alone there the least set with its narrowest signature."""
    return kept.groupBy("class").agg(
        F.max("size").alias("size"), F.max("cluster").alias("cluster"), F.max("alone").alias("alone"),
        F.min_by("low", F.struct("width", "signature")).alias("leader")).withColumn(
        "leader", F.when(F.col("alone"), F.col("leader")).otherwise(F.col("cluster"))).drop("alone").join(
        trees, F.col("class") == F.col("node")).drop("node")


def _placed(sets: DataFrame) -> DataFrame:
    """(class, cluster, block) of ``sets``: blocks of about _SEARCHED shingles.

    Sets with one leader go together, so that a large component is cut between unlike sets where it can be, and
    a cluster that fills blocks has them to itself.
    """
    led = sets.groupBy("component", "leader").agg(F.sum("size").alias("shingles"))
    whole = led.groupBy(F.col("component").alias("_component")).agg(F.ceil(F.sum(F.when(F.col("shingles") <= _SEARCHED, F.col("shingles"))) / _SEARCHED).alias("blocks"))
    cut = F.ceil(F.col("shingles") / _SEARCHED)
    places = led.join(whole, F.col("component") == F.col("_component")).select(
        "_component", F.col("leader").alias("_leader"), cut.alias("cut"),
        F.xxhash64("component", F.when(cut > 1, F.col("leader")), F.when(cut <= 1, F.pmod(F.xxhash64("leader"), F.col("blocks")))).alias("place"))
    on = (F.col("component") == F.col("_component")) & (F.col("leader") == F.col("_leader"))
    return sets.join(places, on).select("class", "cluster", F.when(
        F.col("cut") > 1, F.xxhash64("place", F.pmod(F.xxhash64("class"), F.col("cut")))).otherwise(F.col("place")).alias("block"))


def _asks(asking: DataFrame, kept: DataFrame, placed: DataFrame) -> DataFrame:
    """(class, size, block): the blocks in which a set has as many signatures in common with sets of other clusters as a link takes."""
    place = placed.select(F.col("class").alias("_class"), "block")
    present = kept.select("signature", "class", "cluster").join(place, F.col("class") == F.col("_class")).groupBy(
        F.col("signature").alias("_signature"), "block").agg(F.min("cluster").alias("_low"), F.max("cluster").alias("_high"))
    return (asking.join(present, F.col("signature") == F.col("_signature")).where("_low <> cluster or _high <> cluster")
            .groupBy("class", "size", "block", "needed").agg(F.count(F.lit(1)).alias("n")).where("n >= needed").select("class", "size", "block"))
