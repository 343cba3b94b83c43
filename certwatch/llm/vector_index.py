"""Largest inner products by a navigable small-world graph per shard.

Equal vectors are indexed once with the ids that can matter, so copies neither
crowd the graph nor the results. Each shard is one row: its vectors, members and
one flat neighbour array per layer, node order being by level, highest first, so that
a layer is a prefix. A further coordinate gives all vectors of a shard one length,
which turns the largest inner product into the nearest neighbour. Graphs are built
and searched many nodes at a time, each with its own beam. Every query goes
to every shard in blocks, and the shards' results are merged.

Vectors that are null, empty, zero or hold null or non-finite components take no part, nor
do null ids. Only vectors of one dimension are compared. A query's own id is no candidate
of it, also where the id repeats; other repeated rows are candidates each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_BATCH = 512
_INDEX = "shard int, dim int, layers array<int>, vectors binary, neighbours binary, member_counts binary, members binary"


def usable(vector: Column) -> Column:
    """Has components, none null or non-finite, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _pick(sims: np.ndarray, ids: np.ndarray, vectors: np.ndarray, most: int) -> np.ndarray:
    """Per row up to ``most`` neighbours, nearest first, none nearer to one already taken; then the nearest others."""
    order = np.argsort(-sims, axis=1, kind="stable")
    sims, ids = np.take_along_axis(sims, order, 1), np.take_along_axis(ids, order, 1)
    own = vectors[np.maximum(ids, 0)]
    between = own @ own.transpose(0, 2, 1)
    rows, width = sims.shape
    taken = np.zeros((rows, width), bool)
    count = np.zeros(rows, np.int64)
    for c in range(width):
        rival = np.where(taken, between[:, c, :], -np.inf).max(axis=1)
        good = (ids[:, c] >= 0) & (sims[:, c] > rival) & (count < most)
        taken[:, c] = good
        count += good
    rank = np.where(taken, 0, 1) * width + np.arange(width)
    rank[ids < 0] = 3 * width
    chosen = np.argsort(rank, axis=1, kind="stable")[:, :most]
    out = np.take_along_axis(ids, chosen, 1)
    return np.pad(out, ((0, 0), (0, most - out.shape[1])), constant_values=-1)


def _beam(vectors: np.ndarray, neighbours: np.ndarray, queries: np.ndarray, entries: np.ndarray,
          width: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, similarities) of the nearest nodes each query finds from its entries; -1 where there are fewer."""
    n, lane = len(queries), np.arange(len(queries))[:, None]
    visited = np.zeros((n, len(neighbours)), bool)
    visited[lane, entries] = True
    ids = np.full((n, width), -1, np.int64)
    sims = np.full((n, width), -np.inf, np.float32)
    ids[:, :entries.shape[1]] = entries
    sims[:, :entries.shape[1]] = np.einsum("nd,ned->ne", queries, vectors[entries])
    done = ids < 0
    while True:
        open_ = np.where(done, -np.inf, sims)
        best = open_.argmax(axis=1)
        rows = np.flatnonzero(open_[np.arange(n), best] > -np.inf)
        if not len(rows):
            return ids, sims
        done[rows, best[rows]] = True
        near = neighbours[ids[rows, best[rows]]]
        fresh = (near >= 0) & ~visited[rows[:, None], np.maximum(near, 0)]
        near = np.where(fresh, near, -1)
        visited[np.repeat(rows, near.shape[1])[fresh.ravel()], near.ravel()[fresh.ravel()]] = True
        sim = np.where(fresh, np.einsum("nd,nmd->nm", queries[rows], vectors[np.maximum(near, 0)]), -np.inf)
        all_sims = np.concatenate([sims[rows], sim], axis=1)
        keep = np.argpartition(-all_sims, width - 1, axis=1)[:, :width]
        ids[rows] = np.take_along_axis(np.concatenate([ids[rows], near], axis=1), keep, 1)
        sims[rows] = np.take_along_axis(all_sims, keep, 1)
        done[rows] = np.take_along_axis(np.concatenate([done[rows], near < 0], axis=1), keep, 1)


class Graph:
    """Layers over one set of nodes; layer i holds nodes 0 to sizes[i] - 1, layer 0 all."""

    def __init__(self, vectors: np.ndarray, sizes: list[int], neighbours: list[np.ndarray]):
        self.vectors, self.sizes, self.neighbours = vectors, sizes, neighbours

    @classmethod
    def build(cls, vectors: np.ndarray, links: int, width: int) -> Graph:
        sizes = [len(vectors)]
        while sizes[-1] > 2 * links:
            sizes.append(sizes[-1] // links)
        graph = cls(vectors, sizes, [np.full((s, links * (1 if i else 2)), -1, np.int64) for i, s in enumerate(sizes)])
        for layer in range(len(sizes) - 1, -1, -1):
            graph._fill(layer, width)
        return graph

    def _fill(self, layer: int, width: int) -> None:
        size, above = self.sizes[layer], self.sizes[layer + 1] if layer + 1 < len(self.sizes) else 0
        at = 0
        while at < size:
            end = min(size, at + max(1, min(_BATCH, at)))
            if at < above:
                end = min(end, above)
            new = np.arange(at, end)
            if at:
                entries = np.zeros((len(new), 1), np.int64) if at < above or not above else \
                    self._descend(self.vectors[new], layer)
                ids, sims = _beam(self.vectors, self.neighbours[layer], self.vectors[new], entries, width)
            else:
                ids, sims = np.full((len(new), 1), -1), np.full((len(new), 1), -np.inf, np.float32)
            inner = self.vectors[new] @ self.vectors[new].T  # the batch itself
            np.fill_diagonal(inner, -np.inf)
            few = np.argsort(-inner, axis=1)[:, :16]
            inner = np.take_along_axis(inner, few, 1)
            ids = np.concatenate([ids, np.where(inner > -np.inf, new[few], -1)], axis=1)
            self._connect(layer, new, np.concatenate([sims, inner], axis=1), ids)
            at = end

    def _connect(self, layer: int, new: np.ndarray, sims: np.ndarray, ids: np.ndarray) -> None:
        table = self.neighbours[layer]
        most = table.shape[1]
        table[new] = _pick(sims, ids, self.vectors, most)[:, :most]
        source, target = np.repeat(new, most), table[new].ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.lexsort((-np.einsum("nd,nd->n", self.vectors[source], self.vectors[target]), target))
        source, target = source[order], target[order]
        nodes, first, count = np.unique(target, return_index=True, return_counts=True)
        extra = np.full((len(nodes), min(int(count.max(initial=1)), 2 * most)), -1, np.int64)
        for k in range(extra.shape[1]):
            own = count > k
            extra[own, k] = source[first[own] + k]
        for lo in range(0, len(nodes), _BATCH):
            part = nodes[lo:lo + _BATCH]
            both = np.concatenate([table[part], extra[lo:lo + _BATCH]], axis=1)
            both.sort(axis=1)
            both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
            sim = np.einsum("nd,nmd->nm", self.vectors[part], self.vectors[np.maximum(both, 0)])
            table[part] = _pick(np.where(both >= 0, sim, -np.inf), both, self.vectors, most)

    def _descend(self, queries: np.ndarray, to: int) -> np.ndarray:
        """Entries for layer ``to`` from the layers above it."""
        entries = np.zeros((len(queries), 1), np.int64)
        for layer in range(len(self.sizes) - 1, to, -1):
            ids, sims = _beam(self.vectors, self.neighbours[layer], queries, entries, 8)
            best = np.argsort(-sims, axis=1)[:, :1]
            entries = np.take_along_axis(ids, best, 1)
        return entries

    def search(self, queries: np.ndarray, width: int) -> np.ndarray:
        out = [np.zeros((0, width), np.int64)]
        for at in range(0, len(queries), _BATCH):
            part = queries[at:at + _BATCH]
            out.append(_beam(self.vectors, self.neighbours[0], part, self._descend(part, 0), width)[0])
        return np.concatenate(out)


def _levelled(vectors: np.ndarray) -> np.ndarray:
    """All of one length, by a further coordinate."""
    norms = (vectors ** 2).sum(axis=1)
    rest = np.sqrt(np.maximum(0, norms.max(initial=0) - norms))
    return np.concatenate([vectors, rest[:, None]], axis=1).astype(np.float32)


def _build(links: int, width: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        vectors = np.stack(table.column("vector").to_numpy())
        members = table.column("members").to_pylist()
        graph = Graph.build(_levelled(vectors), links, width)
        row = {"shard": table.column("shard")[0].as_py(), "dim": vectors.shape[1], "layers": graph.sizes,
               "vectors": vectors.astype("<f8").tobytes(),
               "neighbours": b"".join(x.astype("<i4").tobytes() for x in graph.neighbours),
               "member_counts": np.array([len(m) for m in members], "<i4").tobytes(),
               "members": np.array([i for m in members for i in m], "<i8").tobytes()}
        return pa.Table.from_pylist([row], pa.schema([
            ("shard", pa.int32()), ("dim", pa.int32()), ("layers", pa.list_(pa.int32())), ("vectors", pa.binary()),
            ("neighbours", pa.binary()), ("member_counts", pa.binary()), ("members", pa.binary())]))

    return run


def _load(row: dict, links: int) -> tuple[Graph, np.ndarray, np.ndarray, np.ndarray]:
    vectors = np.frombuffer(row["vectors"], "<f8").reshape(-1, row["dim"])
    flat, tables, at = np.frombuffer(row["neighbours"], "<i4").astype(np.int64), [], 0
    for i, size in enumerate(row["layers"]):
        wide = links * (1 if i else 2)
        tables.append(flat[at:at + size * wide].reshape(size, wide))
        at += size * wide
    counts = np.frombuffer(row["member_counts"], "<i4").astype(np.int64)
    return Graph(_levelled(vectors), row["layers"], tables), vectors, counts, np.frombuffer(row["members"], "<i8")


def _search(k: int, links: int, width: int):
    from certwatch.llm.batches import ranges

    def run(index: pa.Table, queries: pa.Table) -> pa.Table:
        out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
        if index.num_rows and queries.num_rows:
            graph, vectors, counts, members = _load({c[1:]: v for c, v in index.to_pylist()[0].items()}, links)
            firsts = np.cumsum(counts) - counts
            q = np.stack(queries.combine_chunks().column("vector").to_numpy())
            found = graph.search(np.pad(q, ((0, 0), (0, 1))).astype(np.float32), max(width, k + 1))
            for own, vector, nodes in zip(queries.column("query_id").to_pylist(), q, found):
                nodes = nodes[nodes >= 0]
                score = (vectors[nodes] * vector).sum(axis=1)
                ids, each = members[ranges(firsts[nodes], counts[nodes])], np.repeat(score, counts[nodes])
                ids, each = ids[ids != own], each[ids != own]
                best = np.lexsort((ids, -each))[:k]
                out["query_id"] += [own] * len(best)
                out["vec_id"] += ids[best].tolist()
                out["score"] += each[best].tolist()
        return pa.table({"query_id": pa.array(out["query_id"], pa.int64()), "vec_id": pa.array(out["vec_id"], pa.int64()),
                         "score": pa.array(out["score"], pa.float64())})

    return run


def _clean(rows: DataFrame, id_: str, vector: str) -> DataFrame:
    return rows.where(F.col(id_).isNotNull() & usable(F.col(vector))).select(
        F.col(id_).cast("long").alias("id"), F.transform(vector, lambda x: x.cast("double")).alias("vector"))


def build_index(rows: DataFrame, k: int, id_: str = "vec_id", vector: str = "embedding", shard_rows: int = 8192,
                links: int = 16, width: int = 96) -> DataFrame:
    """One row per shard of about ``shard_rows`` different vectors; answers for up to ``k`` neighbours."""
    known = _clean(rows, id_, vector).withColumn("hash", F.xxhash64("vector"))
    # a query takes at most k members of a vector, besides itself: k + 1 of the smallest ids suffice
    ranked = known.withColumn("_rank", F.row_number().over(Window.partitionBy("hash", "vector").orderBy("id"))).where(F.col("_rank") <= k + 1)
    different = ranked.groupBy("hash", "vector").agg(F.sort_array(F.collect_list("id")).alias("members"))
    sizes = known.groupBy(F.size("vector").alias("dim")).agg(F.approx_count_distinct("hash").alias("n")).select(
        "dim", F.greatest(F.lit(1), F.ceil(F.col("n") / shard_rows)).cast("int").alias("of"))
    dealt = different.withColumn("dim", F.size("vector")).join(sizes, "dim").select(
        F.pmod(F.xxhash64("dim", F.pmod(F.xxhash64("hash"), F.col("of"))), F.lit(1 << 31)).cast("int").alias("shard"), "vector", "members")
    return dealt.groupBy("shard").applyInArrow(_build(links, width), _INDEX)


def search(index: DataFrame, queries: DataFrame, k: int, id_: str = "vec_id", vector: str = "embedding",
           links: int = 16, width: int = 128, block_rows: int = 4096) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest inner products found for each query."""
    asked = _clean(queries, id_, vector).select(F.col("id").alias("query_id"), "vector", F.size("vector").alias("dim"))
    blocks = max(1, -(-asked.count() // block_rows))
    shards = index.select("shard", F.col("dim").alias("_dim"))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)))
    to_all = asked.join(shards, F.col("dim") == F.col("_dim")).select("shard", "block", "query_id", "vector")
    copies = index.select(
        F.col("shard").alias("_shard"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("_block"),
        *[F.col(c).alias(f"_{c}") for c in index.columns if c != "shard"])
    found = copies.groupBy("_shard", "_block").cogroup(to_all.groupBy("shard", "block")).applyInArrow(
        _search(k, links, width), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
