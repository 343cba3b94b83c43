"""Token-id files: concatenated ids with Elias-Fano document boundaries.

A file set is a folder of Parquet shards. Each row is one block: the ids of
consecutive documents, little-endian, back to back, how many ids its shard has before it, and where each document
ends as an Elias-Fano sequence, about ``2 + log2(mean length)`` bits a document
instead of 64. Documents are in ascending doc_id order over all blocks (nulls
first, equal ids by text within a shard and by its hash between shards), so (shard, block) orders the set.

Null text is an empty document; every document gets ``end_id`` appended. Repeated
doc_ids stay separate documents. An empty table gives an empty set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from certwatch.llm.batches import slices
from certwatch.llm.vocabulary import encoder

_SELECT_STEP = 256
_BLOCK_TOKENS = 1 << 20
_BLOCK_SCHEMA = ("shard int, block int, before long, n_docs long, n_tokens long, width int, doc_ids array<bigint>, "
                 "ids binary, low_bits int, low binary, high binary, samples binary")


class EliasFano:
    """A non-decreasing sequence of n numbers up to ``last``.

    Each number's ``low_bits`` lowest bits are packed side by side; its upper part
    u is a one bit at place u + i of ``high``. ``samples`` keeps the place of every
    256th one bit, from which ``select`` counts on.
    """

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, samples: bytes):
        self.n, self.low_bits = n, low_bits
        self.low, self.high = np.frombuffer(low, np.uint8), np.frombuffer(high, np.uint8)
        self.samples = np.frombuffer(samples, "<u4")

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.int64)
        n = len(values)
        spread = (int(values[-1]) + 1) // n if n else 0
        low_bits = max(0, spread.bit_length() - 1)
        bits = (values[:, None] >> np.arange(low_bits)) & 1
        low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
        places = (values >> low_bits) + np.arange(n)
        high = np.zeros(int(places[-1]) + 1 if n else 0, np.uint8)
        high[places] = 1
        return cls(n, low_bits, low.tobytes(), np.packbits(high, bitorder="little").tobytes(),
                   places[::_SELECT_STEP].astype("<u4").tobytes())

    def select(self, i: int) -> int:
        """The i-th number, from 0."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        start, missing = int(self.samples[i // _SELECT_STEP]), i % _SELECT_STEP
        byte = start // 8
        counts = np.bitwise_count(self.high[byte:byte + 64]).astype(np.int64)
        missing += int(np.bitwise_count(self.high[byte] & ((1 << start % 8) - 1)))
        while counts.sum() <= missing:
            missing -= int(counts.sum())
            byte += 64
            counts = np.bitwise_count(self.high[byte:byte + 64]).astype(np.int64)
        inner = int(np.searchsorted(np.cumsum(counts), missing, side="right"))
        missing -= int(counts[:inner].sum())
        place = (byte + inner) * 8 + int(np.flatnonzero(np.unpackbits(self.high[byte + inner:byte + inner + 1],
                                                                      bitorder="little"))[missing])
        return ((place - i) << self.low_bits) | self._low(np.array([i]))[0]

    def _low(self, which: np.ndarray) -> np.ndarray:
        if self.low_bits == 0:
            return np.zeros(len(which), np.int64)
        at = which[:, None] * self.low_bits + np.arange(self.low_bits)
        bits = (self.low[at >> 3] >> (at & 7)) & 1
        return (bits.astype(np.int64) << np.arange(self.low_bits)).sum(axis=1)

    def all(self) -> np.ndarray:
        places = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[:self.n]
        which = np.arange(self.n)
        return ((places - which) << self.low_bits) | self._low(which)


def _write_blocks(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(path)
        block, before, docs, ids, size = 0, 0, [], [], 0

        def flush() -> pa.RecordBatch:
            ends = EliasFano.of(np.cumsum([len(x) for x in ids]))
            row = {"shard": shard, "block": block, "before": before, "n_docs": len(docs), "n_tokens": size,
                   "width": tool.dtype.itemsize, "doc_ids": docs, "ids": b"".join(x.tobytes() for x in ids),
                   "low_bits": ends.low_bits, "low": ends.low.tobytes(), "high": ends.high.tobytes(),
                   "samples": ends.samples.tobytes()}
            return pa.RecordBatch.from_pylist([row], schema)

        schema = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("before", pa.int64()), ("n_docs", pa.int64()),
                            ("n_tokens", pa.int64()), ("width", pa.int32()),
                            ("doc_ids", pa.list_(pa.int64())), ("ids", pa.binary()), ("low_bits", pa.int32()),
                            ("low", pa.binary()), ("high", pa.binary()), ("samples", pa.binary())])
        end = np.array([end_id], tool.dtype)
        for rows, data, offsets in slices(batches, "text"):
            shard = rows.column("shard")[0].as_py()
            for doc_id, own in zip(rows.column("doc_id").to_pylist(), tool.encode(data, offsets)):
                docs.append(doc_id)
                ids.append(np.concatenate([own, end]))
                size += len(own) + 1
                if size >= _BLOCK_TOKENS:
                    yield flush()
                    block, before, docs, ids, size = block + 1, before + size, [], [], 0
        if docs:
            yield flush()

    return run


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int, path: str) -> None:
    """Encode ``docs`` (doc_id, text) and write them as a file set at ``path``."""
    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
     .repartitionByRange("doc_id", F.xxhash64("text"))
     .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
     .withColumn("shard", F.spark_partition_id())
     .mapInArrow(_write_blocks(tokenizer, end_id), _BLOCK_SCHEMA)
     .write.mode("overwrite").parquet(path))


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = np.frombuffer(row["ids"], f"<u{row['width']}").astype("<u4")
            bounds = EliasFano(row["n_docs"], row["low_bits"], row["low"], row["high"], row["samples"])
            ends = np.fromiter((bounds.select(i) for i in range(row["n_docs"])), np.int64, row["n_docs"])
            starts = np.concatenate([[0], ends[:-1]])
            own = memoryview(ids).cast("B")
            bounds = zip((starts * 4).tolist(), (ends * 4).tolist())
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(row["doc_ids"], pa.int64()),
                "start": pa.array(starts + row["before"] + row["shard_start"], pa.int64()),
                "n_tokens": pa.array(ends - starts, pa.int64()),
                "ids": pa.array([bytes(own[a:b]) for a, b in bounds], pa.binary()),
            })


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document; ids as little-endian 32-bit words.

    ``start`` counts the ids of all documents before it. Document ends come from the blocks' select structures, the
    ids before a block in its shard stand in the file, and the running total is over one short row per shard.
    """
    blocks = spark.read.parquet(path)
    counts = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    shards = counts.select("shard", F.coalesce(F.sum("n").over(
        Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("shard_start"))
    return blocks.join(shards, "shard").mapInArrow(
        _documents, "doc_id long, start long, n_tokens long, ids binary")


def crc32(column: str) -> Column:
    """Unsigned CRC-32 of a binary column."""
    return F.crc32(F.col(column)).cast("long")


__all__ = ["EliasFano", "crc32", "read_token_files", "write_token_files"]
