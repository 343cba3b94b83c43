"""A corpus made ready for training, stage by stage.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and
returns a DataFrame; all but the last return the columns of documents. ``run`` writes
each result as Parquet and reads it again for the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from certwatch.llm import decontamination, ngram_join, packing, personal_data, toxicity
from certwatch.llm.batches import free_name
from certwatch.llm.queries import tokenizer_file
from certwatch.staging import drop, stage

ORACLE_SQL = None  # scores and packing are not SQL; tests/llm compares with plain versions


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score under 0.3."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    name = free_name(docs, "score")
    return toxicity.score(docs, model, out=name).where(F.col(name) < 0.3).drop(name)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group; five words, similarity 0.8.

    Rows are told apart by a 64-bit hash of id and text, so of rows that repeat an id only
    those go whose texts are linked or equal. Documents without an id come last in
    their group, and stay once per text.
    """
    row = F.xxhash64("doc_id", F.col("doc_id").isNull(), "text", F.col("text").isNull())
    groups = ngram_join.near_duplicates(docs.select(row.alias("doc_id"), "text"), width=5, percent=80)
    ids = docs.select(row.alias("_row"), F.col("doc_id").alias("_id")).distinct()
    first = groups.select("doc_id", "component_id").distinct().join(ids, F.col("doc_id") == F.col("_row")).groupBy(
        "component_id").agg(F.min(F.struct(F.col("_id").isNull(), "_id", "_row")).alias("first"))
    key = free_name(docs, "_key")
    kept = docs.withColumn(key, row).join(first.select("first._row"), F.col(key) == F.col("_row"), "left_semi")
    return kept.groupBy(key).agg(F.min(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias("_first")).select("_first.*")


def reject_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words fewer than one in twenty are in a benchmark passage."""
    name = free_name(docs, "passages")
    found = decontamination.find_passages(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), out=name)
    return found.where(~decontamination.is_contaminated(name)).drop(name)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    base, spans = free_name(docs, "base_spans"), free_name(docs, "spans")
    found = personal_data.find_spans(docs, names=(base, spans))
    touched = F.size(spans) > 0
    text = personal_data.redacted(F.col("text"), F.col(spans))
    return found.select(*[
        text.alias(c) if c == "text"
        else F.when(touched, F.length(text).cast(t)).otherwise(F.col(f"`{c}`")).alias(c) if c == "n_chars"
        else F.col(f"`{c}`") for c, t in docs.dtypes])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece: its ids and its place in a sequence of at most 2048 tokens, both read from the packed sequences."""
    pieces = packing.cut_pieces(docs, tokenizer_file(), 0, 2048)
    written = stage(packing.sequences(packing.pack(pieces, 2048)), "sequences", "zstd")
    drop(pieces)
    return packing.read_sequences(written).drop("row_key")


STAGES = [
    ("toxicity", reject_toxic),
    ("near_duplicates", keep_one_of_near_duplicates),
    ("decontamination", reject_contaminated),
    ("personal_data", redact_personal_data),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
        drop(*before)
        before = [docs]
    return docs
