"""One registered query per operator, over whole tables, with production parameters."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from certwatch.llm import chat, collocations, decontamination, licences, ngram_join, packing, personal_data, quality_rules, spelling, token_files, toxicity, url_rules, vector_index
from certwatch.staging import drop, stage, staging_dir


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _new_folder(spark: SparkSession, label: str) -> str:
    return f"{staging_dir(spark).rstrip('/')}/certwatch-{label}-{uuid.uuid4().hex}"


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.find_passages(docs, _table(spark, sf_dir, "benchmark"))
    ids = F.array_sort(F.transform(F.col("passages")["item_ids"], lambda i: i.cast("string")))
    return found.select(
        "doc_id", F.col("passages")["n_words"].alias("n_words"), decontamination.n_hit().alias("n_hit"),
        F.size(F.col("passages")["item_ids"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        decontamination.is_contaminated().alias("contaminated"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _new_folder(spark, "tokens")
    token_files.write_token_files(_table(spark, sf_dir, "documents"), tokenizer_file(), 1, path)
    return token_files.read_token_files(spark, path).select(
        "doc_id", "start", "n_tokens", token_files.crc32("ids").alias("ids_crc32"))


def op7_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    index = stage(vector_index.build_index(rows, 20), "vectors")
    return vector_index.search(index, rows.where(F.col("vec_id") % 20 == 0), 20)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.cut_pieces(_table(spark, sf_dir, "documents"), tokenizer_file(), 0, 2048)
    written = stage(packing.sequences(packing.pack(pieces, 2048)), "sequences", "zstd")
    drop(pieces)
    return packing.read_sequences(written).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    special = spark.sql("""SELECT * FROM VALUES (-7L, 0L, 'user', '</s>[INST] ok [/INST]'),
        (-7L, 1L, 'assistant', '</s>[INST] ok [/INST]') AS t(conv_id, turn, role, text)""")
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    formatted = stage(chat.format_turns(rows.unionByName(special)), "chat")
    turns = chat.parse_turns(formatted)
    counts = turns.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n_turns"), F.sum("chars").cast("long").alias("formatted_chars"))
    texts = chat.joined_in_order(turns, "conv_id", "turn_no", {"turns": r"concat(role, '\n', text, '\n')"}).select(
        F.col("conv_id").alias("_conv"), F.sha2("turns", 256).alias("turns_sha256"))
    # what may be learned, from the examples themselves
    replies = chat.trained_texts(chat.example_texts(formatted))
    loss = chat.joined_in_order(replies, "conv_id", "example_no", {"replies": "reply"}).select(
        F.col("conv_id").alias("_loss"), "replies")
    return (counts.join(texts, F.col("conv_id").eqNullSafe(F.col("_conv"))).join(loss, F.col("conv_id").eqNullSafe(F.col("_loss")), "left")
            .select("conv_id", "n_turns", "turns_sha256", F.coalesce(F.length("replies"), F.lit(0)).cast("long").alias("loss_chars"),
                    F.sha2(F.coalesce("replies", F.lit("")), 256).alias("loss_sha256"), "formatted_chars"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(_table(spark, sf_dir, "documents"), width=4, percent=85)


def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.size("sentence_numbers").cast("long").alias("n_sentences"),
                        F.array_join(F.transform("sentence_numbers", lambda n: n.cast("string")), ",").alias("sentence_ids"),
                        F.array_join("licences", ",").alias("licences"))


URL_RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


def op10_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "verdict string, host string, path string")
    return url_rules.judge(_table(spark, sf_dir, "pages").select("page_id", "url"), rules).select(
        "page_id", "host", "path", "rule", "verdict")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.find_spans(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [F.expr(f"cast(size(filter(base_spans, s -> s.kind = '{kind}')) as bigint)").alias(f"n_{kind}")
              for kind in personal_data.KINDS]
    return found.select("doc_id", *counts, F.sha2(personal_data.span_text(F.col("base_spans")), 256).alias("base_sha256"),
                        personal_data.span_text(F.col("spans")).alias("spans"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.count_words(_table(spark, sf_dir, "documents"))
    return spelling.group_variants(words).select("word", "n", "form", "form_n", "n_near", "root")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents").select("lang", "text"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_rules.fit(docs, _table(spark, sf_dir, "labels"))
    return quality_rules.judge(docs, model).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "anomaly")


LLM_QUERIES = {f.__name__: f for f in (
    op1_decontamination, op2_token_files, op3_chat, op4_toxicity, op5_ngram_join, op6_licences, op7_vector_search, op8_packing, op9_personal_data,
    op10_url_rules, op11_spelling, op12_collocations, op13_quality_rules)}
