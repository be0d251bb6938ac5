"""One registered query per operator: it applies the operator to its whole table and derives digests."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlift.llm import (
    byte_bpe,
    chat,
    fingerprints,
    line_crf,
    mixing,
    packing,
    periodic_runs,
    personal_data,
    simhash,
    site_style,
    token_counts,
    turn_repair,
    vantage,
)

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    encoded = byte_bpe.encode(table(spark, folder, "documents"), RANKS, public_tokenizers.PATTERN, offsets=False)
    return byte_bpe.decode(encoded, RANKS).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("bytes"), 256).alias("decoded_sha256"),
    )


def op2_vantage_search(spark: SparkSession, folder: str) -> DataFrame:
    return vantage.nearest(table(spark, folder, "embeddings"), k=20, every=20)


def op3_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = personal_data.find_personal_data(table(spark, folder, "documents")).select("doc_id", "pii_spans")
    base = F.filter("pii_spans", lambda s: s["kind"].isin(*personal_data.BASE))
    kinds = F.transform("pii_spans", lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("bigint").alias(f"n_{kind}")
        for kind in personal_data.BASE
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(personal_data.span_list(base), 256).alias("base_sha256"),
        personal_data.span_list(F.col("pii_spans")).alias("spans"),
    )


def op4_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), WORD_VOCABULARY)


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = token_counts.prefix_counts(table(spark, folder, "documents"), WORD_VOCABULARY)
    tokens = token_counts.tokens_within(F.col("prefix_tokens"), F.size("prefix_tokens"))
    return counted.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"),
        tokens.alias("n_tokens"),
        (tokens > 2048).alias("over_limit"),
    )


def op6_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    pairs = fingerprints.edited_pairs(table(spark, folder, "documents"))
    return pairs.select(
        "doc_id",
        F.length("text").cast("bigint").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints.packed(F.col("codes")).alias("fingerprint"),
        fingerprints.packed(F.col("edited_codes")).alias("edited_fingerprint"),
        fingerprints.likeness(F.col("codes"), F.col("edited_codes")).alias("near_edited"),
        fingerprints.likeness(F.col("codes"), F.col("next_codes")).alias("near_next"),
    )


def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    return line_crf.quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op9_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string"
    )
    formatted = chat.format_turns(chat.turns_of_rows(rows.unionByName(extra)))
    # everything below is read from the output alone
    read = formatted.withColumn("turns", chat.read_turns(F.col("formatted"))).withColumn(
        "learnt", chat.loss_text(F.col("formatted"), F.col("loss"))
    )
    said_turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(said_turns, 256).alias("turns_sha256"),
        F.length("learnt").cast("bigint").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def op10_main_text(spark: SparkSession, folder: str) -> DataFrame:
    texts = site_style.extract_main_text(table(spark, folder, "pages"))
    return texts.withColumn("n_chars", F.length("text").cast("bigint"))


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periodic_runs.run_digests(periodic_runs.with_repetitions(table(spark, folder, "documents")))


def op12_turn_repair(spark: SparkSession, folder: str) -> DataFrame:
    return turn_repair.repair(turn_repair.damaged(table(spark, folder, "conversations")))


def op13_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    docs = table(spark, folder, "documents").select("doc_id", "text", held_out.alias("held_out"))
    return mixing.lm_scores(docs, "held_out")


QUERIES: dict[str, Query] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_vantage_search": op2_vantage_search,
    "op3_personal_data": op3_personal_data,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_token_counts": op5_token_counts,
    "op6_document_fingerprints": op6_document_fingerprints,
    "op7_simhash": op7_simhash,
    "op8_quality": op8_quality,
    "op9_chat_format": op9_chat_format,
    "op10_main_text": op10_main_text,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_turn_repair": op12_turn_repair,
    "op13_lm_score": op13_lm_score,
}
