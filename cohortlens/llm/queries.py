"""The registered queries of the training-data operators: one per operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from cohortlens.llm import oracle
from cohortlens.llm.byte_bpe import encode_and_decode
from cohortlens.llm.conversation_trie import prefix_trie, share_openings, turn_sequences
from cohortlens.llm.decontamination import find_passages, hit_words
from cohortlens.llm.hard_negatives import hard_negatives, usable_rows
from cohortlens.llm.html_extraction import extract_main_text
from cohortlens.llm.near_dedup import near_groups
from cohortlens.llm.personal_data import count_of, find_personal_data, plain_spans, told
from cohortlens.llm.quality_rules import judge
from cohortlens.llm.sharding import digest, read_shards, write_shards
from cohortlens.llm.suffix_dedup import remove_repeated_bytes
from cohortlens.llm.token_counts import count_tokens
from cohortlens.llm.token_files import (
    checksums,
    document_starts,
    read_token_files,
    write_token_files,
)
from cohortlens.llm.window_dedup import remove_repeated_windows
from cohortlens.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

#: The id that ends each document in the token files.
END_ID = 1
#: Tokens beyond which a document is over the limit.
TOKEN_LIMIT = 2048
SHARDS = 24
SEED = 20
#: Every so many vec_ids is an anchor; one vec_id in so many changes its label first.
ANCHOR_EVERY, RELABEL_EVERY, LABELS = 100, 7, 10


def word_bpe() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def byte_bpe() -> str:
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")


def op1_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids written in document order and read back: places and checksums."""
    path = scratch_path(spark)
    write_token_files(_documents(spark, folder), path, word_bpe, END_ID)
    files = read_token_files(spark, path)
    return document_starts(files, checksums(files)).select(
        "doc_id", "start", "n_tokens", "ids_crc32"
    )


def op2_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of documents linked by near-equal shingle sets."""
    return near_groups(_documents(spark, folder))


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Words of benchmark passages in each document, and the items they come from."""
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    return find_passages(_documents(spark, folder), benchmark).select(
        "row.doc_id",
        "n_words",
        hit_words().alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def op4_window_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Words left after removing the 20-word windows that also start earlier."""
    return remove_repeated_windows(_documents(spark, folder)).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op5_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents shuffled into 24 written shards, and read back."""
    path = scratch_path(spark)
    docs = _documents(spark, folder)
    write_shards(docs, path, SHARDS, SEED)
    return digest(read_shards(spark, path, docs.schema))


def op6_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page."""
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url", "html")
    return extract_main_text(pages).select(
        "row.page_id",
        "row.url",
        F.col("main_text").alias("text"),
        F.char_length("main_text").cast("long").alias("n_chars"),
    )


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes and tokens of every document."""
    return count_tokens(_documents(spark, folder), word_bpe).select(
        "row.doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit")
    )


def op8_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of every document's byte-level BPE ids and of the bytes they decode to."""
    encoded = encode_and_decode(
        _documents(spark, folder), byte_bpe, public_tokenizers.PATTERN
    )
    return encoded.select(
        "row.doc_id",
        F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of every document and the verdict of the line-first rules."""
    return judge(_documents(spark, folder)).select(
        "row.doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op10_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes left after removing the 100-byte strings that also start earlier."""
    return remove_repeated_bytes(_documents(spark, folder)).select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op11_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of every document: counts, places found by pattern and check, all places."""
    return find_personal_data(_documents(spark, folder)).select(
        "row.doc_id",
        *[count_of(kind).alias(f"n_{kind}") for kind in ("email", "ip", "card", "phone")],
        F.sha2(told(plain_spans()), 256).alias("base_sha256"),
        told(F.col("spans")).alias("spans"),
    )


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of another label that score just below each anchor's positives."""
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % RELABEL_EVERY == 0, (F.col("label") + 1) % LABELS)
    rows = usable_rows(vectors.withColumn("label", moved.otherwise(F.col("label"))))
    return hard_negatives(rows, ANCHOR_EVERY)


def op13_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Every shared beginning of the conversations, which open like the first of their group."""
    turns = spark.read.parquet(f"{folder}/conversations.parquet").select(
        "conv_id", "turn", "role", "text"
    )
    return prefix_trie(share_openings(turn_sequences(turns)))


def queries() -> dict[str, Query]:
    found = (
        op1_token_files,
        op2_near_dedup,
        op3_decontamination,
        op4_window_dedup,
        op5_sharding,
        op6_html_extraction,
        op7_token_counts,
        op8_byte_bpe,
        op9_quality_rules,
        op10_suffix_dedup,
        op11_personal_data,
        op12_hard_negatives,
        op13_conversation_trie,
    )
    return {query.__name__: query for query in found} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()
