"""From raw documents to encoded ones: five stages over whole tables.

Each stage takes (spark, docs, sf_dir), with the columns of ``documents``, and all but the
last return those columns. ``run`` writes and rereads every stage's result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm.byte_bpe import encode_and_decode
from cohortlens.llm.decontamination import drop_contaminated
from cohortlens.llm.near_dedup import keep_first
from cohortlens.llm.quality_rules import keep_good
from cohortlens.llm.suffix_dedup import remove_repeated_bytes
from cohortlens.session import materialize


#: Pieces of text that a worker remembers: the executors' heaps have grown in the stages before.
BPE_ENTRIES = 100_000


def byte_bpe() -> str:
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the line-first rules, without their failing lines."""
    return keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each near-duplicate group."""
    return keep_first(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 100-byte strings that also start earlier; n_chars follows."""
    others = [name for name in docs.columns if name not in ("doc_id", "text")]
    left = remove_repeated_bytes(docs, others, as_text=True)

    def column(name: str):
        if name == "doc_id":
            return F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id")
        if name == "text":
            return F.col("kept").alias("text")
        if name == "n_chars":
            return F.char_length("kept").cast(docs.schema["n_chars"].dataType).alias("n_chars")
        return F.col("carried")[name].alias(name)

    return left.select(*[column(name) for name in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of each document's ids and of the bytes that they decode to."""
    encoded = encode_and_decode(
        docs.select("doc_id", "text"), byte_bpe, public_tokenizers.PATTERN, BPE_ENTRIES
    )
    return encoded.select(
        "row.doc_id",
        F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("decontamination", decontamination),
    ("byte_level_bpe", byte_level_bpe),
]

#: SQL cannot express the register bands, suffix order and merges of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
