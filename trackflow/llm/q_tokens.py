"""Queries on tokens: encoding, packing, counts by section."""

from __future__ import annotations

from public_tokenizers import path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackflow.llm import bpe, packing, sections
from trackflow.llm.registry import query
from trackflow.llm.work import staged, table

VOCABULARY = "byte_bpe_50k.json"
END_ID = 0
CAPACITY = 2048


@query("op6_bpe")
def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded, as digests."""
    coded = bpe.encode(table(spark, sf_dir, "documents"), path(VOCABULARY), decoded=True)
    return coded.select(
        "doc_id",
        bpe.n_tokens().alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query("op8_best_fit_packing")
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in sequences of 2048 tokens."""
    pieces = packing.pieces_of(bpe.encode(table(spark, sf_dir, "documents"), path(VOCABULARY), library=True), CAPACITY, END_ID)
    stored = staged(pieces.select("doc_id", "piece", "start", "length", F.crc32("piece_ids").alias("ids_crc32")), "pieces")
    return packing.pack(stored, "length", CAPACITY, ["doc_id", "piece"])


@query("op10_token_counts")
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document, each line with its newline, by the start rule."""
    return sections.line_counts(table(spark, sf_dir, "documents"), path(VOCABULARY))
