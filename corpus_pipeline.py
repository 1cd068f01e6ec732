"""Documents to packed sequences: quality rules, near duplicates, long repeats, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows that it gets; its result is written as Parquet to the shared
folder and read again as the next stage's ``docs``. All but the last return the columns of ``documents``, and further
columns unchanged. Empty tables pass through; a missing doc_id is kept where a stage cannot compare the row.
"""

from __future__ import annotations

from collections.abc import Callable

from public_tokenizers import path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackflow.llm import bpe, near_texts, packing, quality, repeats
from trackflow.llm.work import map_rows, staged, table

VOCABULARY = "byte_bpe_50k.json"
CAPACITY = 2048
END_ID = 0
#: Bytes of a repeat: shorter than fifty words of any length that prose has, longer than phrases that meet by chance.
REPEAT_BYTES = 200


def with_text(row: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of ``like`` from its other columns in ``row`` and a new ``text``."""
    count = {"n_chars": F.length("text").cast(like.schema["n_chars"].dataType)} if "n_chars" in like.columns else {}
    return row.select(*(F.col("text") if c == "text" else count[c].alias(c) if c in count else F.col("row").getField(c).alias(c) for c in like.columns))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go, and documents that the rules reject; null and empty texts are rejected."""
    rows = docs.select(F.struct(*(c for c in docs.columns if c != "text")).alias("row"), "text")
    judged = quality.quality(rows, id_col="row").where("kept")
    return with_text(judged.select("row", F.col("clean_text").alias("text")), docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts alike in 0.8 of their shingles of five words, the one of the smallest doc_id stays.

    Rows that repeat an id and its text count as one row. Rows without an id stay.
    """
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("id"), F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("hash"))
    stay = near_texts.near_groups(docs).where("kept").select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")).distinct()
    kept = rows.join(staged(stay, "stay"), ["id", "hash"], "left_semi").dropDuplicates(["id", "hash"])
    return kept.unionByName(rows.where("id IS NULL")).select("row.*")


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 200 bytes that start at two places or more go, at all of them; documents without a word left go too."""
    cut = repeats.kept(repeats.repeated_spans(docs, REPEAT_BYTES, carry=[c for c in docs.columns if c != "text"]))

    def fn(rows: list, left: list) -> list:
        return [rows, [x.decode("utf-8", "ignore") for x in left]]  # a character cut in part goes

    row_type = cut.schema["row"].dataType.simpleString()
    return with_text(map_rows(cut.select("row", "kept"), fn, f"row {row_type}, text string").where(F.col("text").rlike(r"[^\x20\x09-\x0D]")), docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens: doc_id, piece, start, length, sequence_id, offset."""
    pieces = packing.pieces_of(bpe.encode(docs, path(VOCABULARY), library=True), CAPACITY, END_ID).drop("piece_ids")
    return packing.pack(staged(pieces, "pieces"), "length", CAPACITY, ["doc_id", "piece"])


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("best_fit_packing", best_fit_packing),
]

#: SQL has no fingerprints by XXH64 and no merges of a vocabulary; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the table of documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
