"""Query on near duplicates by MinHash."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackflow.llm import minhash
from trackflow.llm.registry import query
from trackflow.llm.work import table


@query("op13_minhash")
def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document, and whether it is the one to keep."""
    found = minhash.minhash_groups(table(spark, sf_dir, "documents"), shingle_words=4, similarity=0.8)
    kept = F.coalesce(F.col("doc_id") == F.col("component"), F.lit(False))
    return found.select("doc_id", "n_shingles", F.col("component").alias("component_id"), kept.alias("kept"))
