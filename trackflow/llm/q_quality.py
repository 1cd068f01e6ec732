"""Query on quality rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trackflow.llm import quality
from trackflow.llm.registry import query
from trackflow.llm.work import table


@query("op5_quality_rules")
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document judged."""
    return quality.quality(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
