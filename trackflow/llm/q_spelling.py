"""Query on spelling variants."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trackflow.llm import spelling
from trackflow.llm.registry import query
from trackflow.llm.work import table


@query("op11_spelling_variants")
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near words, form and root of every frequent word."""
    return spelling.variants(table(spark, sf_dir, "documents"), min_chars=6, min_count=5, ratio=5, noise=199)
