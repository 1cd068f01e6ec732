"""Query on importance resampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trackflow.llm import resample
from trackflow.llm.registry import query
from trackflow.llm.work import table


@query("op12_importance_resampling")
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of the documents, drawn towards the benchmark texts."""
    drawn = resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), share=25, min_words=20, seed=7)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")
