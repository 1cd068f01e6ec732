"""Query on embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trackflow.llm import neighbours
from trackflow.llm.registry import query
from trackflow.llm.work import table


@query("op2_nearest_neighbours")
def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest rows of every hundredth id."""
    rows = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(rows, rows.where("vec_id % 100 = 0"), k=10)
