"""Query on URLs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trackflow.llm.registry import query
from trackflow.llm.urls import Rule, filter_urls
from trackflow.llm.work import table

RULES = [Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/")]


@query("op4_url_filters")
def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL judged."""
    return filter_urls(table(spark, sf_dir, "pages"), RULES, whole=True).drop("score")
