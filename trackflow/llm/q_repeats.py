"""Query on long repeats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackflow.llm import repeats
from trackflow.llm.registry import query
from trackflow.llm.work import table

LENGTH = 400


@query("op3_suffix_array_dedup")
def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document keeps when repeats of 400 bytes go."""
    found = repeats.kept(repeats.repeated_spans(table(spark, sf_dir, "documents"), LENGTH))
    return found.select(
        "doc_id",
        F.octet_length("bytes").cast("long").alias("n_bytes"),
        (F.octet_length("bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
