"""The reference table of keys: CSV in, one row per key out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackflow.config import KEY_PATTERN
from trackflow.functions.text import clean_key
from trackflow.schemas import REFERENCE, REFERENCE_COLUMNS


def quote_of(spark: SparkSession, path: str) -> str:
    """The quote character, from the first line: an apostrophe if the header begins with one."""
    first = spark.read.text(path).first()  # one line
    return "'" if first and first[0].startswith("'") else '"'


def read_reference_csv(spark: SparkSession, path: str, quote: str | None = None, multi_line: bool = True) -> DataFrame:
    """Header-driven CSV; a doubled quote inside a quoted field is one quote, a backslash is a character like any other.

    Quoted fields may span lines; a file is then read by one task, so give up ``multi_line`` for large files without them.
    """
    quote = quote or quote_of(spark, path)
    return spark.read.option("header", True).option("quote", quote).option("escape", quote).option("multiLine", multi_line).csv(path)


def with_columns(df: DataFrame, columns: Sequence[str] = REFERENCE_COLUMNS) -> DataFrame:
    """Exactly ``columns``, as text; those the file lacks are null."""
    present = set(df.columns)
    return df.select(
        *[(F.col(c) if c in present else F.lit(None)).cast("string").alias(c) for c in columns]
    )


def one_per_key(df: DataFrame, key: str = "icao24", pattern: str = KEY_PATTERN) -> DataFrame:
    """Clean the key, keep well-formed ones, and keep the smallest row of each."""
    rest = [c for c in df.columns if c != key]
    first = Window.partitionBy(key).orderBy(*rest)
    return (
        df.withColumn(key, clean_key(F.col(key)))
        .where(F.col(key).rlike(pattern))
        .withColumn("rn", F.row_number().over(first))
        .where("rn = 1")
        .drop("rn")
    )


def empty_reference(spark: SparkSession) -> DataFrame:
    """Stand-in when no reference file is at hand."""
    return spark.createDataFrame([], REFERENCE)
