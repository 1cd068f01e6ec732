"""Where queries and their check SQL are kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackflow.session import use_utc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def publish(df: DataFrame) -> DataFrame:
    """UTC instants leave as zone-free timestamps, the type the given tables use."""
    return df.select(
        *[F.col(f"`{n}`").cast("timestamp_ntz").alias(n) if t == "timestamp" else F.col(f"`{n}`") for n, t in df.dtypes]
    )


def query(name: str, check: str | None = None):
    """Register a query, and the SQL giving the same rows when there is one."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: publish(fn(use_utc(spark), sf_dir))
        if check is not None:
            CHECKS[name] = check
        return fn

    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column; distances differ between engines in the last bits."""
    return df.select(*[F.round(n, digits).alias(n) if t == "double" else F.col(n) for n, t in df.dtypes])


def steady_sql(value: str, digits: int) -> str:
    """Check SQL of ``steady_round``: decimal half-up rounding after cutting summation noise."""
    return f"CAST(round(CAST({value} AS DECIMAL(18, 9)), {digits}) AS DOUBLE)"
