"""Sessions by inactivity gap."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackflow.functions.times import SECOND, bucket, micros

BORDER = -1  # slot of pieces first or last in their chunk; the others use their own chunk


def session_counts(
    df: DataFrame, key: str = "icao24", ts: str = "event_ts", gap_s: int = 180, chunk_s: int = 3600
) -> DataFrame:
    """Reports per run without a silence longer than ``gap_s``.

    It sees only the rows it is given: visits to a zone, which also end when the key leaves the
    zone for a single report, need ``episodes.visits``.
    """
    if df.isStreaming:
        return _session_windows(df, key, ts, gap_s)
    gap = gap_s * SECOND
    # Copies of one instant are counted before the shuffle; a busy key then spreads by time chunk.
    instants = df.groupBy(key, micros(F.col(ts)).alias("us")).agg(F.count(F.lit(1)).alias("n"))
    in_chunk = Window.partitionBy(key, "chunk").orderBy("us")
    silent = F.col("us") - F.lag("us").over(in_chunk) > gap
    pieces = (
        instants.withColumn("chunk", bucket(F.col("us"), chunk_s * SECOND))
        .withColumn("opens", F.coalesce(silent, F.lit(False)).cast("int"))
        .withColumn("piece", F.sum("opens").over(in_chunk.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(key, "chunk", "piece")
        .agg(F.min("us").alias("us0"), F.max("us").alias("us1"), F.sum("n").alias("n"))
    )
    # Only the first and last piece of a chunk can go on in a neighbouring chunk.
    order = Window.partitionBy(key, "chunk").orderBy("piece")
    outer = F.lag("piece").over(order).isNull() | F.lead("piece").over(order).isNull()
    across = Window.partitionBy(key, "slot").orderBy("us0")
    apart = F.col("us0") - F.lag("us1").over(across) > gap
    return (
        pieces.withColumn("outer", outer)
        .withColumn("slot", F.when(F.col("outer"), F.lit(BORDER)).otherwise(F.col("chunk")))
        .withColumn("opens", F.coalesce(apart, F.lit(True)).cast("int"))
        .withColumn("session", F.sum("opens").over(across.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(key, "slot", "session")
        .agg(
            F.timestamp_micros(F.min("us0")).alias("started_at"),
            F.timestamp_micros(F.max("us1")).alias("ended_at"),
            F.sum("n").alias("reports"),
        )
        .drop("slot", "session")
    )


def _session_windows(df: DataFrame, key: str, ts: str, gap_s: int) -> DataFrame:
    """The same on a stream with a watermark; state is kept per open session."""
    grouped = df.groupBy(key, F.session_window(ts, f"{gap_s} seconds").alias("session"))
    return grouped.agg(
        F.min(ts).alias("started_at"), F.max(ts).alias("ended_at"), F.count(F.lit(1)).alias("reports")
    ).drop("session")
