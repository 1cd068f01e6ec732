"""Landing files to raw and clean tables, as checkpointed streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from trackflow import schemas
from trackflow.operators.quality import POSITION_RULES, POSITION_WARNINGS, Rules, keep_valid, observed
from trackflow.operators.silver import clean_states
from trackflow.sources.landing import append_stream, landing_stream, with_lineage


def land_states(spark: SparkSession, landing: str, table: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Position landing files into the raw table, by ingest day."""
    return append_stream(with_lineage(landing_stream(spark, landing, schemas.STATES)), table, checkpoint, every=every)


def land_weather(spark: SparkSession, landing: str, table: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Weather envelopes into the raw table, by ingest day."""
    return append_stream(with_lineage(landing_stream(spark, landing, schemas.WEATHER)), table, checkpoint, every=every)


def table_stream(spark: SparkSession, table: str, schema: str, files_per_batch: int | None = None) -> DataFrame:
    """An append-only parquet table read as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    return reader.parquet(table)


def clean_stream(
    states: DataFrame, reference: DataFrame, rules: Rules = POSITION_RULES, warnings: Rules = POSITION_WARNINGS
) -> DataFrame:
    """Raw states to valid positions.

    Rules run on the de-duplicated rows: an invalid first arrival also stands for its copies.
    Broken rules are counted in the query progress before the drop.
    """
    positions = clean_states(states, reference)
    return keep_valid(observed(positions, {**rules, **warnings}), rules)


def write_positions(positions: DataFrame, table: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    return append_stream(positions, table, checkpoint, partition_by=["event_date"], every=every)


def dropped_by_watermark(query: StreamingQuery) -> int:
    """Rows that came too late for the watermark, over the batches whose progress the query still holds."""
    return sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)
