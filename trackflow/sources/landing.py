"""Landing folders, partitioned and clustered tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def landing_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int | None = None) -> DataFrame:
    """JSON lines below ``path`` (day folders included) as a stream with a fixed schema."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    return reader.json(path)


def landing_batch(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("recursiveFileLookup", "true").json(path)


def with_lineage(df: DataFrame) -> DataFrame:
    """Where and when each row came in."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("source_file"),
        F.current_timestamp().alias("ingested_at"),
        F.to_date(F.current_timestamp()).alias("ingest_date"),
    )


def append_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: Sequence[str] = ("ingest_date",),
    every: str | None = None,
) -> StreamingQuery:
    """Append a stream to a parquet table; without ``every`` it handles what is there and ends."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return writer.partitionBy(*partition_by).trigger(**trigger).start(path)


def write_clustered(
    df: DataFrame,
    path: str,
    day: str,
    cluster_by: Sequence[str],
    mode: str = "append",
    lookup: Sequence[str] = (),
    lookup_values: int = 100_000,
    row_group_bytes: int | None = None,
) -> None:
    """Write by day, files sorted by ``cluster_by``.

    Rows are range-partitioned on day and all cluster columns, so a busy key splits at its time
    column and each file covers a narrow range that readers can skip by. Columns in ``lookup`` get a
    bloom filter in each row group, sized for ``lookup_values`` different values, so that a search
    for one value also skips groups whose range holds it but whose rows do not: in small appended
    files, and by columns that the files are not sorted by. ``row_group_bytes`` sets how much is
    skipped or read at once; by default the format's own size.
    """
    writer = df.repartitionByRange(day, *cluster_by).sortWithinPartitions(day, *cluster_by).write.mode(mode)
    for column in lookup:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{column}", str(lookup_values))
    if row_group_bytes:
        writer = writer.option("parquet.block.size", str(row_group_bytes))
    writer.partitionBy(day).parquet(path)


def append_log(df: DataFrame, path: str, schema: str) -> None:
    """Append typed rows to a log table."""
    columns = [part.rsplit(" ", 1) for part in schema.split(", ")]
    df.select(*[F.col(n).cast(t.lower()).alias(n) for n, t in columns]).write.mode("append").parquet(path)
