"""Tables, staged tables and Arrow batches shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``; below the warehouse, which is shared as well, where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/staged"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """The same rows from a table written to the shared folder: lineage ends there, and lost executors cost no recomputation."""
    path = shared_folder(df.sparkSession, name)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    df.sparkSession._jvm.System.gc()  # shuffle files of finished work go only when the driver collects its garbage
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_staged(df: DataFrame) -> None:
    """Delete the files of a staged table that nothing reads any more."""
    session = df.sparkSession._jsparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(session.sessionState().newHadoopConf()).delete(path, True)


def small_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes, so that very long texts do not meet in one batch."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def ready(spark: SparkSession) -> SparkSession:
    """Bounded batches, and this package on the workers' path when they share the driver's disk (else: ``--py-files``)."""
    small_batches(spark)
    env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH"), root]))
    return spark


def map_rows(df: DataFrame, fn: Callable[..., list], schema: str) -> DataFrame:
    """Apply ``fn(*columns as lists)`` to every Arrow batch; it returns the output columns as lists or Arrow arrays."""
    ready(df.sparkSession)
    fields = StructType.fromDDL(schema)
    target = to_arrow_schema(fields)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = fn(*(c.to_pylist() for c in batch.columns))
            yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, f.type) for x, f in zip(columns, target, strict=True)], schema=target)

    return df.mapInArrow(over, fields)
