"""Session helpers for local runs; on a cluster the caller brings its own session."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session with the settings the library is tested under; its warehouse is a new temporary folder."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("trackflow")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="trackflow-"))
        .getOrCreate()
    )


def use_utc(spark: SparkSession) -> SparkSession:
    """All instants are UTC; day and hour buckets depend on it."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, on every master; below the warehouse, which is shared as well, where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/staged"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
