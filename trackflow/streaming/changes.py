"""Change-feed views that follow a log: each micro-batch is folded by itself and touches no key but its own.

A batch leaves one row per key it brought: the last state with its order number (deletes are kept as such, so that an older change that
comes later cannot bring a key back) and the facts of its lifecycle. The views fold these rows. The folds are maxima by order
and minima, so batches may come in any order and a repeated batch changes nothing. ``compact`` folds the batches into one
table, so that a view reads one row per key and batch since then.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from trackflow.config import ChangeLogColumns
from trackflow.operators import cdc

VIEWS = ("states", "life")


def follow_changes(
    log: DataFrame, folds: str, key: str, checkpoint: str, names: ChangeLogColumns = cdc.LOG, every: str | None = None
) -> StreamingQuery:
    """Fold every micro-batch of a change log into ``folds``, a folder that a repeated batch overwrites in its own part only."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.DISK_ONLY)
        try:
            for view, rows in zip(VIEWS, (cdc.last_states(batch, key, names), cdc.life_facts(batch, names)), strict=True):
                rows.write.mode("overwrite").parquet(f"{folds}/{view}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return log.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def parts(spark: SparkSession, folds: str, view: str) -> DataFrame:
    return spark.read.parquet(f"{folds}/{view}").drop("batch_id")


def merged(spark: SparkSession, folds: str, view: str, key: str, names: ChangeLogColumns = cdc.LOG) -> DataFrame:
    rows = parts(spark, folds, view)
    return cdc.merged_states(rows, key, names) if view == "states" else cdc.merged_life_facts(rows)


def compact(spark: SparkSession, folds: str, key: str, names: ChangeLogColumns = cdc.LOG) -> None:
    """Fold all parts so far into one with a new negative number, then delete them; not while a batch is being written.

    Should the job stop in between, rows are there twice, which the folds do not mind; none is ever missing.
    """
    for view in VIEWS:
        done = sorted(r[0] for r in spark.read.parquet(f"{folds}/{view}").select("batch_id").distinct().collect())  # folders, not rows
        merged(spark, folds, view, key, names).write.mode("overwrite").parquet(f"{folds}/{view}/batch_id={min(done[0], 0) - 1}")
        for part in done:
            path = spark._jvm.org.apache.hadoop.fs.Path(f"{folds}/{view}/batch_id={part}")
            path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def current(spark: SparkSession, folds: str, key: str, names: ChangeLogColumns = cdc.LOG) -> DataFrame:
    """The live rows after all batches so far."""
    return cdc.live_rows(merged(spark, folds, "states", key, names), key, names)


def lifecycles(spark: SparkSession, folds: str) -> DataFrame:
    """The lifecycles after all batches so far."""
    return cdc.lifecycles_of(merged(spark, folds, "life", "event_id"))
