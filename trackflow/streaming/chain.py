"""The whole chain by path: landing files to raw and clean tables, episodes, work queue and occupancy.

One cycle brings every table up to date with what has landed, and ends; a scheduler calls it again. Every step is idempotent:
streams go on from their checkpoints, merges write the same rows again. The progress of every stream is stored after
its run, so counts of late rows cover the whole life of the chain and not only the batches a query still remembers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trackflow import schemas
from trackflow.config import STACKS, Point, TrackRules
from trackflow.operators.episodes import conform
from trackflow.operators.occupancy import occupancy
from trackflow.operators.upsert import changed, merge_days, upsert_queue, write_days
from trackflow.streaming import detect, etl

QUEUE = schemas.EPISODES + ", status STRING, first_detected_at TIMESTAMP, updated_at TIMESTAMP"
PROGRESS = "step STRING, query_id STRING, run_id STRING, batch_id BIGINT, input_rows BIGINT, late_rows BIGINT, watermark STRING"
RAW, CLEAN, LOG, WORK, HELD, RUNS = "raw", "clean", "episode_log", "queue", "occupancy", "progress"


def store_progress(spark: SparkSession, query: StreamingQuery, step: str, path: str) -> None:
    """Append a row for every batch of the run that has just ended."""
    rows = [
        (step, str(p.id), str(p.runId), p.batchId, p.numInputRows, sum(op.numRowsDroppedByWatermark for op in p.stateOperators), dict(p.eventTime).get("watermark"))
        for p in query.recentProgress
    ]
    if rows:
        spark.createDataFrame(rows, PROGRESS).coalesce(1).write.mode("append").parquet(path)


def late_rows(spark: SparkSession, root: str) -> DataFrame:
    """Rows read and rows dropped as late by each step, over all cycles; a progress stored twice counts once."""
    once = spark.read.schema(PROGRESS).parquet(f"{root}/{RUNS}").dropDuplicates(["query_id", "run_id", "batch_id"])
    return once.groupBy("step").agg(F.sum("input_rows").alias("input_rows"), F.sum("late_rows").alias("late_rows"))


def prepare(spark: SparkSession, root: str) -> None:
    """Make the tables that later steps read, empty, where they are not there yet."""
    dated = ", event_date DATE"
    for name, schema in ((RAW, schemas.STATES), (CLEAN, "event_ts TIMESTAMP"), (WORK, QUEUE)):
        spark.createDataFrame([], schema + ("" if name == RAW else dated)).write.mode("append").parquet(f"{root}/{name}")


def update_queue(spark: SparkSession, root: str, now: Column) -> None:
    """New episodes join the queue as detected, longer ones move their end; what reviewers set stays."""
    found = conform(detect.fold_log(detect.read_log(spark, f"{root}/{LOG}")))
    known = spark.read.schema(QUEUE).parquet(f"{root}/{WORK}")
    merge_days(spark, f"{root}/{WORK}", changed(found, known), lambda t, s: upsert_queue(t, s, now), "started_at", schema=QUEUE + ", event_date DATE")


def update_occupancy(spark: SparkSession, root: str, start_s: int, end_s: int, points: tuple[Point, ...] = STACKS) -> None:
    """Occupancy of the given span; the days it touches are replaced, so give whole days or the whole span of interest."""
    episodes = conform(detect.fold_log(detect.read_log(spark, f"{root}/{LOG}")))
    write_days(occupancy(episodes, start_s, end_s, points), f"{root}/{HELD}", "minute")


def run_cycle(
    spark: SparkSession, landing: str, root: str, reference: DataFrame, span: tuple[int, int], rules: TrackRules = TrackRules(),
    now: Column | None = None,
) -> None:
    """Bring all tables below ``root`` up to date with the files in ``landing``; ``span`` is the occupancy's, in epoch seconds."""
    now = F.current_timestamp() if now is None else now
    prepare(spark, root)

    def done(step: str, query: StreamingQuery) -> None:
        query.awaitTermination()
        store_progress(spark, query, step, f"{root}/{RUNS}")

    at = lambda name: f"{root}/checkpoints/{name}"
    done(RAW, etl.land_states(spark, landing, f"{root}/{RAW}", at(RAW)))
    states = etl.table_stream(spark, f"{root}/{RAW}", schemas.STATES + ", source_file STRING")
    clean = etl.clean_stream(states, reference)
    schema = ", ".join(f"{n} {t}" for n, t in clean.dtypes)
    done(CLEAN, etl.write_positions(clean, f"{root}/{CLEAN}", at(CLEAN)))
    history = lambda: spark.read.schema(schema).parquet(f"{root}/{CLEAN}")
    done(LOG, detect.detect_stream(etl.table_stream(spark, f"{root}/{CLEAN}", schema), history, f"{root}/{LOG}", at(LOG), rules, lambda: now))
    update_queue(spark, root, now)
    update_occupancy(spark, root, *span)
