"""Episode detection on a stream of positions.

Each micro-batch looks at the keys it brought, one look-back to either side of their new reports, with the same
operators as a batch run, so a backlog or a report from the future loses nothing, and one old report reads the days around it
and no others. Episodes near the left edge of a span may have begun before it and are left to earlier batches, unless the key has no report just before the window. What is new or extended is appended to an episode log; the current episode table
is a fold of that log. A repeated batch replaces its own log entries, so it changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trackflow import schemas
from trackflow.config import TrackRules
from trackflow.functions.times import SECOND, bucket, micros
from trackflow.operators.episodes import conform, episodes
from trackflow.operators.upsert import merge_days

LOG_SCHEMA = schemas.EPISODES + ", detected_at TIMESTAMP, batch_id BIGINT, event_date DATE"


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).parquet(path)


def fold_log(log: DataFrame) -> DataFrame:
    """Current episodes: identity and first detection from the first entry, extent from the last."""
    fixed = F.struct("event_type", "icao24", "location", "started_at", "trigger_ts", "detected_at")
    extent = F.struct("ended_at", "duration_s", "n_points", "detected_at")
    named = F.when(F.col("callsign").isNotNull(), F.struct("ended_at", "callsign"))
    return (
        log.groupBy("event_id")
        .agg(
            F.min_by(fixed, "ended_at").alias("first"),
            F.max_by(extent, "ended_at").alias("last"),
            F.max(named).alias("named"),
            F.min("min_alt_ft").alias("min_alt_ft"),
            F.max("max_alt_ft").alias("max_alt_ft"),
            F.max("max_turn_deg").alias("max_turn_deg"),
        )
        .select(
            "event_id", "first.event_type", "first.icao24", F.col("named.callsign").alias("callsign"), "first.location",
            "first.started_at", "last.ended_at", "last.duration_s", "first.trigger_ts", "min_alt_ft", "max_alt_ft",
            "max_turn_deg", "last.n_points", F.col("first.detected_at").alias("first_detected_at"),
            F.col("last.detected_at").alias("updated_at"),
        )
    )


def later_or_new(found: DataFrame, current: DataFrame) -> DataFrame:
    """Episodes the table does not hold yet, or holds with an earlier end."""
    known = current.select("event_id", F.col("ended_at").alias("known_end"))
    return found.join(known, "event_id", "left").where("known_end IS NULL OR ended_at > known_end").drop("known_end")


def write_entries(found: DataFrame, batch_id: int, path: str, now: Column) -> None:
    """Log entries of one batch, in the days where their episodes began; a repeated batch replaces its own entries.

    The touched days are rewritten, so a day's entries stay in few files however many batches bring some.
    """
    entries = found.withColumn("detected_at", now).withColumn("batch_id", F.lit(batch_id).cast("long"))
    others = lambda log, new: log.where(F.col("batch_id") != batch_id).unionByName(new)
    merge_days(found.sparkSession, path, entries, others, "started_at", schema=LOG_SCHEMA)


def affected_spans(batch: DataFrame, rules: TrackRules = TrackRules()) -> DataFrame:
    """Key, ``from_us`` and ``to_us``: the spans of each key's track that its new reports can change, one look-back to either side.

    Spans that overlap are one. A key has as many rows as its new reports touch look-backs.
    """
    c, look = rules.columns, rules.lookback_s * SECOND
    us = micros(F.col(c.ts))
    cells = batch.where(us.isNotNull()).groupBy(c.key, bucket(us, look).alias("cell")).agg((F.min(us) - look).alias("lo"), (F.max(us) + look).alias("hi"))
    in_order = Window.partitionBy(c.key).orderBy("cell")
    apart = F.col("lo") > F.max("hi").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    numbered = cells.withColumn("apart", F.coalesce(apart, F.lit(True)).cast("int")).withColumn("span", F.sum("apart").over(in_order))
    return numbered.groupBy(c.key, "span").agg(F.min("lo").alias("from_us"), F.max("hi").alias("to_us")).drop("span")


def spans_days(spans: DataFrame, rules: TrackRules = TrackRules()) -> list:
    """The days that any span touches, a calendar's worth at most: only their partitions are read."""
    first, last = (F.to_date(F.timestamp_micros(x)) for x in (F.col("from_us") - rules.visit_gap_s * SECOND, F.col("to_us")))
    return sorted(r[0] for r in spans.select(F.explode(F.sequence(first, last))).distinct().collect())


def detect_stream(
    positions: DataFrame,
    history: Callable[[], DataFrame],
    log_path: str,
    checkpoint: str,
    rules: TrackRules = TrackRules(),
    now: Callable[[], Column] = F.current_timestamp,
    every: str | None = None,
) -> StreamingQuery:
    """Run detection for every micro-batch of ``positions``; ``history`` reads the position table."""
    c = rules.columns
    spark = positions.sparkSession

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spans = affected_spans(batch, rules).persist()
        try:
            days = spans_days(spans, rules)
            if not days:
                return
            margin, window_start = F.make_dt_interval(secs=F.lit(float(rules.edge_margin_s))), F.timestamp_micros("from_us")
            us = micros(F.col(c.ts))
            read = history().where(F.col("event_date").isin(days)).join(spans, c.key).where((us > F.col("from_us") - rules.visit_gap_s * SECOND) & (us <= F.col("to_us"))).drop("to_us")
            edge = ["icao24", "from_us"]
            cut = read.where(us <= F.col("from_us")).select(F.col(c.key).cast("string").alias("icao24"), "from_us").distinct().withColumn("is_cut", F.lit(True))
            every = episodes(read.where(us > F.col("from_us")), rules, by=["from_us"])
            whole = every.join(cut, edge, "left").where(F.col("is_cut").isNull() | (F.col("started_at") >= window_start + margin))
            earlier = read_log(spark, log_path).where(F.col("event_date").isin(days) & (F.col("batch_id") < batch_id))
            write_entries(later_or_new(conform(whole), fold_log(earlier)), batch_id, log_path, now())
        finally:
            spans.unpersist()

    spark.createDataFrame([], LOG_SCHEMA).write.mode("append").parquet(log_path)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return positions.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint).trigger(**trigger).start()
