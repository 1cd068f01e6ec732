"""Merging into tables, written as joins of the current table with the incoming rows.

Each operator returns the next content of the rows it is given. ``merge_days`` applies one of them to a stored table
and reads and rewrites only the days that the incoming rows touch. Where a catalog offers MERGE the same column
policies apply through ``DataFrame.mergeInto``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackflow.operators.silver import first_of
from trackflow.session import shared_folder


def extend_later(
    target: DataFrame, source: DataFrame, key: str, policy: Mapping[str, Column], later: str = "ended_at"
) -> DataFrame:
    """Insert new keys; where the source ends later, set the columns in ``policy``; keep all else.

    Policies are written on ``t`` (target) and ``s`` (source). Columns without one never change.
    """
    grows = F.col(f"s.{later}") > F.col(f"t.{later}")
    columns = []
    for name in target.columns:
        old, new = F.col(f"t.{name}"), F.col(f"s.{name}")
        kept = F.when(grows, policy[name]).otherwise(old) if name in policy else old
        columns.append(F.when(F.col(f"t.{key}").isNull(), new).otherwise(kept).alias(name))
    joined = target.alias("t").join(source.alias("s"), F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer")
    return joined.select(*columns)


def merge_episodes(target: DataFrame, found: DataFrame, now: Column) -> DataFrame:
    """Next content of the episode table. Start, trigger, place and first detection never change."""
    s, t = (lambda n: F.col(f"s.{n}")), (lambda n: F.col(f"t.{n}"))
    policy = {
        "ended_at": s("ended_at"),
        "duration_s": s("duration_s"),
        "callsign": F.coalesce(s("callsign"), t("callsign")),
        "min_alt_ft": F.least(s("min_alt_ft"), t("min_alt_ft")),
        "max_alt_ft": F.greatest(s("max_alt_ft"), t("max_alt_ft")),
        "max_turn_deg": F.greatest(s("max_turn_deg"), t("max_turn_deg")),
        "n_points": s("n_points"),
        "updated_at": s("updated_at"),
    }
    stamped = found.withColumn("first_detected_at", now).withColumn("updated_at", now)
    return extend_later(target, stamped, "event_id", policy)


def upsert_queue(target: DataFrame, found: DataFrame, now: Column) -> DataFrame:
    """Next content of the work queue. Status belongs to its reviewers and is never touched."""
    s, t = (lambda n: F.col(f"s.{n}")), (lambda n: F.col(f"t.{n}"))
    policy = {
        "ended_at": s("ended_at"),
        "duration_s": s("duration_s"),
        "callsign": F.coalesce(s("callsign"), t("callsign")),
        "updated_at": s("updated_at"),
    }
    fresh = found.select("*", F.lit("detected").alias("status"), now.alias("first_detected_at"), now.alias("updated_at"))
    return extend_later(target, fresh, "event_id", policy)


def write_days(df: DataFrame, path: str, at: str, day: str = "event_date") -> None:
    """Replace the days that ``df`` holds in a table partitioned by the day of ``at``; other days stay as they are."""
    dated = df.withColumn(day, F.to_date(at))
    dated.repartition(day, F.date_trunc("hour", at)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def merge_days(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    merge: Callable[[DataFrame, DataFrame], DataFrame],
    at: str,
    day: str = "event_date",
    schema: str | None = None,
) -> None:
    """Merge ``source`` into the table at ``path``, partitioned by the day of ``at``, through ``merge(target, source)``.

    A row's day must not change by the merge. Only the touched days are read (a partition filter) and replaced; their next
    content is written to the shared folder first, since a table cannot be overwritten while it is read. ``source`` is
    computed once and kept on disk meanwhile, as its days and its rows are asked for apart.
    """
    # a plan of its own, so a cache of the caller stays; lost blocks are made again, as the table is replaced only after the last read
    source = source.select("*").persist(StorageLevel.DISK_ONLY)
    try:
        days = sorted(r[0] for r in source.select(F.to_date(at)).distinct().collect() if r[0])  # a calendar's worth at most
        table = (spark.read.schema(schema) if schema else spark.read).parquet(path)
        touched = table.where(F.col(day).isin(days)).drop(day)
        scratch = shared_folder(spark, "merge")
        merge(touched, source).write.parquet(scratch)
    finally:
        source.unpersist()
    write_days(spark.read.parquet(scratch), path, at, day)


def changed(found: DataFrame, target: DataFrame, key: str = "event_id", mark: str = "ended_at") -> DataFrame:
    """Rows that are new or whose mark differs from the table's."""
    return found.join(target.select(key, mark), [key, mark], "left_anti")


def replace_by_key(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows win over target rows of the same key; the rest stays."""
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return kept.unionByName(source)


def insert_absent(target: DataFrame, source: DataFrame, unique: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Rows of ``source`` to append: unique key not in the table, first of its key in the batch."""
    absent = source.join(target.select(*unique), list(unique), "left_anti")
    return first_of(absent, unique, order)


def mark_assessed(queue: DataFrame, assessed: DataFrame, now: Column, key: str = "event_id") -> DataFrame:
    """Move detected events with an assessment to assessed; later states are never overwritten."""
    hit = assessed.select(key).distinct().withColumn("__hit", F.lit(True))
    moves = (F.col("status") == "detected") & F.col("__hit").isNotNull()
    return (
        queue.join(hit, key, "left")
        .withColumn("updated_at", F.when(moves, now).otherwise(F.col("updated_at")))
        .withColumn("status", F.when(moves, "assessed").otherwise(F.col("status")))
        .select(*queue.columns)
    )


def apply_reviews(queue: DataFrame, reviews: DataFrame, key: str = "event_id") -> DataFrame:
    """Status by the latest review: rejected when it is no event, confirmed otherwise."""
    verdict = F.max(F.struct("reviewed_at", "review_id", "verdict")).alias("last")
    latest = reviews.groupBy(key).agg(verdict)
    seen = F.col("last").isNotNull()
    outcome = F.when(F.col("last.verdict") == "not_an_event", "rejected").otherwise("confirmed")
    return (
        queue.join(latest, key, "left")
        .withColumn("status", F.when(seen, outcome).otherwise(F.col("status")))
        .withColumn("updated_at", F.when(seen, F.col("last.reviewed_at")).otherwise(F.col("updated_at")))
        .select(*queue.columns)
    )


def due(forecasts: DataFrame, now: Column, delay: str = "65 minutes") -> DataFrame:
    """Pending forecasts whose hour ended long enough ago."""
    return forecasts.where((F.col("status") == "pending") & (F.col("target_hour") + F.expr(f"INTERVAL {delay}") <= now))


def score_forecasts(forecasts: DataFrame, hourly: DataFrame, now: Column) -> DataFrame:
    """Fill in actuals and errors of due forecasts; an hour without episodes counts as zero."""
    actual = hourly.select(F.col("hour").alias("target_hour"), "mean_hold_min", "holding_flights")
    ready = (F.col("status") == "pending") & (F.col("target_hour") + F.expr("INTERVAL 65 MINUTES") <= now)
    mean = F.coalesce("mean_hold_min", F.lit(0.0))
    return forecasts.join(actual, "target_hour", "left").select(
        *[c for c in forecasts.columns if c != "status"],
        F.when(ready, mean).alias("actual_mean_hold_min"),
        F.when(ready, F.coalesce("holding_flights", F.lit(0)).cast("int")).alias("actual_holding_flights"),
        F.when(ready, F.abs(F.col("predicted_mean_hold_min") - mean)).alias("abs_error"),
        F.when(ready, "scored").otherwise(F.col("status")).alias("status"),
    )


def missing_forecasts(expected: DataFrame, forecasts: DataFrame) -> DataFrame:
    """(target_hour, model_version) pairs that have no forecast yet."""
    keys = ["target_hour", "model_version"]
    return expected.join(forecasts.select(*keys), keys, "left_anti")


def cascade_delete(
    parents: DataFrame, children: Mapping[str, DataFrame], doomed: Column, key: str = "event_id"
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Remove parents matching ``doomed`` and every child row pointing at one."""
    gone = parents.where(doomed).select(key)
    kept = {name: child.join(gone, key, "left_anti") for name, child in children.items()}
    return parents.where(~F.coalesce(doomed, F.lit(False))), kept
