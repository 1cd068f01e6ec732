"""Change logs: rebuild current rows, fold lifecycles, produce a log from two snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackflow.config import ChangeLogColumns
from trackflow.functions.times import seconds_between

LOG = ChangeLogColumns()


def last_states(log: DataFrame, key: str, names: ChangeLogColumns = LOG) -> DataFrame:
    """``key`` and ``row``, the other columns of its change of the highest order, deletes included; pre-images and null keys are left out.

    One scan with a grouped maximum, which combines before the shuffle: a key with very many changes costs one row per task.
    Of the folds of parts of a log, ``merged_states`` makes the fold of the log, in any order and however often a part is repeated.
    """
    states = log.where(F.col(names.kind).isin("insert", "update_postimage", "delete") & F.col(key).isNotNull())
    rest = [c for c in log.columns if c != key]
    return states.groupBy(key).agg(F.max_by(F.struct(*rest), names.order).alias("row"))


def merged_states(parts: DataFrame, key: str, names: ChangeLogColumns = LOG) -> DataFrame:
    return parts.groupBy(key).agg(F.max_by("row", F.col("row").getField(names.order)).alias("row"))


def live_rows(states: DataFrame, key: str, names: ChangeLogColumns = LOG) -> DataFrame:
    """The rows of keys whose last change is no delete."""
    return states.select(key, "row.*").where(F.col(names.kind) != "delete")


def current_rows(log: DataFrame, key: str, names: ChangeLogColumns = LOG) -> DataFrame:
    """Last state of each key; pre-images are ignored, deleted and null keys vanish."""
    return live_rows(last_states(log, key, names), key, names)


LIFE_FACTS = ("event_type", "location", "status", "duration_s")
LIFE_TIMES = ("detected_at", "trigger_ts", "assessed_at", "reviewed_at")


def life_facts(log: DataFrame, names: ChangeLogColumns = LOG) -> DataFrame:
    """One row per event: its last facts with their order, and the first time of each step. Folds of parts merge as for states."""
    at, status = F.col(names.at), F.col("status")
    return (
        log.where(F.col(names.kind).isin("insert", "update_postimage"))
        .groupBy("event_id")
        .agg(
            F.max_by(F.struct(F.col(names.order).alias("order"), *LIFE_FACTS), names.order).alias("last"),
            F.min("first_detected_at").alias("detected_at"),
            F.min("trigger_ts").alias("trigger_ts"),
            F.min(F.when(status == "assessed", at)).alias("assessed_at"),
            F.min(F.when(status.isin("confirmed", "rejected"), at)).alias("reviewed_at"),
        )
    )


def merged_life_facts(parts: DataFrame) -> DataFrame:
    return parts.groupBy("event_id").agg(F.max_by("last", F.col("last.order")).alias("last"), *[F.min(n).alias(n) for n in LIFE_TIMES])


def lifecycles_of(facts: DataFrame) -> DataFrame:
    """Lifecycles from one row of facts per event."""
    return facts.select(
        "event_id",
        F.col("last.event_type").alias("event_type"),
        F.col("last.location").alias("location"),
        F.col("last.status").alias("current_status"),
        F.col("last.duration_s").alias("duration_s"),
        *LIFE_TIMES,
        seconds_between(F.col("detected_at"), F.col("trigger_ts")).alias("detection_latency_s"),
        seconds_between(F.col("assessed_at"), F.col("detected_at")).alias("time_to_assess_s"),
        seconds_between(F.col("reviewed_at"), F.col("detected_at")).alias("time_to_review_s"),
    )


def lifecycle(log: DataFrame, names: ChangeLogColumns = LOG) -> DataFrame:
    """When each event was detected, assessed and reviewed. Deleted events stay in."""
    return lifecycles_of(life_facts(log, names))


def log_from_snapshots(
    before: DataFrame, after: DataFrame, key: Sequence[str], step: int, names: ChangeLogColumns = LOG
) -> DataFrame:
    """Change rows turning ``before`` into ``after``: inserts, deletes, and update image pairs.

    The order number is the step, doubled so that an update's post-image follows its pre-image.
    """
    values = [c for c in after.columns if c not in key]
    old = before.select(*key, F.struct(*values).alias("old"))
    new = after.select(*key, F.struct(*values).alias("new"))
    change = F.struct
    kinds = (
        F.when(F.col("old").isNull(), F.array(change(F.lit("insert").alias("k"), F.lit(1).alias("n"), F.col("new").alias("v"))))
        .when(F.col("new").isNull(), F.array(change(F.lit("delete").alias("k"), F.lit(1).alias("n"), F.col("old").alias("v"))))
        .otherwise(
            F.array(
                change(F.lit("update_preimage").alias("k"), F.lit(0).alias("n"), F.col("old").alias("v")),
                change(F.lit("update_postimage").alias("k"), F.lit(1).alias("n"), F.col("new").alias("v")),
            )
        )
    )
    return (
        old.join(new, list(key), "full_outer")
        .where(~F.col("old").eqNullSafe(F.col("new")))
        .select(*key, F.explode(kinds).alias("c"))
        .select(
            *key, "c.v.*", F.col("c.k").alias(names.kind), (F.lit(2 * step) + F.col("c.n")).cast("long").alias(names.order)
        )
    )
