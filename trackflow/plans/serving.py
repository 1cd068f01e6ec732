"""Listings read by people: live picture, queue, work picks, tracks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackflow.config import OPEN_STATUSES, STATUSES, TrackRules
from trackflow.functions.geo import nearest, point_id
from trackflow.functions.numbers import steady_round
from trackflow.functions.text import display_name
from trackflow.operators.joins import flag_members
from trackflow.plans.analytics import after


def latest_by(df: DataFrame, key: str, order: str, columns: Sequence[str]) -> DataFrame:
    """Last value of ``columns`` per key."""
    last = F.max(F.struct(order, *columns)).alias("last")
    return df.groupBy(key).agg(last).select(key, "last.*")


def active_keys(queue: DataFrame, now: Column, minutes: int = 3) -> DataFrame:
    """Keys holding within the last minutes."""
    held = after(queue.where("event_type = 'holding'"), "ended_at", now, f"{minutes} MINUTES")
    return held.select("icao24").distinct()


def live_picture(positions: DataFrame, queue: DataFrame, now: Column, minutes: int = 10) -> DataFrame:
    """Last airborne position of each key seen lately, with a holding flag and a label."""
    flying = after(positions, "event_ts", now, f"{minutes} MINUTES").where("NOT coalesce(on_ground, false)")
    seen = latest_by(flying, "icao24", "event_ts", ["callsign", "lat", "lon", "alt_ft"])
    return flag_members(seen, active_keys(queue, now), "icao24", "holding").select(
        "icao24", "callsign", "lat", "lon", steady_round(F.col("alt_ft"), 0).alias("alt_ft"), F.col("event_ts").alias("last_seen"),
        "holding", display_name(F.col("callsign"), F.col("icao24")).alias("label"),
    )


def expand_status(status: str) -> tuple[str, ...]:
    return {"open": OPEN_STATUSES, "all": STATUSES}.get(status, (status,))


def newest(events: DataFrame, limit: int, order: str = "started_at", tie: str = "event_id") -> DataFrame:
    return events.orderBy(F.col(order).desc(), tie).limit(limit)


def last_of_picked(picked: DataFrame, facts: DataFrame, order: Sequence[str]) -> DataFrame:
    """Latest fact of each picked event. Facts of other events are dropped before any shuffle."""
    ids = picked.select("event_id")
    rest = [c for c in facts.columns if c != "event_id"]
    last = F.max_by(F.struct(*rest), F.struct(*order)).alias("last")
    return facts.join(ids, "event_id", "left_semi").groupBy("event_id").agg(last).select("event_id", "last.*")


def event_queue(
    events: DataFrame, assessments: DataFrame, reviews: DataFrame, now: Column, hours: int = 24, limit: int = 200
) -> DataFrame:
    """Newest events with their latest assessment and latest review."""
    picked = newest(after(events, "started_at", now, f"{hours} HOURS"), limit)
    said = last_of_picked(
        picked,
        assessments.select("event_id", "created_at", "assessment_id", "cause", "severity", "confidence", "reasoning", "evidence", "model_version"),
        ["created_at", "assessment_id"],
    ).drop("created_at")
    judged = last_of_picked(
        picked,
        reviews.select("event_id", "reviewed_at", "review_id", "verdict", "corrected_cause", "notes", "reviewer"),
        ["reviewed_at", "review_id"],
    ).drop("review_id")
    return (
        picked.select(
            "event_id", "event_type", "location", "icao24", "callsign", "started_at", "ended_at",
            steady_round(F.col("duration_s") / 60.0, 1).alias("duration_min"), "status", "trigger_ts", "first_detected_at",
        )
        .join(said, "event_id", "left")
        .join(judged, "event_id", "left")
        .orderBy(F.col("started_at").desc(), "event_id")
    )


def open_events(
    events: DataFrame, assessments: DataFrame, reviews: DataFrame, now: Column,
    status: str = "open", hours: int = 6, limit: int = 20,
) -> DataFrame:
    """Newest events in a status set, with the latest opinion on each."""
    chosen = events.where(F.col("status").isin(*expand_status(status)))
    picked = newest(after(chosen, "started_at", now, f"{hours} HOURS"), limit)
    said = last_of_picked(
        picked, assessments.select("event_id", "created_at", "assessment_id", "cause", "confidence"),
        ["created_at", "assessment_id"],
    )
    judged = last_of_picked(
        picked, reviews.select("event_id", "reviewed_at", "review_id", "verdict", "corrected_cause"),
        ["reviewed_at", "review_id"],
    )
    return (
        picked.select(
            "event_id", "event_type", "icao24", "callsign", "location", "started_at", "ended_at", "duration_s", "status"
        )
        .join(said.select("event_id", F.col("cause").alias("agent_cause"), "confidence"), "event_id", "left")
        .join(judged.select("event_id", "verdict", "corrected_cause"), "event_id", "left")
    )


def next_to_assess(events: DataFrame, limit: int) -> DataFrame:
    """Oldest events nobody has assessed."""
    return (
        events.where("status = 'detected'")
        .orderBy("started_at", "event_id")
        .limit(limit)
        .select("event_id", "event_type", "icao24", "callsign", "location", "started_at", "ended_at")
    )


def recent_corrections(reviews: DataFrame, events: DataFrame, assessments: DataFrame, limit: int = 5) -> DataFrame:
    """Newest disagreements, with what had been said and what was put in its place."""
    return (
        reviews.where("verdict = 'disagree'")
        .join(events.select("event_id", "event_type", "location"), "event_id")
        .join(assessments.select("assessment_id", F.col("cause").alias("agent_cause")), "assessment_id")
        .orderBy(F.col("reviewed_at").desc(), F.col("review_id").desc())
        .limit(limit)
        .select("event_type", "location", "agent_cause", "corrected_cause", "notes")
    )


def forecast_series(forecasts: DataFrame, now: Column, hours: int = 48) -> DataFrame:
    return (
        after(forecasts, "target_hour", now, f"{hours} HOURS")
        .select(
            "target_hour", "predicted_mean_hold_min", "actual_mean_hold_min", "predicted_holding_flights",
            "actual_holding_flights", "abs_error", "status", "rationale", "model_version",
        )
        .orderBy("target_hour", "model_version")
    )


def track_window(
    positions: DataFrame, start: Column, end: Column, columns: Sequence[str], key: str | None = None
) -> DataFrame:
    """Reports between two instants, in order: of one key, or of all."""
    wanted = positions.where(F.col("event_ts").between(start, end))
    if key is not None:
        wanted = wanted.where(F.col("icao24") == key)
    return wanted.select("icao24", "event_ts", *columns).orderBy("icao24", "event_ts")


def track_windows(
    positions: DataFrame, start: Column, end: Column, columns: Sequence[str], keys: Sequence[str], day: str = "event_date"
) -> DataFrame:
    """Reports of a few keys between two instants, from a table clustered by day and key.

    Days, keys and times are plain predicates, so days that the span does not touch are not listed, and row groups whose
    ranges or bloom filters exclude every key are not read. No keys: no rows. The rows come unordered.
    """
    days = F.col(day).between(F.to_date(start), F.to_date(end))
    wanted = positions.where(days & F.col("event_ts").between(start, end) & F.col("icao24").isin(list(keys)))
    return wanted.select("icao24", "event_ts", *columns)


def downsample(positions: DataFrame, unit: str = "minute", rules: TrackRules = TrackRules()) -> DataFrame:
    """One row per key and minute: means, first heading, ground flag, and nearest points."""
    first = F.min(F.when(F.col("track_deg").isNotNull(), F.struct("event_ts", "track_deg")))["track_deg"]
    cut = positions.groupBy("icao24", F.date_trunc(unit, "event_ts").alias("minute")).agg(
        steady_round(F.avg("lat"), 4).alias("lat"),
        steady_round(F.avg("lon"), 4).alias("lon"),
        steady_round(F.avg("alt_ft"), 0).alias("alt_ft"),
        steady_round(F.avg("speed_kt"), 0).alias("speed_kt"),
        steady_round(first, 0).alias("track_deg"),
        steady_round(F.avg("vr_fpm"), 0).alias("vr_fpm"),
        F.max("on_ground").alias("on_ground"),
    )
    near = cut.select(
        "*", nearest("lat", "lon", rules.stacks).alias("stack"), nearest("lat", "lon", rules.runways).alias("rwy")
    )
    located = F.col("lat").isNotNull()
    columns = ["icao24", "minute", "alt_ft", "speed_kt", "track_deg", "vr_fpm", "on_ground"]
    return near.select(
        *columns,
        F.when(located, point_id(F.col("stack.rank"), rules.stacks)).alias("nearest_stack"),
        steady_round(F.col("stack.dist"), 1).alias("dist_stack_nm"),
        F.when(located, point_id(F.col("rwy.rank"), rules.runways)).alias("nearest_rwy"),
        steady_round(F.col("rwy.dist"), 1).alias("dist_rwy_nm"),
    )


def track_summary(positions: DataFrame, key: str = "icao24") -> DataFrame:
    """First and last report, count and altitude range per key."""
    return positions.groupBy(key).agg(
        F.count(F.lit(1)).alias("reports"),
        F.min("event_ts").alias("first_seen"),
        F.max("event_ts").alias("last_seen"),
        F.min("alt_ft").alias("min_alt_ft"),
        F.max("alt_ft").alias("max_alt_ft"),
        F.avg("alt_ft").alias("mean_alt_ft"),
    )
