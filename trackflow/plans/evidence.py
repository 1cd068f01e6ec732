"""What is known around each event, for all events at once, and the rule-based cause label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackflow.functions.times import plus_seconds
from trackflow.operators.joins import asof_join, interval_join


def weather_for_events(events: DataFrame, weather: DataFrame, before_s: int = 3600) -> DataFrame:
    """Observations from an hour before each event to its end."""
    observed = weather.where("kind = 'metar'").drop("kind", "fetched_ts")
    ids = events.select("event_id", "started_at", "ended_at")
    return interval_join(
        ids, observed, plus_seconds(F.col("started_at"), -before_s), F.col("ended_at"), "obs_time"
    ).drop("started_at", "ended_at")


def latest_outlook(events: DataFrame, weather: DataFrame) -> DataFrame:
    """The forecast report in force when each event ended."""
    outlooks = weather.where("kind = 'taf'").select("obs_time", F.col("raw_text").alias("outlook"))
    return asof_join(events.select("event_id", "ended_at"), outlooks, "ended_at", "obs_time", ["outlook"]).select(
        "event_id", F.col("last_obs_time").alias("issued_at"), "outlook"
    )


def weather_evidence(events: DataFrame, weather: DataFrame) -> DataFrame:
    """Worst values per event, and the wind direction of the last report that gives one."""
    direction = F.max(F.when(F.col("wind_dir_deg").isNotNull(), F.struct("obs_time", "wind_dir_deg")))
    return (
        weather_for_events(events, weather)
        .groupBy("event_id")
        .agg(
            F.count(F.lit(1)).alias("reports"),
            F.max("wind_kt").alias("max_wind_kt"),
            F.max("gust_kt").alias("max_gust_kt"),
            F.min("visibility_sm").alias("min_visibility_sm"),
            F.min("ceiling_ft").alias("min_ceiling_ft"),
            F.coalesce(F.max(F.col("flight_category").isin("IFR", "LIFR")), F.lit(False)).alias("instrument_weather"),
            direction.alias("d"),
        )
        .select("*", F.col("d.wind_dir_deg").alias("wind_dir_deg"))
        .drop("d")
    )


def track_evidence(events: DataFrame, minutes: DataFrame) -> DataFrame:
    """How close each event's key came to a stack and a runway while it lasted.

    ``minutes`` is a track cut down to one row per key and minute, so an event meets at most as
    many rows as it has minutes.
    """
    ids = events.select("event_id", "icao24", "started_at", "ended_at")
    near = minutes.select("icao24", "minute", "alt_ft", "dist_stack_nm", "dist_rwy_nm")
    start = F.date_trunc("minute", "started_at")
    return (
        interval_join(ids, near, start, F.col("ended_at"), "minute", on=["icao24"])
        .groupBy("event_id")
        .agg(
            F.count(F.lit(1)).alias("track_minutes"),
            F.min("alt_ft").alias("track_min_alt_ft"),
            F.min("dist_stack_nm").alias("track_dist_stack_nm"),
            F.min("dist_rwy_nm").alias("track_dist_rwy_nm"),
        )
    )


def busy_places(events: DataFrame, occupancy: DataFrame) -> DataFrame:
    """Places with at least one holding key in the minute each event ended."""
    busy = occupancy.where("holding_count > 0").groupBy("minute").agg(F.count(F.lit(1)).alias("busy_stacks"))
    ids = events.select("event_id", F.date_trunc("minute", "ended_at").alias("minute"))
    return ids.join(busy, "minute", "left").select(
        "event_id", F.coalesce("busy_stacks", F.lit(0)).alias("busy_stacks")
    )


def evidence_bundle(events: DataFrame, minutes: DataFrame, weather: DataFrame, occupancy: DataFrame) -> DataFrame:
    """One row per event with all of the above."""
    return (
        events.select("event_id", "event_type", "location", "duration_s", "started_at", "ended_at")
        .join(track_evidence(events, minutes), "event_id", "left")
        .join(weather_evidence(events, weather), "event_id", "left")
        .join(latest_outlook(events, weather), "event_id", "left")
        .join(busy_places(events, occupancy), "event_id", "left")
    )


def _holds(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def with_repeats(bundle: DataFrame, events: DataFrame) -> DataFrame:
    """Add ``repeated``: the event is one of several go-arounds of its key."""
    tries = events.where("event_type = 'go_around'")
    several = tries.groupBy("icao24").agg(F.count(F.lit(1)).alias("tries")).where("tries > 1").select("icao24")
    ids = tries.join(several, "icao24").select("event_id", F.lit(True).alias("repeated"))
    return bundle.join(ids, "event_id", "left").withColumn("repeated", F.coalesce("repeated", F.lit(False)))


def label_causes(bundle: DataFrame) -> DataFrame:
    """Cause by fixed thresholds, tried in order; severity by the length of the hold, busy stacks and repeated go-arounds.

    A go-around on a runway the wind speaks against counts as a runway change: wind from 140 to
    320 degrees favours westerly landings.
    """
    westerly = F.col("wind_dir_deg").between(140, 320)
    facing_west = F.col("location").startswith("27")
    windy = _holds(F.col("max_gust_kt") >= 25) | _holds(F.col("max_wind_kt") >= 20)
    murky = _holds(F.col("min_visibility_sm") < 3) | _holds(F.col("min_ceiling_ft") < 1000) | _holds(
        F.col("instrument_weather")
    )
    crossed = _holds((F.col("event_type") == "go_around") & (westerly != facing_west))
    cause = (
        F.when(windy, "wind")
        .when(murky, "low_visibility_cloud")
        .when(crossed, "runway_change")
        .when(F.col("busy_stacks") >= 2, "traffic_volume")
        .otherwise("other")
    )
    several = F.col("repeated") if "repeated" in bundle.columns else F.lit(False)
    severe, moderate = (F.col("duration_s") > 1200) | several, (F.col("duration_s") >= 600) | (F.col("busy_stacks") >= 2)
    severity = F.when(severe, 3).when(moderate, 2).otherwise(1)
    return bundle.select("event_id", cause.alias("cause"), severity.alias("severity"))
