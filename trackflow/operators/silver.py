"""Cleaning of landing rows: staleness, units, de-duplication, enrichment, weather parsing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackflow.functions import units
from trackflow.functions.geo import ceiling
from trackflow.functions.text import blank_to_null, clean_key
from trackflow.functions.times import whole_seconds


def fresh(states: DataFrame, max_age_s: float = 60) -> DataFrame:
    """Drop repeats of an old position: fetched more than ``max_age_s`` after it was measured."""
    return states.where(F.col("fetched_at") - F.col("time_position") <= max_age_s)


def to_positions(states: DataFrame) -> DataFrame:
    """Clean names, instants and aviation units. Geometric altitude goes before barometric."""
    kept = [c for c in ("source_file",) if c in states.columns]
    return states.select(
        clean_key(F.col("icao24")).alias("icao24"),
        blank_to_null(F.col("callsign")).alias("callsign"),
        whole_seconds(F.col("time_position")).alias("event_ts"),
        whole_seconds(F.col("fetched_at")).alias("fetched_ts"),
        F.col("latitude").alias("lat"),
        F.col("longitude").alias("lon"),
        units.metres_to_feet(F.coalesce("geo_altitude", "baro_altitude")).alias("alt_ft"),
        units.metres_to_feet(F.col("baro_altitude")).alias("baro_alt_ft"),
        units.ms_to_knots(F.col("velocity")).alias("speed_kt"),
        F.col("true_track").alias("track_deg"),
        units.ms_to_fpm(F.col("vertical_rate")).alias("vr_fpm"),
        "on_ground",
        "transponder_code",
        *kept,
    )


def first_of(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in ``order``.

    The filter on the row number lets Spark cut each key down to one row before the shuffle, so a
    heap of copies of one key never meets in one task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")


def dedupe(positions: DataFrame, keys: Sequence[str] = ("icao24", "event_ts"), delay: str = "2 minutes") -> DataFrame:
    """One row per key and instant: first arrival on a stream, earliest fetch in a batch."""
    if positions.isStreaming:
        return positions.withWatermark("event_ts", delay).dropDuplicatesWithinWatermark(list(keys))
    rest = [c for c in positions.columns if c not in (*keys, "fetched_ts")]
    return first_of(positions, keys, [F.col("fetched_ts"), *[F.col(c) for c in rest]])


def enrich(positions: DataFrame, reference: DataFrame, key: str = "icao24") -> DataFrame:
    """Left join with the reference table.

    No hint is given: the planner broadcasts the reference only while its measured size is below
    ``spark.sql.autoBroadcastJoinThreshold``, and beyond that sorts and merges, where adaptive
    execution splits a busy key's partition.
    """
    return positions.join(reference, key, "left")


def clean_states(states: DataFrame, reference: DataFrame, max_age_s: float = 60, delay: str = "2 minutes") -> DataFrame:
    """Landing rows to enriched positions, the same for stream and batch."""
    unique = dedupe(to_positions(fresh(states, max_age_s)), delay=delay)
    return enrich(unique.withColumn("event_date", F.to_date("event_ts")), reference)


REPORT = (
    "wdir STRING, wspd STRING, wgst STRING, visib STRING, clouds ARRAY<STRUCT<cover: STRING, base: INT>>, "
    "fltCat STRING, rawOb STRING, rawTAF STRING"
)


def parse_weather(raw: DataFrame) -> DataFrame:
    """Columns of each report, from one parse of its JSON; text where a number is expected reads as null."""
    fetched = raw.select("kind", "obs_time", "fetched_at", F.from_json("raw_json", REPORT).alias("r"))
    return fetched.select(
        "kind",
        F.timestamp_seconds("obs_time").alias("obs_time"),
        whole_seconds(F.col("fetched_at")).alias("fetched_ts"),
        F.col("r.wdir").try_cast("int").alias("wind_dir_deg"),
        F.col("r.wspd").try_cast("int").alias("wind_kt"),
        F.col("r.wgst").try_cast("int").alias("gust_kt"),
        F.replace("r.visib", F.lit("+"), F.lit("")).try_cast("double").alias("visibility_sm"),
        ceiling(F.col("r.clouds")).alias("ceiling_ft"),
        F.col("r.fltCat").alias("flight_category"),
        F.coalesce("r.rawOb", "r.rawTAF").alias("raw_text"),
    )


def latest_reports(parsed: DataFrame) -> DataFrame:
    """Last fetch of each (kind, observation time)."""
    known = parsed.where("obs_time IS NOT NULL")
    return first_of(known, ["kind", "obs_time"], [F.col("fetched_ts").desc(), F.col("raw_text").desc()])


def weather(raw: DataFrame) -> DataFrame:
    return latest_reports(parse_weather(raw))


def without_prefix(df: DataFrame, prefix: str = "ffff", key: str = "icao24") -> DataFrame:
    """Leave out injected test keys."""
    return df.where(~F.col(key).startswith(prefix))
