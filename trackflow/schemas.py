"""Explicit schemas. Nothing is inferred from data."""

from __future__ import annotations

# Landing rows (fixed field names and order of the feed).
STATES = (
    "poll_id STRING, fetched_at DOUBLE, api_time BIGINT, icao24 STRING, callsign STRING, "
    "origin_country STRING, time_position BIGINT, last_contact BIGINT, longitude DOUBLE, latitude DOUBLE, "
    "baro_altitude DOUBLE, on_ground BOOLEAN, velocity DOUBLE, true_track DOUBLE, vertical_rate DOUBLE, "
    "geo_altitude DOUBLE, transponder_code STRING, spi BOOLEAN, position_source INT, category INT"
)
WEATHER = "kind STRING, fetched_at DOUBLE, obs_time BIGINT, raw_json STRING"

# Slots of a positional state vector, in array order.
VECTOR_FIELDS = (
    "icao24", "callsign", "origin_country", "time_position", "last_contact", "longitude", "latitude",
    "baro_altitude", "on_ground", "velocity", "true_track", "vertical_rate", "sensors", "geo_altitude",
    "transponder_code", "spi", "position_source", "category",
)

# Element of the object feed's array; altitude stays text because it may hold the word "ground".
OBJECT_REPORT = (
    "hex STRING, flight STRING, alt_baro STRING, alt_geom STRING, gs DOUBLE, track DOUBLE, "
    "baro_rate DOUBLE, geom_rate DOUBLE, lat DOUBLE, lon DOUBLE, seen_pos DOUBLE, "
    "seen DOUBLE, spi STRING, category STRING"
)


def object_body(code_field: str) -> str:
    """Schema of an object feed response; the caller names the field of the transponder's code."""
    report = f"{OBJECT_REPORT}, `{code_field}` STRING"
    return f"now DOUBLE, ac ARRAY<STRUCT<{report}>>, aircraft ARRAY<STRUCT<{report}>>"


REFERENCE_COLUMNS = (
    "icao24", "registration", "typecode", "model", "manufacturername", "operator", "operatoricao",
)
REFERENCE = ", ".join(f"{c} STRING" for c in REFERENCE_COLUMNS)

EPISODES = (
    "event_id STRING, event_type STRING, icao24 STRING, callsign STRING, location STRING, "
    "started_at TIMESTAMP, ended_at TIMESTAMP, duration_s BIGINT, trigger_ts TIMESTAMP, "
    "min_alt_ft DOUBLE, max_alt_ft DOUBLE, max_turn_deg DOUBLE, n_points BIGINT"
)

CALL_LOG = (
    "source STRING, called_at TIMESTAMP, http_status INT, latency_ms INT, credits_remaining INT, error STRING"
)


def names(ddl: str) -> list[str]:
    """Column names of a flat DDL schema string."""
    return [part.split()[0] for part in ddl.split(", ")]
