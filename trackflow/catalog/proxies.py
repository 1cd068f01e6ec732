"""Inputs of the registered queries, derived from the given tables.

Each input is one SQL text written for both Spark and DuckDB, so a query and its check read the
same rows. Only three spellings differ between the engines; they are filled in by ``spark_sql`` and
``duck_sql``. All inputs use their whole source tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trackflow.config import RUNWAYS, STACKS
from trackflow.session import use_utc

# The events table starts here; its 30 days are pressed into 30 minutes so that one user's events
# have the spacing of one aircraft's reports.
EPOCH = 1704067200
PRESS = 1440

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(selector: str, values) -> str:
    whens = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values))
    return f"(CASE {selector} {whens} END)"


_POINTS = (*STACKS, *RUNWAYS)
_LAT = _pick("(user_id % 8)", [f"{p.lat}e0" for p in _POINTS])
_LON = _pick("(user_id % 8)", [f"{p.lon}e0" for p in _POINTS])
_STACK = _pick("(user_id % 4)", [f"'{p.id}'" for p in STACKS])
_US = "$us(ts)"
_SEC = f"({EPOCH} + ({_US} - {EPOCH}000000) $div {PRESS}000000)"
_HEX = "$fmt('%06x', user_id)"

# Position reports: key = user, whole-second times as the feeds have them.
POSITIONS = f"""
SELECT {_HEX} AS icao24,
       CASE WHEN event_id % 7 = 3 THEN NULL WHEN event_id % 7 = 4 THEN ' FL' || user_id || ' '
            ELSE 'FL' || user_id END AS callsign,
       $at({_SEC}) AS event_ts,
       CASE WHEN event_id % 89 = 7 THEN NULL ELSE {_LAT} + ((event_id * 7) % 41 - 20) * 4e-3 END AS lat,
       {_LON} + ((event_id * 11) % 37 - 18) * 4e-3 AS lon,
       CASE WHEN event_id % 97 = 5 THEN NULL WHEN user_id % 8 < 4 THEN 65e2 + value * 20e0
            ELSE value * 40e0 END AS alt_ft,
       CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST((event_id * 131) % 4001 - 2000 AS DOUBLE) END AS vr_fpm,
       CASE WHEN event_id % 53 = 9 THEN NULL ELSE CAST((event_id * 37 + user_id * 11) % 360 AS DOUBLE) END AS track_deg,
       CASE WHEN event_type = 'signup' THEN NULL ELSE event_type = 'error' END AS on_ground,
       CAST(120 + event_id % 331 AS DOUBLE) AS speed_kt
FROM events
"""

# Landing rows of the position feed: each report fetched three times, the last time stale.
RAW_STATES = f"""
SELECT 'p' || event_id || '-' || late AS poll_id,
       CAST({_SEC} + late AS DOUBLE) AS fetched_at,
       {_SEC} AS api_time,
       CASE WHEN event_id % 5 = 0 THEN ' ' || upper({_HEX}) || ' ' ELSE {_HEX} END AS icao24,
       CASE WHEN event_id % 7 = 3 THEN NULL WHEN event_id % 7 = 4 THEN '  ' ELSE 'FL' || user_id || '  ' END AS callsign,
       CAST(NULL AS $text) AS origin_country,
       CASE WHEN event_id % 71 = 8 THEN NULL ELSE {_SEC} END AS time_position,
       {_SEC} AS last_contact,
       {_LON} + ((event_id * 11) % 37 - 18) * 4e-3 AS longitude,
       CASE WHEN event_id % 89 = 7 THEN NULL WHEN event_id % 31 = 4 THEN 55e0
            ELSE {_LAT} + ((event_id * 7) % 41 - 20) * 4e-3 END AS latitude,
       CASE WHEN event_id % 11 = 2 THEN NULL WHEN event_id % 101 = 3 THEN 2e4 ELSE 1e3 + value * 6e0 END AS baro_altitude,
       event_type = 'error' AS on_ground,
       CASE WHEN event_id % 43 = 6 THEN 4e2 ELSE CAST(60 + event_id % 170 AS DOUBLE) END AS velocity,
       CAST((event_id * 37 + user_id * 11) % 360 AS DOUBLE) AS true_track,
       CAST((event_id * 13) % 41 - 20 AS DOUBLE) AS vertical_rate,
       CASE WHEN event_id % 4 = 0 THEN NULL ELSE 1e3 + value * 61e-1 END AS geo_altitude,
       CAST(NULL AS $text) AS transponder_code,
       FALSE AS spi, CAST(0 AS INT) AS position_source, CAST(NULL AS INT) AS category
FROM (SELECT *, $each(5, 20, 100) AS late FROM events)
"""

# Reference table: customers with their nation; only every other user has an entry.
REFERENCE = """
SELECT $fmt('%06x', c_custkey * 2) AS icao24, c_name AS registration, 'T' || c_nationkey AS typecode,
       c_mktsegment AS model, n_name AS manufacturername, CAST(NULL AS $text) AS operator,
       CAST(NULL AS $text) AS operatoricao
FROM customer JOIN nation ON c_nationkey = n_nationkey
"""

# Work queue of episodes: one row per event, at its real time.
_START = f"({_US} $div 1000000)"
EPISODES = f"""
SELECT $uuid('e' || event_id) AS event_id,
       CASE WHEN event_type IN ('view', 'click', 'signup') THEN 'holding' ELSE 'go_around' END AS event_type,
       {_HEX} AS icao24,
       CASE WHEN event_id % 7 = 3 THEN NULL ELSE 'FL' || user_id END AS callsign,
       {_STACK} AS location,
       $at({_START}) AS started_at,
       $at({_START} + CAST(floor(value * 20e0) AS BIGINT)) AS ended_at,
       CAST(floor(value * 20e0) AS BIGINT) AS duration_s,
       $at({_START} + CAST(floor(value * 10e0) AS BIGINT)) AS trigger_ts,
       CAST(7000 + event_id % 900 AS DOUBLE) AS min_alt_ft,
       CAST(8000 + event_id % 1900 AS DOUBLE) AS max_alt_ft,
       CAST((event_id * 7) % 900 AS DOUBLE) AS max_turn_deg,
       3 + event_id % 40 AS n_points,
       $at({_START} + CAST(floor(value * 10e0) AS BIGINT) + event_id % 200) AS first_detected_at,
       CASE event_id % 4 WHEN 0 THEN 'detected' WHEN 1 THEN 'assessed' WHEN 2 THEN 'confirmed' ELSE 'rejected' END AS status,
       $at({_START} + CAST(floor(value * 20e0) AS BIGINT)) AS updated_at,
       event_id AS event_no
FROM events
"""

# Position reports at the real time of their events, to go with the queue above.
TRACKS = POSITIONS.replace(_SEC, _START)
RAW_TRACKS = RAW_STATES.replace(_SEC, _START)

# Assessments and reviews of the first events, one row per document / label.
ASSESSMENTS = """
SELECT doc_id AS assessment_id, $uuid('e' || (doc_id $div 3)) AS event_id,
       CASE lang WHEN 'en' THEN 'wind' WHEN 'fr' THEN 'low_visibility_cloud' WHEN 'de' THEN 'traffic_volume'
                 ELSE 'other' END AS cause,
       CAST(1 + n_chars % 3 AS INT) AS severity, CAST(n_chars % 101 AS DOUBLE) / 1e2 AS confidence,
       text AS reasoning, '{"summary":"' || source || '"}' AS evidence, source AS model_version, $at(1704067200 + doc_id * 31) AS created_at
FROM documents
"""
REVIEWS = """
SELECT doc_id AS review_id, $uuid('e' || (doc_id $div 3)) AS event_id,
       CASE WHEN doc_id % 17 = 4 THEN NULL ELSE doc_id END AS assessment_id,
       CASE WHEN toxic = 1 THEN 'not_an_event' WHEN quality = 1 THEN 'agree' ELSE 'disagree' END AS verdict,
       CASE WHEN quality = 0 THEN 'wind' END AS corrected_cause, 'n' || doc_id AS notes, 'r' || (doc_id % 5) AS reviewer,
       $at(1704070800 + (doc_id * 7919) % 86400) AS reviewed_at
FROM labels
"""

# Change log of a queue: key = user, every event one change.
QUEUE_LOG = f"""
SELECT $uuid('u' || user_id) AS event_id,
       CASE WHEN user_id % 2 = 0 THEN 'holding' ELSE 'go_around' END AS event_type,
       {_STACK} AS location,
       CASE WHEN value < 20e0 THEN 'detected' WHEN value < 60e0 THEN 'assessed' WHEN value < 10e1 THEN 'confirmed'
            ELSE 'rejected' END AS status,
       event_id % 3600 AS duration_s,
       $at({_START} - event_id % 300) AS trigger_ts,
       $at({_START}) AS first_detected_at,
       CASE event_type WHEN 'signup' THEN 'insert' WHEN 'view' THEN 'update_preimage' WHEN 'error' THEN 'delete'
            ELSE 'update_postimage' END AS _pg_change_type,
       $at({_START} + 15) AS _timestamp,
       event_id AS _sort_by
FROM events
"""

# Forecasts: one per hour and version, made from the hour's events.
FORECASTS = f"""
SELECT min(event_id) AS forecast_id, $hour(ts) AS target_hour, event_type AS model_version,
       CAST(count(*) % 37 AS DOUBLE) AS predicted_mean_hold_min, CAST(count(*) AS INT) AS predicted_holding_flights,
       'n=' || count(*) AS rationale, 'pending' AS status
FROM events GROUP BY $hour(ts), event_type
"""

# Weather envelopes: half-hourly reports, repeated fetches, with the odd spellings the feed uses.
_K = "CAST($json(props, '$.k') AS INT)"
WEATHER = f"""
SELECT CASE WHEN event_type = 'error' THEN 'taf' ELSE 'metar' END AS kind,
       CAST({_US} AS DOUBLE) / 1e6 AS fetched_at,
       CASE WHEN event_id % 61 = 5 THEN NULL ELSE ({_US} $div 1800000000) * 1800 END AS obs_time,
       '{{"wdir":' || CASE WHEN k % 9 = 0 THEN '"VRB"' ELSE CAST(k * 3 AS $text) END
       || ',"wspd":' || CAST(k % 40 AS $text)
       || CASE WHEN k % 3 = 0 THEN ',"wgst":' || CAST(k % 50 AS $text) ELSE '' END
       || ',"visib":' || CASE WHEN k % 4 = 0 THEN '"6+"' ELSE CAST(k % 10 AS $text) END
       || CASE WHEN k % 5 = 0 THEN '' ELSE ',"clouds":[{{"cover":"FEW","base":900}},{{"cover":"'
            || CASE WHEN k % 2 = 0 THEN 'BKN' ELSE 'SCT' END || '","base":' || CAST(k * 100 AS $text)
            || '}},{{"cover":"OVC","base":' || CAST(2000 + k AS $text) || '}}]' END
       || ',"fltCat":"' || CASE WHEN k % 7 = 0 THEN 'IFR' ELSE 'VFR' END
       || '","' || CASE WHEN event_type = 'error' THEN 'rawTAF' ELSE 'rawOb' END || '":"R' || CAST(event_id AS $text) || '"}}' AS raw_json
FROM (SELECT *, {_K} AS k FROM events)
"""

# Request log: source = event type, latency = value.
CALLS = f"""
SELECT event_type AS source, $at({_START}) AS called_at,
       CAST(CASE WHEN event_id % 10 = 3 THEN 429 ELSE 200 END AS INT) AS http_status,
       CAST(floor(value * 10e0) AS INT) AS latency_ms,
       CAST(CASE WHEN event_id % 3 = 0 THEN NULL ELSE 4000 - event_id % 4000 END AS INT) AS credits_remaining,
       CAST(NULL AS $text) AS error
FROM events
"""

def _calls(text: str, name: str, render) -> str:
    """Rewrite ``name(args)`` with balanced brackets through ``render(args)``."""
    while (at := text.find(name + "(")) >= 0:
        depth, i = 0, at + len(name)
        while True:
            depth += {"(": 1, ")": -1}.get(text[i], 0)
            if depth == 0:
                break
            i += 1
        text = text[:at] + render(text[at + len(name) + 1 : i]) + text[i + 1 :]
    return text


def spark_sql(text: str) -> str:
    text = _calls(text, "$us", lambda a: f"unix_micros(CAST({a} AS TIMESTAMP))")
    text = _calls(text, "$at", lambda a: f"timestamp_seconds({a})")
    text = _calls(text, "$each", lambda a: f"explode(array({a}))")
    text = _calls(text, "$hour", lambda a: f"date_trunc('hour', CAST({a} AS TIMESTAMP))")
    text = _calls(
        text, "$uuid",
        lambda a: f"regexp_replace(md5({a}), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '$1-$2-$3-$4-$5')",
    )
    text = _calls(text, "$json", lambda a: f"get_json_object({a})")
    return text.replace("$fmt", "format_string").replace("$div", "div").replace("$text", "STRING")


def duck_sql(text: str) -> str:
    text = _calls(text, "$us", lambda a: f"epoch_us({a})")
    text = _calls(text, "$at", lambda a: f"make_timestamp(({a}) * 1000000)")
    text = _calls(text, "$each", lambda a: f"unnest([{a}])")
    text = _calls(text, "$hour", lambda a: f"date_trunc('hour', {a})")
    text = _calls(text, "$uuid", lambda a: f"CAST(CAST(md5({a}) AS UUID) AS VARCHAR)")
    text = _calls(text, "$json", lambda a: f"json_extract_string({a})")
    return text.replace("$fmt", "printf").replace("$div", "//").replace("$text", "VARCHAR")


def load(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Run an input's SQL on the parquet tables it names."""
    use_utc(spark)
    sql = spark_sql(text)
    frames = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if f" {t}" in sql}
    for name, df in frames.items():
        sql = sql.replace(f"FROM {name}", f"FROM {{{name}}}").replace(f"JOIN {name}", f"JOIN {{{name}}}")
    return _format(spark, sql, frames)


def _format(spark: SparkSession, sql: str, frames: dict[str, DataFrame]) -> DataFrame:
    for name in frames:
        sql = sql.replace(f"{{{name}}}", f"__{name}__")
    sql = sql.replace("{", "{{").replace("}", "}}")
    for name in frames:
        sql = sql.replace(f"__{name}__", f"{{{name}}}")
    return spark.sql(sql, **frames)


def ctes(**inputs: str) -> str:
    """WITH clause of a check query: the same inputs in DuckDB's spelling."""
    return "WITH " + ", ".join(f"{name} AS ({duck_sql(text)})" for name, text in inputs.items())
