"""Queries of the sources, the cleaning steps and the row rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from trackflow import config, schemas
from trackflow.catalog import proxies as P
from trackflow.catalog.registry import query, rounded
from trackflow.functions.geo import ceiling
from trackflow.functions.text import blank_to_null, clean_key, event_label, json_double, json_int
from trackflow.functions.times import hour_floor, iso_to_epoch, next_hour, plus_seconds, seconds_between
from trackflow.operators import quality as Q
from trackflow.operators import silver as S
from trackflow.plans.serving import track_windows
from trackflow.session import shared_folder
from trackflow.sources import feeds, landing, reference

RAW = P.ctes(raw=P.RAW_STATES)
_FRESH = "fresh AS (SELECT * FROM raw WHERE time_position IS NOT NULL AND fetched_at - time_position <= 60)"
_SILVER = f"""
silver AS (SELECT lower(trim(icao24)) AS icao24, nullif(trim(callsign), '') AS callsign, make_timestamp(time_position * 1000000) AS event_ts,
  make_timestamp(CAST(trunc(fetched_at) AS BIGINT) * 1000000) AS fetched_ts, latitude AS lat, longitude AS lon,
  coalesce(geo_altitude, baro_altitude) * {config.M_TO_FT}e0 AS alt_ft, baro_altitude * {config.M_TO_FT}e0 AS baro_alt_ft,
  velocity * {config.MS_TO_KT}e0 AS speed_kt, true_track AS track_deg, vertical_rate * {config.MS_TO_FPM}e0 AS vr_fpm, on_ground, transponder_code
  FROM fresh)"""
_COLUMNS = "lat, lon, alt_ft, baro_alt_ft, speed_kt, track_deg, vr_fpm, on_ground, transponder_code"
_DEDUPED = f"""
uniq AS (SELECT * FROM silver QUALIFY row_number() OVER (PARTITION BY icao24, event_ts ORDER BY fetched_ts, callsign NULLS FIRST,
  {', '.join(c.strip() + ' NULLS FIRST' for c in _COLUMNS.split(','))}) = 1)"""
SILVER = f"{RAW}, {_FRESH}, {_SILVER}"
UNIQUE = f"{SILVER}, {_DEDUPED}"
_NUMBERS = ("lat", "lon", "alt_ft", "baro_alt_ft", "speed_kt", "vr_fpm")
_ROUND = ", ".join(f"round({c}, 6) AS {c}" for c in _NUMBERS)
_VALID = f"""lat IS NOT NULL AND lon IS NOT NULL AND event_ts IS NOT NULL
  AND lat BETWEEN {config.BOX_LAT[0]} AND {config.BOX_LAT[1]} AND lon BETWEEN {config.BOX_LON[0]} AND {config.BOX_LON[1]}
  AND (alt_ft IS NULL OR alt_ft BETWEEN -1500 AND 60000) AND (speed_kt IS NULL OR speed_kt < 700)"""
REF = P.duck_sql(P.REFERENCE)


def raw_states(spark, sf_dir):
    return P.load(spark, sf_dir, P.RAW_STATES)


def silver(spark, sf_dir):
    return S.to_positions(S.fresh(raw_states(spark, sf_dir)))


def unique(spark, sf_dir):
    return S.dedupe(silver(spark, sf_dir))


@query("silver_staleness", f"{RAW}, {_FRESH} SELECT poll_id, icao24, time_position, fetched_at FROM fresh")
def silver_staleness(spark, sf_dir):
    return S.fresh(raw_states(spark, sf_dir)).select("poll_id", "icao24", "time_position", "fetched_at")


@query("silver_project", f"{SILVER} SELECT * REPLACE ({_ROUND}) FROM silver")
def silver_project(spark, sf_dir):
    return rounded(silver(spark, sf_dir))


@query("dedupe_events", f"{UNIQUE} SELECT * REPLACE ({_ROUND}) FROM uniq")
def dedupe_events(spark, sf_dir):
    return rounded(unique(spark, sf_dir))


@query("quality_drop", f"{UNIQUE} SELECT * REPLACE ({_ROUND}) FROM uniq WHERE {_VALID}")
def quality_drop(spark, sf_dir):
    return rounded(Q.keep_valid(unique(spark, sf_dir)))


@query(
    "quality_metrics",
    f"""{UNIQUE}, t AS (SELECT count(*) AS n,
      count(*) FILTER (lat IS NOT NULL AND lon IS NOT NULL AND event_ts IS NOT NULL) AS has_position,
      count(*) FILTER (lat BETWEEN {config.BOX_LAT[0]} AND {config.BOX_LAT[1]} AND lon BETWEEN {config.BOX_LON[0]} AND {config.BOX_LON[1]}) AS inside_box,
      count(*) FILTER (alt_ft IS NULL OR alt_ft BETWEEN -1500 AND 60000) AS plausible_altitude,
      count(*) FILTER (speed_kt IS NULL OR speed_kt < 700) AS plausible_speed,
      count(*) FILTER (callsign IS NOT NULL AND callsign <> '') AS has_callsign FROM uniq),
    u AS (UNPIVOT t ON has_position, inside_box, plausible_altitude, plausible_speed, has_callsign INTO NAME rule VALUE passed)
    SELECT rule, passed, n - passed AS failed FROM u""",
)
def quality_metrics(spark, sf_dir):
    return Q.rule_metrics(unique(spark, sf_dir), {**Q.POSITION_RULES, **Q.POSITION_WARNINGS})


@query("enrich_left_broadcast", f"{UNIQUE}, ref AS ({REF}) SELECT uniq.* REPLACE ({_ROUND}), ref.* EXCLUDE (icao24) FROM uniq LEFT JOIN ref USING (icao24)")
def enrich_left_broadcast(spark, sf_dir):
    return rounded(S.enrich(unique(spark, sf_dir), P.load(spark, sf_dir, P.REFERENCE)))


_NO_REFERENCE = ", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in schemas.REFERENCE_COLUMNS[1:])


@query("enrich_empty_reference", f"{UNIQUE} SELECT * REPLACE ({_ROUND}), {_NO_REFERENCE} FROM uniq")
def enrich_empty_reference(spark, sf_dir):
    return rounded(S.enrich(unique(spark, sf_dir), reference.empty_reference(spark)))


@query("silver_layout", f"{UNIQUE} SELECT * REPLACE ({_ROUND}), CAST(event_ts AS DATE) AS event_date FROM uniq WHERE {_VALID}")
def silver_layout(spark, sf_dir):
    path = shared_folder(spark, "silver")
    dated = Q.keep_valid(unique(spark, sf_dir)).withColumn("event_date", F.to_date("event_ts"))
    landing.write_clustered(dated, path, "event_date", ["icao24", "event_ts"])
    return rounded(spark.read.parquet(path))


# The keys of users 3, 42 and 81.
LOOKUP = ("000003", "00002a", "000051")


@query(
    "track_lookup",
    f"""{UNIQUE} SELECT icao24, event_ts, round(alt_ft, 6) AS alt_ft FROM uniq WHERE {_VALID} AND icao24 IN {LOOKUP}
    AND event_ts BETWEEN TIMESTAMP '2024-01-01 00:05:00' AND TIMESTAMP '2024-01-01 00:25:00'""",
)
def track_lookup(spark, sf_dir):
    path = shared_folder(spark, "lookup")
    dated = Q.keep_valid(unique(spark, sf_dir)).withColumn("event_date", F.to_date("event_ts"))
    landing.write_clustered(dated, path, "event_date", ["icao24", "event_ts"], lookup=["icao24"], row_group_bytes=16 << 20)
    first, last = (F.lit(t).cast("timestamp") for t in ("2024-01-01 00:05:00", "2024-01-01 00:25:00"))
    return rounded(track_windows(spark.read.parquet(path), first, last, ["alt_ft"], LOOKUP))


@query("exclude_prefix", f"{SILVER} SELECT icao24, event_ts, fetched_ts FROM silver WHERE NOT starts_with(icao24, '00000')")
def exclude_prefix(spark, sf_dir):
    return S.without_prefix(silver(spark, sf_dir), "00000").select("icao24", "event_ts", "fetched_ts")


# --- reference table -------------------------------------------------------------------------

# Customers written as an untidy CSV: padded upper-case keys, malformed keys, repeats, quoted names.
REFERENCE_FILE = """
SELECT CASE WHEN c_custkey % 50 = 7 THEN 'zz' || c_custkey ELSE ' ' || upper($fmt('%06x', c_custkey $div 2)) END AS icao24,
       c_name || ', "' || n_name || '"' || CASE WHEN c_custkey % 10 = 3 THEN ' O' || chr(39) || 'B, ' || chr(39) || chr(39) WHEN c_custkey % 10 = 4 THEN chr(92) ELSE '' END AS registration, 'T' || c_nationkey AS typecode, c_mktsegment AS model
FROM customer JOIN nation ON c_nationkey = n_nationkey
"""


@query(
    "ref_load_dedupe",
    f"""{P.ctes(f=REFERENCE_FILE)}, c AS (SELECT lower(trim(icao24)) AS icao24, registration, typecode, model,
      CAST(NULL AS VARCHAR) AS manufacturername, CAST(NULL AS VARCHAR) AS operator, CAST(NULL AS VARCHAR) AS operatoricao FROM f)
    SELECT * FROM c WHERE regexp_matches(icao24, '{config.KEY_PATTERN}')
    QUALIFY row_number() OVER (PARTITION BY icao24 ORDER BY registration, typecode, model) = 1""",
)
def ref_load_dedupe(spark, sf_dir):
    path = shared_folder(spark, "reference-csv")
    P.load(spark, sf_dir, REFERENCE_FILE).write.options(header=True, quote="'", escape="'", quoteAll=True, ignoreLeadingWhiteSpace=False).csv(path)
    table = shared_folder(spark, "reference")
    rows = reference.one_per_key(reference.with_columns(reference.read_reference_csv(spark, path)))
    rows.write.mode("overwrite").parquet(table)
    return spark.read.parquet(table)


# --- raw responses ---------------------------------------------------------------------------

_SEC = f"({P.EPOCH} + event_id * 7)"
OBJECT_BODIES = f"""
SELECT 'p' || event_id AS poll_id, CAST({_SEC} + 2 AS DOUBLE) AS fetched_at,
       '{{"now":' || ({_SEC} * 1000 + 250) || CASE WHEN event_id % 5 = 0 THEN '.5' ELSE '' END || ',"total":3,"' || CASE WHEN event_id % 2 = 0 THEN 'ac' ELSE 'aircraft' END
       || '":[{{"hex":" ' || upper($fmt('%06x', user_id)) || '","flight":"FL' || user_id || '  ","alt_baro":'
       || CASE WHEN event_type = 'error' THEN '"ground"' ELSE '' || (1000 + event_id % 9000) END
       || ',"alt_geom":' || (1200 + event_id % 9000) || ',"gs":' || (event_id % 400) || '.5,"track":' || (event_id % 360)
       || CASE WHEN event_id % 3 = 0 THEN ',"baro_rate":' || (event_id % 4000 - 2000) ELSE '' END
       || ',"geom_rate":' || (event_id % 3000) || ',"lat":51.' || (100 + event_id % 800) || ',"lon":-0.' || (100 + event_id % 700)
       || ',"seen_pos":' || (event_id % 50) || '.75,"seen":1,"spi":' || (event_id % 2) || '}},'
       || '{{"hex":"nopos","flight":"X","seen":3}},{{"hex":"' || $fmt('%06x', user_id + 1048576) || '","lat":50,"lon":0.25}}]}}' AS body
FROM events
"""
_OBJECT_CHECK = f"""
SELECT 'p' || event_id AS poll_id, CAST({_SEC} + 2 AS DOUBLE) AS fetched_at, {_SEC} AS api_time, printf('%06x', user_id) AS icao24,
  'FL' || user_id AS callsign, {_SEC} - (event_id % 50) - 1 AS time_position, {_SEC} - 1 AS last_contact,
  CAST('-0.' || (100 + event_id % 700) AS DOUBLE) AS longitude, CAST('51.' || (100 + event_id % 800) AS DOUBLE) AS latitude,
  CASE WHEN event_type <> 'error' THEN (1000 + event_id % 9000) * {config.FT_TO_M}e0 END AS baro_altitude, event_type = 'error' AS on_ground,
  (event_id % 400 + 5e-1) * {config.KT_TO_MS}e0 AS velocity, CAST(event_id % 360 AS DOUBLE) AS true_track,
  CASE WHEN event_id % 3 = 0 THEN event_id % 4000 - 2000 ELSE event_id % 3000 END * (1e0 / {config.MS_TO_FPM}e0) AS vertical_rate,
  (1200 + event_id % 9000) * {config.FT_TO_M}e0 AS geo_altitude, event_id % 2 = 1 AS spi FROM events
UNION ALL SELECT 'p' || event_id, CAST({_SEC} + 2 AS DOUBLE), {_SEC}, printf('%06x', user_id + 1048576), NULL, {_SEC}, {_SEC}, 25e-2, 5e1,
  NULL, FALSE, NULL, NULL, NULL, NULL, FALSE FROM events
"""


@query(
    "normalise_object_feed",
    f"SELECT * REPLACE (round(baro_altitude, 6) AS baro_altitude, round(geo_altitude, 6) AS geo_altitude, round(velocity, 6) AS velocity, "
    f"round(vertical_rate, 6) AS vertical_rate) FROM ({_OBJECT_CHECK})",
)
def normalise_object_feed(spark, sf_dir):
    rows = feeds.object_reports(P.load(spark, sf_dir, OBJECT_BODIES))
    return rounded(rows.drop("origin_country", "transponder_code", "position_source", "category"))


VECTOR_BODIES = f"""
SELECT 'v' || event_id AS poll_id, CAST({_SEC} + 2 AS DOUBLE) AS fetched_at,
       '{{"time":' || {_SEC} || ',"states":[["' || $fmt('%06x', user_id) || '","FL' || user_id || '  ","Land",' || ({_SEC} - 3) || CASE WHEN event_id % 7 = 1 THEN '.7' ELSE '' END || ',' || CASE WHEN event_id % 7 = 2 THEN '"n/a"' ELSE '' || ({_SEC} - 1) END
       || ',-0.' || (100 + event_id % 700) || ',51.' || (100 + event_id % 800) || ',' || (event_id % 9000) || ',' || CASE WHEN event_type = 'error' THEN 'true' ELSE 'false' END
       || ',' || (event_id % 300) || '.5,' || (event_id % 360) || ',-' || (event_id % 20) || ',[1,2],null,"' || (1000 + event_id % 6000) || '",false,0,'
       || (event_id % 8) || '],["' || $fmt('%06x', user_id + 1048576) || '","","Land",null,' || ({_SEC} - 9) || ']]}}' AS body
FROM events
"""
_VECTOR_CHECK = f"""
SELECT 'v' || event_id AS poll_id, CAST({_SEC} + 2 AS DOUBLE) AS fetched_at, {_SEC} AS api_time, printf('%06x', user_id) AS icao24, 'FL' || user_id AS callsign,
  'Land' AS origin_country, {_SEC} - 3 AS time_position, CASE WHEN event_id % 7 <> 2 THEN {_SEC} - 1 END AS last_contact, CAST('-0.' || (100 + event_id % 700) AS DOUBLE) AS longitude,
  CAST('51.' || (100 + event_id % 800) AS DOUBLE) AS latitude, CAST(event_id % 9000 AS DOUBLE) AS baro_altitude, event_type = 'error' AS on_ground,
  event_id % 300 + 5e-1 AS velocity, CAST(event_id % 360 AS DOUBLE) AS true_track, CAST(-(event_id % 20) AS DOUBLE) AS vertical_rate,
  CAST(NULL AS DOUBLE) AS geo_altitude, '' || (1000 + event_id % 6000) AS transponder_code, FALSE AS spi, CAST(0 AS INTEGER) AS position_source, CAST(event_id % 8 AS INTEGER) AS category FROM events
UNION ALL SELECT 'v' || event_id, CAST({_SEC} + 2 AS DOUBLE), {_SEC}, printf('%06x', user_id + 1048576), '', 'Land', NULL, {_SEC} - 9,
  NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM events
"""


@query("normalise_vector_feed", _VECTOR_CHECK)
def normalise_vector_feed(spark, sf_dir):
    return feeds.vector_reports(P.load(spark, sf_dir, VECTOR_BODIES))


WEATHER_BODIES = f"""
SELECT CASE WHEN event_type = 'error' THEN 'taf' ELSE 'metar' END AS kind, CAST({_SEC} AS DOUBLE) AS fetched_at,
       CASE WHEN event_id % 3 = 0 THEN item WHEN event_id % 3 = 1 THEN '[' || item || ']' ELSE '[' || item || ',' || item || ']' END AS body
FROM (SELECT *, '{{"id":' || event_id || CASE WHEN event_type = 'error'
        THEN ',"issueTime":"2024-01-' || (10 + event_id % 20) || 'T0' || (event_id % 10) || ':30:00Z"' ELSE ',"obsTime":' || {_SEC} END || '}}' AS item FROM events)
"""


@query(
    "normalise_weather_feed",
    f"""WITH i AS (SELECT *, '{{"id":' || event_id || CASE WHEN event_type = 'error'
        THEN ',"issueTime":"2024-01-' || (10 + event_id % 20) || 'T0' || (event_id % 10) || ':30:00Z"' ELSE ',"obsTime":' || {_SEC} END || '}}' AS raw_json,
        unnest(range(0, CASE WHEN event_id % 3 = 2 THEN 2 ELSE 1 END)) AS copy FROM events)
    SELECT CASE WHEN event_type = 'error' THEN 'taf' ELSE 'metar' END AS kind, CAST({_SEC} AS DOUBLE) AS fetched_at,
    CASE WHEN event_type = 'error' THEN epoch_us(make_timestamp(2024, 1, 10 + event_id % 20, event_id % 10, 30, 0)) // 1000000 ELSE {_SEC} END AS obs_time, raw_json FROM i""",
)
def normalise_weather_feed(spark, sf_dir):
    return feeds.weather_reports(P.load(spark, sf_dir, WEATHER_BODIES))


# --- weather ---------------------------------------------------------------------------------

WEATHER = P.ctes(w=P.WEATHER)
_PARSED = """
parsed AS (SELECT kind, make_timestamp(obs_time * 1000000) AS obs_time, make_timestamp(CAST(trunc(fetched_at) AS BIGINT) * 1000000) AS fetched_ts,
  TRY_CAST(raw_json->>'$.wdir' AS INTEGER) AS wind_dir_deg, TRY_CAST(raw_json->>'$.wspd' AS INTEGER) AS wind_kt,
  TRY_CAST(raw_json->>'$.wgst' AS INTEGER) AS gust_kt, TRY_CAST(replace(raw_json->>'$.visib', '+', '') AS DOUBLE) AS visibility_sm,
  CAST(list_min(list_transform(list_filter(CAST(raw_json->'$.clouds' AS STRUCT(cover VARCHAR, base INTEGER)[]),
    lambda c: c.cover IN ('BKN', 'OVC', 'OVX')), lambda c: c.base)) AS INTEGER) AS ceiling_ft,
  raw_json->>'$.fltCat' AS flight_category, coalesce(raw_json->>'$.rawOb', raw_json->>'$.rawTAF') AS raw_text FROM w)"""
_LATEST = """
weather AS (SELECT * FROM parsed WHERE obs_time IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY kind, obs_time ORDER BY fetched_ts DESC, raw_text DESC) = 1)"""
WEATHER_CTES = f"w AS ({P.duck_sql(P.WEATHER)}), {_PARSED}, {_LATEST}"


def weather_raw(spark, sf_dir):
    return P.load(spark, sf_dir, P.WEATHER)


@query("weather_parse", f"{WEATHER}, {_PARSED} SELECT * FROM parsed")
def weather_parse(spark, sf_dir):
    return S.parse_weather(weather_raw(spark, sf_dir))


@query("weather_latest", f"WITH {WEATHER_CTES} SELECT * FROM weather")
def weather_latest(spark, sf_dir):
    return S.weather(weather_raw(spark, sf_dir))


@query("array_lowest_ceiling", f"{WEATHER}, {_PARSED} SELECT raw_text, ceiling_ft FROM parsed")
def array_lowest_ceiling(spark, sf_dir):
    layers = F.from_json(F.get_json_object("raw_json", "$.clouds"), "array<struct<cover:string,base:int>>")
    text = F.coalesce(F.get_json_object("raw_json", "$.rawOb"), F.get_json_object("raw_json", "$.rawTAF"))
    return weather_raw(spark, sf_dir).select(text.alias("raw_text"), ceiling(layers).alias("ceiling_ft"))


@query(
    "json_extract",
    """SELECT event_id, TRY_CAST(props->>'$.k' AS INTEGER) AS k, TRY_CAST(props->>'$.k' AS DOUBLE) / 4 AS quarter, props->>'$.none' AS absent,
    TRY_CAST(event_type AS INTEGER) AS not_a_number, '{"event_id":' || event_id || ',"event_type":"' || event_type || '"}' AS packed FROM events""",
)
def json_extract(spark, sf_dir):
    return P.table(spark, sf_dir, "events").select(
        "event_id", json_int(F.col("props"), "$.k").alias("k"),
        (json_double(F.col("props"), "$.k") / 4).alias("quarter"),
        F.get_json_object("props", "$.none").alias("absent"),
        F.col("event_type").try_cast("int").alias("not_a_number"),
        F.to_json(F.struct("event_id", "event_type")).alias("packed"),
    )


@query(
    "scalar_string",
    f"""SELECT doc_id, lower(trim(' ' || source || ' ')) AS source_key, nullif(trim(CASE WHEN lang = 'en' THEN '  ' ELSE lang END), '') AS lang,
    replace(source || '+', '+', '') AS plain, regexp_matches(source, '^src[0-9]+$') AS numbered, regexp_matches(lang, '{config.KEY_PATTERN}') AS is_key,
    '00:' || lpad(CAST(doc_id % 60 AS VARCHAR), 2, '0') || ' · go-around · ' || lang || ' · ' || source || ' · detected' AS label FROM documents""",
)
def scalar_string(spark, sf_dir):
    d = P.table(spark, sf_dir, "documents")
    at = F.timestamp_seconds((F.col("doc_id") % 60) * 60)
    return d.select(
        "doc_id", clean_key(F.concat(F.lit(" "), "source", F.lit(" "))).alias("source_key"),
        blank_to_null(F.when(F.col("lang") == "en", "  ").otherwise(F.col("lang"))).alias("lang"),
        F.replace(F.concat("source", F.lit("+")), F.lit("+"), F.lit("")).alias("plain"),
        F.col("source").rlike("^src[0-9]+$").alias("numbered"), F.col("lang").rlike(config.KEY_PATTERN).alias("is_key"),
        event_label(at, F.lit("go_around"), F.col("lang"), F.col("source"), F.lit("detected")).alias("label"),
    )


@query(
    "scalar_datetime",
    """SELECT event_id, make_timestamp((epoch_us(ts) // 1000000) * 1000000) AS whole, CAST(ts AS DATE) AS day, date_trunc('minute', ts) AS minute,
    date_trunc('hour', ts) AS hour, CAST(hour(ts) AS INTEGER) AS hour_of_day, date_trunc('hour', ts) + INTERVAL 1 HOUR AS next_hour, ts - INTERVAL 90 SECOND AS earlier,
    date_sub('second', TIMESTAMP '2024-01-15 12:00:00', ts) AS seconds, epoch_us(ts) // 1000000 AS epoch FROM events""",
)
def scalar_datetime(spark, sf_dir):
    ts = F.col("ts").cast("timestamp")
    noon = F.lit("2024-01-15 12:00:00").cast("timestamp")
    iso = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return P.table(spark, sf_dir, "events").select(
        "event_id", F.timestamp_seconds(F.floor(F.unix_micros(ts) / 1_000_000)).alias("whole"), F.to_date(ts).alias("day"),
        F.date_trunc("minute", ts).alias("minute"), hour_floor(ts).alias("hour"), F.hour(ts).alias("hour_of_day"),
        next_hour(ts).alias("next_hour"), plus_seconds(ts, -90).alias("earlier"),
        seconds_between(ts, noon).alias("seconds"), iso_to_epoch(iso).alias("epoch"),
    )


# --- rules on records ------------------------------------------------------------------------


@query(
    "constraint_violations",
    f"""{P.ctes(e=P.EPISODES)}, u AS (SELECT icao24, event_type, date_trunc('hour', started_at) AS h, count(*) AS n FROM e GROUP BY ALL)
    SELECT 'event_type' AS name, count(*) FILTER (event_type NOT IN ('holding', 'go_around')) AS violations FROM e
    UNION ALL SELECT 'status', count(*) FILTER (status NOT IN ('detected', 'assessed', 'confirmed', 'rejected')) FROM e
    UNION ALL SELECT 'required', count(*) FILTER (icao24 IS NULL OR location IS NULL OR started_at IS NULL OR ended_at IS NULL) FROM e
    UNION ALL SELECT 'named', count(*) FILTER (callsign IS NULL) FROM e
    UNION ALL SELECT 'one_per_start', count(*) - count(DISTINCT (icao24, event_type, started_at)) FROM e
    UNION ALL SELECT 'one_per_hour', CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM u""",
)
def constraint_violations(spark, sf_dir):
    e = P.load(spark, sf_dir, P.EPISODES).withColumn("hour", F.date_trunc("hour", "started_at"))
    return Q.violations(
        e,
        {**Q.QUEUE_RULES, "named": "callsign IS NOT NULL"},
        {
            "one_per_start": ["icao24", "event_type", "started_at"],
            "one_per_hour": ["icao24", "event_type", "hour"],
        },
    )


# Records before validation, with every kind of fault.
DRAFTS = """
SELECT doc_id AS assessment_id, CASE WHEN doc_id % 13 = 4 THEN 'e' || doc_id ELSE $uuid('e' || doc_id) END AS event_id,
       CASE lang WHEN 'en' THEN 'wind' WHEN 'fr' THEN 'low_visibility_cloud' ELSE lang END AS cause,
       CAST(n_chars % 5 AS INT) AS severity, CAST(n_chars % 120 AS DOUBLE) / 1e2 AS confidence, text AS reasoning,
       source || '/' || lang AS evidence_summary
FROM documents
"""


@query(
    "validate_assessments",
    f"""{P.ctes(d=DRAFTS)} SELECT * EXCLUDE (evidence_summary), '{{"summary":"' || evidence_summary || '"}}' AS evidence,
      concat_ws(',', CASE WHEN NOT regexp_matches(event_id, '{config.UUID_PATTERN}') THEN 'event_id' END,
      CASE WHEN cause NOT IN ('wind', 'low_visibility_cloud', 'runway_change', 'traffic_volume', 'other') THEN 'cause' END,
      CASE WHEN severity NOT BETWEEN 1 AND 3 THEN 'severity' END, CASE WHEN confidence NOT BETWEEN 0 AND 1 THEN 'confidence' END) AS reasons FROM d""",
)
def validate_assessments(spark, sf_dir):
    return Q.checked_assessments(P.load(spark, sf_dir, DRAFTS))


@query(
    "validate_forecasts",
    f"""{P.ctes(f=P.FORECASTS)}, c AS (SELECT *, concat_ws(',', CASE WHEN predicted_mean_hold_min NOT BETWEEN 0 AND 120 THEN 'mean' END,
      CASE WHEN predicted_holding_flights NOT BETWEEN 0 AND 200 THEN 'flights' END,
      CASE WHEN date_trunc('hour', target_hour) NOT BETWEEN TIMESTAMP '2024-01-15 11:20:00' AND TIMESTAMP '2024-01-15 15:20:00' THEN 'target_hour' END) AS reasons FROM f)
    SELECT forecast_id, date_trunc('hour', target_hour) AS target_hour, model_version, rationale, reasons FROM c""",
)
def validate_forecasts(spark, sf_dir):
    drafts = P.load(spark, sf_dir, P.FORECASTS).withColumn("target_hour", F.col("target_hour") + F.expr("INTERVAL 7 MINUTES"))
    marked = Q.checked_forecasts(drafts, "2024-01-15 12:20:00")
    return marked.select("forecast_id", "target_hour", "model_version", "rationale", "reasons")


@query("append_log", f"{P.ctes(c=P.CALLS)} SELECT * FROM c UNION ALL SELECT * FROM c")
def append_log(spark, sf_dir):
    path, calls = shared_folder(spark, "call-log"), P.load(spark, sf_dir, P.CALLS)
    for _ in range(2):
        landing.append_log(calls, path, schemas.CALL_LOG)
    return spark.read.parquet(path)
