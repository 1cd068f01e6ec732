"""Queries of the listings, the evidence around events, and the threshold probe."""

from __future__ import annotations

from pyspark.sql import functions as F

from trackflow import config
from trackflow.catalog import proxies as P
from trackflow.catalog.cleaning import WEATHER_CTES, weather_raw
from trackflow.catalog.detection import FEATURES, POS, RULES, feature_ctes, nearest_sql, positions
from trackflow.catalog.operations import (
    NOW_SQL, SCORED, SPAN, _OCC, assessments, episodes, load, now, reviews, scored,
)
from trackflow.catalog.registry import query, rounded, steady_sql
from trackflow.config import RUNWAYS, STACKS
from trackflow.operators import occupancy, silver
from trackflow.operators.joins import flag_members
from trackflow.operators.quantiles import quantile_sketches, sketched_percentiles, within_ranks
from trackflow.operators.sessions import session_counts
from trackflow.plans import analytics as A
from trackflow.plans import evidence as V
from trackflow.plans import probe as B
from trackflow.plans import serving as L
from trackflow.session import shared_folder

tracks, calls = load("TRACKS"), load("CALLS")
TRACKS = P.ctes(p=P.TRACKS, e=P.EPISODES)
QUEUE = P.ctes(e=P.EPISODES, a=P.ASSESSMENTS, r=P.REVIEWS)
_HELD = f"held AS (SELECT DISTINCT icao24 FROM e WHERE event_type = 'holding' AND ended_at > {NOW_SQL} - INTERVAL 3 MINUTE)"


@query(
    "latest_position",
    f"""{TRACKS}, {_HELD}, f AS (SELECT * FROM p WHERE event_ts > {NOW_SQL} - INTERVAL 10 MINUTE AND NOT coalesce(on_ground, FALSE)
      QUALIFY row_number() OVER (PARTITION BY icao24 ORDER BY event_ts DESC, callsign DESC NULLS LAST, lat DESC NULLS LAST, lon DESC, alt_ft DESC NULLS LAST) = 1)
    SELECT icao24, callsign, round(lat, 6) AS lat, round(lon, 6) AS lon, {steady_sql('alt_ft', 0)} AS alt_ft, event_ts AS last_seen,
    icao24 IN (SELECT icao24 FROM held) AS holding, coalesce(callsign, icao24) AS label FROM f""",
)
def latest_position(spark, sf_dir):
    return rounded(L.live_picture(tracks(spark, sf_dir), episodes(spark, sf_dir), now()))


@query("flag_active_keys", f"{TRACKS}, {_HELD} SELECT event_no, icao24, icao24 IN (SELECT icao24 FROM held) AS holding FROM e")
def flag_active_keys(spark, sf_dir):
    e = episodes(spark, sf_dir)
    return flag_members(e.select("event_no", "icao24"), L.active_keys(e, now()), "icao24", "holding")


@query(
    "track_window",
    """SELECT user_id AS icao24, ts AS event_ts, value AS alt_ft FROM events
    WHERE ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-25 00:00:00'""",
)
def track_window(spark, sf_dir):
    reports = P.table(spark, sf_dir, "events").select(
        F.col("user_id").alias("icao24"), F.col("ts").alias("event_ts"), F.col("value").alias("alt_ft")
    )
    first, last = (F.lit(t).cast("timestamp_ntz") for t in ("2024-01-05 00:00:00", "2024-01-25 00:00:00"))
    return L.track_window(reports, first, last, ["alt_ft"])


@query("lookback_filter", f"SELECT event_id, user_id, ts FROM events WHERE ts > {NOW_SQL} - INTERVAL 180 MINUTE")
def lookback_filter(spark, sf_dir):
    at = now().cast("timestamp_ntz")
    return A.after(P.table(spark, sf_dir, "events"), "ts", at, "180 MINUTES").select("event_id", "user_id", "ts")


_MINUTES = f"""
cut AS (SELECT icao24, date_trunc('minute', event_ts) AS minute, {steady_sql('avg(lat)', 4)} AS lat, {steady_sql('avg(lon)', 4)} AS lon,
  {steady_sql('avg(alt_ft)', 0)} AS alt_ft, {steady_sql('avg(speed_kt)', 0)} AS speed_kt,
  {steady_sql("(min({t: event_ts, v: track_deg}) FILTER (track_deg IS NOT NULL)).v", 0)} AS track_deg,
  {steady_sql('avg(vr_fpm)', 0)} AS vr_fpm, max(on_ground) AS on_ground FROM p GROUP BY ALL),
placed AS (SELECT *, {nearest_sql('stack', STACKS)}, {nearest_sql('rwy', RUNWAYS)} FROM cut),
minutes AS (SELECT icao24, minute, alt_ft, speed_kt, track_deg, vr_fpm, on_ground, CASE WHEN lat IS NOT NULL THEN nearest_stack END AS nearest_stack,
  CASE WHEN lat IS NOT NULL THEN {steady_sql('dist_stack_nm', 1)} END AS dist_stack_nm, CASE WHEN lat IS NOT NULL THEN nearest_rwy END AS nearest_rwy,
  CASE WHEN lat IS NOT NULL THEN {steady_sql('dist_rwy_nm', 1)} END AS dist_rwy_nm FROM placed)"""


@query("track_downsample", f"{TRACKS}, {_MINUTES} SELECT * FROM minutes")
def track_downsample(spark, sf_dir):
    return L.downsample(tracks(spark, sf_dir))


@query(
    "track_summary",
    f"""{POS} SELECT icao24, count(*) AS reports, min(event_ts) AS first_seen, max(event_ts) AS last_seen, round(min(alt_ft), 6) AS min_alt_ft,
    round(max(alt_ft), 6) AS max_alt_ft, round(avg(alt_ft), 6) AS mean_alt_ft FROM pos GROUP BY icao24""",
)
def track_summary(spark, sf_dir):
    return rounded(L.track_summary(positions(spark, sf_dir)))


_SAID = "said AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY created_at DESC, assessment_id DESC) = 1)"
_JUDGED = "judged AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY reviewed_at DESC, review_id DESC) = 1)"
# The documents that carry opinions describe the first events, so the listings look back from there.
EARLY = "TIMESTAMP '2024-01-01 12:00:00'"


def early():
    return F.lit("2024-01-01 12:00:00").cast("timestamp")


@query(
    "event_queue",
    f"""{QUEUE}, {_SAID}, {_JUDGED}, w AS (SELECT * FROM e WHERE started_at > {NOW_SQL} - INTERVAL 24 HOUR ORDER BY started_at DESC, event_id LIMIT 200)
    SELECT w.event_id, w.event_type, w.location, w.icao24, w.callsign, w.started_at, w.ended_at, {steady_sql('w.duration_s / 60e0', 1)} AS duration_min, w.status,
    w.trigger_ts, w.first_detected_at, said.assessment_id, said.cause, said.severity, said.confidence, said.reasoning, said.evidence, said.model_version,
    judged.verdict, judged.corrected_cause, judged.notes, judged.reviewer, judged.reviewed_at
    FROM w LEFT JOIN said USING (event_id) LEFT JOIN judged USING (event_id)""",
)
def event_queue(spark, sf_dir):
    return L.event_queue(
        episodes(spark, sf_dir), assessments(spark, sf_dir), reviews(spark, sf_dir), now(), hours=24, limit=200
    )


@query(
    "open_events",
    f"""{QUEUE}, {_SAID}, {_JUDGED}, w AS (SELECT * FROM e WHERE status IN ('detected', 'assessed') AND started_at > {NOW_SQL} - INTERVAL 6 HOUR
      ORDER BY started_at DESC, event_id LIMIT 20)
    SELECT w.event_id, w.event_type, w.icao24, w.callsign, w.location, w.started_at, w.ended_at, w.duration_s, w.status, said.cause AS agent_cause, said.confidence,
    judged.verdict, judged.corrected_cause FROM w LEFT JOIN said USING (event_id) LEFT JOIN judged USING (event_id)""",
)
def open_events(spark, sf_dir):
    return L.open_events(episodes(spark, sf_dir), assessments(spark, sf_dir), reviews(spark, sf_dir), now())


@query(
    "status_counts",
    f"""{QUEUE} SELECT s AS status, count(e.event_id) AS n FROM (SELECT unnest(['detected', 'assessed', 'confirmed', 'rejected']) AS s)
    LEFT JOIN e ON e.status = s GROUP BY s""",
)
def status_counts(spark, sf_dir):
    return A.status_counts(episodes(spark, sf_dir), config.STATUSES)


@query(
    "next_to_assess",
    f"{QUEUE} SELECT event_id, event_type, icao24, callsign, location, started_at, ended_at FROM e WHERE status = 'detected' ORDER BY started_at, event_id LIMIT 10",
)
def next_to_assess(spark, sf_dir):
    return L.next_to_assess(episodes(spark, sf_dir), 10)


@query(
    "recent_corrections",
    f"""{QUEUE} SELECT e.event_type, e.location, a.cause AS agent_cause, r.corrected_cause, r.notes FROM r JOIN e USING (event_id) JOIN a USING (assessment_id)
    WHERE r.verdict = 'disagree' ORDER BY r.reviewed_at DESC, r.review_id DESC LIMIT 5""",
)
def recent_corrections(spark, sf_dir):
    return L.recent_corrections(reviews(spark, sf_dir), episodes(spark, sf_dir), assessments(spark, sf_dir))


@query(
    "forecast_series",
    f"""{SCORED} SELECT target_hour, predicted_mean_hold_min, actual_mean_hold_min, predicted_holding_flights, actual_holding_flights,
    round(abs_error, 6) AS abs_error, status, rationale, model_version FROM scored WHERE target_hour > {NOW_SQL} - INTERVAL 48 HOUR""",
)
def forecast_series(spark, sf_dir):
    return rounded(L.forecast_series(scored(spark, sf_dir), now()))


CALLS = P.ctes(c=P.CALLS)


@query(
    "table_kpis",
    f"{CALLS} SELECT count(*) AS rows, (max({{t: called_at, v: credits_remaining}}) FILTER (credits_remaining IS NOT NULL)).v AS latest_credits_remaining FROM c",
)
def table_kpis(spark, sf_dir):
    return A.table_kpis(calls(spark, sf_dir), "credits_remaining", "called_at")


@query(
    "call_log_metrics",
    f"""{CALLS} SELECT source, count(*) AS calls, {steady_sql('2592000e0 / count(*)', 1)} AS interval_s, {steady_sql('avg(latency_ms)', 1)} AS mean_ms,
    quantile_disc(latency_ms, 0.95) AS p95_ms, count(*) FILTER (http_status = 200) AS answered, count(*) FILTER (http_status = 429) AS refused FROM c GROUP BY source""",
)
def call_log_metrics(spark, sf_dir):
    return A.call_metrics(calls(spark, sf_dir), 30 * 86400)


@query(
    "freshness_lag",
    f"""{CALLS}, s AS (SELECT date_trunc('hour', called_at) + INTERVAL 1 HOUR AS sampled_at, max(called_at) AS newest FROM c GROUP BY ALL),
    l AS (SELECT date_sub('second', newest, sampled_at) AS lag_s FROM s)
    SELECT min(lag_s) AS min_s, CAST(quantile_cont(lag_s, 0.5) AS DOUBLE) AS median_s, round(quantile_cont(lag_s, 0.95), 6) AS p95_s, max(lag_s) AS max_s,
    count(*) FILTER (lag_s < 60) AS under_limit, count(*) AS samples FROM l""",
)
def freshness_lag(spark, sf_dir):
    hourly = calls(spark, sf_dir).withColumn(
        "sampled_at", F.date_trunc("hour", "called_at") + F.expr("INTERVAL 1 HOUR")
    )
    return rounded(A.lag_stats(A.lag_samples(hourly, "sampled_at", "called_at")))


@query(
    "sketch_percentiles",
    """SELECT event_type, count(value) AS n, TRUE AS p0_close, TRUE AS p1_close, TRUE AS p2_close FROM events WHERE NOT isnan(value) GROUP BY event_type""",
)
def sketch_percentiles(spark, sf_dir):
    """Daily sketches are stored, merged over all days, and their percentiles held against the ranks of all rows."""
    shares, path = (0.05, 0.5, 0.95), shared_folder(spark, "sketches")
    events = P.table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    quantile_sketches(events, "value", ["day", "event_type"]).write.partitionBy("day").parquet(path)
    found = sketched_percentiles(spark.read.parquet(path), shares, ["event_type"])
    return within_ranks(events, "value", found, shares, 0.03, ["event_type"])


@query(
    "session_counts",
    f"""{POS}, g AS (SELECT icao24, event_ts, CASE WHEN event_ts - lag(event_ts) OVER (PARTITION BY icao24 ORDER BY event_ts) <= INTERVAL 180 SECOND THEN 0 ELSE 1 END AS opens FROM pos),
    n AS (SELECT *, sum(opens) OVER (PARTITION BY icao24 ORDER BY event_ts ROWS UNBOUNDED PRECEDING) AS session FROM g)
    SELECT icao24, min(event_ts) AS started_at, max(event_ts) AS ended_at, count(*) AS reports FROM n GROUP BY icao24, session""",
)
def sessions(spark, sf_dir):
    return session_counts(positions(spark, sf_dir), chunk_s=600)


# --- evidence --------------------------------------------------------------------------------

EVIDENCE = f"WITH e AS ({P.duck_sql(P.EPISODES)}), p AS ({P.duck_sql(P.TRACKS)}), {WEATHER_CTES}, {_MINUTES}, {_OCC}"
_IN_SPAN = "e.started_at - INTERVAL 1 HOUR"
_EVIDENCE = f"""
t AS (SELECT e.event_id, count(*) AS track_minutes, min(m.alt_ft) AS track_min_alt_ft, min(m.dist_stack_nm) AS track_dist_stack_nm,
  min(m.dist_rwy_nm) AS track_dist_rwy_nm FROM e JOIN minutes m ON m.icao24 = e.icao24 AND m.minute BETWEEN date_trunc('minute', e.started_at) AND e.ended_at GROUP BY e.event_id),
x AS (SELECT e.event_id, count(*) AS reports, max(w.wind_kt) AS max_wind_kt, max(w.gust_kt) AS max_gust_kt, min(w.visibility_sm) AS min_visibility_sm,
  min(w.ceiling_ft) AS min_ceiling_ft, coalesce(max(w.flight_category IN ('IFR', 'LIFR')), FALSE) AS instrument_weather,
  max_by(w.wind_dir_deg, w.obs_time) FILTER (w.wind_dir_deg IS NOT NULL) AS wind_dir_deg
  FROM e JOIN weather w ON w.kind = 'metar' AND w.obs_time BETWEEN {_IN_SPAN} AND e.ended_at GROUP BY e.event_id),
o AS (SELECT e.event_id, w.obs_time AS issued_at, w.raw_text AS outlook FROM e ASOF JOIN (SELECT * FROM weather WHERE kind = 'taf') w ON e.ended_at >= w.obs_time),
b AS (SELECT minute, count(*) AS busy_stacks FROM occ WHERE holding_count > 0 GROUP BY minute),
bundle AS (SELECT e.event_id, e.event_type, e.location, e.duration_s, e.started_at, e.ended_at, t.* EXCLUDE (event_id), x.* EXCLUDE (event_id), o.* EXCLUDE (event_id),
  coalesce(b.busy_stacks, 0) AS busy_stacks FROM e LEFT JOIN t USING (event_id) LEFT JOIN x USING (event_id) LEFT JOIN o USING (event_id)
  LEFT JOIN b ON b.minute = date_trunc('minute', e.ended_at))"""


def weather(spark, sf_dir):
    return silver.weather(weather_raw(spark, sf_dir))


def bundle(spark, sf_dir):
    e = episodes(spark, sf_dir)
    return V.evidence_bundle(
        e, L.downsample(tracks(spark, sf_dir)), weather(spark, sf_dir), occupancy.occupancy(e, *SPAN)
    )


@query(
    "weather_for_event",
    f"""{EVIDENCE} SELECT e.event_id, w.* EXCLUDE (kind, fetched_ts) FROM e JOIN weather w ON w.kind = 'metar' AND w.obs_time BETWEEN {_IN_SPAN} AND e.ended_at""",
)
def weather_for_event(spark, sf_dir):
    return V.weather_for_events(episodes(spark, sf_dir), weather(spark, sf_dir))


@query(
    "asof_latest_report",
    f"""{EVIDENCE} SELECT e.event_id, w.obs_time AS issued_at, w.raw_text AS outlook FROM e ASOF LEFT JOIN (SELECT * FROM weather WHERE kind = 'taf') w
    ON e.ended_at >= w.obs_time""",
)
def asof_latest_report(spark, sf_dir):
    return V.latest_outlook(episodes(spark, sf_dir), weather(spark, sf_dir))


@query("evidence_bundle", f"{EVIDENCE}, {_EVIDENCE} SELECT * FROM bundle")
def evidence_bundle(spark, sf_dir):
    return bundle(spark, sf_dir)


@query(
    "rule_cause_label",
    f"""{EVIDENCE}, {_EVIDENCE} SELECT event_id, CASE WHEN max_gust_kt >= 25 OR max_wind_kt >= 20 THEN 'wind'
      WHEN min_visibility_sm < 3 OR min_ceiling_ft < 1000 OR instrument_weather THEN 'low_visibility_cloud'
      WHEN event_type = 'go_around' AND (wind_dir_deg BETWEEN 140 AND 320) <> starts_with(location, '27') THEN 'runway_change'
      WHEN busy_stacks >= 2 THEN 'traffic_volume' ELSE 'other' END AS cause,
    CAST(CASE WHEN duration_s > 1200 OR event_id IN (SELECT event_id FROM e WHERE event_type = 'go_around'
      QUALIFY count(*) OVER (PARTITION BY icao24) > 1) THEN 3 WHEN duration_s >= 600 OR busy_stacks >= 2 THEN 2 ELSE 1 END AS INTEGER) AS severity FROM bundle""",
)
def rule_cause_label(spark, sf_dir):
    return V.label_causes(V.with_repeats(bundle(spark, sf_dir), episodes(spark, sf_dir)))


# --- threshold probe -------------------------------------------------------------------------

_ALL_REPORTS = feature_ctes().replace(
    "event_ts IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL AND alt_ft IS NOT NULL", "event_ts IS NOT NULL"
)
_PROBE = f"""{POS}, {_ALL_REPORTS},
z AS (SELECT *, coalesce(dist_stack_nm <= 12 AND alt_ft >= 7000 AND NOT on_ground, FALSE) AS zone FROM feat),
place AS (SELECT icao24, nearest_stack FROM z WHERE zone GROUP BY icao24, nearest_stack
          QUALIFY row_number() OVER (PARTITION BY icao24 ORDER BY count(*) DESC, nearest_stack) = 1),
enough AS (SELECT icao24, arg_min(callsign, event_ts) FILTER (callsign IS NOT NULL) AS callsign FROM (SELECT * FROM pos ORDER BY icao24, event_ts, callsign)
           GROUP BY icao24 HAVING count(*) >= 5),
probe AS (SELECT icao24, min(place.nearest_stack) AS stack, count(*) FILTER (zone) AS points_in_zone,
  {steady_sql('(max(us) FILTER (zone) - min(us) FILTER (zone)) / 6e7', 1)} AS minutes_in_zone, {steady_sql('min(dist_stack_nm)', 1)} AS min_dist_nm,
  CAST(trunc(min(alt_ft) FILTER (zone)) AS BIGINT) AS min_alt_ft, CAST(trunc(max(alt_ft) FILTER (zone)) AS BIGINT) AS max_alt_ft,
  {steady_sql('max(abs(cum_turn_deg)) FILTER (zone)', 0)} AS max_turn_deg, CAST(trunc(max(gap_s) FILTER (zone)) AS BIGINT) AS max_gap_s
  FROM z JOIN place USING (icao24) GROUP BY icao24),
report AS (SELECT probe.*, enough.callsign FROM probe JOIN enough USING (icao24))"""


@query("zone_probe", f"{_PROBE} SELECT * FROM report")
def zone_probe(spark, sf_dir):
    return B.zone_probe(positions(spark, sf_dir), RULES)


@query("zone_probe_top", f"{_PROBE} SELECT * FROM report ORDER BY max_turn_deg DESC, icao24 LIMIT 30")
def zone_probe_top(spark, sf_dir):
    return B.top(B.zone_probe(positions(spark, sf_dir), RULES))


_BUCKETS = ", ".join(
    f"({i}, '{label}', {lo}, {hi})"
    for i, (label, lo, hi) in enumerate(zip(config.TURN_LABELS, config.TURN_BUCKETS, config.TURN_BUCKETS[1:]))
)


@query(
    "turn_histogram",
    f"""{_PROBE} SELECT CAST(i AS INTEGER) AS position, label AS bucket, count(icao24) AS n FROM (VALUES {_BUCKETS}) b(i, label, lo, hi)
    LEFT JOIN report ON max_turn_deg >= lo AND max_turn_deg < hi GROUP BY i, label""",
)
def turn_histogram(spark, sf_dir):
    return B.histogram(B.zone_probe(positions(spark, sf_dir), RULES))


@query(
    "threshold_sweep",
    f"""{_PROBE} SELECT CAST(t AS INTEGER) AS threshold, count(icao24) AS keys, round(quantile_cont(minutes_in_zone, 0.5), 6) AS median_min
    FROM (SELECT unnest([270, 300, 360, 540]) AS t) LEFT JOIN report ON max_turn_deg >= t GROUP BY t""",
)
def threshold_sweep(spark, sf_dir):
    return rounded(B.threshold_sweep(B.zone_probe(positions(spark, sf_dir), RULES)))
