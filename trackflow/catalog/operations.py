"""Queries of occupancy, merges, change logs and the reports built on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from trackflow.catalog import proxies as P
from trackflow.catalog.registry import query, rounded, steady_sql
from trackflow.config import STACKS
from trackflow.operators import cdc, occupancy, upsert
from trackflow.plans import analytics as A
from trackflow.session import shared_folder

DAY = 86400
SPAN = (P.EPOCH, P.EPOCH + 31 * DAY)  # every minute the events touch
NOW_TEXT = "2024-01-20 12:00:00"
NOW_SQL = f"TIMESTAMP '{NOW_TEXT}'"


def now():
    return F.lit(NOW_TEXT).cast("timestamp")


def load(name):
    return lambda spark, sf_dir: P.load(spark, sf_dir, getattr(P, name))


episodes, queue_log, forecasts = load("EPISODES"), load("QUEUE_LOG"), load("FORECASTS")
assessments, reviews = load("ASSESSMENTS"), load("REVIEWS")

EPS = P.ctes(e=P.EPISODES)
_STACK_LIST = ", ".join(f"'{p.id}'" for p in STACKS)
_OCC = f"""
grid AS (SELECT m AS minute, s AS stack FROM (SELECT unnest(generate_series(make_timestamp({SPAN[0]}000000), make_timestamp({SPAN[1]}000000), INTERVAL 1 MINUTE)) AS m),
         (SELECT unnest([{_STACK_LIST}]) AS s)),
near AS (SELECT *, unnest(generate_series(date_trunc('minute', started_at) - INTERVAL 1 MINUTE, date_trunc('minute', ended_at), INTERVAL 1 MINUTE)) AS minute
         FROM e WHERE event_type = 'holding'),
touched AS (SELECT * FROM near WHERE started_at <= minute + INTERVAL 1 MINUTE AND ended_at >= minute),
occ AS (SELECT g.minute, g.stack, CAST(count(DISTINCT t.icao24) AS INTEGER) AS holding_count FROM grid g
        LEFT JOIN touched t ON t.location = g.stack AND t.minute = g.minute GROUP BY g.minute, g.stack)"""
_HOURLY = f"""
hourly AS (SELECT date_trunc('hour', started_at) AS hour, count(*) FILTER (event_type = 'holding') AS holding_flights,
  {steady_sql("avg(duration_s / 60e0) FILTER (event_type = 'holding')", 1)} AS mean_hold_min,
  {steady_sql("max(duration_s / 60e0) FILTER (event_type = 'holding')", 1)} AS max_hold_min,
  count(*) FILTER (event_type = 'go_around') AS go_arounds FROM e GROUP BY ALL)"""


@query("occupancy_per_minute", f"{EPS}, {_OCC} SELECT * FROM occ")
def occupancy_per_minute(spark, sf_dir):
    return occupancy.occupancy(episodes(spark, sf_dir), *SPAN)


@query(
    "occupancy_summary",
    f"""{EPS}, {_OCC} SELECT stack, max_by(holding_count, minute) AS now, max(holding_count) AS peak, {steady_sql('avg(holding_count)', 2)} AS mean
    FROM occ WHERE minute > make_timestamp({SPAN[1] - 2 * DAY}000000) GROUP BY stack""",
)
def occupancy_summary(spark, sf_dir):
    occ = occupancy.occupancy(episodes(spark, sf_dir), *SPAN)
    return occupancy.occupancy_summary(occ, F.timestamp_seconds(F.lit(SPAN[1] - 2 * DAY)))


@query("hourly_rollup", f"{EPS}, {_HOURLY} SELECT * FROM hourly")
def hourly_rollup(spark, sf_dir):
    return A.hourly_rollup(episodes(spark, sf_dir))


# --- merges: the table holds two thirds of the events, shorter than the incoming rows of some ----

_COLUMNS = (
    "event_id, event_type, icao24, callsign, location, started_at, ended_at, duration_s, trigger_ts, "
    "min_alt_ft, max_alt_ft, max_turn_deg, n_points"
)
GOLD = f"""
SELECT event_id, event_type, icao24, callsign, location, started_at, ended_at - INTERVAL 60 SECOND AS ended_at,
       duration_s - 60 AS duration_s, trigger_ts, min_alt_ft - 5e0 * (event_no % 3 - 1) AS min_alt_ft,
       max_alt_ft - 7e0 * (event_no % 2) AS max_alt_ft, max_turn_deg, n_points + 2 AS n_points,
       first_detected_at, updated_at, status, event_no FROM ({P.EPISODES}) WHERE status IN ('detected', 'assessed')
UNION ALL
SELECT {_COLUMNS}, first_detected_at, updated_at, status, event_no FROM ({P.EPISODES}) WHERE status = 'confirmed'
"""
FOUND = f"SELECT {_COLUMNS} FROM ({P.EPISODES}) WHERE status <> 'assessed'"
MERGE = P.ctes(t=GOLD, s=FOUND)
_GROWS = "s.ended_at > t.ended_at"


def _merged(names: dict[str, str], kept: list[str]) -> str:
    """Check SQL of a conditional merge: changed columns, kept columns, new rows."""
    columns = ", ".join(
        f"CASE WHEN t.event_id IS NULL THEN {new} WHEN {_GROWS} THEN {change} ELSE t.{c} END AS {c}"
        for c, (new, change) in names.items()
    )
    fixed = ", ".join(f"CASE WHEN t.event_id IS NULL THEN s.{c} ELSE t.{c} END AS {c}" for c in kept)
    return f"SELECT {fixed}, {columns} FROM t FULL OUTER JOIN s ON t.event_id = s.event_id"


_FIXED = ["event_id", "event_type", "icao24", "location", "started_at", "trigger_ts"]
_SHARED = {
    "ended_at": ("s.ended_at", "s.ended_at"),
    "duration_s": ("s.duration_s", "s.duration_s"),
    "callsign": ("s.callsign", "coalesce(s.callsign, t.callsign)"),
    "updated_at": (NOW_SQL, NOW_SQL),
    "first_detected_at": (NOW_SQL, "t.first_detected_at"),
}
_GOLD_ONLY = {
    "min_alt_ft": ("s.min_alt_ft", "least(t.min_alt_ft, s.min_alt_ft)"),
    "max_alt_ft": ("s.max_alt_ft", "greatest(t.max_alt_ft, s.max_alt_ft)"),
    "max_turn_deg": ("s.max_turn_deg", "greatest(t.max_turn_deg, s.max_turn_deg)"),
    "n_points": ("s.n_points", "s.n_points"),
}


def gold(spark, sf_dir):
    return P.load(spark, sf_dir, GOLD)


def found(spark, sf_dir):
    return P.load(spark, sf_dir, FOUND)


def through_table(spark, target, source, merge, at):
    """The stored target after a merge that rewrites only the days of the source."""
    path = shared_folder(spark, "table")
    upsert.write_days(target, path, at)
    upsert.merge_days(spark, path, source, merge, at)
    return spark.read.parquet(path).drop("event_date")


@query("merge_episodes", f"{MERGE} {_merged({**_SHARED, **_GOLD_ONLY}, _FIXED)}")
def merge_episodes(spark, sf_dir):
    target = gold(spark, sf_dir).drop("status", "event_no")
    return through_table(spark, target, found(spark, sf_dir), lambda t, s: upsert.merge_episodes(t, s, now()), "started_at")


@query("upsert_queue", f"{MERGE} {_merged({**_SHARED, 'status': (repr('detected'), 't.status')}, _FIXED)}")
def upsert_queue(spark, sf_dir):
    extra = ["min_alt_ft", "max_alt_ft", "max_turn_deg", "n_points"]
    target = gold(spark, sf_dir).drop(*extra, "event_no")
    return through_table(spark, target, found(spark, sf_dir).drop(*extra), lambda t, s: upsert.upsert_queue(t, s, now()), "started_at")


@query("changed_episodes", f"{MERGE} SELECT s.* FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.event_id = s.event_id AND t.ended_at = s.ended_at)")
def changed_episodes(spark, sf_dir):
    return upsert.changed(found(spark, sf_dir), gold(spark, sf_dir))


@query(
    "merge_occupancy",
    # Of the stored first half, counts are one too high; from half an hour before its end on, fresh rows replace it.
    f"""{EPS}, {_OCC}, fresh AS (SELECT *, minute >= make_timestamp({SPAN[0] + 15 * DAY - 1800}000000) AS is_new FROM occ)
    SELECT minute, stack, CASE WHEN is_new THEN holding_count ELSE holding_count + 1 END AS holding_count,
    CASE WHEN is_new THEN {NOW_SQL} ELSE minute END AS updated_at FROM fresh""",
)
def merge_occupancy(spark, sf_dir):
    occ = occupancy.occupancy(episodes(spark, sf_dir), *SPAN)
    cut = F.timestamp_seconds(F.lit(SPAN[0] + 15 * DAY))
    old = occ.where(F.col("minute") < cut).withColumns({"holding_count": F.col("holding_count") + 1, "updated_at": F.col("minute")})
    new = occ.where(F.col("minute") >= cut - F.expr("INTERVAL 30 MINUTES")).withColumn("updated_at", now())
    return through_table(spark, old, new, lambda t, s: upsert.replace_by_key(t, s, ["minute", "stack"]), "minute")


# Assessments already stored (one version) and a batch with repeats per event and version.
BATCH = """
SELECT doc_id AS assessment_id, $uuid('e' || (doc_id $div 3)) AS event_id, 'v' || (doc_id % 2) AS model_version, lang AS cause FROM documents
"""
STORED = """
SELECT doc_id AS assessment_id, $uuid('e' || (doc_id $div 3)) AS event_id, 'v' || quality AS model_version, 'other' AS cause FROM labels
"""


@query(
    "insert_if_absent",
    f"""{P.ctes(b=BATCH, o=STORED)} SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.event_id = b.event_id AND o.model_version = b.model_version)
    QUALIFY row_number() OVER (PARTITION BY event_id, model_version ORDER BY assessment_id) = 1""",
)
def insert_if_absent(spark, sf_dir):
    return upsert.insert_absent(
        P.load(spark, sf_dir, STORED), P.load(spark, sf_dir, BATCH), ["event_id", "model_version"], [F.col("assessment_id")]
    )


QUEUE = P.ctes(e=P.EPISODES, a=P.ASSESSMENTS, r=P.REVIEWS)


@query(
    "status_transition",
    f"""{QUEUE} SELECT event_id, CASE WHEN status = 'detected' AND event_id IN (SELECT event_id FROM a) THEN 'assessed' ELSE status END AS status,
    CASE WHEN status = 'detected' AND event_id IN (SELECT event_id FROM a) THEN {NOW_SQL} ELSE updated_at END AS updated_at FROM e""",
)
def status_transition(spark, sf_dir):
    queue = episodes(spark, sf_dir).select("event_id", "status", "updated_at")
    return upsert.mark_assessed(queue, assessments(spark, sf_dir), now())


@query(
    "apply_reviews",
    f"""{QUEUE}, l AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY reviewed_at DESC, review_id DESC) = 1)
    SELECT e.event_id, CASE WHEN l.verdict IS NULL THEN e.status WHEN l.verdict = 'not_an_event' THEN 'rejected' ELSE 'confirmed' END AS status,
    coalesce(l.reviewed_at, e.updated_at) AS updated_at FROM e LEFT JOIN l USING (event_id)""",
)
def apply_reviews(spark, sf_dir):
    queue = episodes(spark, sf_dir).select("event_id", "status", "updated_at")
    return upsert.apply_reviews(queue, reviews(spark, sf_dir))


# --- forecasts -------------------------------------------------------------------------------

FC = P.ctes(e=P.EPISODES, f=P.FORECASTS)
_SCORED = f"""
scored AS (SELECT f.* EXCLUDE (status), CASE WHEN d THEN m END AS actual_mean_hold_min,
  CASE WHEN d THEN CAST(coalesce(holding_flights, 0) AS INTEGER) END AS actual_holding_flights,
  CASE WHEN d THEN abs(predicted_mean_hold_min - m) END AS abs_error, CASE WHEN d THEN 'scored' ELSE status END AS status
  FROM (SELECT f.*, h.holding_flights, coalesce(h.mean_hold_min, 0e0) AS m, f.target_hour + INTERVAL 65 MINUTE <= {NOW_SQL} AS d
        FROM f LEFT JOIN hourly h ON h.hour = f.target_hour) f)"""
_SCORED = _SCORED.replace("f.* EXCLUDE (status)", "f.* EXCLUDE (status, holding_flights, m, d)")
SCORED = f"{FC}, {_HOURLY}, {_SCORED}"
_VERSUS = f"""
versus AS (SELECT s.forecast_id, s.target_hour, s.model_version, s.predicted_mean_hold_min, s.actual_mean_hold_min, s.abs_error,
  coalesce(h.mean_hold_min, 0e0) AS naive_pred_min, abs(coalesce(h.mean_hold_min, 0e0) - s.actual_mean_hold_min) AS naive_abs_error,
  CAST(hour(s.target_hour) AS INTEGER) AS hour_of_day FROM scored s LEFT JOIN hourly h ON h.hour + INTERVAL 1 HOUR = s.target_hour WHERE s.status = 'scored')"""


def scored(spark, sf_dir):
    hourly = A.hourly_rollup(episodes(spark, sf_dir))
    return upsert.score_forecasts(forecasts(spark, sf_dir), hourly, now())


@query("forecast_score", f"{SCORED} SELECT * REPLACE (round(abs_error, 6) AS abs_error) FROM scored")
def forecast_score(spark, sf_dir):
    return rounded(scored(spark, sf_dir))


@query("forecasts_due", f"{FC} SELECT * FROM f WHERE status = 'pending' AND target_hour + INTERVAL 65 MINUTE <= {NOW_SQL}")
def forecasts_due(spark, sf_dir):
    return upsert.due(forecasts(spark, sf_dir), now())


@query(
    "missing_forecasts",
    """WITH h AS (SELECT DISTINCT date_trunc('hour', ts) + INTERVAL 1 HOUR AS target_hour, 'click' AS model_version FROM events),
    f AS (SELECT DISTINCT date_trunc('hour', ts) AS target_hour, event_type AS model_version FROM events)
    SELECT * FROM h WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.target_hour = h.target_hour AND f.model_version = h.model_version)""",
)
def missing_forecasts(spark, sf_dir):
    have = forecasts(spark, sf_dir)
    expected = (
        have.select((F.col("target_hour") + F.expr("INTERVAL 1 HOUR")).alias("target_hour"))
        .distinct()
        .withColumn("model_version", F.lit("click"))
    )
    return upsert.missing_forecasts(expected, have)


@query("forecast_vs_persistence", f"{SCORED}, {_VERSUS} SELECT * REPLACE (round(abs_error, 6) AS abs_error, round(naive_abs_error, 6) AS naive_abs_error) FROM versus")
def forecast_vs_persistence(spark, sf_dir):
    hourly = A.hourly_rollup(episodes(spark, sf_dir))
    return rounded(A.with_persistence(scored(spark, sf_dir).where("status = 'scored'"), hourly))


@query(
    "forecast_error_summary",
    f"""{SCORED} SELECT model_version, {steady_sql('avg(abs_error)', 2)} AS mae_min, {steady_sql('avg(predicted_mean_hold_min - actual_mean_hold_min)', 2)} AS bias_min,
    count(*) AS forecasts FROM scored WHERE status = 'scored' GROUP BY model_version""",
)
def forecast_error_summary(spark, sf_dir):
    return A.forecast_errors(scored(spark, sf_dir).where("status = 'scored'"), ["model_version"])


# --- change log ------------------------------------------------------------------------------

LOG = P.ctes(q=P.QUEUE_LOG)
_LIFE = """
life AS (SELECT event_id, max_by(event_type, _sort_by) AS event_type, max_by(location, _sort_by) AS location, max_by(status, _sort_by) AS current_status,
  max_by(duration_s, _sort_by) AS duration_s, min(first_detected_at) AS detected_at, min(trigger_ts) AS trigger_ts,
  min(_timestamp) FILTER (status = 'assessed') AS assessed_at, min(_timestamp) FILTER (status IN ('confirmed', 'rejected')) AS reviewed_at
  FROM q WHERE _pg_change_type IN ('insert', 'update_postimage') GROUP BY event_id),
lifecycle AS (SELECT *, date_sub('second', trigger_ts, detected_at) AS detection_latency_s, date_sub('second', detected_at, assessed_at) AS time_to_assess_s,
  date_sub('second', detected_at, reviewed_at) AS time_to_review_s FROM life)"""


@query(
    "cdc_latest_rows",
    f"""{LOG}, k AS (SELECT * FROM q WHERE _pg_change_type <> 'update_preimage' QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY _sort_by DESC) = 1)
    SELECT * FROM k WHERE _pg_change_type <> 'delete'""",
)
def cdc_latest_rows(spark, sf_dir):
    return cdc.current_rows(queue_log(spark, sf_dir), "event_id")


@query("event_lifecycle", f"{LOG}, {_LIFE} SELECT * FROM lifecycle")
def event_lifecycle(spark, sf_dir):
    return cdc.lifecycle(queue_log(spark, sf_dir))


@query(
    "daily_summary",
    f"""{P.ctes(q=P.QUEUE_LOG, e=P.EPISODES, f=P.FORECASTS)}, {_LIFE}, {_HOURLY}, {_SCORED}, {_VERSUS},
    a AS (SELECT CAST(detected_at AS DATE) AS day, count(*) AS events, count(*) FILTER (event_type = 'holding') AS holding_events,
      count(*) FILTER (event_type = 'go_around') AS go_arounds, quantile_disc(detection_latency_s, 0.5) AS latency_p50_s,
      quantile_disc(detection_latency_s, 0.95) AS latency_p95_s, quantile_disc(time_to_review_s, 0.5) AS time_to_review_p50_s FROM lifecycle GROUP BY ALL),
    b AS (SELECT CAST(target_hour AS DATE) AS day, {steady_sql('avg(abs_error)', 2)} AS agent_mae_min, {steady_sql('avg(naive_abs_error)', 2)} AS naive_mae_min,
      count(*) AS forecasts_scored FROM versus GROUP BY ALL)
    SELECT * FROM a FULL OUTER JOIN b USING (day)""",
)
def daily_summary(spark, sf_dir):
    hourly = A.hourly_rollup(episodes(spark, sf_dir))
    versus = A.with_persistence(scored(spark, sf_dir).where("status = 'scored'"), hourly)
    return A.daily_summary(cdc.lifecycle(queue_log(spark, sf_dir)), versus)


_BEFORE = "SELECT event_no, status, duration_s, callsign FROM e WHERE status <> 'rejected'"
_AFTER = (
    "SELECT event_no, CASE WHEN status = 'assessed' THEN 'confirmed' ELSE status END AS status, duration_s, "
    "callsign FROM e WHERE status <> 'detected'"
)


@query(
    "cdc_from_snapshots",
    f"""{EPS}, o AS ({_BEFORE}), n AS ({_AFTER})
    SELECT n.*, 'insert' AS _pg_change_type, CAST(15 AS BIGINT) AS _sort_by FROM n WHERE event_no NOT IN (SELECT event_no FROM o)
    UNION ALL SELECT o.*, 'delete', 15 FROM o WHERE event_no NOT IN (SELECT event_no FROM n)
    UNION ALL SELECT o.*, 'update_preimage', 14 FROM o JOIN n USING (event_no) WHERE (o.status, o.duration_s, o.callsign) IS DISTINCT FROM (n.status, n.duration_s, n.callsign)
    UNION ALL SELECT n.*, 'update_postimage', 15 FROM o JOIN n USING (event_no) WHERE (o.status, o.duration_s, o.callsign) IS DISTINCT FROM (n.status, n.duration_s, n.callsign)""",
)
def cdc_from_snapshots(spark, sf_dir):
    e = episodes(spark, sf_dir).select("event_no", "status", "duration_s", "callsign")
    moved = F.when(F.col("status") == "assessed", "confirmed").otherwise(F.col("status"))
    before, after = e.where("status <> 'rejected'"), e.where("status <> 'detected'").withColumn("status", moved)
    return cdc.log_from_snapshots(before, after, ["event_no"], step=7)


# --- reviews ---------------------------------------------------------------------------------

_REVIEW_LOG = P.REVIEWS.replace("SELECT doc_id AS review_id", "SELECT 'insert' AS _pg_change_type, doc_id AS _sort_by, doc_id AS review_id")
_REVIEW_LOG += """
UNION ALL SELECT 'delete', doc_id + 1000000000, doc_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM labels WHERE quality = 0 AND toxic = 1
"""


@query(
    "review_agreement",
    f"""{P.ctes(l=_REVIEW_LOG, a=P.ASSESSMENTS, e=P.EPISODES)},
    r AS (SELECT * FROM l WHERE _pg_change_type = 'insert' AND review_id NOT IN (SELECT review_id FROM l WHERE _pg_change_type = 'delete')),
    x AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY reviewed_at DESC, review_id DESC) = 1),
    j AS (SELECT x.verdict, a.cause, a.model_version, a.confidence, e.event_type FROM x LEFT JOIN a USING (assessment_id) LEFT JOIN e ON e.event_id = x.event_id),
    g AS (SELECT event_type, cause, model_version, count(*) AS reviewed, count(*) FILTER (verdict = 'agree') AS agree, count(*) FILTER (verdict = 'disagree') AS disagree,
      count(*) FILTER (verdict = 'not_an_event') AS not_an_event, {steady_sql('avg(confidence)', 2)} AS mean_confidence FROM j GROUP BY ALL)
    SELECT *, {steady_sql('agree / CAST(nullif(agree + disagree, 0) AS DOUBLE)', 3)} AS agreement_rate, {steady_sql('1e0 - not_an_event / CAST(reviewed AS DOUBLE)', 3)} AS detection_precision FROM g""",
)
def review_agreement(spark, sf_dir):
    current = cdc.current_rows(P.load(spark, sf_dir, _REVIEW_LOG), "review_id")
    return A.agreement(A.review_facts(current, assessments(spark, sf_dir), episodes(spark, sf_dir)))


@query(
    "cascade_delete",
    f"""{QUEUE}, p AS (SELECT * FROM e WHERE NOT starts_with(icao24, '00000'))
    SELECT 'assessments' AS tab, assessment_id AS id FROM a WHERE event_id NOT IN (SELECT event_id FROM e WHERE starts_with(icao24, '00000'))
    UNION ALL SELECT 'reviews', review_id FROM r WHERE event_id NOT IN (SELECT event_id FROM e WHERE starts_with(icao24, '00000'))
    UNION ALL SELECT 'events', event_no FROM p""",
)
def cascade_delete(spark, sf_dir):
    parents, kept = upsert.cascade_delete(
        episodes(spark, sf_dir),
        {"assessments": assessments(spark, sf_dir), "reviews": reviews(spark, sf_dir)},
        F.col("icao24").startswith("00000"),
    )

    def rows(tab, df, key):
        return df.select(F.lit(tab).alias("tab"), F.col(key).alias("id"))

    return (
        rows("assessments", kept["assessments"], "assessment_id")
        .unionByName(rows("reviews", kept["reviews"], "review_id"))
        .unionByName(rows("events", parents, "event_no"))
    )
