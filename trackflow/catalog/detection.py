"""Queries of the track and episode operators."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackflow.catalog import proxies as P
from trackflow.catalog.registry import query, rounded
from trackflow.config import EARTH_RADIUS_NM, RUNWAYS, STACKS, TrackRules
from trackflow.functions.geo import great_circle_nm, nearest, point_id
from trackflow.functions.text import episode_id
from trackflow.operators import episodes as E
from trackflow.operators import tracks as K
from trackflow.operators.nearest import nearest_place
from trackflow.operators.windows import look_ahead, look_back, run_starts

# The proxy presses its data into 30 minutes; ten-minute chunks make visits cross chunk borders.
RULES = TrackRules(chunk_s=600)
WINDOW_RULES = replace(RULES, lookback_s=15 * 60, edge_margin_s=5 * 60)


def positions(spark, sf_dir) -> DataFrame:
    return P.load(spark, sf_dir, P.POSITIONS)


# --- check SQL building blocks ---------------------------------------------------------------


def distance_sql(lat: str, lon: str, p) -> str:
    h = (
        f"pow(sin(radians({p.lat}e0 - {lat}) / 2), 2) + cos(radians({lat})) * cos(radians({p.lat}e0)) "
        f"* pow(sin(radians({p.lon}e0 - {lon}) / 2), 2)"
    )
    return f"CASE WHEN {lat} IS NOT NULL AND {lon} IS NOT NULL THEN {2 * EARTH_RADIUS_NM!r}e0 * asin(sqrt(least(1e0, {h}))) END"


def nearest_sql(prefix: str, points, lat="lat", lon="lon") -> str:
    """Two columns: name and distance of the closest point."""
    d = [distance_sql(lat, lon, p) for p in points]
    best = f"least({', '.join(d)})"
    names = " ".join(f"WHEN {x} = {best} THEN '{p.id}'" for x, p in zip(d, points))
    return f"CASE {names} END AS nearest_{prefix}, {best} AS dist_{prefix}_nm"


def feature_ctes(source: str = "pos", part: str = "icao24") -> str:
    """Features as plain windows over the whole key: no chunks, a range frame for the rolling turn."""
    return f"""
valid AS (SELECT * FROM {source} WHERE event_ts IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL AND alt_ft IS NOT NULL),
uniq AS (SELECT * REPLACE (max(callsign) OVER (PARTITION BY {part}, event_ts) AS callsign), epoch_us(event_ts) AS us FROM valid
         QUALIFY row_number() OVER (PARTITION BY {part}, event_ts ORDER BY lat NULLS FIRST, lon NULLS FIRST,
             alt_ft NULLS FIRST, vr_fpm NULLS FIRST, track_deg NULLS FIRST, on_ground NULLS FIRST) = 1),
geo AS (SELECT * REPLACE (coalesce(on_ground, FALSE) AS on_ground), {nearest_sql("stack", STACKS)}, {nearest_sql("rwy", RUNWAYS)},
        (us - lag(us) OVER w) / 1e6 AS gap, track_deg - lag(track_deg) OVER w AS dt, alt_ft - lag(alt_ft) OVER w AS da
        FROM uniq WINDOW w AS (PARTITION BY {part} ORDER BY us)),
turns AS (SELECT * REPLACE (coalesce(vr_fpm, da / (gap / 60e0)) AS vr_fpm),
          CASE WHEN gap <= 120 AND dt IS NOT NULL THEN (dt + 540e0) % 360e0 - 180e0 ELSE 0e0 END AS dtrack,
          coalesce(gap, 0e0) AS gap_s FROM geo),
feat AS (SELECT *, sum(dtrack) OVER (PARTITION BY {part} ORDER BY us RANGE BETWEEN 479999999 PRECEDING AND CURRENT ROW) AS cum_turn_deg
         FROM turns)"""


def visit_ctes(part: str = "icao24") -> str:
    return f"""
zoned AS (SELECT *, coalesce(dist_stack_nm <= 12 AND alt_ft >= 7000 AND NOT on_ground, FALSE) AS zone FROM feat),
marked AS (SELECT *, zone AND (NOT coalesce(lag(zone) OVER (PARTITION BY {part} ORDER BY us), FALSE) OR gap_s > 180) AS opens FROM zoned),
numbered AS (SELECT *, sum(CASE WHEN opens THEN 1 ELSE 0 END) OVER (PARTITION BY {part} ORDER BY us) AS visit FROM marked)"""


def holding_ctes(part: str = "icao24") -> str:
    return f"""
place AS (SELECT {part}, visit, nearest_stack FROM numbered WHERE zone GROUP BY {part}, visit, nearest_stack
          QUALIFY row_number() OVER (PARTITION BY {part}, visit ORDER BY count(*) DESC, nearest_stack) = 1),
holds AS (SELECT 'holding' AS event_type, {part}, visit, min(us) AS us0, max(us) AS us1,
          min(CASE WHEN abs(cum_turn_deg) >= 360 THEN us END) AS trig, min(alt_ft) AS min_alt_ft, max(alt_ft) AS max_alt_ft,
          max(abs(cum_turn_deg)) AS max_turn_deg, count(*) AS n_points
          FROM numbered WHERE zone GROUP BY {part}, visit HAVING max(abs(cum_turn_deg)) >= 360),
holding AS (SELECT holds.* EXCLUDE (visit), place.nearest_stack AS location FROM holds JOIN place USING ({part}, visit))"""


def approach_ctes(part: str = "icao24") -> str:
    same = " AND ".join(f"f.{k.strip()} = c.{k.strip()}" for k in part.split(","))
    cols = ", ".join(f"c.{k.strip()}" for k in part.split(","))
    return f"""
lows AS (SELECT *, coalesce(dist_rwy_nm <= 6 AND alt_ft < 1500 AND NOT on_ground, FALSE) AS low,
         max(on_ground) OVER b AS was_ground, max(alt_ft) OVER b AS was_alt FROM feat
         WINDOW b AS (PARTITION BY {part} ORDER BY us RANGE BETWEEN 180000000 PRECEDING AND 1 PRECEDING)),
firsts AS (SELECT *, low AND NOT coalesce(lag(low) OVER (PARTITION BY {part} ORDER BY us), FALSE) AS first_low FROM lows),
cand AS (SELECT * FROM firsts WHERE first_low AND NOT was_ground AND was_alt >= alt_ft + 300),
ahead AS (SELECT {cols}, c.us AS us0, c.nearest_rwy AS location,
          min(f.us) FILTER (NOT f.on_ground AND f.alt_ft > 2500 AND f.vr_fpm > 1000) AS climb_us, min(f.us) FILTER (f.on_ground) AS ground_us
          FROM cand c JOIN feat f ON {same} AND f.us > c.us AND f.us <= c.us + 300000000 GROUP BY ALL),
hits AS (SELECT * FROM ahead WHERE climb_us IS NOT NULL AND (ground_us IS NULL OR climb_us < ground_us)),
aborted AS (SELECT 'go_around' AS event_type, {cols}, c.us0, c.climb_us AS us1, c.climb_us AS trig, min(f.alt_ft) AS min_alt_ft,
            max(f.alt_ft) AS max_alt_ft, sum(abs(f.dtrack)) AS max_turn_deg, count(*) AS n_points, c.location
            FROM hits c JOIN feat f ON {same} AND f.us BETWEEN c.us0 AND c.climb_us
            GROUP BY {cols}, c.us0, c.climb_us, c.location)"""


def episode_ctes(source: str, part: str = "icao24") -> str:
    columns = (
        f"{part}, event_type, location, us0, us1, trig, min_alt_ft, max_alt_ft, max_turn_deg, n_points"
    )
    return f"""
who AS (SELECT {part}, max_by(trim(callsign), us) FILTER (callsign IS NOT NULL) AS callsign FROM uniq GROUP BY ALL),
enough AS (SELECT {part} FROM valid GROUP BY ALL HAVING count(*) >= 3),
eps AS (SELECT {columns} FROM {source.replace('+', f' UNION ALL SELECT {columns} FROM ')}),
out AS (SELECT {part + ', ' if part != 'icao24' else ''}
        CAST(CAST(md5(icao24 || '|' || event_type || '|' || strftime(make_timestamp(us0), '%Y-%m-%dT%H:%M:%S')) AS UUID) AS VARCHAR) AS event_id,
        event_type, {'icao24, ' if part == 'icao24' else ''}callsign, location, make_timestamp(us0) AS started_at, make_timestamp(us1) AS ended_at,
        (us1 - us0) // 1000000 AS duration_s, make_timestamp(trig) AS trigger_ts,
        round(min_alt_ft, 6) AS min_alt_ft, round(max_alt_ft, 6) AS max_alt_ft, round(max_turn_deg, 6) AS max_turn_deg, n_points
        FROM eps JOIN enough USING ({part}) LEFT JOIN who USING ({part}))"""


POS = P.ctes(pos=P.POSITIONS)
FEATURES = f"{POS}, {feature_ctes()}"
ALL_EPISODES = f"{FEATURES}, {visit_ctes()}, {holding_ctes()}, {approach_ctes()}, {episode_ctes('holding+aborted')}"

# --- queries ---------------------------------------------------------------------------------


@query(
    "haversine_distance",
    f"""{POS} SELECT icao24, event_ts, lat, lon, round({distance_sql('lat', 'lon', STACKS[2])}, 6) AS nm FROM pos""",
)
def haversine_distance(spark, sf_dir):
    p = STACKS[2]
    nm = great_circle_nm("lat", "lon", f"{p.lat}D", f"{p.lon}D")
    return positions(spark, sf_dir).select("icao24", "event_ts", "lat", "lon", F.round(nm, 6).alias("nm"))


@query(
    "nearest_point",
    f"""{POS}, n AS (SELECT icao24, event_ts, {nearest_sql('stack', STACKS)}, {nearest_sql('rwy', RUNWAYS)} FROM pos WHERE lat IS NOT NULL)
    SELECT * REPLACE (round(dist_stack_nm, 6) AS dist_stack_nm, round(dist_rwy_nm, 6) AS dist_rwy_nm) FROM n""",
)
def nearest_point(spark, sf_dir):
    at = positions(spark, sf_dir).where("lat IS NOT NULL")
    stack, rwy = (nearest("lat", "lon", p) for p in (STACKS, RUNWAYS))
    return rounded(
        at.select("icao24", "event_ts", stack.alias("s"), rwy.alias("r")).select(
            "icao24", "event_ts", point_id(F.col("s.rank"), STACKS).alias("nearest_stack"), F.col("s.dist").alias("dist_stack_nm"),
            point_id(F.col("r.rank"), RUNWAYS).alias("nearest_rwy"), F.col("r.dist").alias("dist_rwy_nm"),
        )
    )


# Every customer is a place inside of the box.
PLACES = """
SELECT c_custkey AS place, 506e-1 + (c_custkey * 7919 % 10007) / 10007e0 * 172e-2 AS lat, -181e-2 + (c_custkey * 104729 % 10009) / 10009e0 * 27e-1 AS lon
FROM customer
"""


@query(
    "nearest_of_many",
    f"""{P.ctes(pos=P.POSITIONS, places=PLACES)}, spots AS (SELECT DISTINCT lat, lon FROM pos WHERE lat IS NOT NULL AND lon IS NOT NULL),
    pairs AS (SELECT s.lat, s.lon, place, {2 * EARTH_RADIUS_NM!r}e0 * asin(sqrt(least(1e0, pow(sin(radians(p.lat - s.lat) / 2), 2)
        + cos(radians(s.lat)) * cos(radians(p.lat)) * pow(sin(radians(p.lon - s.lon) / 2), 2)))) AS nm FROM spots s CROSS JOIN places p),
    best AS (SELECT lat, lon, arg_min(place, nm) AS nearest_id, round(min(nm), 6) AS nearest_nm FROM pairs GROUP BY ALL)
    SELECT icao24, event_ts, nearest_id, nearest_nm FROM pos LEFT JOIN best USING (lat, lon)""",
)
def nearest_of_many(spark, sf_dir):
    at = positions(spark, sf_dir).select("icao24", "event_ts", "lat", "lon")
    return rounded(nearest_place(at, P.load(spark, sf_dir, PLACES), "place").drop("lat", "lon"))


@query(
    "track_features",
    f"""{FEATURES} SELECT icao24, event_ts, callsign, round(lat, 6) AS lat, round(lon, 6) AS lon, round(alt_ft, 6) AS alt_ft,
    round(vr_fpm, 6) AS vr_fpm, track_deg, on_ground, nearest_stack, round(dist_stack_nm, 6) AS dist_stack_nm, nearest_rwy,
    round(dist_rwy_nm, 6) AS dist_rwy_nm, dtrack, gap_s, cum_turn_deg FROM feat""",
)
def track_features(spark, sf_dir):
    return rounded(K.track_features(positions(spark, sf_dir), RULES))


@query("rolling_turn", f"{FEATURES} SELECT icao24, event_ts, dtrack, cum_turn_deg FROM feat")
def rolling_turn(spark, sf_dir):
    frames = K.track_frames(positions(spark, sf_dir), RULES).where("home")
    return rounded(frames.select("icao24", F.timestamp_micros("us").alias("event_ts"), "dtrack", K.degrees(F.col("cum_micro")).alias("cum_turn_deg")))


@query(
    "visit_sessions",
    f"""{FEATURES}, {visit_ctes()} SELECT icao24, make_timestamp(min(us)) AS started_at, make_timestamp(max(us)) AS ended_at,
    count(*) AS n_points, round(max(abs(cum_turn_deg)), 6) AS max_turn_deg FROM numbered WHERE zone GROUP BY icao24, visit""",
)
def visit_sessions(spark, sf_dir):
    return rounded(E.visits(positions(spark, sf_dir), RULES))


@query(
    "run_starts",
    f"""{FEATURES}, l AS (SELECT *, coalesce(dist_rwy_nm <= 6 AND alt_ft < 1500 AND NOT on_ground, FALSE) AS low FROM feat),
    f AS (SELECT *, low AND NOT coalesce(lag(low) OVER (PARTITION BY icao24 ORDER BY us), FALSE) AS first_low FROM l)
    SELECT icao24, event_ts, nearest_rwy, round(alt_ft, 6) AS alt_ft FROM f WHERE first_low""",
)
def low_run_starts(spark, sf_dir):
    return rounded(run_starts(positions(spark, sf_dir), RULES))


@query(
    "look_back_frame",
    f"""{FEATURES} SELECT icao24, event_ts, coalesce(max(on_ground) OVER b, FALSE) AS ground_before, round(max(alt_ft) OVER b, 6) AS alt_before
    FROM feat WINDOW b AS (PARTITION BY icao24 ORDER BY us RANGE BETWEEN 180000000 PRECEDING AND 1 PRECEDING)""",
)
def look_back_frame(spark, sf_dir):
    return rounded(look_back(positions(spark, sf_dir), RULES))


@query(
    "look_ahead_frame",
    f"""{FEATURES} SELECT icao24, event_ts, make_timestamp(min(CASE WHEN on_ground THEN us END) OVER a) AS ground_ts,
    make_timestamp(min(CASE WHEN NOT on_ground AND alt_ft > 2500 AND vr_fpm > 1000 THEN us END) OVER a) AS climb_ts
    FROM feat WINDOW a AS (PARTITION BY icao24 ORDER BY us RANGE BETWEEN 1 FOLLOWING AND 300000000 FOLLOWING)""",
)
def look_ahead_frame(spark, sf_dir):
    return look_ahead(positions(spark, sf_dir), RULES)


@query(
    "deterministic_id",
    f"""{POS} SELECT icao24, event_ts, CAST(CAST(md5(icao24 || '|holding|' || strftime(event_ts, '%Y-%m-%dT%H:%M:%S')) AS UUID) AS VARCHAR) AS event_id FROM pos""",
)
def deterministic_id(spark, sf_dir):
    return positions(spark, sf_dir).select(
        "icao24", "event_ts", episode_id(F.col("icao24"), F.lit("holding"), F.col("event_ts")).alias("event_id")
    )


@query("holding_episodes", f"{FEATURES}, {visit_ctes()}, {holding_ctes()}, {episode_ctes('holding')} SELECT * FROM out")
def holding_episodes(spark, sf_dir):
    return rounded(E.conform(E.episodes(positions(spark, sf_dir), RULES, kinds=["holding"])))


@query("go_around_episodes", f"{FEATURES}, {approach_ctes()}, {episode_ctes('aborted')} SELECT * FROM out")
def go_around_episodes(spark, sf_dir):
    return rounded(E.conform(E.episodes(positions(spark, sf_dir), RULES, kinds=["go_around"])))


@query("episodes_all", f"{ALL_EPISODES} SELECT * FROM out")
def episodes_all(spark, sf_dir):
    return rounded(E.conform(E.episodes(positions(spark, sf_dir), RULES)))


_WINDOW_START = P.EPOCH + 10 * 60


@query(
    "episodes_windowed",
    f"""{POS}, recent AS (SELECT * FROM pos WHERE event_ts > make_timestamp({_WINDOW_START}000000)),
    {feature_ctes('recent')}, {visit_ctes()}, {holding_ctes()}, {approach_ctes()}, {episode_ctes('holding+aborted')}
    SELECT * FROM out WHERE started_at >= make_timestamp({_WINDOW_START + 300}000000)""",
)
def episodes_windowed(spark, sf_dir):
    start = F.timestamp_seconds(F.lit(_WINDOW_START))
    return rounded(E.conform(E.episodes_in_window(positions(spark, sf_dir), start, WINDOW_RULES)))


@query(
    "sliding_redetect",
    f"""{POS}, spread AS (SELECT pos.*, w.n AS window_no FROM pos JOIN (SELECT unnest(range(0, 4)) AS n) w
        ON event_ts > make_timestamp(({P.EPOCH} + w.n * 300) * 1000000) AND event_ts <= make_timestamp(({P.EPOCH} + 900 + w.n * 300) * 1000000)),
    {feature_ctes('spread', 'window_no, icao24')}, {visit_ctes('window_no, icao24')}, {holding_ctes('window_no, icao24')},
    {approach_ctes('window_no, icao24')}, {episode_ctes('holding+aborted', 'window_no, icao24')}
    SELECT event_id, count(*) AS windows, min(started_at) AS started_at, max(ended_at) AS ended_at FROM out
    WHERE started_at >= make_timestamp(({P.EPOCH} + window_no * 300 + 300) * 1000000) GROUP BY event_id""",
)
def sliding_redetect(spark, sf_dir):
    first, last = (F.timestamp_seconds(F.lit(P.EPOCH + m * 60)) for m in (15, 30))
    return E.redetected_ids(positions(spark, sf_dir), first, last, 300, WINDOW_RULES)
