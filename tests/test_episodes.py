"""Detection on synthetic tracks: positives, negatives, identity, invariances."""

import random
from dataclasses import replace
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.tracks import POINTS, SCHEMA, T0, approach, circling, on_line, reports
from trackflow.config import TrackRules
from trackflow.functions.geo import great_circle_nm
from trackflow.operators import episodes as E
from trackflow.operators.episodes import conform, episodes, episodes_in_window, redetected_ids, visits
from trackflow.operators.tracks import track_features, track_frames

RULES = TrackRules()
GO_AROUND = [(210, -700, False), (150, 1800, False), (60, 0, False)]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def found(spark, rows, rules=RULES):
    return sorted(conform(episodes(frame(spark, rows), rules)).collect(), key=lambda r: (r.started_at, r.event_type))


def test_holding_is_found(spark):
    (e,) = found(spark, circling())
    assert (e.event_type, e.location, e.callsign) == ("holding", "BNN", "TST1")
    assert e.max_turn_deg >= 360 and e.duration_s >= 600 and e.trigger_ts > e.started_at


def test_passing_through_is_not_holding(spark):
    p = POINTS["LAM"]
    assert found(spark, reports(on_line(p.lat, p.lon - 0.2, 90.0, 220), [(600, -800, False)], 11000.0)) == []


def test_go_around_is_found(spark):
    (e,) = found(spark, approach("27L", GO_AROUND))
    assert (e.event_type, e.location) == ("go_around", "27L")
    assert e.min_alt_ft < 1500 and e.ended_at == e.trigger_ts


@pytest.mark.parametrize(
    "rows",
    [
        approach("27R", [(270, -700, False), (180, 0, True)]),
        reports(on_line(POINTS["27L"].lat, POINTS["27L"].lon, 270.0, 160), [(90, 0, True), (240, 2000, False)], 0.0),
    ],
    ids=["landing", "departure"],
)
def test_landing_and_departure_are_not_go_arounds(spark, rows):
    assert found(spark, rows) == []


def test_id_is_stable_when_the_track_grows(spark):
    rows = circling("OCK", alt=8000.0, side=-1, lead=90, descent=0)
    (part,) = found(spark, rows[: len(rows) * 2 // 3])
    (whole,) = found(spark, rows)
    assert part.event_id == whole.event_id and len(whole.event_id) == 36
    assert whole.ended_at > part.ended_at


def test_sliding_windows_give_one_id(spark):
    start = T0 + timedelta(minutes=60)
    rows = reports(on_line(50.7, -1.7, 90.0, 1), [(3600, 0, False)], 20000.0) + circling("LAM", laps=5, start=start)
    df = frame(spark, rows)
    first, last = (F.lit(T0 + timedelta(minutes=m)) for m in (60, 300))
    got = redetected_ids(df, first, last, 120, RULES).collect()
    assert len(got) == 1 and got[0].windows > 10
    (direct,) = found(spark, rows)
    assert got[0].event_id == direct.event_id


def test_edge_margin_drops_cut_off_starts(spark):
    rows = circling(start=T0)
    df = frame(spark, rows)
    assert episodes_in_window(df, F.lit(T0 - timedelta(minutes=10)), RULES).count() == 0
    assert episodes_in_window(df, F.lit(T0 - timedelta(minutes=31)), RULES).count() == 1


def test_nulls_and_row_order_do_not_matter(spark):
    rows = [list(r) for r in circling()]
    rows[5][6], rows[7][8] = None, None
    shuffled = rows[:] + rows[10:20]
    random.Random(3).shuffle(shuffled)
    assert found(spark, rows) == found(spark, shuffled)
    assert len(found(spark, rows)) == 1


def test_too_few_reports(spark):
    loose = replace(RULES, hold_turn_deg=90.0)
    two = [r for r in circling()[5:9]][:2]
    assert found(spark, two, loose) == []


def mixed(seed):
    """Noisy tracks with gaps, ground reports and long stays, to cross many chunk borders."""
    rnd = random.Random(seed)
    rows = []
    for k in range(4):
        p = POINTS["BNN"] if k % 2 else POINTS["27L"]
        at = T0
        for _ in range(400):
            at += timedelta(seconds=rnd.choice([5, 20, 30, 60, 130, 200, 1500] if rnd.random() < 0.1 else [15, 30]))
            alt = rnd.choice([500.0, 1200.0, 2600.0, 4000.0]) if k % 2 == 0 else rnd.choice([7500.0] * 30 + [100.0])
            rows.append((f"00000{k}", None, at, p.lat + rnd.uniform(-0.05, 0.05), p.lon, alt,
                         rnd.choice([None, 1500.0, -300.0]), rnd.randrange(360) * 1.0, rnd.random() < 0.02))
    return rows


def test_chunk_length_does_not_change_results(spark):
    rows = mixed(5)
    reference = found(spark, rows, replace(RULES, chunk_s=10**7))
    assert {e.event_type for e in reference} == {"holding", "go_around"} and len(reference) > 20
    for size in (600, 900, 3600):
        assert found(spark, rows, replace(RULES, chunk_s=size)) == reference


def test_chunk_length_does_not_change_features_and_visits(spark):
    df = frame(spark, mixed(9)).cache()
    for operator in (track_features, visits):
        results = [sorted(operator(df, replace(RULES, chunk_s=n)).collect(), key=str) for n in (600, 3600, 10**7)]
        assert results[0] == results[1] == results[2] and results[0]


def brute_force(rows):
    """Plain-Python statement of the two rules on one key, used as an independent check."""
    from bisect import bisect_right

    from trackflow.config import EARTH_RADIUS_NM

    import math

    def dist(lat, lon, p):
        a, b, c, d = map(math.radians, (lat, lon, p.lat, p.lon))
        h = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
        return 2 * EARTH_RADIUS_NM * math.asin(math.sqrt(h))

    n = len(rows)
    secs = [(r[2] - T0).total_seconds() for r in rows]
    gap = [0] + [b - a for a, b in zip(secs, secs[1:])]
    turn = [0] + [
        (b[7] - a[7] + 540) % 360 - 180 if g <= 120 else 0 for a, b, g in zip(rows, rows[1:], gap[1:])
    ]
    cum = [sum(turn[bisect_right(secs, secs[i] - 480): i + 1]) for i in range(n)]
    vr = [r[6] if r[6] is not None else ((r[5] - rows[i - 1][5]) / (gap[i] / 60) if i else None) for i, r in enumerate(rows)]
    out, visit = [], []

    def close():
        if any(abs(cum[i]) >= 360 for i in visit):
            out.append(("holding", secs[visit[0]], secs[visit[-1]], len(visit)))
        visit.clear()

    for i, r in enumerate(rows):
        inside = min(dist(r[3], r[4], p) for p in RULES.stacks) <= 12 and r[5] >= 7000 and not r[8]
        if visit and (not inside or gap[i] > 180):
            close()
        if inside:
            visit.append(i)
    close()
    low = [min(dist(r[3], r[4], p) for p in RULES.runways) <= 6 and r[5] < 1500 and not r[8] for r in rows]
    for i in range(n):
        before = [k for k in range(i) if secs[k] >= secs[i] - 180]
        if not low[i] or (i and low[i - 1]) or not before or any(rows[k][8] for k in before):
            continue
        if max(rows[k][5] for k in before) < rows[i][5] + 300:
            continue
        for j in range(i + 1, n):
            if secs[j] > secs[i] + 300 or rows[j][8]:
                break
            if rows[j][5] > 2500 and vr[j] > 1000:
                out.append(("go_around", secs[i], secs[j], j - i + 1))
                break
    return out


def test_against_brute_force(spark):
    rows = mixed(21)
    got = {
        (e.icao24, e.event_type, e.started_at.timestamp(), e.ended_at.timestamp(), e.n_points)
        for e in found(spark, rows, replace(RULES, chunk_s=600))
    }
    want = {
        (key, kind, T0.timestamp() + a, T0.timestamp() + b, n)
        for key in {r[0] for r in rows}
        for kind, a, b, n in brute_force([r for r in rows if r[0] == key])
    }
    assert got == want and len(want) > 20


def test_a_busy_key_spreads_over_chunks(spark):
    """No window partition holds more than a chunk and its borders, copies of a report not counted."""
    rules = replace(RULES, chunk_s=900)
    seconds = spark.range(20_000).select(F.explode(F.array(F.col("id"), F.col("id"))).alias("s"))
    df = seconds.select(
        F.lit("hot").alias("icao24"), F.lit("H").alias("callsign"), F.timestamp_seconds(F.col("s") + 1_700_000_000).alias("event_ts"),
        F.lit(51.7).alias("lat"), F.lit(-0.5).alias("lon"), F.lit(9000.0).alias("alt_ft"), F.lit(0.0).alias("vr_fpm"),
        (F.col("s") * 3 % 360).cast("double").alias("track_deg"), F.lit(False).alias("on_ground"),
    )
    sizes = track_frames(df, rules).groupBy("icao24", "chunk").agg(F.count("*").alias("n"), F.count_if("home").alias("own"))
    largest, own, chunks = sizes.agg(F.max("n"), F.sum("own"), F.count("*")).first()
    assert largest <= rules.chunk_s + rules.back_s + rules.ahead_s and own == 20_000 and chunks >= 20_000 // 900
    (e,) = episodes(df, rules).collect()
    assert (e.n_points, e.duration_s) == (20_000, 19_999)


def test_distance_is_null_without_a_position(spark):
    df = spark.createDataFrame([(51.0, 0.0), (None, 0.0)], "lat double, lon double")
    far, none = df.select(great_circle_nm("lat", "lon", "52D", "0D").alias("nm")).collect()
    assert round(far.nm, 3) == 60.040 and none.nm is None
    (opposite,) = spark.range(1).select(great_circle_nm("0D", "0D", "0D", "180D").alias("nm")).collect()
    assert round(opposite.nm, 1) == 10807.3


@pytest.mark.parametrize(("look", "margin", "step"), [(1800, 900, 20), (1200, 300, 25), (1500, 200, 60), (900, 60, 60)])
def test_shared_windows_equal_copied_windows(spark, look, margin, step):
    """Ninety windows, cutting visits and approaches on either side, with guards longer and shorter than the look-back."""
    rules = replace(TrackRules(), chunk_s=700, lookback_s=look, edge_margin_s=margin)
    tail = [(240, -700, False), (60, 1800, False), (120, 1500, False)]
    rows = circling(laps=4, key="one") + circling(laps=12, key="two", start=T0 + timedelta(seconds=50), step=20) + circling(laps=2, side=-1, key="one", start=T0 + timedelta(minutes=31))
    rows += approach("27L", tail, key="away") + approach("09R", tail, key="two", start=T0 + timedelta(minutes=62)) + approach("27R", tail, key="gap")[::3]
    df = spark.createDataFrame(rows, SCHEMA)
    first, last = (F.lit(T0 + timedelta(seconds=s)) for s in (500, 500 + 89 * step))
    got = E.redetected_ids(df, first, last, step, rules)
    want = E.redetected_in_copies(df, first, last, step, rules)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and want.count() >= 2
    assert E.windows_share(rules) == (margin >= 180)
