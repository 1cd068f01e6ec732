"""Merges, change logs, joins, occupancy and reports on small tables."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from trackflow.config import STACKS
from trackflow.operators import cdc, joins, occupancy, upsert
from trackflow.operators.quantiles import exact_percentiles
from trackflow.operators.sessions import session_counts
from trackflow.plans import analytics, evidence, probe

T0 = datetime(2026, 1, 5, 9, 0)
LOG = "event_id string, status string, note string, _pg_change_type string, _timestamp timestamp, _sort_by long"


def at(minutes):
    return T0 + timedelta(minutes=minutes)


def log(spark, *rows):
    return spark.createDataFrame([(k, s, None, kind, at(n), n) for n, (k, s, kind) in enumerate(rows)], LOG)


def test_current_rows(spark):
    df = log(
        spark,
        ("only", "a", "insert"),
        ("grown", "a", "insert"), ("grown", "b", "update_postimage"), ("grown", "c", "update_postimage"),
        ("gone", "a", "insert"), ("gone", "b", "update_postimage"), ("gone", "b", "delete"),
        ("back", "a", "insert"), ("back", "a", "delete"), ("back", "z", "insert"),
        ("image", "a", "insert"), ("image", "x", "update_preimage"),
        (None, "a", "insert"),
    )
    assert {r.event_id: r.status for r in cdc.current_rows(df, "event_id").collect()} == {
        "only": "a", "grown": "c", "back": "z", "image": "a",
    }


def test_snapshot_log_round_trip(spark):
    rnd = random.Random(4)
    schema = "event_id int, status string, note string"
    before = spark.createDataFrame([(i, rnd.choice("ab"), rnd.choice([None, "x"])) for i in range(60)], schema)
    after = spark.createDataFrame([(i, rnd.choice("ab"), rnd.choice([None, "x"])) for i in range(30, 90)], schema)
    first = cdc.log_from_snapshots(spark.createDataFrame([], schema), before, ["event_id"], step=1)
    second = cdc.log_from_snapshots(before, after, ["event_id"], step=2)
    rebuilt = cdc.current_rows(first.unionByName(second), "event_id").select("event_id", "status", "note")
    assert sorted(map(tuple, rebuilt.collect()), key=str) == sorted(map(tuple, after.collect()), key=str)
    assert cdc.log_from_snapshots(after, after, ["event_id"], step=3).count() == 0


def test_lifecycle_keeps_deleted_events(spark):
    schema = (
        "event_id string, event_type string, location string, status string, duration_s long, trigger_ts timestamp, "
        "first_detected_at timestamp, _pg_change_type string, _timestamp timestamp, _sort_by long"
    )
    rows = [
        ("e", "holding", "BNN", s, n, at(0), at(2), kind, at(10 * n), n)
        for n, (s, kind) in enumerate([("detected", "insert"), ("assessed", "update_postimage"), ("confirmed", "update_postimage"), ("x", "delete")])
    ]
    (r,) = cdc.lifecycle(spark.createDataFrame(rows, schema)).collect()
    assert (r.current_status, r.detection_latency_s, r.time_to_assess_s, r.time_to_review_s) == ("confirmed", 120, 480, 1080)


EPISODE = (
    "event_id string, callsign string, started_at timestamp, ended_at timestamp, duration_s long, min_alt_ft double, "
    "max_alt_ft double, max_turn_deg double, n_points long"
)


def test_merge_episodes_policy(spark):
    base = spark.createDataFrame(
        [("grow", "A", at(0), at(5), 300, 7000.0, 9000.0, 400.0, 10), ("same", "B", at(0), at(5), 300, 1.0, 2.0, 3.0, 4)], EPISODE
    ).withColumn("first_detected_at", F.lit(at(1))).withColumn("updated_at", F.lit(at(1)))
    incoming = spark.createDataFrame(
        [("grow", None, at(1), at(9), 540, 7500.0, 9500.0, 390.0, 7), ("same", "C", at(0), at(5), 9, 0.0, 9.0, 9.0, 9),
         ("new", "D", at(3), at(4), 60, 5.0, 6.0, 7.0, 8)], EPISODE,
    )
    got = {r.event_id: r for r in upsert.merge_episodes(base, incoming, F.lit(at(60))).collect()}
    grow = got["grow"]
    assert (grow.callsign, grow.started_at, grow.ended_at, grow.n_points) == ("A", at(0), at(9), 7)
    assert (grow.min_alt_ft, grow.max_alt_ft, grow.max_turn_deg) == (7000.0, 9500.0, 400.0)
    assert (grow.first_detected_at, grow.updated_at) == (at(1), at(60))
    assert (got["same"].callsign, got["same"].updated_at) == ("B", at(1))
    assert (got["new"].first_detected_at, got["new"].n_points) == (at(60), 8)


def test_queue_status_is_never_touched(spark):
    found = spark.createDataFrame([("e", "A", at(0), at(9), 540)], "event_id string, callsign string, started_at timestamp, ended_at timestamp, duration_s long")
    empty = found.where("false").select("*", F.lit("").alias("status"), F.lit(at(0)).alias("first_detected_at"), F.lit(at(0)).alias("updated_at"))
    first = upsert.upsert_queue(empty, found, F.lit(at(1)))
    assert first.collect()[0].status == "detected"
    reviewed = first.withColumn("status", F.lit("confirmed"))
    longer = found.withColumn("ended_at", F.lit(at(12)))
    (r,) = upsert.upsert_queue(reviewed, longer, F.lit(at(13))).collect()
    assert (r.status, r.ended_at, r.first_detected_at) == ("confirmed", at(12), at(1))


def test_reviews_and_assessments_move_status(spark):
    queue = spark.createDataFrame([(k, s, at(0)) for k, s in [("a", "detected"), ("b", "confirmed"), ("c", "detected")]], "event_id string, status string, updated_at timestamp")
    seen = spark.createDataFrame([("a",), ("a",), ("b",)], "event_id string")
    assert {r.event_id: r.status for r in upsert.mark_assessed(queue, seen, F.lit(at(5))).collect()} == {"a": "assessed", "b": "confirmed", "c": "detected"}
    reviews = spark.createDataFrame([(1, "a", "agree", at(1)), (2, "a", "not_an_event", at(2)), (3, "c", "disagree", at(1))], "review_id int, event_id string, verdict string, reviewed_at timestamp")
    assert {r.event_id: r.status for r in upsert.apply_reviews(queue, reviews).collect()} == {"a": "rejected", "b": "confirmed", "c": "confirmed"}


def test_forecast_scoring(spark):
    fc = spark.createDataFrame([(1, T0, 5.0, "pending"), (2, at(60), 5.0, "pending"), (3, at(240), 5.0, "pending")], "forecast_id int, target_hour timestamp, predicted_mean_hold_min double, status string")
    hourly = spark.createDataFrame([(T0, 8.0, 3)], "hour timestamp, mean_hold_min double, holding_flights long")
    got = {r.forecast_id: (r.status, r.actual_mean_hold_min, r.actual_holding_flights, r.abs_error) for r in upsert.score_forecasts(fc, hourly, F.lit(at(125))).collect()}
    assert got == {1: ("scored", 8.0, 3, 3.0), 2: ("scored", 0.0, 0, 5.0), 3: ("pending", None, None, None)}
    assert upsert.due(fc, F.lit(at(125))).count() == 2 and upsert.due(fc, F.lit(at(124))).count() == 1


def test_agreement_guards_empty_denominators(spark):
    facts = spark.createDataFrame([("h", "wind", "v", "not_an_event", 0.5), ("h", "wind", "v", "not_an_event", None)], "event_type string, cause string, model_version string, verdict string, confidence double")
    (r,) = analytics.agreement(facts).collect()
    assert (r.reviewed, r.agreement_rate, r.detection_precision, r.mean_confidence) == (2, None, 0.0, 0.5)


def test_latest_review_wins_and_assessment_may_be_missing(spark):
    reviews = spark.createDataFrame([(1, "e", 7, "agree", at(1)), (2, "e", None, "disagree", at(2))], "review_id int, event_id string, assessment_id int, verdict string, reviewed_at timestamp")
    said = spark.createDataFrame([(7, "wind", 1, 0.5, "v")], "assessment_id int, cause string, severity int, confidence double, model_version string")
    events = spark.createDataFrame([("e", "holding")], "event_id string, event_type string")
    (r,) = analytics.review_facts(reviews, said, events).collect()
    assert (r.verdict, r.cause, r.event_type) == ("disagree", None, "holding")


@pytest.mark.parametrize("seed", range(3))
def test_time_joins_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    left = [(i, rnd.choice("xyz"), at(rnd.randrange(3000)), at(rnd.randrange(3000))) for i in range(150)]
    right = sorted({(rnd.choice("xy"), at(rnd.randrange(0, 3000, 7))) for _ in range(120)})
    ldf = spark.createDataFrame(left, "i int, k string, a timestamp, b timestamp")
    rdf = spark.createDataFrame([(*r, n) for n, r in enumerate(right)], "k string, t timestamp, n int")
    pairs = joins.interval_join(ldf, rdf, F.col("a"), F.col("b"), "t", on=["k"])
    assert {(r.i, r.n) for r in pairs.collect()} == {
        (i, n) for i, k, a, b in left for n, (rk, t) in enumerate(right) if rk == k and a <= t <= b
    }
    assert pairs.count() == pairs.distinct().count()
    for on in (["k"], []):
        source = rdf if on else spark.createDataFrame([(t, n) for n, t in enumerate(sorted({t for _, t in right}))], "t timestamp, n int")
        rows = [(r.k if on else None, r.t, r.n) for r in source.collect()]
        got = joins.asof_join(ldf, source, "a", "t", ["n"], on=on, bucket_s=(3600, 60, 1)[seed]).collect()
        want = {
            i: max(((t, n) for rk, t, n in rows if (not on or rk == k) and t <= a), default=(None, None)) for i, k, a, _ in left
        }
        assert {r.i: (r.last_t, r.n) for r in got} == want and len(got) == len(left)


def test_occupancy_counts_and_bounds(spark):
    def hold(key, place, a, b):
        return ("holding", key, place, a, b)

    rows = [hold(k, "BIG", at(5), at(6)) for k in ("a", "b", "c")] + [hold("a", "BIG", at(5), at(5))]
    rows += [hold("z", "LAM", at(2) + timedelta(seconds=30), at(3) + timedelta(seconds=1)), ("go_around", "q", "27L", at(5), at(6))]
    df = spark.createDataFrame(rows, "event_type string, icao24 string, location string, started_at timestamp, ended_at timestamp")
    seconds = [int((at(m) - datetime(1970, 1, 1)).total_seconds()) for m in (0, 9)]
    got = {(r.minute, r.stack): r.holding_count for r in occupancy.occupancy(df, *seconds).collect()}
    assert len(got) == 10 * len(STACKS)
    for (m, place), n in got.items():
        want = {k for kind, k, p, a, b in rows if kind == "holding" and p == place and a <= m + timedelta(minutes=1) and b >= m}
        assert n == len(want)
    assert got[(at(5), "BIG")] == 3 and got[(at(5), "LAM")] == 0


def test_occupancy_of_overlapping_spans_over_days(spark):
    rnd = random.Random(9)
    rows = []
    for _ in range(400):
        start = at(rnd.randrange(-300, 3200)) + timedelta(seconds=rnd.randrange(60))
        rows.append(("holding", rnd.choice(["a", "b", "c", None]), rnd.choice(["BIG", "LAM", None]), start, start + timedelta(minutes=rnd.choice([0, 1, 7, 90, 3000]))))
    df = spark.createDataFrame(rows, "event_type string, icao24 string, location string, started_at timestamp, ended_at timestamp")
    seconds = [int((at(m) - datetime(1970, 1, 1)).total_seconds()) for m in (0, 2999)]
    got = {(r.minute, r.stack): r.holding_count for r in occupancy.occupancy(df, *seconds).collect()}
    assert len(got) == 3000 * len(STACKS)
    for (m, place), n in got.items():
        assert n == len({k for _, k, p, a, b in rows if k and p == place and a <= m + timedelta(minutes=1) and b >= m})


@pytest.mark.parametrize("chunk_s", [200, 3600, 10**6])
def test_sessions_do_not_depend_on_chunks(spark, chunk_s):
    rnd = random.Random(8)
    rows, t = [], 0
    for _ in range(300):
        t += rnd.choice([0, 10, 179, 180, 181, 900])
        rows.append((rnd.choice("kk m".replace(" ", "")), T0 + timedelta(seconds=t)))
    df = spark.createDataFrame(rows, "icao24 string, event_ts timestamp")
    want = []
    for key in "km":
        times = sorted(x for k, x in rows if k == key)
        group = [times[0]]
        for x in times[1:]:
            if (x - group[-1]).total_seconds() > 180:
                want.append((key, group[0], group[-1], len(group)))
                group = []
            group.append(x)
        want.append((key, group[0], group[-1], len(group)))
    assert sorted(map(tuple, session_counts(df, chunk_s=chunk_s).collect())) == sorted(want)


def test_cause_labels(spark):
    schema = (
        "event_id string, event_type string, location string, duration_s long, max_wind_kt int, max_gust_kt int, "
        "min_visibility_sm double, min_ceiling_ft int, instrument_weather boolean, wind_dir_deg int, busy_stacks long"
    )
    rows = [
        ("gust", "holding", "BNN", 599, 1, 25, 1.0, 100, True, 90, 4), ("mist", "holding", "BNN", 600, 19, 24, 2.9, None, None, None, 4),
        ("turn", "go_around", "09L", 1201, 5, None, 9.0, 1000, False, 200, 4), ("fine", "go_around", "27R", 1200, 5, None, None, None, None, 200, 1),
        ("many", "holding", "LAM", 1, None, None, None, None, None, None, 2),
    ]
    got = {r.event_id: (r.cause, r.severity) for r in evidence.label_causes(spark.createDataFrame(rows, schema)).collect()}
    assert got == {
        "gust": ("wind", 2), "mist": ("low_visibility_cloud", 2), "turn": ("runway_change", 3), "fine": ("other", 2), "many": ("traffic_volume", 2),
    }


def test_histogram_and_sweep(spark):
    df = spark.createDataFrame([(89.0, 1.0), (90.0, 2.0), (359.0, 3.0), (360.0, 4.0), (900.0, 6.0)], "max_turn_deg double, minutes_in_zone double")
    assert [r.n for r in sorted(probe.histogram(df).collect(), key=lambda r: r.position)] == [1, 1, 0, 0, 1, 1, 0, 1]
    assert {r.threshold: (r["keys"], r.median_min) for r in probe.threshold_sweep(df).collect()} == {
        270: (3, 4.0), 300: (3, 4.0), 360: (2, 5.0), 540: (1, 6.0),
    }


def test_status_counts_keep_zeros(spark):
    df = spark.createDataFrame([("a",), ("a",), ("other",)], "status string")
    assert {r.status: r.n for r in analytics.status_counts(df, ["a", "b"]).collect()} == {"a": 2, "b": 0}


def test_repeated_go_arounds_are_severe(spark):
    events = spark.createDataFrame([("a", "go_around", "k1"), ("b", "go_around", "k1"), ("c", "go_around", "k2"), ("d", "holding", "k1")], "event_id string, event_type string, icao24 string")
    got = {r.event_id: r.repeated for r in evidence.with_repeats(events.select("event_id"), events).collect()}
    assert got == {"a": True, "b": True, "c": False, "d": False}


def test_merge_touches_only_its_days(spark, tmp_path):
    path = str(tmp_path / "table")
    schema = "event_id string, started_at timestamp, ended_at timestamp, n int"
    day = lambda d, h=0: datetime(2026, 1, d, h)
    upsert.write_days(spark.createDataFrame([(f"e{d}", day(d), day(d, 1), 0) for d in (1, 2, 3)], schema), path, "started_at")
    files = lambda: {f for f in spark.read.parquet(path).inputFiles() if "2026-01-02" not in f}
    before = files()
    source = spark.createDataFrame([("e2", day(2), day(2, 5), 7), ("f2", day(2, 3), day(2, 4), 8)], schema)
    upsert.merge_days(spark, path, source, lambda t, s: upsert.extend_later(t, s, "event_id", {"n": F.col("s.n")}), "started_at")
    assert files() == before and len(before) == 2
    assert sorted((r.event_id, r.n) for r in spark.read.parquet(path).collect()) == [("e1", 0), ("e2", 7), ("e3", 0), ("f2", 8)]


def test_merge_computes_its_source_once(spark, tmp_path):
    path = str(tmp_path / "table")
    schema = "event_id string, started_at timestamp, ended_at timestamp, n int"
    day = lambda d, h=0: datetime(2026, 1, d, h)
    upsert.write_days(spark.createDataFrame([("e1", day(1), day(1, 1), 0)], schema), path, "started_at")
    made, kept = spark.sparkContext.accumulator(0), spark.sparkContext._jsc.getPersistentRDDs().size()

    def counted(frames):
        for f in frames:
            made.add(len(f))
            yield f

    source = spark.createDataFrame([("e1", day(1), day(1, 2), 7), ("f2", day(2), day(2, 1), 8), ("f3", None, day(2, 1), 9)], schema).mapInPandas(counted, schema)
    upsert.merge_days(spark, path, source, lambda t, s: upsert.extend_later(t, s, "event_id", {"n": F.col("s.n")}), "started_at")
    assert made.value == 3
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == kept
    assert sorted((r.event_id, r.n) for r in spark.read.parquet(path).collect()) == [("e1", 7), ("f2", 8), ("f3", 9)]


def test_exact_percentiles_against_spark(spark):
    rnd = random.Random(5)
    rows = [(k, rnd.choice([None, float(rnd.randrange(50)), rnd.gauss(0, 1e6), rnd.random() * 1e-6])) for k in "abc" for _ in range(700)] + [("one", 3.5), ("none", None)]
    df = spark.createDataFrame(rows, "k string, x double")
    shares = [0.0, 0.05, 0.5, 0.95, 1.0]
    want = df.groupBy("k").agg(F.count("x").alias("n"), *[F.percentile("x", F.lit(p)).alias(f"p{i}") for i, p in enumerate(shares)]).where("n > 0")
    assert sorted(map(tuple, exact_percentiles(df, "x", shares, by=["k"]).collect())) == sorted(map(tuple, want.collect()))
    whole = df.agg(F.count("x"), *[F.percentile("x", F.lit(p)) for p in shares])
    assert list(map(tuple, exact_percentiles(df, "x", shares).collect())) == list(map(tuple, whole.collect()))
    assert exact_percentiles(df.limit(0), "x", shares).count() == 0
