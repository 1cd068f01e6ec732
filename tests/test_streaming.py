"""Streams give what the batch operators give, once each, and survive a repeated batch."""

from dataclasses import replace
from datetime import timedelta

from pyspark.sql import functions as F

from tests.tracks import SCHEMA, T0, approach, circling
from trackflow import schemas
from trackflow.config import TrackRules
from trackflow.operators.episodes import conform, episodes
from trackflow.operators.quality import keep_valid
from trackflow.operators.sessions import session_counts
from trackflow.operators.silver import clean_states
from trackflow.sources import landing, reference
from trackflow.streaming import detect, etl

RULES = replace(TrackRules(), edge_margin_s=0)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def land(spark, folder, rows):
    base = dict.fromkeys(schemas.names(schemas.STATES))
    full = [tuple({**base, "longitude": -0.4, "latitude": 51.4, **r}.values()) for r in rows]
    spark.createDataFrame(full, schemas.STATES).coalesce(1).write.mode("append").json(folder)


def test_clean_stream_equals_batch(spark, tmp_path):
    source, raw, table = (str(tmp_path / n) for n in ("landing/2026-01-05", "raw", "table"))
    land(spark, source, [
        {"icao24": k, "time_position": t, "fetched_at": t + 5.0, "velocity": v, "callsign": c}
        for k in ("a1", "b2") for t in range(1000, 1400, 20) for v, c in [(100.0, "X ")]
    ] + [{"icao24": "c3", "time_position": 1000, "fetched_at": 1100.0}, {"icao24": "d4", "time_position": 1000, "fetched_at": 1001.0, "velocity": 400.0}])
    for _ in range(2):
        etl.land_states(spark, str(tmp_path / "landing"), raw, str(tmp_path / "c1")).awaitTermination()
    stored = spark.read.parquet(raw)
    assert stored.count() == 42 and set(stored.columns) >= {"source_file", "ingested_at", "ingest_date"}
    assert stored.where("source_file LIKE '%2026-01-05%'").count() == 42
    none = reference.empty_reference(spark)
    query = etl.write_positions(
        etl.clean_stream(etl.table_stream(spark, raw, schemas.STATES), none), table, str(tmp_path / "c2")
    )
    query.awaitTermination()
    batch = keep_valid(clean_states(landing.landing_batch(spark, str(tmp_path / "landing"), schemas.STATES), none))
    columns = batch.columns
    assert rows_of(spark.read.parquet(table).select(*columns)) == rows_of(batch) and batch.count() == 40
    seen = [p.observedMetrics["rules"] for p in query.recentProgress if "rules" in p.observedMetrics]
    assert sum(m.plausible_speed for m in seen) == 1 and sum(m.has_callsign for m in seen) == 1


def test_first_arrival_wins_and_late_rows_go(spark, tmp_path):
    source, table, checkpoint = (str(tmp_path / n) for n in ("in", "out", "c"))
    dropped = []

    def deliver(*rows):
        land(spark, source, [{"icao24": k, "time_position": t, "fetched_at": f} for k, t, f in rows])
        states = landing.landing_stream(spark, source, schemas.STATES)
        query = etl.write_positions(etl.clean_stream(states, reference.empty_reference(spark)), table, checkpoint)
        query.awaitTermination()
        dropped.append(etl.dropped_by_watermark(query))
        return sorted((r.icao24, int(r.event_ts.timestamp()), int(r.fetched_ts.timestamp())) for r in spark.read.parquet(table).collect())

    assert deliver(("a", 600, 601.0)) == [("a", 600, 601)]
    # 480 lies on the watermark (600 - 120) and is dropped; 481 is kept; a copy of 600 is not new.
    assert deliver(("b", 480, 482.0), ("b", 481, 482.0), ("a", 600, 602.0)) == [("a", 600, 601), ("b", 481, 482)]
    assert dropped[0] == 0 and dropped[1] >= 1


def test_a_running_stream_picks_up_new_files(spark, tmp_path):
    source, table = str(tmp_path / "landing"), str(tmp_path / "table")
    land(spark, source + "/2026-01-05", [{"icao24": "a", "time_position": 1000, "fetched_at": 1001.0}])
    query = etl.land_states(spark, source, table, str(tmp_path / "c"), every="1 second")
    try:
        query.processAllAvailable()
        assert query.isActive and spark.read.parquet(table).count() == 1
        land(spark, source + "/2026-01-05", [{"icao24": "b", "time_position": 1000, "fetched_at": 1001.0}])
        query.processAllAvailable()
        assert spark.read.parquet(table).count() == 2
    finally:
        query.stop()


def positions(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn("event_date", F.to_date("event_ts"))


def test_detection_in_deliveries_equals_batch(spark, tmp_path):
    table, log, checkpoint = (str(tmp_path / n) for n in ("positions", "log", "c"))
    rows = circling("BNN", laps=6, key="aaaaaa") + approach(
        "27L", [(210, -700, False), (150, 1800, False), (60, 0, False)], key="bbbbbb"
    )
    df = positions(spark, rows)
    schema = ", ".join(f"{n} {t}" for n, t in df.dtypes)

    def run(path=checkpoint):
        detect.detect_stream(
            etl.table_stream(spark, table, schema), lambda: spark.read.schema(schema).parquet(table), log, path, RULES
        ).awaitTermination()
        return detect.fold_log(detect.read_log(spark, log))

    ends = []
    for lo, hi in ((0, 18), (18, 22), (22, 999)):
        part = df.where((F.col("event_ts") >= T0 + timedelta(minutes=lo)) & (F.col("event_ts") < T0 + timedelta(minutes=hi)))
        part.coalesce(1).write.mode("append").partitionBy("event_date").parquet(table)
        ends.append({r.event_type: r.ended_at for r in run().collect()})
    assert ends[0]["holding"] < ends[1]["holding"] < ends[2]["holding"]
    assert rows_of(conform(run())) == rows_of(conform(episodes(df, RULES)))
    entries = detect.read_log(spark, log).count()
    # A lost checkpoint replays everything as batch 0: its log partition is rewritten, the fold stays.
    assert rows_of(conform(run(str(tmp_path / "c-new")))) == rows_of(conform(episodes(df, RULES)))
    assert detect.read_log(spark, log).count() == entries


def test_backlog_and_future_report_lose_nothing(spark, tmp_path):
    """Two holds six hours apart and a report from next year, all in one micro-batch, with the guard on."""
    table, log, checkpoint = (str(tmp_path / n) for n in ("positions", "log", "c"))
    rows = circling("BNN", key="aaaaaa") + circling("BNN", key="aaaaaa", start=T0 + timedelta(hours=6)) + circling("LAM", key="bbbbbb", start=T0 + timedelta(days=300))[:1]
    df = positions(spark, rows)
    schema = ", ".join(f"{n} {t}" for n, t in df.dtypes)
    df.write.partitionBy("event_date").parquet(table)
    rules = TrackRules()
    detect.detect_stream(etl.table_stream(spark, table, schema), lambda: spark.read.schema(schema).parquet(table), log, checkpoint, rules).awaitTermination()
    found = detect.fold_log(detect.read_log(spark, log))
    assert found.count() == 2 and rows_of(conform(found)) == rows_of(conform(episodes(df, rules)))


def test_one_old_report_reads_its_own_days_only(spark, tmp_path):
    """Days between an old report and today hold a file that cannot be read."""
    table, log, checkpoint = (str(tmp_path / n) for n in ("positions", "log", "c"))
    old = circling("BNN", key="aaaaaa", start=T0 - timedelta(days=365))
    df = positions(spark, old + circling("LAM", key="bbbbbb") + circling("BNN", key="aaaaaa"))
    schema = ", ".join(f"{n} {t}" for n, t in df.dtypes)
    df.write.partitionBy("event_date").parquet(table)
    for day in (T0 - timedelta(days=180), T0 - timedelta(days=2)):
        broken = tmp_path / "positions" / f"event_date={day:%Y-%m-%d}"
        broken.mkdir()
        (broken / "part-0.parquet").write_text("not parquet")
    arriving = str(tmp_path / "arriving")
    df.write.parquet(arriving)
    detect.detect_stream(etl.table_stream(spark, arriving, schema), lambda: spark.read.schema(schema).parquet(table), log, checkpoint, TrackRules()).awaitTermination()
    found = detect.fold_log(detect.read_log(spark, log))
    assert found.count() == 3 and rows_of(conform(found)) == rows_of(conform(episodes(df, TrackRules())))
    spans = sorted(map(tuple, detect.affected_spans(df).select("icao24", ((F.col("to_us") - F.col("from_us")) / 3.6e9).cast("int")).collect()))
    assert [k for k, _ in spans] == ["aaaaaa", "aaaaaa", "bbbbbb"] and all(h == 6 for _, h in spans)


def test_guard_leaves_cut_off_starts_to_earlier_batches(spark, tmp_path):
    table, log, checkpoint = (str(tmp_path / n) for n in ("positions", "log", "c"))
    df = positions(spark, circling("BNN", laps=20))
    schema = ", ".join(f"{n} {t}" for n, t in df.dtypes)
    rules = replace(TrackRules(), lookback_s=1800, edge_margin_s=900)
    for lo, hi in ((0, 40), (40, 60), (60, 999)):
        df.where((F.col("event_ts") >= T0 + timedelta(minutes=lo)) & (F.col("event_ts") < T0 + timedelta(minutes=hi))).coalesce(1).write.mode("append").partitionBy("event_date").parquet(table)
        detect.detect_stream(etl.table_stream(spark, table, schema), lambda: spark.read.schema(schema).parquet(table), log, checkpoint, rules).awaitTermination()
    assert {r.started_at for r in detect.read_log(spark, log).collect()} == {r.started_at for r in episodes(df, rules).collect()}


def test_session_windows_on_a_stream(spark, tmp_path):
    source = str(tmp_path / "in")
    rows = [("a", T0 + timedelta(seconds=s)) for s in (0, 100, 280, 461, 1000)]
    df = spark.createDataFrame(rows, "icao24 string, event_ts timestamp")
    df.write.parquet(source)
    stream = etl.table_stream(spark, source, "icao24 STRING, event_ts TIMESTAMP").withWatermark("event_ts", "1 minute")
    query = (
        session_counts(stream).writeStream.format("memory").queryName("sessions").outputMode("complete").trigger(availableNow=True)
        .option("checkpointLocation", str(tmp_path / "c")).start()
    )
    query.awaitTermination()
    assert rows_of(spark.table("sessions")) == rows_of(session_counts(df))
