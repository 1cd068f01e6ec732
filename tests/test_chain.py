"""The chain by path, cycle by cycle."""

from dataclasses import replace

from pyspark.sql import functions as F

from tests.tracks import T0, circling
from trackflow import config, schemas
from trackflow.config import STACKS, TrackRules
from trackflow.sources.reference import empty_reference
from trackflow.streaming import chain


def test_cycles_extend_queue_and_occupancy_and_count_late_rows(spark, tmp_path):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "root")
    base = dict.fromkeys(schemas.names(schemas.STATES))
    rows = []
    for key, name, at, lat, lon, alt, vr, track, ground in circling(laps=8, key="abc123"):
        t = int(at.timestamp())
        rows.append({**base, "icao24": key, "callsign": name, "time_position": t, "fetched_at": t + 1.0, "latitude": lat, "longitude": lon, "baro_altitude": alt / config.M_TO_FT, "geo_altitude": alt / config.M_TO_FT, "vertical_rate": vr / config.MS_TO_FPM, "true_track": track, "on_ground": ground})
    start = int(T0.timestamp())
    span, rules = (start, start + 3600), replace(TrackRules(), edge_margin_s=0)

    def cycle(part):
        if part:
            spark.createDataFrame([tuple(r.values()) for r in part], schemas.STATES).coalesce(1).write.mode("append").json(f"{landing}/2026-01-05")
        chain.run_cycle(spark, landing, root, empty_reference(spark), span, rules, F.lit(T0))
        queue = spark.read.parquet(f"{root}/{chain.WORK}").collect()
        held = {r.minute: r.holding_count for r in spark.read.parquet(f"{root}/{chain.HELD}").where("stack = 'BNN'").collect()}
        return queue, held

    queue, held = cycle(rows[:30])
    assert [(r.event_type, r.location, r.status) for r in queue] == [("holding", "BNN", "detected")] and sum(held.values()) > 0
    late = [{**r, "icao24": "late01"} for r in rows[:2]]
    longer, more = cycle(rows[30:] + late)
    assert [r.event_id for r in longer] == [r.event_id for r in queue] and longer[0].ended_at > queue[0].ended_at
    assert sum(more.values()) > sum(held.values()) and len(more) == 61 and spark.read.parquet(f"{root}/{chain.HELD}").count() == 61 * len(STACKS)
    assert cycle([]) == (longer, more)
    counts = {r.step: (r.input_rows, r.late_rows) for r in chain.late_rows(spark, root).collect()}
    assert counts[chain.RAW][0] == len(rows) + 2 and counts[chain.CLEAN][1] == 2
