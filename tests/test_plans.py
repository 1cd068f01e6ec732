"""Shape of the physical plans: what is pushed down, how often data moves, what is never planned."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from trackflow.catalog import proxies as P
from trackflow.catalog.detection import RULES
from trackflow.catalog.registered import QUERIES
from trackflow.operators import episodes as E
from trackflow.operators.cdc import current_rows
from trackflow.operators.joins import asof_join
from trackflow.operators.occupancy import occupancy
from trackflow.operators.silver import dedupe, enrich, fresh, to_positions
from trackflow.plans.analytics import after

SF = "/root/testdata/sf0.001"


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("stream_") and n not in ("silver_layout", "append_log")])
def test_no_cross_join_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert banned not in text


def test_detection_shuffles(spark):
    """Copies, chunks and border pieces each move once; the names move as one row per key."""
    text = plan(E.episodes(P.load(spark, SF, P.POSITIONS), RULES))
    assert text.count("Exchange hashpartitioning") == 4 and "Exchange SinglePartition" not in text
    assert text.count(" Window [") <= 6


def test_time_bounds_reach_the_scan(spark):
    now = F.lit("2024-01-20 12:00:00").cast("timestamp_ntz")
    text = plan(after(spark.read.parquet(f"{SF}/events.parquet"), "ts", now, "180 MINUTES").select("event_id"))
    assert "GreaterThan(ts," in text and "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text


def test_copies_are_cut_before_the_shuffle(spark):
    text = plan(dedupe(to_positions(fresh(P.load(spark, SF, P.RAW_STATES)))))
    assert "WindowGroupLimit" in text and text.index("Partial") > text.index("Exchange")  # below the exchange
    log = plan(current_rows(P.load(spark, SF, P.QUEUE_LOG), "event_id"))
    assert log.count("Exchange hashpartitioning") == 1 and "partial_max_by" in log


def test_reference_is_broadcast_only_by_size(spark):
    reference, positions = P.load(spark, SF, P.REFERENCE), to_positions(P.load(spark, SF, P.RAW_STATES))
    assert "BroadcastHashJoin" in plan(enrich(positions, reference))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(enrich(positions, reference))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text


def test_time_scans_use_no_single_partition(spark):
    """The as-of join without keys carries rows over in levels; occupancy neither makes the minutes of an episode nor one long window."""
    events, weather = P.load(spark, SF, P.POSITIONS).select("icao24", "event_ts"), P.load(spark, SF, P.POSITIONS).select(F.col("event_ts").alias("seen_at"), "alt_ft").distinct()
    text = plan(asof_join(events, weather.dropDuplicates(["seen_at"]), "event_ts", "seen_at", ["alt_ft"]))
    assert "SinglePartition" not in text
    text = plan(occupancy(E.conform(E.episodes(P.load(spark, SF, P.POSITIONS), RULES)), 1_700_000_000, 1_700_400_000))
    assert "SinglePartition" not in text and "sequence(lo" not in text
