"""Stand-alone forms of the time-window operators used by the episode rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackflow.config import TrackRules
from trackflow.functions.geo import point_id
from trackflow.functions.times import SECOND
from trackflow.operators.tracks import chunk_window, is_climbing, is_low, starts_run, track_frames


def run_starts(df: DataFrame, rules: TrackRules = TrackRules(), by: Sequence[str] = ()) -> DataFrame:
    """First report of every run of low reports near a runway."""
    c = rules.columns
    first = starts_run(is_low(rules), [*by, c.key]).alias("first_low")
    return (
        track_frames(df, rules, by, exact_gaps=True, also=[first])
        .where("home AND first_low")
        .select(
            *by, c.key, F.timestamp_micros("us").alias(c.ts),
            point_id(F.col("rwy_rank"), rules.runways).alias("nearest_rwy"), c.alt,
        )
    )


def look_back(df: DataFrame, rules: TrackRules = TrackRules(), by: Sequence[str] = ()) -> DataFrame:
    """Over [t - span, t): was there a ground report, and how high was the key."""
    c = rules.columns
    w = chunk_window([*by, c.key]).rangeBetween(-rules.arrival_window_s * SECOND, -1)
    seen = [
        F.coalesce(F.max(c.ground).over(w), F.lit(False)).alias("ground_before"),
        F.max(c.alt).over(w).alias("alt_before"),
    ]
    return (
        track_frames(df, rules, by, also=seen)
        .where("home")
        .select(*by, c.key, F.timestamp_micros("us").alias(c.ts), "ground_before", "alt_before")
    )


def look_ahead(df: DataFrame, rules: TrackRules = TrackRules(), by: Sequence[str] = ()) -> DataFrame:
    """Over (t, t + span]: first ground report and first strong climb."""
    c = rules.columns
    w = chunk_window([*by, c.key]).rangeBetween(1, rules.climb_window_s * SECOND)
    seen = [
        F.min(F.when(F.col(c.ground), F.col("us"))).over(w).alias("ground_us"),
        F.min(F.when(is_climbing(rules), F.col("us"))).over(w).alias("climb_us"),
    ]
    return (
        track_frames(df, rules, by, also=seen)
        .where("home")
        .select(
            *by, c.key, F.timestamp_micros("us").alias(c.ts),
            F.timestamp_micros("ground_us").alias("ground_ts"), F.timestamp_micros("climb_us").alias("climb_ts"),
        )
    )
