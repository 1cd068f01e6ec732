"""Per-key track features.

A key's reports are cut into time chunks before any window runs. Reports close to a chunk border
are copied into the neighbouring chunk, so every rule sees all it needs while the window partition
stays bounded by time: after de-duplication a chunk holds at most one report per instant.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackflow.config import TrackRules
from trackflow.functions.geo import heading_change, nearest, point_id
from trackflow.functions.times import SECOND, bucket, micros

MICRODEGREE = 1_000_000


def usable_reports(df: DataFrame, rules: TrackRules = TrackRules()) -> DataFrame:
    """Reports with a time, a position and an altitude."""
    c = rules.columns
    return df.where(" AND ".join(f"{name} IS NOT NULL" for name in (c.ts, c.lat, c.lon, c.alt)))


def unique_reports(df: DataFrame, rules: TrackRules = TrackRules(), by: Sequence[str] = ()) -> DataFrame:
    """One report per (key, instant).

    The smallest report in column order is kept, with any name its copies carry, so the result does
    not depend on row order. A grouped minimum combines on the map side: a heap of copies of one
    report shrinks before the shuffle.
    """
    c = rules.columns
    keys = [*by, c.key]
    return (
        df.groupBy(*keys, micros(F.col(c.ts)).alias("us"))
        .agg(F.min(F.struct(c.lat, c.lon, c.alt, c.vr, c.track, c.ground)).alias("report"), F.max(c.name).alias(c.name))
        .select(*keys, "us", c.name, "report.*")
    )


def in_chunks(reports: DataFrame, rules: TrackRules) -> DataFrame:
    """Each report in its own chunk (``home``) and as a copy in those whose border it is near."""
    size, back, ahead = (s * SECOND for s in (rules.chunk_s, rules.back_s, rules.ahead_s))
    us = F.col("us")
    first, last = bucket(us - ahead, size), bucket(us + back, size)
    return reports.select(
        "*", F.explode(F.sequence(first, last)).alias("chunk")
    ).withColumn("home", F.col("chunk") == bucket(us, size))


def with_carried_report(reports: DataFrame, chunked: DataFrame, rules: TrackRules, keys: Sequence[str]) -> DataFrame:
    """Add the last earlier report to chunks whose look-back is empty.

    Gaps longer than the look-back matter for the published gap, the derived climb rate and run
    starts; no episode rule can see across them.
    One row per (key, chunk) is looked at, a number bounded by time and not by the data.
    """
    size, back = rules.chunk_s * SECOND, rules.back_s * SECOND
    values = [name for name in reports.columns if name not in (*keys, "us")]
    last_of_chunk = (
        reports.groupBy(*keys, bucket(F.col("us"), size).alias("own"))
        .agg(F.max(F.struct("us", *values)).alias("last"))
        .withColumn("chunk", F.lead("own").over(Window.partitionBy(*keys).orderBy("own")))
        .where(F.col("last.us") < F.col("chunk") * size - back)
        .select(*keys, "chunk", "last.*", F.lit(False).alias("home"))
    )
    return chunked.unionByName(last_of_chunk)


def chunk_window(keys: Sequence[str]):
    return Window.partitionBy(*keys, "chunk").orderBy("us")


def rolling_sum(value: Column, keys: Sequence[str], span_us: int) -> Column:
    """Sum of ``value`` over (t - span, t], as a difference of two running sums (linear time).

    ``value`` should be a whole number: the difference is then exact.
    """
    w = chunk_window(keys)
    running = F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    before = F.sum(value).over(w.rangeBetween(Window.unboundedPreceding, -span_us))
    return running - F.coalesce(before, F.lit(0))


def placed_reports(reports: DataFrame, rules: TrackRules, keys: Sequence[str]) -> DataFrame:
    """Unique reports with the nearest stack and runway; a missing ground flag counts as airborne."""
    c = rules.columns
    named = reports.select(
        *keys, "us", c.name, c.lat, c.lon, c.alt, c.vr, c.track, F.coalesce(F.col(c.ground), F.lit(False)).alias(c.ground),
        nearest(c.lat, c.lon, rules.stacks).alias("stack"), nearest(c.lat, c.lon, rules.runways).alias("runway"),
    )
    return named.select(
        *[n for n in named.columns if n not in ("stack", "runway")],
        F.col("stack.dist").alias("dist_stack_nm"), F.col("stack.rank").alias("stack_rank"),
        F.col("runway.dist").alias("dist_rwy_nm"), F.col("runway.rank").alias("rwy_rank"),
    )


def chunk_frames(chunked: DataFrame, rules: TrackRules, keys: Sequence[str], also: Sequence[Column] = ()) -> DataFrame:
    """Features of placed reports that already sit in their chunks; ``also`` are further windows over the same order."""
    c = rules.columns
    alt, us, w = F.col(c.alt), F.col("us"), chunk_window(keys)
    gap = (us - F.col("prev_us")) / F.lit(float(SECOND))
    turn = heading_change(F.col(c.track), F.col("prev_track"))
    kept = [n for n in chunked.columns if n != c.vr]
    return (
        chunked.select(
            "*", F.lag("us").over(w).alias("prev_us"), F.lag(c.track).over(w).alias("prev_track"),
            F.lag(c.alt).over(w).alias("prev_alt"),
        )
        .select(
            *kept,
            F.coalesce(F.col(c.vr), (alt - F.col("prev_alt")) / (gap / 60.0)).alias(c.vr),
            F.coalesce(gap, F.lit(0.0)).alias("gap_s"),
            F.coalesce(F.when(gap <= rules.turn_gap_s, turn), F.lit(0.0)).alias("dtrack"),
        )
        .select("*", F.round(F.col("dtrack") * MICRODEGREE).cast("long").alias("turn_micro"))
        .select(
            "*", rolling_sum(F.col("turn_micro"), keys, rules.turn_window_s * SECOND).alias("cum_micro"), *also
        )
    )


def track_frames(
    df: DataFrame,
    rules: TrackRules = TrackRules(),
    by: Sequence[str] = (),
    exact_gaps: bool = False,
    also: Sequence[Column] = (),
    complete: bool = True,
) -> DataFrame:
    """Features of every report in every chunk it was copied to; ``home`` marks the owner.

    ``also`` are further window columns over the same (key, chunk) order; they are computed in the
    same pass as the rolling turn. ``complete`` leaves out reports without position or altitude.
    """
    c = rules.columns
    keys = [*by, c.key]
    usable = usable_reports(df, rules) if complete else df.where(F.col(c.ts).isNotNull())
    placed = placed_reports(unique_reports(usable, rules, by), rules, keys)
    frames = in_chunks(placed, rules)
    if exact_gaps:
        frames = with_carried_report(placed, frames, rules, keys)
    return chunk_frames(frames, rules, keys, also)


def degrees(micro: Column) -> Column:
    return micro / F.lit(float(MICRODEGREE))


def track_features(df: DataFrame, rules: TrackRules = TrackRules(), by: Sequence[str] = ()) -> DataFrame:
    """One row per report: nearest points, heading change, gap, rolling turn, filled climb rate."""
    c = rules.columns
    return track_frames(df, rules, by, exact_gaps=True).where("home").select(
        *by, c.key, F.timestamp_micros("us").alias(c.ts), c.name, c.lat, c.lon, c.alt, c.vr, c.track, c.ground,
        point_id(F.col("stack_rank"), rules.stacks).alias("nearest_stack"), "dist_stack_nm",
        point_id(F.col("rwy_rank"), rules.runways).alias("nearest_rwy"), "dist_rwy_nm",
        "dtrack", "gap_s", degrees(F.col("cum_micro")).alias("cum_turn_deg"),
    )


def in_stack_zone(rules: TrackRules) -> Column:
    c = rules.columns
    inside = (F.col("dist_stack_nm") <= rules.stack_radius_nm) & (F.col(c.alt) >= rules.stack_min_alt_ft)
    return F.coalesce(inside & ~F.col(c.ground), F.lit(False))


def is_low(rules: TrackRules) -> Column:
    c = rules.columns
    near = (F.col("dist_rwy_nm") <= rules.runway_radius_nm) & (F.col(c.alt) < rules.low_alt_ft)
    return F.coalesce(near & ~F.col(c.ground), F.lit(False))


def is_climbing(rules: TrackRules) -> Column:
    c = rules.columns
    strong = (F.col(c.alt) > rules.climb_alt_ft) & (F.col(c.vr) > rules.climb_rate_fpm)
    return F.coalesce(strong & ~F.col(c.ground), F.lit(False))


def starts_run(pred: Column, keys: Sequence[str]) -> Column:
    """True on the first row of each consecutive run of ``pred``."""
    return pred & ~F.coalesce(F.lag(pred).over(chunk_window(keys)), F.lit(False))
