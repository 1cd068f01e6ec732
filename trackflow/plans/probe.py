"""How far keys turn near a stack: the report behind the choice of threshold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackflow.config import TURN_BUCKETS, TURN_CANDIDATES, TURN_LABELS, TrackRules
from trackflow.functions.geo import nearest
from trackflow.functions.numbers import steady_round
from trackflow.operators.episodes import most_common_stack
from trackflow.operators.quantiles import exact_percentiles
from trackflow.operators.tracks import degrees, in_stack_zone, track_frames


def candidates(df: DataFrame, rules: TrackRules = TrackRules()) -> DataFrame:
    """Keys with at least one report inside a stack zone."""
    c = rules.columns
    inside = F.coalesce(
        (nearest(c.lat, c.lon, rules.stacks)["dist"] <= rules.stack_radius_nm)
        & (F.col(c.alt) >= rules.stack_min_alt_ft)
        & ~F.coalesce(F.col(c.ground), F.lit(False)),
        F.lit(False),
    )
    return df.where(inside).select(c.key).distinct()


def zone_probe(df: DataFrame, rules: TrackRules = TrackRules(), min_points: int = 5) -> DataFrame:
    """Per key: time in zone, closest approach, altitudes, largest turn, largest gap.

    Keys that never enter a zone are left out before any window runs.
    """
    c = rules.columns
    wanted = df.join(candidates(df, rules), c.key, "left_semi")
    frames = track_frames(wanted, rules, exact_gaps=True, complete=False).where("home")
    zone = in_stack_zone(rules)

    def inside(value: Column) -> Column:
        return F.when(zone, value)

    tallies = [
        F.count_if(zone & (F.col("stack_rank") == i)).alias(f"at_{i}") for i in range(len(rules.stacks))
    ]
    folded = frames.groupBy(c.key).agg(
        F.count_if(zone).alias("points_in_zone"),
        F.min(inside(F.col("us"))).alias("us0"),
        F.max(inside(F.col("us"))).alias("us1"),
        F.min("dist_stack_nm").alias("min_dist"),
        F.min(inside(F.col(c.alt))).alias("low"),
        F.max(inside(F.col(c.alt))).alias("high"),
        F.max(inside(F.abs("cum_micro"))).alias("turn"),
        F.max(inside(F.col("gap_s"))).alias("gap"),
        *tallies,
    )
    named = F.when(F.col(c.name).isNotNull(), F.struct(c.ts, c.name))
    enough = (
        df.groupBy(c.key)
        .agg(F.count(F.lit(1)).alias("reports"), F.min(named).alias("named"))
        .where(F.col("reports") >= min_points)
    )
    return folded.where("points_in_zone > 0").join(enough, c.key).select(
        c.key,
        F.col("named")[c.name].alias(c.name),
        most_common_stack(rules).alias("stack"),
        "points_in_zone",
        steady_round((F.col("us1") - F.col("us0")) / 60e6, 1).alias("minutes_in_zone"),
        steady_round(F.col("min_dist"), 1).alias("min_dist_nm"),
        F.col("low").cast("long").alias("min_alt_ft"),
        F.col("high").cast("long").alias("max_alt_ft"),
        steady_round(degrees(F.col("turn")), 0).alias("max_turn_deg"),
        F.col("gap").cast("long").alias("max_gap_s"),
    )


def top(probe: DataFrame, n: int = 30, key: str = "icao24") -> DataFrame:
    return probe.orderBy(F.col("max_turn_deg").desc(), key).limit(n)


def histogram(
    probe: DataFrame, column: str = "max_turn_deg",
    edges: Sequence[float] = TURN_BUCKETS, labels: Sequence[str] = TURN_LABELS,
) -> DataFrame:
    """Rows per half-open bucket [low, high); empty buckets stay in."""
    buckets = list(zip(labels, edges, edges[1:]))
    counts = probe.agg(
        *[F.count_if((F.col(column) >= lo) & (F.col(column) < hi)).alias(f"b{i}") for i, (_, lo, hi) in enumerate(buckets)]
    )
    each = F.array(
        *[
            F.struct(F.lit(i).alias("position"), F.lit(label).alias("bucket"), F.col(f"b{i}").alias("n"))
            for i, (label, _, _) in enumerate(buckets)
        ]
    )
    return counts.select(F.explode(each).alias("b")).select("b.*")


def threshold_sweep(probe: DataFrame, thresholds: Sequence[float] = TURN_CANDIDATES) -> DataFrame:
    """Keys reaching each threshold and their median time in zone."""
    reached = F.explode(F.filter(F.array(*[F.lit(t) for t in thresholds]), lambda t: F.col("max_turn_deg") >= t))
    hits = exact_percentiles(probe.select("minutes_in_zone", reached.alias("threshold")), "minutes_in_zone", [0.5], by=["threshold"])
    wanted = probe.sparkSession.range(1).select(F.explode(F.array(*[F.lit(int(t)) for t in thresholds])).alias("threshold"))
    return wanted.join(hits, "threshold", "left").select(
        "threshold", F.coalesce("n", F.lit(0)).alias("keys"), F.col("p0").alias("median_min")
    )
