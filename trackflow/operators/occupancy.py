"""Keys holding per place and minute."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackflow.config import STACKS, Point
from trackflow.functions.numbers import steady_round
from trackflow.functions.times import SECOND, bucket, micros

MINUTE = 60 * SECOND
DAY_MINUTES = 24 * 60


def minute_grid(spark: SparkSession, points: Sequence[Point], start_s: int, end_s: int) -> DataFrame:
    """Every (minute, place) from start to end, both floored and included (epoch seconds)."""
    first, last = start_s // 60, end_s // 60
    places = F.array(*[F.lit(p.id) for p in points])
    return spark.range(first, last + 1).select(
        F.timestamp_seconds(F.col("id") * 60).alias("minute"), F.explode(places).alias("stack")
    )


def held_spans(episodes: DataFrame, start: Column, end: Column) -> DataFrame:
    """``icao24``, ``stack``, ``lo``, ``hi``: the minutes in which a key holds at a place, as disjoint spans inside the report's.

    A minute m is touched when the episode starts at or before m + 1 min and ends at or after m. Spans of one key and place that
    overlap become one, so a key counts once; of spans that begin in one minute the longest moves.
    """
    first = F.greatest(bucket(micros(F.col("started_at")) - 1, MINUTE), bucket(micros(start), MINUTE))
    last = F.least(bucket(micros(F.col("ended_at")), MINUTE), bucket(micros(end), MINUTE))
    held = episodes.where("event_type = 'holding' AND icao24 IS NOT NULL").select("icao24", F.col("location").alias("stack"), first.alias("lo"), last.alias("hi"))
    longest = held.where("lo <= hi").groupBy("icao24", "stack", "lo").agg(F.max("hi").alias("hi"))
    in_order = Window.partitionBy("icao24", "stack").orderBy("lo")
    apart = F.col("lo") > F.max("hi").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    numbered = longest.withColumn("apart", F.coalesce(apart, F.lit(True)).cast("int")).withColumn("span", F.sum("apart").over(in_order))
    return numbered.groupBy("icao24", "stack", "span").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("span")


def occupancy(
    episodes: DataFrame, start_s: int, end_s: int, points: Sequence[Point] = STACKS
) -> DataFrame:
    """Distinct holding keys per place and minute, zeros included.

    A sweep: one up and one down for each span, summed per place and minute, then running sums inside days on top of running
    sums over days. An episode costs the same however long it lasts, and no window is longer than a day or than the days.
    """
    spark = episodes.sparkSession
    span = [F.timestamp_seconds(F.lit(s)) for s in (start_s, end_s)]
    steps = F.explode(F.array(F.struct(F.col("lo").alias("m"), F.lit(1).alias("step")), F.struct((F.col("hi") + 1).alias("m"), F.lit(-1).alias("step"))))
    changes = held_spans(episodes, *span).select("stack", steps.alias("c")).groupBy("stack", F.col("c.m").alias("m")).agg(F.sum("c.step").alias("step"))
    day = F.floor(F.col("m") / DAY_MINUTES)
    days = spark.range(start_s // 60 // DAY_MINUTES, end_s // 60 // DAY_MINUTES + 1).select(F.col("id").alias("day"), F.explode(F.array(*[F.lit(p.id) for p in points])).alias("stack"))
    totals = changes.groupBy("stack", day.alias("day")).agg(F.sum("step").alias("step"))
    earlier = Window.partitionBy("stack").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    opening = days.join(totals, ["stack", "day"], "left").select("stack", "day", F.coalesce(F.sum("step").over(earlier), F.lit(0)).alias("step"))
    minute_no = (micros(F.col("minute")) / MINUTE).cast("long")
    grid = minute_grid(spark, points, start_s, end_s).select("minute", "stack", minute_no.alias("m"), F.lit(0).cast("long").alias("step"))
    at_dawn = opening.select("stack", (F.col("day") * DAY_MINUTES).alias("m"), "step")
    # minutes, changes and openings are rows of one window, so the grid moves once
    rows = grid.unionByName(changes, allowMissingColumns=True).unionByName(at_dawn, allowMissingColumns=True)
    within = Window.partitionBy("stack", "day").orderBy("m").rangeBetween(Window.unboundedPreceding, 0)
    return rows.select("*", day.alias("day")).withColumn("holding_count", F.sum("step").over(within).cast("int")).where("minute IS NOT NULL").select(
        "minute", "stack", "holding_count"
    )


def occupancy_summary(occ: DataFrame, since: Column) -> DataFrame:
    """Latest, highest and mean count per place after ``since``."""
    return (
        occ.where(F.col("minute") > since)
        .groupBy("stack")
        .agg(
            F.max_by("holding_count", "minute").alias("now"),
            F.max("holding_count").alias("peak"),
            steady_round(F.avg("holding_count"), 2).alias("mean"),
        )
    )
