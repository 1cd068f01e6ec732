"""Percentiles of sets that no task could hold: exact ones, and sketches that are kept and merged."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackflow.session import shared_folder

CELLS = 1024
#: Items a sketch keeps on its largest level: ranks are right to 0.7 % of the rows, 99 times in 100.
SKETCH_K = 400
#: Up to so many open ranges are broadcast.
FEW_RANGES = 10_000


def stored(df: DataFrame, name: str) -> DataFrame:
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exact_percentiles(df: DataFrame, value: str, shares: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """``by``, ``n`` and one column ``p0``, ``p1``, ... for each share: percentiles with interpolation between neighbours.

    Values are counted in Spark, and the two ranks of each percentile are found by narrowing: a round cuts the open range of
    every rank into 1,024 cells, counts them, and goes on in the cell that holds the rank, until one value is left. A state
    holds cells, never values; rounds grow with the logarithm of range over spacing. Nulls are left out; a group without
    values gives no row.
    """
    if not by:
        return exact_percentiles(df.withColumn("__all", F.lit(0)), value, shares, ["__all"]).drop("__all")
    counts = stored(df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).cast("double").alias("v")).agg(F.count("*").alias("n")), "counts")
    groups = counts.groupBy(*by).agg(F.sum("n").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).where("n > 0")
    place = lambda p: F.lit(float(p)) * (F.col("n") - 1)
    wanted = F.explode(F.array(*[F.struct(F.lit(i).alias("share"), F.lit(side).alias("side"), end(place(p)).cast("long").alias("rank")) for i, p in enumerate(shares) for side, end in enumerate((F.floor, F.ceil))]))
    own = [*by, "share", "side"]
    open_ = stored(groups.select(*by, "n", "low", "high", wanted.alias("w")).select(*by, "n", "low", "high", "w.*"), "ranks")
    settled = open_.where("low = high")
    open_ = open_.where("low < high")
    while left := open_.count():
        ranges = open_.select(*own, "n", "low", "high", "rank").withColumnRenamed("n", "total")
        joined = counts.join(F.broadcast(ranges) if left <= FEW_RANGES else ranges, list(by))
        inside = joined.where(F.col("v").between(F.col("low"), F.col("high")))
        cell = F.least(F.floor((F.col("v") - F.col("low")) / (F.col("high") - F.col("low")) * CELLS), F.lit(CELLS - 1))
        cells = inside.groupBy(*own, "total", "rank", cell.alias("cell")).agg(F.sum("n").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        before = F.coalesce(F.sum("n").over(Window.partitionBy(*own).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        hit = cells.withColumn("before", before).where("rank >= before AND rank < before + n")
        narrowed = stored(hit.select(*by, F.col("total").alias("n"), "low", "high", "share", "side", (F.col("rank") - F.col("before")).alias("rank")), "ranks")
        settled = settled.unionByName(narrowed.where("low = high"))
        open_ = narrowed.where("low < high")
    values = settled.groupBy(*by, "n").pivot("share", list(range(len(shares)))).agg(F.max(F.when(F.col("side") == 0, F.col("low"))).alias("a"), F.max(F.when(F.col("side") == 1, F.col("low"))).alias("b"))
    columns = []
    for i, p in enumerate(shares):
        at, low, high = place(p), F.col(f"{i}_a"), F.col(f"{i}_b")
        columns.append(F.when(low == high, low).otherwise((F.ceil(at) - at) * low + (at - F.floor(at)) * high).alias(f"p{i}"))
    return values.select(*by, "n", *columns)


def quantile_sketches(df: DataFrame, value: str, by: Sequence[str], k: int = SKETCH_K) -> DataFrame:
    """``by``, ``n`` and ``sketch``: a KLL sketch of a few kilobytes for each group, for a table that grows by a day at a time.

    Sketches combine before the shuffle, so a group with a third of all rows moves as one sketch per task. Nulls and NaN are
    left out; a group without values gives no row.
    """
    known = df.select(*by, F.col(value).cast("double").alias("__v")).where("__v IS NOT NULL AND NOT isnan(__v)")
    return known.groupBy(*by).agg(F.count("*").alias("n"), F.kll_sketch_agg_double("__v", k).alias("sketch"))


def sketched_percentiles(sketches: DataFrame, shares: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """``by``, ``n`` and ``p0``, ``p1``, ... from stored sketches of finer groups: each is a value that occurs, near that rank.

    Reads sketches only, never the rows below them. Without ``by`` all sketches are merged; no sketches, no row.
    """
    merged = sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch")).where("n > 0")
    found = [F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias(f"p{i}") for i, p in enumerate(shares)]
    return merged.select(*by, "n", *found)


def within_ranks(df: DataFrame, value: str, estimates: DataFrame, shares: Sequence[float], error: float, by: Sequence[str]) -> DataFrame:
    """``by``, ``n`` and ``p0_close``, ...: whether each estimate's rank lies within ``error`` of its share, counted over all rows."""
    rows = df.select(*by, F.col(value).cast("double").alias("__v")).where("__v IS NOT NULL AND NOT isnan(__v)")
    counts = [f(F.col("__v"), i).alias(f"{name}{i}") for i in range(len(shares)) for name, f in (("below", lambda v, i: F.count_if(v < F.col(f"p{i}"))), ("upto", lambda v, i: F.count_if(v <= F.col(f"p{i}"))))]
    met = rows.join(estimates.drop("n"), list(by)).groupBy(*by).agg(F.count("*").alias("n"), *counts)
    close = [(F.col(f"below{i}") <= F.lit(p + error) * F.col("n")) & (F.col(f"upto{i}") >= F.lit(p - error) * F.col("n")) for i, p in enumerate(shares)]
    return met.select(*by, "n", *[c.alias(f"p{i}_close") for i, c in enumerate(close)])
