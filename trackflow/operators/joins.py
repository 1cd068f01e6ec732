"""Time joins that Spark has no operator for, as equi-joins on time buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackflow.functions.times import SECOND, bucket, micros


def interval_join(
    intervals: DataFrame,
    points: DataFrame,
    start: Column,
    end: Column,
    at: str,
    on: Sequence[str] = (),
    bucket_s: int = 3600,
) -> DataFrame:
    """Pair each interval with the points inside [start, end].

    Intervals are copied to the time buckets they touch, points sit in one, so the join has an
    equality to hash or sort on.
    """
    size = bucket_s * SECOND
    span = F.sequence(bucket(F.col("__from"), size), bucket(F.col("__to"), size))
    marked = intervals.withColumns({"__from": micros(start), "__to": micros(end)})
    cut = marked.where("__from <= __to").select("*", F.explode(span).alias("__bucket"))
    dated = points.withColumn("__at", micros(F.col(at))).withColumn("__bucket", bucket(F.col("__at"), size))
    inside = cut.join(dated, [*on, "__bucket"]).where("__at BETWEEN __from AND __to")
    return inside.drop("__from", "__to", "__bucket", "__at")


FAN = 4096  # nodes of one level below one node of the next
LEVELS = 3  # 4096 ** 3 buckets of a second are two thousand years


def carried_rows(asked: DataFrame, closing: DataFrame, on: Sequence[str]) -> DataFrame:
    """For each asked bucket ``__row``, the ``__last`` of the latest closing bucket before it, if there is one.

    A scan in levels: 4,096 neighbouring buckets make a node of the next level, with the last row among them. A bucket looks
    among the earlier nodes beside its own on each level; the lowest level with a find has the latest. So no window holds more
    rows than that, whether or not there are keys.
    """
    levels = F.explode(F.array(*[F.struct(F.lit(k).alias("__level"), bucket(F.col("__bucket"), FAN**k).alias("__node")) for k in range(LEVELS)])).alias("__at")
    place = [*on, "__level", "__node"]
    wanted = asked.select(*on, "__bucket", levels).select(*on, "__bucket", "__at.*")
    held = closing.select(*on, "__last", levels).select(*on, "__at.*", "__last", F.lit(None).cast("int").alias("__asked"))
    both = held.unionByName(wanted.select(*place, F.lit(1).alias("__asked")), allowMissingColumns=True)
    nodes = both.groupBy(*place).agg(F.max("__last").alias("__last"), F.max("__asked").alias("__asked"))
    beside = Window.partitionBy(*on, "__level", bucket(F.col("__node"), FAN)).orderBy("__node").rowsBetween(Window.unboundedPreceding, -1)
    before = nodes.withColumn("__row", F.last("__last", ignorenulls=True).over(beside)).where("__asked IS NOT NULL AND __row IS NOT NULL")
    return wanted.join(before.select(*place, "__row"), place).groupBy(*on, "__bucket").agg(F.min_by("__row", "__level").alias("__row"))


def asof_join(
    left: DataFrame,
    right: DataFrame,
    left_at: str,
    right_at: str,
    values: Sequence[str],
    on: Sequence[str] = (),
    bucket_s: int = 3600,
) -> DataFrame:
    """Left rows with ``values`` of the last right row at or before their time.

    Right rows become segments that end at the next row or at the bucket border; buckets without a
    row at their start get one segment carrying the last earlier row. A left row then matches at
    most one segment of its own bucket. Right rows must be unique in (on, right_at).
    """
    size = bucket_s * SECOND
    keyed = left.withColumn("__at", micros(F.col(left_at))).withColumn("__bucket", bucket(F.col("__at"), size))
    payload = F.struct(F.col(right_at).alias("__seen"), *values)
    seen = right.where(F.col(right_at).isNotNull()).select(
        *on, micros(F.col(right_at)).alias("__from"), payload.alias("__row")
    ).withColumn("__bucket", bucket(F.col("__from"), size))
    # One row per bucket on either side: the carried row is found over these few.
    closing = seen.groupBy(*on, "__bucket").agg(F.max("__row").alias("__last"))
    asked = keyed.groupBy(*on, "__bucket").agg(F.lit(1).alias("__asked"))
    carried = carried_rows(asked, closing, on).select(
        *on, (F.col("__bucket") * size).alias("__from"), "__row", "__bucket", F.lit(0).alias("__fresh")
    )
    within = Window.partitionBy(*on, "__bucket").orderBy("__from", "__fresh")
    segments = (
        seen.select("*", F.lit(1).alias("__fresh"))
        .unionByName(carried)
        .withColumn("__until", F.coalesce(F.lead("__from").over(within), (F.col("__bucket") + 1) * size))
        .select(*on, "__bucket", "__from", "__until", "__row")
    )
    # Equality columns are renamed: an inequality beside USING columns would be ambiguous.
    renamed = segments.withColumnsRenamed({k: f"__r_{k}" for k in (*on, "__bucket")})
    match = (F.col("__at") >= F.col("__from")) & (F.col("__at") < F.col("__until"))
    for k in (*on, "__bucket"):
        match = match & (F.col(k) == F.col(f"__r_{k}"))
    return keyed.join(renamed, match, "left").select(
        *left.columns, F.col("__row.__seen").alias(f"last_{right_at}"), *[F.col(f"__row.{v}").alias(v) for v in values]
    )


def flag_members(df: DataFrame, members: DataFrame, key: str, flag: str) -> DataFrame:
    """True where the key occurs in ``members``."""
    known = members.select(key).distinct().withColumn("__known", F.lit(True))
    return df.join(known, key, "left").withColumn(flag, F.coalesce("__known", F.lit(False))).drop("__known")
