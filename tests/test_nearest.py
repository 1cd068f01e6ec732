"""Nearest of many places against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from test_plans import plan
from trackflow.config import EARTH_RADIUS_NM
from trackflow.operators.nearest import nearest_place


def haversine(a, b, c, d):
    h = math.sin(math.radians(c - a) / 2) ** 2 + math.cos(math.radians(a)) * math.cos(math.radians(c)) * math.sin(math.radians(d - b) / 2) ** 2
    return 2 * EARTH_RADIUS_NM * math.asin(math.sqrt(min(1.0, h)))


def compare(spark, asked, places, **options):
    rows = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(asked)], "row long, lat double, lon double")
    table = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(places)], "place long, lat double, lon double")
    got = {r.row: r for r in nearest_place(rows, table, "place", **options).collect()}
    assert len(got) == len(asked)
    for k, (a, b) in enumerate(asked):
        best = min((haversine(a, b, c, d), i) for i, (c, d) in enumerate(places))
        assert abs(got[k].nearest_nm - best[0]) < 1e-6
        other = places[got[k].nearest_id]
        assert abs(haversine(a, b, *other) - best[0]) < 1e-6


def test_ten_thousand_places_and_a_crowd(spark):
    """A third of the places crowd one spot, others spread over the globe; positions near, far, at the poles and the date line."""
    r = random.Random(3)
    globe = lambda: (math.degrees(math.asin(r.uniform(-1, 1))), r.uniform(-180, 180))
    places = [(51.5 + r.gauss(0, 0.002), -0.4 + r.gauss(0, 0.002)) for _ in range(3_300)] + [globe() for _ in range(6_700)]
    asked = [globe() for _ in range(120)] + [(51.5 + r.gauss(0, 0.01), -0.4 + r.gauss(0, 0.01)) for _ in range(40)]
    asked += [(90.0, 0.0), (-90.0, 12.0), (10.0, 180.0), (10.0, -180.0), (0.0, 0.0), (51.5, -0.4), (51.5, -0.4)]
    compare(spark, asked, places)


@pytest.mark.parametrize("depth", [2, 6, 20])
def test_any_depth_is_exact(spark, depth):
    r = random.Random(depth)
    places = [(r.uniform(-90, 90), r.choice((-179.9, 179.9)) + r.uniform(-0.1, 0.1)) for _ in range(60)]
    compare(spark, [(r.uniform(-90, 90), r.uniform(-180, 180)) for _ in range(40)], places, depth=depth)


def test_ties_unknown_places_and_empty_tables(spark):
    rows = spark.createDataFrame([(1, 1.0, 1.0, "x"), (2, None, 1.0, "x"), (3, float("nan"), 1.0, None), (4, 91.0, 1.0, "y"), (1, 1.0, 1.0, "x")], "row long, lat double, lon double, nearest_note string")
    places = spark.createDataFrame([(9, 1.0, 1.0), (7, 1.0, 1.0), (8, 2.0, 1.0), (1, None, None), (2, float("nan"), 1.0), (3, 1.0, 200.0)], "place long, lat double, lon double")
    got = sorted((r.row, r.nearest_id, r.nearest_nm) for r in nearest_place(rows, places, "place").collect() if r.row == 1)
    assert got == [(1, 7, 0.0)] * 2
    assert all(r.nearest_id is None and r.nearest_nm is None for r in nearest_place(rows, places, "place").where("row > 1").collect())
    assert nearest_place(rows, places.limit(0), "place").where("nearest_id IS NULL").count() == 5
    assert nearest_place(rows.limit(0), places, "place").count() == 0
    with pytest.raises(ValueError):
        nearest_place(rows, places, "place", depth=3)


def test_no_cross_join_and_only_bounded_broadcasts(spark):
    rows = spark.range(10).select(F.col("id").alias("row"), (F.col("id") * 1.0).alias("lat"), (F.col("id") * 2.0).alias("lon"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(nearest_place(rows, rows.withColumnRenamed("row", "place"), "place"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert text.count("BroadcastExchange") == 3 and " SinglePartition" not in text
