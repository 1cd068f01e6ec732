"""Quantile sketches against exact ranks."""

import random

from pyspark.sql import functions as F

from test_plans import plan
from trackflow.operators.quantiles import exact_percentiles, quantile_sketches, sketched_percentiles, within_ranks

SHARES = (0.01, 0.25, 0.5, 0.95)


def test_merged_daily_sketches_are_near_the_exact_ranks(spark):
    """One kind holds most rows, on one day; values repeat and have a long tail."""
    r = random.Random(5)
    rows = [("hot", 0, round(r.lognormvariate(0, 2), 1)) for _ in range(40_000)] + [("calm", d, r.gauss(0, 1)) for d in range(20) for _ in range(300)]
    df = spark.createDataFrame(rows, "kind string, day int, value double")
    daily = quantile_sketches(df, "value", ["kind", "day"])
    assert daily.count() == 21
    found = sketched_percentiles(daily, SHARES, ["kind"])
    checked = within_ranks(df, "value", found, SHARES, 0.02, ["kind"]).collect()
    assert len(checked) == 2 and all(all(x[2:]) for x in checked) and {x.kind: x.n for x in checked} == {"hot": 40_000, "calm": 6_000}
    assert not all(within_ranks(df, "value", found.withColumn("p2", F.col("p3")), SHARES, 0.02, ["kind"]).first()[2:])
    assert plan(daily).count("Exchange") == 1 and "partial_kll_sketch_agg_double" in plan(daily)


def test_few_values_are_exact_and_unknown_ones_are_left_out(spark):
    rows = [("a", float(k)) for k in range(11)] + [("a", None), ("a", float("nan")), ("b", None), (None, 3.0)]
    df = spark.createDataFrame(rows, "kind string, value double")
    got = {x.kind: (x.n, x.p0, x.p1) for x in sketched_percentiles(quantile_sketches(df, "value", ["kind"]), (0.5, 1.0), ["kind"]).collect()}
    assert got == {"a": (11, 5.0, 10.0), None: (1, 3.0, 3.0)}
    exact = exact_percentiles(df.where("kind = 'a' AND NOT isnan(value)"), "value", [0.5]).first()
    assert exact.p0 == 5.0
    assert sketched_percentiles(quantile_sketches(df, "value", ["kind"]), [0.5]).first().n == 12
    assert sketched_percentiles(quantile_sketches(df.limit(0), "value", ["kind"]), [0.5]).count() == 0
