"""Point lookups on clustered files: which row groups are read, by the scan's own count of rows."""

import pytest
from pyspark.sql import functions as F

from trackflow.plans.serving import track_windows
from trackflow.sources.landing import write_clustered

KEYS, EACH = 2_000, 60


def rows_read(df, *more):
    """Result rows, rows that the scan handed on, and ``more`` of its metrics; a run resets them, the files are chosen once."""
    n = len(df.collect())
    metrics = df._jdf.queryExecution().executedPlan().collectLeaves().head().metrics()
    return n, *(metrics.apply(m).value() for m in ("numOutputRows", *more))


@pytest.fixture(scope="module")
def reports(spark):
    n = F.col("id")
    return spark.range(KEYS * EACH).select(
        F.format_string("%06x", n % KEYS).alias("icao24"), F.md5(n.cast("string")).alias("serial"),
        F.timestamp_seconds(F.lit(1704067200) + (n / KEYS).cast("int") * 3600).alias("event_ts"), (n * 1.0).alias("alt_ft"),
    ).withColumn("event_date", F.to_date("event_ts"))


def instants(first, last):
    return F.lit(first).cast("timestamp"), F.lit(last).cast("timestamp")


def test_a_key_reads_its_row_groups_and_days_only(spark, reports, tmp_path):
    write_clustered(reports, str(tmp_path / "t"), "event_date", ["icao24", "event_ts"], lookup=["icao24"], row_group_bytes=64 << 10)
    table = spark.read.parquet(str(tmp_path / "t"))
    found = track_windows(table, *instants("2024-01-02 03:00:00", "2024-01-02 09:00:00"), ["alt_ft"], ["00002a"])
    n, read, days = rows_read(found, "numPartitions")
    assert n == 7 and read < KEYS * EACH / 50 and days == 1  # of three
    two = track_windows(table, *instants("2024-01-01 00:00:00", "2024-01-03 23:00:00"), ["alt_ft"], ["00002a", "000700"])
    assert two.count() == 2 * EACH
    assert track_windows(table, *instants("2024-01-01 00:00:00", "2024-01-03 23:00:00"), ["alt_ft"], []).count() == 0


def test_a_bloom_filter_skips_groups_whose_range_holds_the_value(spark, reports, tmp_path):
    for name, lookup in (("with", ["serial"]), ("without", [])):
        write_clustered(reports, str(tmp_path / name), "event_date", ["icao24", "event_ts"], lookup=lookup, lookup_values=20_000)
    absent, held = "7" * 32, reports.where("icao24 = '00002a'").agg(F.min("serial")).first()[0]
    read = {name: rows_read(spark.read.parquet(str(tmp_path / name)).where(F.col("serial") == absent)) for name in ("with", "without")}
    assert read["with"] == (0, 0) and read["without"][0] == 0 and read["without"][1] > KEYS * EACH / 2
    n, seen = rows_read(spark.read.parquet(str(tmp_path / "with")).where(F.col("serial") == held))
    assert n == 1 and seen < KEYS * EACH / 2
