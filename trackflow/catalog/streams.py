"""Streaming queries: run to the end of their input, then return the sink as a table."""

from __future__ import annotations

from pyspark.sql import functions as F

from trackflow import schemas
from trackflow.catalog import proxies as P
from trackflow.catalog.cleaning import _ROUND, _VALID, RAW, REF, UNIQUE, raw_states, weather_raw
from trackflow.catalog.detection import ALL_EPISODES, POS, RULES, approach_ctes, episode_ctes, feature_ctes, holding_ctes, positions, visit_ctes
from trackflow.catalog.operations import _LIFE, LOG
from trackflow.catalog.registry import query, rounded
from trackflow.config import STACKS
from trackflow.operators.episodes import conform
from trackflow.operators.silver import dedupe
from trackflow.session import shared_folder
from trackflow.sources.landing import append_stream
from trackflow.streaming import chain, changes, detect, etl, stateful

LINEAGE = ("source_file", "ingested_at", "ingest_date")


def landed(spark, df, name):
    """Write rows as JSON lines in day folders, the layout the feeds are landed in."""
    path = shared_folder(spark, name)
    day = F.date_format(F.timestamp_seconds(F.col("fetched_at").cast("long")), "yyyy-MM-dd")
    df.withColumn("day", day).write.partitionBy("day").json(path)
    return path


def bronze(spark, raw):
    table = shared_folder(spark, "bronze-states")
    source = landed(spark, raw, "landing-states")
    etl.land_states(spark, source, table, shared_folder(spark, "checkpoint")).awaitTermination()
    return table


@query("stream_bronze_states", f"{RAW} SELECT * FROM raw")
def stream_bronze_states(spark, sf_dir):
    return spark.read.parquet(bronze(spark, raw_states(spark, sf_dir))).drop(*LINEAGE)


@query("stream_bronze_weather", f"{P.ctes(w=P.WEATHER)} SELECT * FROM w")
def stream_bronze_weather(spark, sf_dir):
    table, checkpoint = shared_folder(spark, "bronze-weather"), shared_folder(spark, "checkpoint")
    source = landed(spark, weather_raw(spark, sf_dir), "landing-weather")
    for _ in range(2):  # the second run finds nothing new
        etl.land_weather(spark, source, table, checkpoint).awaitTermination()
    return spark.read.parquet(table).drop(*LINEAGE)


@query(
    "stream_silver",
    # Of the copies of a report, which differ only in their fetch, the stream keeps whichever comes first.
    f"""{UNIQUE.replace(P.duck_sql(P.RAW_STATES), P.duck_sql(P.RAW_TRACKS))}, ref AS ({REF}) SELECT uniq.* EXCLUDE (fetched_ts) REPLACE ({_ROUND}), CAST(event_ts AS DATE) AS event_date, ref.* EXCLUDE (icao24)
    FROM uniq LEFT JOIN ref USING (icao24) WHERE {_VALID}""",
)
def stream_silver(spark, sf_dir):
    table = shared_folder(spark, "silver")
    raw = P.load(spark, sf_dir, P.RAW_TRACKS)
    states = etl.table_stream(spark, bronze(spark, raw), schemas.STATES + ", source_file STRING")
    clean = etl.clean_stream(states, P.load(spark, sf_dir, P.REFERENCE))
    etl.write_positions(clean, table, shared_folder(spark, "checkpoint")).awaitTermination()
    return rounded(spark.read.parquet(table).drop("source_file", "fetched_ts"))


# Two deliveries to one stream: the first half hour of reports, then every report again under
# another key. What lies behind the watermark by then is dropped.
_HALF = P.EPOCH + 900


@query(
    "stream_late_data",
    f"""{POS}, a AS (SELECT icao24, event_ts FROM pos WHERE event_ts < make_timestamp({_HALF}000000)),
    b AS (SELECT 'b' || icao24 AS icao24, event_ts FROM pos WHERE event_ts > (SELECT max(event_ts) FROM a) - INTERVAL 120 SECOND)
    SELECT DISTINCT * FROM (SELECT * FROM a UNION ALL SELECT * FROM b)""",
)
def stream_late_data(spark, sf_dir):
    source, table, checkpoint = (shared_folder(spark, n) for n in ("deliveries", "on-time", "checkpoint"))
    reports = positions(spark, sf_dir).select("icao24", "event_ts")
    deliveries = (
        reports.where(F.col("event_ts") < F.timestamp_seconds(F.lit(_HALF))),
        reports.withColumn("icao24", F.concat(F.lit("b"), "icao24")),
    )
    for delivery in deliveries:
        delivery.write.mode("append").parquet(source)
        stream = dedupe(etl.table_stream(spark, source, "icao24 STRING, event_ts TIMESTAMP"))
        append_stream(stream, table, checkpoint, partition_by=[]).awaitTermination()
    return spark.read.parquet(table)


@query("stream_detect", f"{ALL_EPISODES} SELECT * FROM out")
def stream_detect(spark, sf_dir):
    """Positions arrive in two deliveries; the episodes found first are extended by the second."""
    table, log, checkpoint = (shared_folder(spark, n) for n in ("positions", "episode-log", "checkpoint"))
    reports = positions(spark, sf_dir).withColumn("event_date", F.to_date("event_ts"))
    schema = ", ".join(f"{n} {t}" for n, t in reports.dtypes)
    cut = F.timestamp_seconds(F.lit(_HALF))
    for delivery in (reports.where(F.col("event_ts") < cut), reports.where(F.col("event_ts") >= cut)):
        delivery.write.mode("append").partitionBy("event_date").parquet(table)
        stream = etl.table_stream(spark, table, schema)
        detect.detect_stream(
            stream, lambda: spark.read.schema(schema).parquet(table), log, checkpoint, RULES
        ).awaitTermination()
    return rounded(conform(detect.fold_log(detect.read_log(spark, log))))


@query("stream_detect_stateful", f"{ALL_EPISODES} SELECT * FROM out")
def stream_detect_stateful(spark, sf_dir):
    """Reports arrive up to two minutes late and out of order, in three deliveries; a last report far ahead ends the wait."""
    source, log, checkpoint = (shared_folder(spark, n) for n in ("reports", "piece-log", "checkpoint"))
    reports = positions(spark, sf_dir)
    schema = ", ".join(f"{n} {t}" for n, t in reports.dtypes)
    arrival = F.unix_micros("event_ts") / 1_000_000 - P.EPOCH + F.pmod(F.xxhash64("icao24", "event_ts"), F.lit(120))
    part = F.least(F.floor(arrival / 600), F.lit(2))
    clock = reports.limit(1).select(*[F.timestamp_seconds(F.lit(P.EPOCH + 86400)).alias(n) if n == "event_ts" else F.lit("clock").alias(n) if n == "icao24" else F.lit(None).cast(t).alias(n) for n, t in reports.dtypes])
    for delivery in (*(reports.where(part == k) for k in range(3)), clock):
        delivery.write.mode("append").parquet(source)
        stateful.detect_stateful(etl.table_stream(spark, source, schema), log, checkpoint, RULES, delay="3 minutes").awaitTermination()
    return rounded(conform(stateful.logged_episodes(spark, log, RULES)))


def followed_log(spark, sf_dir):
    """The change log in three deliveries out of order, the second one delivered twice, folded batch by batch and then compacted."""
    source, folds, checkpoint = (shared_folder(spark, n) for n in ("changes", "folds", "checkpoint"))
    log = P.load(spark, sf_dir, P.QUEUE_LOG)
    schema = ", ".join(f"{n} {t}" for n, t in log.dtypes)
    part = F.pmod(F.xxhash64("event_id", "_sort_by"), F.lit(3))
    for k in (0, 1, 1, 2):
        log.where(part == k).write.mode("append").parquet(source)
        changes.follow_changes(etl.table_stream(spark, source, schema), folds, "event_id", checkpoint).awaitTermination()
        if k == 1:
            changes.compact(spark, folds, "event_id")
    return folds


@query(
    "stream_current_rows",
    f"""{LOG}, k AS (SELECT * FROM q WHERE _pg_change_type <> 'update_preimage' QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY _sort_by DESC) = 1)
    SELECT * FROM k WHERE _pg_change_type <> 'delete'""",
)
def stream_current_rows(spark, sf_dir):
    return changes.current(spark, followed_log(spark, sf_dir), "event_id")


@query("stream_lifecycle", f"{LOG}, {_LIFE} SELECT * FROM lifecycle")
def stream_lifecycle(spark, sf_dir):
    return changes.lifecycles(spark, followed_log(spark, sf_dir))


# Landing files to occupancy: the same reports cleaned, searched and counted by SQL.
_CLEANED = f"{UNIQUE.replace(P.duck_sql(P.RAW_STATES), P.duck_sql(P.RAW_TRACKS))} SELECT uniq.* EXCLUDE (fetched_ts) FROM uniq WHERE {_VALID}"
_CHAINED = f"""WITH clean AS ({_CLEANED}), {feature_ctes('clean')}, {visit_ctes()}, {holding_ctes()}, {approach_ctes()}, {episode_ctes('holding+aborted')}"""
_SPAN = (P.EPOCH, P.EPOCH + 2400)


def chained(spark, sf_dir):
    """Two cycles, each after half of the files have landed, and a third that finds nothing new."""
    landing, root = shared_folder(spark, "landing-chain"), shared_folder(spark, "chain")
    raw = P.load(spark, sf_dir, P.RAW_TRACKS)
    first = F.col("time_position") < P.EPOCH + 900
    for part in (first | F.col("time_position").isNull(), ~first, None):
        if part is not None:
            raw.where(part).withColumn("day", F.lit("2024-01-01")).write.mode("append").partitionBy("day").json(landing)
        chain.run_cycle(spark, landing, root, P.load(spark, sf_dir, P.REFERENCE), _SPAN, RULES)
    return root


@query(
    "stream_chain",
    f"""{_CHAINED}, grid AS (SELECT make_timestamp({_SPAN[0]}000000) + INTERVAL 1 MINUTE * m AS minute, s AS stack FROM range(0, {(_SPAN[1] - _SPAN[0]) // 60 + 1}) r(m),
      (SELECT unnest([{", ".join(f"'{p.id}'" for p in STACKS)}]) AS s))
    SELECT minute, stack, CAST(count(DISTINCT icao24) AS INTEGER) AS holding_count FROM grid LEFT JOIN out
    ON location = stack AND event_type = 'holding' AND started_at <= minute + INTERVAL 1 MINUTE AND ended_at >= minute GROUP BY minute, stack""",
)
def stream_chain(spark, sf_dir):
    return spark.read.parquet(f"{chained(spark, sf_dir)}/{chain.HELD}").drop("event_date")
