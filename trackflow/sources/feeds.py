"""Raw feed responses to flat landing rows.

Each response is one row holding its JSON text; parsing and flattening are column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackflow import schemas
from trackflow.functions import units
from trackflow.functions.text import blank_to_null, clean_key
from trackflow.functions.times import iso_to_epoch


def number_or_null(c: Column) -> Column:
    """The feed writes the word "ground" where an altitude would be."""
    return c.try_cast("double")


def _states(df: DataFrame) -> DataFrame:
    """The landing schema, in its column order. A malformed value is null; whole numbers lose their fraction."""
    types = dict(part.lower().split() for part in schemas.STATES.split(", "))

    def typed(name: str, kind: str) -> Column:
        if kind == "double":
            return F.col(name).try_cast("double") + F.lit(0.0)  # no negative zero
        whole = F.col(name).try_cast("double") if kind in ("bigint", "int") else F.col(name)
        return whole.try_cast(kind)

    return df.select(*[typed(n, t).alias(n) for n, t in types.items()])


def object_reports(responses: DataFrame, code_field: str = "transponder_code") -> DataFrame:
    """Landing rows from (poll_id, fetched_at, body) responses holding an array of objects.

    The array is named ``ac`` or ``aircraft``; reports without a position are left out. ``code_field`` names the field
    of a report that holds the transponder's code.
    """
    body = F.from_json("body", schemas.object_body(code_field))
    reports = F.when(F.size("parsed.ac") > 0, F.col("parsed.ac")).otherwise(F.col("parsed.aircraft"))
    stamped = F.when(F.col("parsed.now") != 0, F.col("parsed.now") / 1000.0).otherwise(F.col("fetched_at"))
    r = F.col
    flat = (
        responses.select("poll_id", "fetched_at", body.alias("parsed"))
        .select("poll_id", "fetched_at", F.coalesce(stamped, F.col("fetched_at")).alias("now_s"), F.explode(reports).alias("r"))
        .where("r.lat IS NOT NULL AND r.lon IS NOT NULL")
    )
    climb = F.coalesce(r("r.baro_rate"), r("r.geom_rate"))
    return _states(
        flat.select(
            "poll_id",
            "fetched_at",
            F.col("now_s").cast("long").alias("api_time"),
            F.coalesce(clean_key(r("r.hex")), F.lit("")).alias("icao24"),
            blank_to_null(r("r.flight")).alias("callsign"),
            F.lit(None).alias("origin_country"),
            (F.col("now_s") - F.coalesce(r("r.seen_pos"), F.lit(0.0))).cast("long").alias("time_position"),
            (F.col("now_s") - F.coalesce(r("r.seen"), F.lit(0.0))).cast("long").alias("last_contact"),
            r("r.lon").alias("longitude"),
            r("r.lat").alias("latitude"),
            units.feet_to_metres(number_or_null(r("r.alt_baro"))).alias("baro_altitude"),
            F.coalesce(r("r.alt_baro") == "ground", F.lit(False)).alias("on_ground"),
            units.knots_to_ms(r("r.gs")).alias("velocity"),
            r("r.track").alias("true_track"),
            units.fpm_to_ms(climb).alias("vertical_rate"),
            units.feet_to_metres(number_or_null(r("r.alt_geom"))).alias("geo_altitude"),
            r(f"r.`{code_field}`").alias("transponder_code"),
            (~F.coalesce(r("r.spi"), F.lit("0")).isin("0", "false", "")).alias("spi"),
            F.lit(None).alias("position_source"),
            F.lit(None).alias("category"),
        )
    )


def vector_reports(responses: DataFrame) -> DataFrame:
    """Landing rows from (poll_id, fetched_at, body) responses holding arrays by position.

    Slots missing at the end of a short array read as null.
    """
    body = F.from_json("body", "time BIGINT, states ARRAY<ARRAY<STRING>>")
    flat = responses.select("poll_id", "fetched_at", body.alias("parsed")).select(
        "poll_id", "fetched_at", F.col("parsed.time").alias("api_time"), F.explode("parsed.states").alias("v")
    )
    slots = [
        F.get("v", F.lit(i)).alias(n) for i, n in enumerate(schemas.VECTOR_FIELDS) if n != "sensors"
    ]
    rows = flat.select("poll_id", "fetched_at", "api_time", *slots)
    return _states(rows.withColumn("callsign", F.trim("callsign")))


def weather_reports(responses: DataFrame) -> DataFrame:
    """(kind, fetched_at, obs_time, raw_json) from bodies holding one report or a list of them."""
    listed = F.when(F.ltrim("body").startswith("["), F.from_json("body", "ARRAY<STRING>")).otherwise(
        F.array("body")
    )
    items = responses.where(F.trim("body") != "").select("kind", "fetched_at", F.explode(listed).alias("raw_json"))
    observed = F.when(
        F.col("kind") == "metar", F.get_json_object("raw_json", "$.obsTime").try_cast("long")
    ).otherwise(iso_to_epoch(F.get_json_object("raw_json", "$.issueTime")))
    return items.select("kind", "fetched_at", observed.alias("obs_time"), "raw_json")
