"""Text, identifier and JSON column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(c: Column) -> Column:
    """Trimmed text; empty becomes null."""
    return F.nullif(F.trim(c), F.lit(""))


def clean_key(c: Column) -> Column:
    return F.lower(F.trim(c))


def uuid_of(text: Column) -> Column:
    """MD5 of ``text`` written as a lower-case UUID."""
    return F.regexp_replace(F.md5(text), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def episode_id(key: Column, kind: Column, started_at: Column) -> Column:
    """The same key, kind and whole-second start always give the same id."""
    stamp = F.date_format(started_at, "yyyy-MM-dd'T'HH:mm:ss")
    return uuid_of(F.concat_ws("|", key.cast("string"), kind, stamp))


def display_name(name: Column, key: Column) -> Column:
    return F.coalesce(name, key)


def event_label(started_at: Column, kind: Column, location: Column, who: Column, status: Column) -> Column:
    """One-line label: time, kind, place, name, status."""
    return F.concat_ws(
        " · ", F.date_format(started_at, "HH:mm"), F.translate(kind, "_", "-"), location, who, status
    )


def json_int(json: Column, path: str) -> Column:
    """Whole number at a path, null when it is absent or text."""
    return F.get_json_object(json, path).try_cast("int")


def json_double(json: Column, path: str, strip: str = "+") -> Column:
    """Number at a path; ``strip`` is removed first ("6+" reads as 6)."""
    return F.replace(F.get_json_object(json, path), F.lit(strip), F.lit("")).try_cast("double")
