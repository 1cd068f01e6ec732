"""Unit conversions between the feeds (metric) and the tables (aviation units)."""

from __future__ import annotations

from pyspark.sql import Column

from trackflow import config


def metres_to_feet(c: Column) -> Column:
    return c * config.M_TO_FT


def ms_to_knots(c: Column) -> Column:
    return c * config.MS_TO_KT


def ms_to_fpm(c: Column) -> Column:
    return c * config.MS_TO_FPM


def feet_to_metres(c: Column) -> Column:
    return c * config.FT_TO_M


def knots_to_ms(c: Column) -> Column:
    return c * config.KT_TO_MS


def fpm_to_ms(c: Column) -> Column:
    return c * config.FPM_TO_MS
