"""Tracks for the detection tests, in closed form: where a key is at each report follows from the time alone."""

from __future__ import annotations

import math
from datetime import datetime, timedelta, timezone

from trackflow.config import RUNWAYS, STACKS

T0 = datetime(2026, 1, 5, 9, 0, tzinfo=timezone.utc)
SCHEMA = (
    "icao24 string, callsign string, event_ts timestamp, lat double, lon double, alt_ft double, "
    "vr_fpm double, track_deg double, on_ground boolean"
)
POINTS = {p.id: p for p in (*STACKS, *RUNWAYS)}


def offset(lat, lon, north_nm, east_nm):
    return lat + north_nm / 60, lon + east_nm / 60 / math.cos(math.radians(lat))


def on_line(lat, lon, heading, knots):
    """Place and heading after t seconds of straight flight."""
    angle = math.radians(heading)

    def at(t):
        miles = knots * t / 3600
        return *offset(lat, lon, miles * math.cos(angle), miles * math.sin(angle)), heading

    return at


def on_circle(lat, lon, radius_nm, lap_s, side):
    """Place and heading on a circle around a point, clockwise for side 1."""

    def at(t):
        bearing = math.radians(side * 360 * t / lap_s)
        return *offset(lat, lon, radius_nm * math.cos(bearing), radius_nm * math.sin(bearing)), (math.degrees(bearing) + 90 * side) % 360

    return at


def reports(place, profile, alt, key="abc123", name="TST1", start=T0, step=30):
    """One report every ``step`` seconds; the profile is a list of (seconds, feet per minute, on the ground)."""
    rows, begun = [], 0
    for seconds, climb, ground in profile:
        for t in range(begun, begun + seconds, step):
            height = max(alt + climb * (t - begun) / 60, 0.0)
            rows.append((key, name, start + timedelta(seconds=t), *place(t)[:2], height, float(climb), place(t)[2] % 360, ground))
        alt += climb * seconds / 60
        begun += seconds
    return rows


def circling(point="BNN", laps=3, alt=9000.0, side=1, lap_s=240, lead=120, descent=240, **kw):
    """Straight in, laps around the point, straight out and down."""
    p, radius = POINTS[point], 2.3
    ring = on_circle(p.lat, p.lon, radius, lap_s, side)
    lat, lon, heading = ring(0)
    line = on_line(lat, lon, heading, 220)

    def place(t):
        if lead <= t < lead + laps * lap_s:
            return ring(t - lead)
        return line(t - lead if t < lead else t - lead - laps * lap_s)

    return reports(place, [(lead + laps * lap_s, 0, False), (descent, -1500, False)], alt, **kw)


def approach(runway, profile, alt=3300.0, miles=10, knots=150, **kw):
    """Along the runway's direction from so many miles before it."""
    p = POINTS[runway]
    heading = 270.0 if runway.startswith("27") else 90.0
    lat, lon = offset(p.lat, p.lon, 0, miles if heading == 270.0 else -miles)
    return reports(on_line(lat, lon, heading, knots), profile, alt, **kw)
