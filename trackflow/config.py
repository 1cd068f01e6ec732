"""Default parameters. Every operator takes these as arguments; nothing reads them as globals."""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# These must equal the published defaults for results to agree.
# ---------------------------------------------------------------------------
EARTH_RADIUS_NM = 3440.065

M_TO_FT = 3.28084
MS_TO_KT = 1.943844
MS_TO_FPM = 196.8504
FT_TO_M = 0.3048
KT_TO_MS = 0.514444
FPM_TO_MS = 1 / 196.8504

BOX_LAT = (50.60, 52.32)
BOX_LON = (-1.81, 0.89)

STACK_POINTS = (
    ("BNN", 51.726101, -0.549722),
    ("BIG", 51.330898, 0.034811),
    ("LAM", 51.646099, 0.151667),
    ("OCK", 51.305000, -0.447222),
)
RUNWAY_POINTS = (
    ("09L", 51.4775, -0.4850),
    ("27R", 51.4776, -0.4332),
    ("09R", 51.4647, -0.4823),
    ("27L", 51.4649, -0.4341),
)

CAUSES = ("wind", "low_visibility_cloud", "runway_change", "traffic_volume", "other")
STATUSES = ("detected", "assessed", "confirmed", "rejected")
OPEN_STATUSES = ("detected", "assessed")
VERDICTS = ("agree", "disagree", "not_an_event")
EPISODE_KINDS = ("holding", "go_around")

TURN_BUCKETS = (0, 90, 180, 270, 300, 360, 540, 720, 10_000)
TURN_LABELS = ("<90", "90-180", "180-270", "270-300", "300-360", "360-540", "540-720", "720+")
TURN_CANDIDATES = (270, 300, 360, 540)

UUID_PATTERN = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
KEY_PATTERN = "^[0-9a-f]{6}$"
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Point:
    """A named reference position."""

    id: str
    lat: float
    lon: float


STACKS = tuple(Point(*p) for p in STACK_POINTS)
RUNWAYS = tuple(Point(*p) for p in RUNWAY_POINTS)


@dataclass(frozen=True)
class TrackColumns:
    """Names of the input columns of a track table."""

    key: str = "icao24"
    ts: str = "event_ts"
    lat: str = "lat"
    lon: str = "lon"
    alt: str = "alt_ft"
    vr: str = "vr_fpm"
    track: str = "track_deg"
    ground: str = "on_ground"
    name: str = "callsign"


@dataclass(frozen=True)
class TrackRules:
    """Thresholds of the feature and episode operators.

    ``chunk_s`` sets how a key's history is cut into time chunks. Windows run per (key, chunk), so
    one very busy key spreads over as many tasks as it has chunks; each chunk also receives the
    reports up to ``back_s`` before and ``ahead_s`` after it, which is all the rules can look at.
    """

    stacks: tuple[Point, ...] = STACKS
    runways: tuple[Point, ...] = RUNWAYS
    stack_radius_nm: float = 12.0
    stack_min_alt_ft: float = 7000.0
    hold_turn_deg: float = 360.0
    turn_window_s: int = 480
    turn_gap_s: int = 120
    visit_gap_s: int = 180
    runway_radius_nm: float = 6.0
    low_alt_ft: float = 1500.0
    climb_alt_ft: float = 2500.0
    climb_rate_fpm: float = 1000.0
    climb_window_s: int = 300
    arrival_window_s: int = 180
    arrival_drop_ft: float = 300.0
    min_reports: int = 3
    lookback_s: int = 180 * 60
    edge_margin_s: int = 30 * 60
    chunk_s: int = 3600
    columns: TrackColumns = field(default_factory=TrackColumns)

    def __post_init__(self):
        if self.climb_alt_ft < self.low_alt_ft:
            raise ValueError("climb_alt_ft must not lie below low_alt_ft")
        if self.chunk_s < max(self.back_s, self.ahead_s):
            raise ValueError("chunk_s must be at least as long as the look-back and look-ahead")

    @property
    def back_s(self) -> int:
        return max(self.turn_window_s + self.turn_gap_s, self.visit_gap_s, self.arrival_window_s)

    @property
    def ahead_s(self) -> int:
        return max(self.climb_window_s, self.visit_gap_s)


@dataclass(frozen=True)
class ChangeLogColumns:
    """Control columns of a change log (names fixed by the feed that writes it)."""

    kind: str = "_pg_change_type"
    at: str = "_timestamp"
    order: str = "_sort_by"
