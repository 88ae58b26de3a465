"""Constants that are part of the results, and tuning values that are not."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Box:
    """Inclusive latitude / longitude box in degrees."""

    lat_min: float
    lat_max: float
    lon_min: float
    lon_max: float


@dataclass(frozen=True)
class Skew:
    """When a join group counts as hot."""

    hot_rows: int = 1_000_000


@dataclass(frozen=True)
class Settings:
    # Results depend on them.
    watermark_delay: str = "15 minutes"
    aq_window_minutes: int = 15
    weather_window_minutes: int = 15
    box: Box = field(default_factory=lambda: Box(40.4774, 40.9176, -74.2591, -73.7004))
    max_speed: float = 100.0
    max_pm25: float = 2000.0
    near_degrees: float = 0.001
    high_emission: float = 10000.0
    local_zone: str = "America/New_York"
    weather_key: str = "nyc"

    # Grid: projection origin and hexagon edge in metres.
    origin_lat: float = 40.7
    origin_lon: float = -74.0
    hex_edge_m: float = 1200.0

    # Tuning: results do not depend on them.
    trigger: str = "30 seconds"
    max_offsets_per_trigger: int | None = None  # per topic; None: all that is there
    # Parts a streaming join key is cut into; the right side is copied to each.
    aq_salt: int = 1  # the cell and the time spread these rows already
    weather_salt: int | None = None  # None: as many as a shuffle has partitions
    region_key: bool = False
    # Options that change the result; off as in the plain reading.
    # Readings stamped further ahead of their arrival are dropped, so one fast clock cannot move the watermark.
    future_slack_seconds: int | None = None
    # One reading per station and bin of so many seconds: feeds that stamp an unchanged value anew do not multiply rows.
    thin_seconds: int | None = None
    # With a clock: how far behind it a silent feed's event time is moved on; a feed may be silent that long without loss.
    idle_hold: str = "1 hour"
    skew: Skew = field(default_factory=Skew)


# Topic names by feed.
TOPICS = {
    "traffic": "nyc_traffic_raw",
    "openaq": "nyc_openaq_raw",
    "purpleair": "nyc_purpleair_raw",
    "weather": "nyc_weather_raw",
}

# Centre points of the five regions (name, lat, lon).
REGION_CENTRES = (
    ("manhattan", 40.7831, -73.9712),
    ("brooklyn", 40.6782, -73.9442),
    ("queens", 40.7282, -73.7949),
    ("bronx", 40.8448, -73.8648),
    ("staten_island", 40.5795, -74.1502),
)

# 16-point compass, clockwise from north.
COMPASS = (
    "N", "NNE", "NE", "ENE", "E", "ESE", "SE", "SSE",
    "S", "SSW", "SW", "WSW", "W", "WNW", "NW", "NNW",
)

# Labels of the report buckets, by upper edge.
SPEED_BUCKETS = (
    (10, "0-10 mph (gridlock)"),
    (25, "10-25 mph (slow)"),
    (45, "25-45 mph (moderate)"),
    (None, "45+ mph (free flow)"),
)
WIND_BUCKETS = (
    (5, "Calm (<5 mph)"),
    (15, "Breezy (5-15 mph)"),
    (None, "Windy (15+ mph)"),
)
