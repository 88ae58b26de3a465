"""SQL that states the expected results straight from the given tables.

It starts from table columns and arithmetic, not from the JSON messages, so it
also checks that parsing and refining lose nothing.
"""

from __future__ import annotations

from tidegrid.catalogue import feeds
from tidegrid.config import REGION_CENTRES, Settings

CFG = feeds.CFG


def num(x: float) -> str:
    """A DOUBLE literal; a plain 40.7 would be a DECIMAL."""
    return f"cast({x!r} as double)"


def mean(c: str, digits: int = 2) -> str:
    return rounded(f"avg({c})", digits)


def rounded(x: str, digits: int = 2) -> str:
    return f"cast(round(cast({x} as decimal(28,10)), {digits}) as double)"


def pct(part: str, whole: str = "count(*)", digits: int = 2) -> str:
    return rounded(f"cast({part} as double) * {num(100.0)} / nullif(cast({whole} as double), 0)", digits)


def lat(key: str) -> str:
    return f"({num(40.47)} + cast(({key} * 7919) % 4600 as double) / {num(10000.0)})"


def lon(key: str) -> str:
    return f"({num(-74.27)} + cast(({key} * 10473) % 5900 as double) / {num(10000.0)})"


def haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"{num(12742000.0)} * asin(sqrt(least({num(1.0)}, pow(sin(radians({lat2} - {lat1}) / 2), 2)"
        f" + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))))"
    )


def hex_steps(source: str, name: str, edge_m: float) -> str:
    """CTEs that add ``cell`` to a relation with ``lat`` and ``lon``; the last is called ``name``."""
    e = num(float(edge_m))
    return f"""
{name}_xy AS (SELECT *, {num(6371000.0)} * radians(lon - {num(-74.0)}) * cos(radians({num(40.7)})) AS x_m,
    {num(6371000.0)} * radians(lat - {num(40.7)}) AS y_m FROM {source}),
{name}_qr AS (SELECT *, (sqrt({num(3.0)}) / {num(3.0)} * x_m - y_m / {num(3.0)}) / {e} AS qf,
    ({num(2.0)} * y_m / {num(3.0)}) / {e} AS rf FROM {name}_xy),
{name}_round AS (SELECT *, floor(qf + {num(0.5)}) AS q0, floor(rf + {num(0.5)}) AS r0,
    floor((-qf - rf) + {num(0.5)}) AS s0 FROM {name}_qr),
{name}_err AS (SELECT *, abs(q0 - qf) AS dq, abs(r0 - rf) AS dr, abs(s0 - (-qf - rf)) AS ds FROM {name}_round),
{name}_axial AS (SELECT * EXCLUDE (x_m, y_m, qf, rf, q0, r0, s0, dq, dr, ds),
    cast(CASE WHEN dq > dr AND dq > ds THEN -r0 - s0 ELSE q0 END as bigint) AS q,
    cast(CASE WHEN NOT (dq > dr AND dq > ds) AND dr > ds THEN -q0 - s0 ELSE r0 END as bigint) AS r FROM {name}_err),
{name} AS (SELECT *, 'hx{int(edge_m)}_' || q || '_' || r AS cell FROM {name}_axial)"""


def in_box(lat_: str = "lat", lon_: str = "lon") -> str:
    b = CFG.box
    return (
        f"{lat_} BETWEEN {num(b.lat_min)} AND {num(b.lat_max)}"
        f" AND {lon_} BETWEEN {num(b.lon_min)} AND {num(b.lon_max)}"
    )


PLACED = f"""
placed AS (SELECT event_id, user_id, event_type, value, ts, cast(json_extract_string(props, '$.k') as int) AS k,
    {lat('user_id')} AS lat, {lon('user_id')} AS lon FROM events)"""

EVENTS = PLACED + "," + hex_steps("placed", "ev", CFG.hex_edge_m)

TRAFFIC_RAW = """
traffic_raw AS (SELECT cast(event_id as varchar) AS id, cast(user_id % 3 as varchar) AS status,
    CASE WHEN event_id % 17 <> 0 THEN value END AS speed, cast(event_id % 900 as double) AS travel_time,
    'link ' || user_id AS link_name, CASE WHEN event_id % 23 <> 0 THEN r_name END AS borough,
    'from ' || (user_id % 7) AS from_street, 'to ' || (user_id % 11) AS to_street,
    CASE WHEN event_id % 29 <> 0 THEN date_trunc('millisecond', ts) END AS event_ts,
    lat, lon, cell, ts + INTERVAL 20 SECOND AS arrived
  FROM ev LEFT JOIN region ON r_regionkey = user_id % 5 WHERE event_type = 'view' AND event_id % 10 <> 0)"""

TRAFFIC = f"""
traffic AS (SELECT * FROM traffic_raw WHERE event_ts IS NOT NULL AND {in_box()}
    AND speed BETWEEN 0 AND {num(CFG.max_speed)})"""

AQ_TYPED = f"""
aq_typed AS (
  SELECT 'openaq' AS aq_source,
    coalesce(CASE WHEN event_id % 3 <> 0 THEN cast(user_id as varchar) END,
      CASE WHEN event_id % 6 <> 0 THEN cast(user_id + 1000 as varchar) END,
      CASE WHEN event_id % 12 <> 0 THEN 'site ' || (user_id % 10) END) AS aq_location_id,
    CASE WHEN event_id % 12 <> 0 THEN 'site ' || (user_id % 10) END AS aq_location_name,
    ts AS aq_event_ts, lat, lon, cell, value * {num(5.0)} AS pm25,
    cast(NULL as double) AS aq_temperature, cast(NULL as double) AS aq_humidity, ts + INTERVAL 20 SECOND AS arrived
  FROM ev WHERE event_type = 'click' AND event_id % 10 <> 0
  UNION ALL
  SELECT 'purpleair', coalesce(CASE WHEN event_id % 4 <> 0 THEN cast(user_id as varchar) END, 'node ' || user_id),
    'node ' || user_id, CASE WHEN event_id % 9 <> 0 THEN ts ELSE ts + INTERVAL 20 SECOND END,
    lat, lon, cell, value * {num(3.0)}, cast(k as double), cast(k % 50 as double), ts + INTERVAL 20 SECOND
  FROM ev WHERE event_type = 'error' AND event_id % 10 <> 0)"""

AQ = f"""
aq AS (SELECT * FROM aq_typed WHERE aq_location_id IS NOT NULL AND {in_box()}
    AND pm25 BETWEEN 0 AND {num(CFG.max_pm25)})"""

WEATHER = """
weather AS (SELECT ts AS weather_event_ts,
    CASE WHEN event_id % 11 <> 0 THEN lower(r_name) ELSE 'Unknown' END AS weather_period_name,
    CASE WHEN k % 13 <> 0 THEN cast(floor(value) as int) END AS weather_temperature,
    'F' AS weather_temperature_unit,
    cast(CASE WHEN k % 4 = 0 OR k % 7 = 0 THEN -1 ELSE k END as int) AS weather_wind_speed_mph,
    CASE WHEN k % 3 <> 0 THEN 'NW' ELSE 'Unknown' END AS weather_wind_direction,
    CASE WHEN k % 2 = 0 THEN 'clear' ELSE 'Unknown' END AS weather_short_forecast,
    cast(CASE WHEN k % 5 <> 0 THEN k ELSE 0 END as int) AS weather_precip_probability,
    lower(r_name) AS region, ts + INTERVAL 20 SECOND AS arrived
  FROM ev LEFT JOIN region ON r_regionkey = user_id % 5 WHERE event_type = 'signup' AND event_id % 10 <> 0)"""


def _edges() -> str:
    rows = []
    for n, ring in enumerate(feeds.ZONE_RINGS):
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
            rows.append(f"({n}, {num(ax)}, {num(ay)}, {num(bx)}, {num(by)})")
    ox, oy = (
        f"{num(o)} + cast(r_regionkey as double) * {num(s)}" for o, s in zip(feeds.ZONE_ORIGIN, feeds.ZONE_STEP)
    )
    return f"""
zone_edges AS (SELECT cast(r_regionkey as bigint) AS zone_id, {ox} + ax AS x1, {oy} + ay AS y1,
    {ox} + bx AS x2, {oy} + by_ AS y2
  FROM region, (VALUES {', '.join(rows)}) AS e(ring, ax, ay, bx, by_))"""


def _segments() -> str:
    rows = [
        f"({num(ax)}, {num(ay)}, {num(bx)}, {num(by)})"
        for (ax, ay), (bx, by) in zip(feeds.ROUTE_PATH, feeds.ROUTE_PATH[1:])
    ]
    ox, oy = (
        f"{num(o)} + cast(n_nationkey as double) * {num(s)}" for o, s in zip(feeds.ROUTE_ORIGIN, feeds.ROUTE_STEP)
    )
    return f"""
segments AS (SELECT cast(n_nationkey as bigint) AS line_id, {ox} + ax AS x1, {oy} + ay AS y1,
    {ox} + bx AS x2, {oy} + by_ AS y2
  FROM nation, (VALUES {', '.join(rows)}) AS s(ax, ay, bx, by_))"""


SITES = f"""
sites AS (SELECT s_suppkey AS site_id, {lon('s_suppkey')} + {num(0.0004)} AS site_lon,
    {lat('s_suppkey')} + {num(0.0003)} AS site_lat, s_acctbal * {num(2.0)} AS measure FROM supplier)"""

LAYERS = _edges() + "," + _segments() + "," + SITES


def zone_hits(points: str, key: str) -> str:
    """(key, zone_id) of points inside a zone: an odd number of edges to their right."""
    return f"""SELECT {key}, zone_id FROM {points}, zone_edges
    WHERE (y1 > lat) <> (y2 > lat) AND lon < (x2 - x1) * (lat - y1) / nullif(y2 - y1, 0) + x1
    GROUP BY {key}, zone_id HAVING count(*) % 2 = 1"""


_U = "greatest(0, least(1, coalesce(((lon - x1) * (x2 - x1) + (lat - y1) * (y2 - y1)) / nullif((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1), 0), 0)))"


def line_hits(points: str, key: str, degrees: float) -> str:
    """(key, line_id, distance) of points near a line."""
    return f"""SELECT {key}, line_id, min(sqrt(pow(lon - (x1 + u * (x2 - x1)), 2) + pow(lat - (y1 + u * (y2 - y1)), 2))) AS d
    FROM (SELECT *, {_U} AS u FROM {points}, segments) GROUP BY {key}, line_id HAVING d < {num(degrees)}"""


def site_hits(points: str, key: str, degrees: float) -> str:
    return f"""SELECT {key}, site_id, measure, sqrt(pow(site_lon - lon, 2) + pow(site_lat - lat, 2)) AS d
    FROM {points}, sites WHERE d < {num(degrees)}"""


LOOKUP = f"""
spots AS (SELECT DISTINCT cell, lat, lon FROM traffic_raw WHERE {in_box()}),
flags AS (SELECT cell AS h3_lookup_index,
    bool_or((lat, lon) IN (SELECT (lat, lon) FROM ({zone_hits('spots', 'lat, lon')}))) AS is_in_congestion_zone,
    bool_or((lat, lon) IN (SELECT (lat, lon) FROM ({line_hits('spots', 'lat, lon', CFG.near_degrees)}))) AS is_near_truck_route,
    bool_or((lat, lon) IN (SELECT (lat, lon) FROM ({site_hits('spots', 'lat, lon', CFG.near_degrees)})
      WHERE measure > {num(CFG.high_emission)})) AS is_near_high_emission_bldg
  FROM spots GROUP BY cell)"""

BUSINESS = """
business AS (SELECT t.id AS traffic_id, t.status AS traffic_status, t.speed AS traffic_speed,
    t.travel_time AS traffic_travel_time, t.link_name AS traffic_link_name, t.borough AS traffic_borough,
    t.from_street AS traffic_from_street, t.to_street AS traffic_to_street, t.event_ts AS traffic_event_ts,
    t.lat AS traffic_lat, t.lon AS traffic_lon, t.cell AS h3_index,
    coalesce(is_in_congestion_zone, false) AS is_in_congestion_zone,
    coalesce(is_near_truck_route, false) AS is_near_truck_route,
    coalesce(is_near_high_emission_bldg, false) AS is_near_high_emission_bldg,
    coalesce(is_in_congestion_zone, false) AS is_congestion_zone,
    coalesce(is_near_truck_route, false) AS is_truck_route,
    a.aq_source, a.aq_location_id, a.aq_location_name, a.pm25 AS aq_pm25_ugm3, a.aq_temperature, a.aq_humidity,
    a.aq_event_ts, a.pm25 IS NOT NULL AS has_aq_match,
    w.weather_period_name, w.weather_temperature, w.weather_temperature_unit, w.weather_wind_speed_mph,
    w.weather_wind_direction, w.weather_short_forecast, w.weather_precip_probability, w.weather_event_ts,
    w.weather_event_ts IS NOT NULL AS has_weather_match
  FROM traffic t LEFT JOIN flags ON h3_lookup_index = t.cell
  LEFT JOIN aq a ON a.cell = t.cell AND a.aq_event_ts >= t.event_ts - INTERVAL 15 MINUTE
    AND a.aq_event_ts <= t.event_ts + INTERVAL 15 MINUTE
  LEFT JOIN weather w ON w.weather_event_ts >= t.event_ts - INTERVAL 15 MINUTE
    AND w.weather_event_ts <= t.event_ts + INTERVAL 15 MINUTE)"""

_CTES = {
    "ev": EVENTS, "traffic_raw": TRAFFIC_RAW, "traffic": TRAFFIC, "aq_typed": AQ_TYPED, "aq": AQ,
    "weather": WEATHER, "layers": LAYERS, "lookup": LOOKUP, "business": BUSINESS,
}
_ORDER = list(_CTES)


def upto(last: str, final: str, *extra: str) -> str:
    """``final`` behind all relations up to ``last`` in dependency order, and further CTEs."""
    parts = [_CTES[n] for n in _ORDER[: _ORDER.index(last) + 1]]
    return f"WITH {','.join([*parts, *extra])}\n{final}"


def on_business(final: str) -> str:
    return upto("business", final)


REGIONS = "(VALUES {}) AS centre(name, c_lat, c_lon)".format(
    ", ".join(f"('{n}', {num(a)}, {num(b)})" for n, a, b in REGION_CENTRES)
)

__all__ = ["CFG", "Settings", "haversine", "hex_steps", "mean", "num", "on_business", "pct", "rounded", "upto"]
