"""Distances and point-in-ring tests on longitude / latitude columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegrid.config import Box
from tidegrid.functions.hexgrid import EARTH_M


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_lat = F.sin(F.radians(lat2 - lat1) / F.lit(2.0))
    half_lon = F.sin(F.radians(lon2 - lon1) / F.lit(2.0))
    h = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    # Rounding can lift h of antipodal points above 1.
    return F.lit(2.0 * EARTH_M) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def in_box(lat: Column, lon: Column, box: Box) -> Column:
    return lat.between(box.lat_min, box.lat_max) & lon.between(box.lon_min, box.lon_max)


def point(lon: Column, lat: Column) -> Column:
    return F.struct(lon.alias("lon"), lat.alias("lat"))


def planar_distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.hypot(x2 - x1, y2 - y1)


def segment_distance(px: Column, py: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Planar distance from a point to the segment (x1,y1)-(x2,y2)."""
    dx, dy = x2 - x1, y2 - y1
    along = (px - x1) * dx + (py - y1) * dy
    u = F.coalesce(along / F.nullif(dx * dx + dy * dy, F.lit(0.0)), F.lit(0.0))
    u = F.greatest(F.lit(0.0), F.least(F.lit(1.0), u))
    return F.sqrt(F.pow(px - (x1 + u * dx), 2) + F.pow(py - (y1 + u * dy), 2))


def ring_edges(ring: Column) -> Column:
    """Edges of one ring given as ``array<struct<lon,lat>>``; an open ring is closed, an empty one has none."""
    n = F.greatest(F.size(ring), F.lit(1))
    edges = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.struct(
            F.get(ring, i)["lon"].alias("x1"),
            F.get(ring, i)["lat"].alias("y1"),
            F.get(ring, F.pmod(i + 1, n))["lon"].alias("x2"),
            F.get(ring, F.pmod(i + 1, n))["lat"].alias("y2"),
        ),
    )
    return F.filter(edges, lambda e: e["x1"].isNotNull() & e["y1"].isNotNull() & e["x2"].isNotNull() & e["y2"].isNotNull())


def in_edges(px: Column, py: Column, edges: Column) -> Column:
    """Even-odd rule over all edges, so holes need no special case."""

    def crosses(e: Column) -> Column:
        spans = (e["y1"] > py) != (e["y2"] > py)
        at = (e["x2"] - e["x1"]) * (py - e["y1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0)) + e["x1"]
        return F.coalesce(spans & (px < at), F.lit(False))

    crossings = F.aggregate(edges, F.lit(0), lambda acc, e: acc + crosses(e).cast("int"))
    return F.pmod(crossings, F.lit(2)) == 1
