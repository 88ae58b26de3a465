"""Grid and geometry operators: disks, zones, lines, sites and cell flags.

Every spatial predicate becomes an equi-join on square grid buckets followed by
the exact test. Layers are cut into buckets, so none of them has to fit in one
task; Spark broadcasts a layer by itself only when its size allows, and splits
skewed buckets of either side at run time (the joins are inner).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.config import Settings
from tidegrid.functions.geo import in_edges, planar_distance, ring_edges, segment_distance
from tidegrid.functions.hexgrid import CELL_PATTERN, EARTH_M, cell_axial, cell_edge, cell_id, disk_offsets, hex_cell

_GRID = ["_gx", "_gy"]
DEGREE_M = EARTH_M * math.pi / 180.0  # metres of a degree of latitude


def with_cell(df: DataFrame, lat: str, lon: str, edge_m: float, name: str = "h3_index") -> DataFrame:
    return df.withColumn(name, hex_cell(F.col(lat), F.col(lon), edge_m))


def k_ring(cells: DataFrame, cell: str, k: int, name: str = "neighbour") -> DataFrame:
    """Each cell with all cells at most ``k`` steps away, itself included, and the steps."""
    q, r = cell_axial(F.col(cell))
    offsets = F.array(
        *(
            F.struct(F.lit(dq).alias("dq"), F.lit(dr).alias("dr"), F.lit((abs(dq) + abs(dr) + abs(dq + dr)) // 2).alias("s"))
            for dq, dr in disk_offsets(k)
        )
    )
    edge = cell_edge(F.col(cell)).cast("string")
    ident = F.concat(
        F.lit("hx"), edge, F.lit("_"), (q + F.col("_o.dq")).cast("string"), F.lit("_"), (r + F.col("_o.dr")).cast("string")
    )
    return (
        cells.withColumn("_o", F.explode(offsets))
        .withColumns({name: ident, "steps": F.col("_o.s")})
        .drop("_o")
    )


def validate_cells(df: DataFrame, lat: str, lon: str, cell: str, edge_m: float) -> DataFrame:
    """Counts of cells with the right form, the right edge length, and equal to a recomputation."""
    c = F.col(cell)
    return df.where(c.isNotNull() & F.col(lat).isNotNull() & F.col(lon).isNotNull()).agg(
        F.count(F.lit(1)).alias("cells"),
        F.count_if(c.rlike(CELL_PATTERN)).alias("format_valid"),
        F.count_if(cell_edge(c) == int(edge_m)).alias("edge_valid"),
        F.count_if(c == hex_cell(F.col(lat), F.col(lon), edge_m)).alias("cell_valid"),
    )


def _bucket(v: Column, size: float) -> Column:
    return F.floor(v / F.lit(size))


def _bucket_points(points: DataFrame, lon: str, lat: str, size: float) -> DataFrame:
    return points.withColumns({"_gx": _bucket(F.col(lon), size), "_gy": _bucket(F.col(lat), size)})


def _copy_to_buckets(df: DataFrame, x1: Column, x2: Column, y1: Column, y2: Column, size: float) -> DataFrame:
    """Each row copied to all buckets that its box touches."""
    return df.withColumn("_gx", F.explode(F.sequence(_bucket(x1, size), _bucket(x2, size)))).withColumn(
        "_gy", F.explode(F.sequence(_bucket(y1, size), _bucket(y2, size)))
    )


def _outer(points: DataFrame, hits: DataFrame, point_id: str, how: str) -> DataFrame:
    if how == "inner":
        return hits
    extra = [c for c in hits.columns if c not in points.columns]
    return points.join(hits.select(point_id, *extra), point_id, "left")


def points_in_zones(
    points: DataFrame, zones: DataFrame, point_id: str, lon: str, lat: str,
    how: str = "inner", size: float = 0.05,
) -> DataFrame:
    """Point x zone pairs where the zone contains the point; ``left`` keeps the other points.

    ``zones``: zone_id, rings array<array<struct<lon,lat>>> (holes are further
    rings). ``point_id`` is unique. The boundary itself is undefined.
    """
    edges = F.flatten(F.transform("rings", ring_edges))
    layer = zones.select("zone_id", edges.alias("_edges")).where(F.size("_edges") > 0)
    x1, x2 = (F.transform("_edges", lambda e: e["x1"]), F.transform("_edges", lambda e: e["y1"]))
    layer = layer.withColumns(
        {"_x1": F.array_min(x1), "_x2": F.array_max(x1), "_y1": F.array_min(x2), "_y2": F.array_max(x2)}
    )
    layer = _copy_to_buckets(layer, F.col("_x1"), F.col("_x2"), F.col("_y1"), F.col("_y2"), size)
    # A point looks along its latitude to larger longitudes: a bucket needs no edge above, below or behind it.
    low, left = F.col("_gy") * F.lit(size), F.col("_gx") * F.lit(size)
    pad = F.lit(size * 1e-6)
    meets = lambda e: (
        (F.least(e["y1"], e["y2"]) <= low + F.lit(size) + pad) & (F.greatest(e["y1"], e["y2"]) >= low - pad)
        & (F.greatest(e["x1"], e["x2"]) >= left - pad)
    )
    layer = layer.withColumn("_edges", F.filter("_edges", meets)).where(F.size("_edges") > 0)
    px, py = F.col(lon), F.col(lat)
    in_box = px.between(F.col("_x1"), F.col("_x2")) & py.between(F.col("_y1"), F.col("_y2"))
    hits = (
        _bucket_points(points, lon, lat, size)
        .join(layer, _GRID)
        .where(in_box)
        .where(in_edges(px, py, F.col("_edges")))
        .select(*points.columns, "zone_id")
    )
    return _outer(points, hits, point_id, how)


def near_lines(
    points: DataFrame, lines: DataFrame, point_id: str, lon: str, lat: str, degrees: float,
    how: str = "inner", size: float | None = None,
) -> DataFrame:
    """Point x line pairs closer than ``degrees`` (planar), with the smallest distance.

    ``lines``: line_id, path array<struct<lon,lat>>. A line is cut into segments;
    long segments are walked in bucket-sized steps, so a diagonal does not claim
    the whole of its bounding box.
    """
    size = size or max(degrees * 10, 1e-6)
    seg = F.transform(
        F.sequence(F.lit(1), F.size("path") - 1),
        lambda i: F.struct(F.get("path", i - 1).alias("a"), F.get("path", i).alias("b")),
    )
    segments = (
        lines.where(F.size("path") >= 2)
        .select("line_id", F.explode(seg).alias("_s"))
        .select(
            "line_id",
            F.col("_s.a.lon").alias("_x1"), F.col("_s.a.lat").alias("_y1"),
            F.col("_s.b.lon").alias("_x2"), F.col("_s.b.lat").alias("_y2"),
        )
    )
    x1, y1, x2, y2 = (F.col(c) for c in ("_x1", "_y1", "_x2", "_y2"))
    steps = F.greatest(F.ceil(F.greatest(F.abs(x2 - x1), F.abs(y2 - y1)) / F.lit(size)), F.lit(1))
    pad = F.lit(degrees * 1.000001)

    # One row per step of a segment, in the buckets the step touches; a bucket keeps a segment once.
    i = F.col("_i")
    ax, ay, bx, by = (v + d * n / steps for v, d, n in ((x1, x2 - x1, i), (y1, y2 - y1, i), (x1, x2 - x1, i + 1), (y1, y2 - y1, i + 1)))
    walked = segments.withColumn("_i", F.explode(F.sequence(F.lit(0), steps.cast("int") - 1)))
    layer = _copy_to_buckets(
        walked, F.least(ax, bx) - pad, F.greatest(ax, bx) + pad, F.least(ay, by) - pad, F.greatest(ay, by) + pad, size
    )
    layer = layer.drop("_i").distinct()
    px, py = F.col(lon), F.col(lat)
    hits = (
        _bucket_points(points.select(point_id, lon, lat), lon, lat, size)
        .join(layer, _GRID)
        .withColumn("line_degrees", segment_distance(px, py, x1, y1, x2, y2))
        .where(F.col("line_degrees") < degrees)
        .groupBy(point_id, "line_id")
        .agg(F.min("line_degrees").alias("line_degrees"))
    )
    return points.join(hits, point_id, "left" if how == "left" else "inner")


def near_sites(
    points: DataFrame, sites: DataFrame, point_id: str, lon: str, lat: str, degrees: float,
    how: str = "inner", size: float | None = None,
) -> DataFrame:
    """Point x site pairs closer than ``degrees`` (planar). ``sites``: site_id, site_lon, site_lat."""
    size = size or max(degrees * 10, 1e-6)
    pad = F.lit(degrees * 1.000001)
    sx, sy = F.col("site_lon"), F.col("site_lat")
    located = sites.where(sx.isNotNull() & sy.isNotNull())
    layer = _copy_to_buckets(located, sx - pad, sx + pad, sy - pad, sy + pad, size)
    hits = (
        _bucket_points(points, lon, lat, size)
        .join(layer, _GRID)
        .withColumn("site_degrees", planar_distance(F.col(lon), F.col(lat), sx, sy))
        .where(F.col("site_degrees") < degrees)
        .drop(*_GRID)
    )
    return _outer(points, hits, point_id, how)


def _scaled(df: DataFrame, lon: str, shrink: float) -> DataFrame:
    """Longitudes in units as long as a degree of latitude."""
    return df.withColumn("_scaled", F.col(lon) * F.lit(shrink))


def near_lines_metres(
    points: DataFrame, lines: DataFrame, point_id: str, lon: str, lat: str, metres: float, shrink: float, how: str = "inner"
) -> DataFrame:
    """As ``near_lines``, within ``metres`` and with ``line_metres``.

    A degree of longitude is ``shrink`` (the cosine of the region's latitude)
    times as long as one of latitude, so 0.001 degrees are not the same distance
    in both directions.
    """
    flat = F.transform("path", lambda p: F.struct((p["lon"] * F.lit(shrink)).alias("lon"), p["lat"].alias("lat")))
    found = near_lines(
        _scaled(points, lon, shrink), lines.withColumn("path", flat), point_id, "_scaled", lat, metres / DEGREE_M, how
    )
    return found.withColumn("line_metres", F.col("line_degrees") * F.lit(DEGREE_M)).drop("_scaled", "line_degrees")


def near_sites_metres(
    points: DataFrame, sites: DataFrame, point_id: str, lon: str, lat: str, metres: float, shrink: float, how: str = "inner"
) -> DataFrame:
    """As ``near_sites``, within ``metres`` and with ``site_metres``; see ``near_lines_metres``."""
    flat = sites.withColumn("site_lon", F.col("site_lon") * F.lit(shrink))
    found = near_sites(_scaled(points, lon, shrink), flat, point_id, "_scaled", lat, metres / DEGREE_M, how)
    return found.withColumn("site_metres", F.col("site_degrees") * F.lit(DEGREE_M)).drop("_scaled", "site_degrees")


def collapse_flags(df: DataFrame, key: str, flags: list[str]) -> DataFrame:
    """One row per key; a flag is true if any row of the key has it."""
    return df.groupBy(key).agg(*(F.coalesce(F.bool_or(f), F.lit(False)).alias(f) for f in flags))


FLAGS = ["is_in_congestion_zone", "is_near_truck_route", "is_near_high_emission_bldg"]


def cell_flags(
    points: DataFrame, zones: DataFrame, lines: DataFrame, sites: DataFrame, lon: str, lat: str,
    cell: str = "h3_index", cfg: Settings = Settings(),
) -> DataFrame:
    """Cell -> static flags, any-true over **all** distinct points of a cell.

    The three layers are matched independently and their hits united, so a point
    in many zones and near many lines does not multiply rows. ``points`` is read
    once per layer: pass a stored table of distinct points, not a raw topic.
    """
    spots = points.where(F.col(cell).isNotNull()).select(lon, lat, cell).distinct().withColumn("_spot", F.struct(lon, lat))
    emitting = sites.where(F.col("measure") > cfg.high_emission)
    none = {f: F.lit(False) for f in FLAGS}
    hits = (
        points_in_zones(spots, zones, "_spot", lon, lat),
        near_lines(spots, lines, "_spot", lon, lat, cfg.near_degrees),
        near_sites(spots, emitting, "_spot", lon, lat, cfg.near_degrees),
    )
    rows = spots.select(cell, *(v.alias(f) for f, v in none.items()))
    for flag, hit in zip(FLAGS, hits):
        rows = rows.unionByName(hit.select(cell, *((F.lit(f == flag)).alias(f) for f in FLAGS)))
    return collapse_flags(rows, cell, FLAGS).withColumnRenamed(cell, "h3_lookup_index")


__all__ = [
    "FLAGS", "cell_flags", "cell_id", "collapse_flags", "k_ring", "near_lines", "near_sites",
    "points_in_zones", "validate_cells", "with_cell",
]
