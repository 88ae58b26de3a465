"""Hexagonal grid over a planar projection around a reference point.

Good for one metropolitan area: the projection is only locally true. Cell ids
carry the edge length, so cells of different resolutions never compare equal;
they are not ids of any global grid system.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegrid.config import Settings

EARTH_M = 6371000.0
CELL_PATTERN = r"^hx\d+_-?\d+_-?\d+$"

_DEFAULT = Settings()


def project(lat: Column, lon: Column, cfg: Settings = _DEFAULT) -> tuple[Column, Column]:
    x = F.lit(EARTH_M) * F.radians(lon - F.lit(cfg.origin_lon)) * F.cos(F.radians(F.lit(cfg.origin_lat)))
    y = F.lit(EARTH_M) * F.radians(lat - F.lit(cfg.origin_lat))
    return x, y


def axial(lat: Column, lon: Column, edge_m: float, cfg: Settings = _DEFAULT) -> tuple[Column, Column]:
    """Axial (q, r) of the pointy-top hexagon around a point.

    Both coordinates are rounded; the one that was cut further is then moved by
    one step where the other's rest calls for it. No branches, so generated code
    computes the shared parts once.
    """
    x, y = project(lat, lon, cfg)
    edge = F.lit(float(edge_m))
    q = (F.sqrt(F.lit(3.0)) / F.lit(3.0) * x - y / F.lit(3.0)) / edge
    r = (F.lit(2.0) * y / F.lit(3.0)) / edge
    half = F.lit(0.5)
    q0, r0 = F.floor(q + half), F.floor(r + half)
    dq, dr = q - q0, r - r0
    q_further = (F.abs(dq) >= F.abs(dr)).cast("bigint")
    q_cell = q0 + F.floor(dq + half * dr + half) * q_further
    r_cell = r0 + F.floor(dr + half * dq + half) * (F.lit(1) - q_further)
    # bigint: a double can be -0.0, whose text differs from 0 and would split a cell.
    return q_cell.cast("bigint"), r_cell.cast("bigint")


def cell_id(q: Column, r: Column, edge_m: float) -> Column:
    return F.concat_ws("_", F.lit(f"hx{int(edge_m)}"), q.cast("string"), r.cast("string"))


def hex_cell(
    lat: Column, lon: Column, edge_m: float, cfg: Settings = _DEFAULT, checked: bool = False
) -> Column:
    """Cell id of a point; NULL when a coordinate is NULL or not on the globe.

    ``checked`` says that the coordinates were filtered before. The result is
    then known not to be NULL, which spares joins a second evaluation to test it.
    """
    cell = cell_id(*axial(lat, lon, edge_m, cfg), edge_m)
    if checked:
        return cell
    return F.when(lat.between(-90.0, 90.0) & lon.between(-180.0, 180.0), cell)


def cell_axial(cell: Column) -> tuple[Column, Column]:
    parts = F.split(cell, "_")
    return F.get(parts, F.lit(1)).try_cast("bigint"), F.get(parts, F.lit(2)).try_cast("bigint")


def cell_edge(cell: Column) -> Column:
    return F.regexp_extract(cell, r"^hx(\d+)_", 1).try_cast("bigint")


def grid_distance(a: Column, b: Column) -> Column:
    """Number of steps between two cells; NULL for cells of different edge length."""
    (qa, ra), (qb, rb) = cell_axial(a), cell_axial(b)
    dq, dr = qa - qb, ra - rb
    steps = ((F.abs(dq) + F.abs(dr) + F.abs(dq + dr)) / F.lit(2)).cast("bigint")
    return F.when(cell_edge(a) == cell_edge(b), steps)


def disk_offsets(k: int) -> list[tuple[int, int]]:
    return [
        (dq, dr)
        for dq in range(-k, k + 1)
        for dr in range(max(-k, -dq - k), min(k, -dq + k) + 1)
    ]
