import math
import random

import pytest
from pyspark.sql import functions as F

from tidegrid.operators import neighbours, spatial

RING = "array<struct<lon: double, lat: double>>"


def test_concave_zone_with_hole_and_horizontal_edges(spark):
    outline = [(0, 0), (4, 0), (4, 1), (1, 1), (1, 3), (0, 3)]
    hole = [(2, 0.25), (3, 0.25), (3, 0.75), (2, 0.75)]
    zones = spark.createDataFrame(
        [(1, [[(float(x), float(y)) for x, y in outline + outline[:1]], [(float(x), float(y)) for x, y in hole]])],
        f"zone_id int, rings array<{RING}>",
    )
    cases = {
        (0.5, 0.5): True, (3.5, 0.5): True, (0.5, 2.5): True,  # both arms
        (2.5, 2.0): False,  # notch
        (2.5, 0.5): False,  # hole
        (1.5, 0.9): True, (-0.5, 1.0): False, (5.0, 0.5): False, (0.5, 1.0): True,
    }
    points = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(cases)], "id int, lon double, lat double")
    for size in (0.05, 0.7, 50.0):
        found = spatial.points_in_zones(points, zones, "id", "lon", "lat", how="left", size=size).orderBy("id").collect()
        assert [r.zone_id is not None for r in found] == list(cases.values())


def _segment(p, a, b):
    (px, py), (x1, y1), (x2, y2) = p, a, b
    dx, dy = x2 - x1, y2 - y1
    n = dx * dx + dy * dy
    u = max(0.0, min(1.0, ((px - x1) * dx + (py - y1) * dy) / n)) if n else 0.0
    return math.hypot(px - x1 - u * dx, py - y1 - u * dy)


@pytest.mark.parametrize("size", [None, 0.003, 1.0])
def test_near_lines_equals_brute_force(spark, size):
    rng = random.Random(1)
    points = [(i, rng.uniform(0, 0.2), rng.uniform(0, 0.2)) for i in range(200)]
    lines = [(j, [(rng.uniform(0, 0.2), rng.uniform(0, 0.2)) for _ in range(rng.choice([2, 3, 5]))]) for j in range(8)]
    lines.append((99, [(0.1, 0.1), (0.1, 0.1)]))
    want = {
        (i, j) for i, x, y in points for j, path in lines
        if min(_segment((x, y), a, b) for a, b in zip(path, path[1:])) < 0.004
    }
    p = spark.createDataFrame(points, "id int, lon double, lat double")
    l = spark.createDataFrame(lines, f"line_id int, path {RING}")
    got = spatial.near_lines(p, l, "id", "lon", "lat", 0.004, size=size).collect()
    assert {(r.id, r.line_id) for r in got} == want and len(got) == len(want)


def test_near_sites_is_strict(spark):
    p = spark.createDataFrame([(1, 0.0, 0.0)], "id int, lon double, lat double")
    s = spark.createDataFrame(
        [(1, 0.0, 0.0009), (2, 0.0, 0.001), (3, -0.0005, 0.0), (4, None, 0.0)], "site_id int, site_lon double, site_lat double"
    )
    got = spatial.near_sites(p, s, "id", "lon", "lat", 0.001).select("site_id").collect()
    assert sorted(r[0] for r in got) == [1, 3]


def test_k_ring_sizes(spark):
    cells = spark.createDataFrame([("hx10_0_-1",)], "cell string")
    ring = spatial.k_ring(cells, "cell", 2)
    counts = {r.steps: r["count"] for r in ring.groupBy("steps").count().collect()}
    assert counts == {0: 1, 1: 6, 2: 12}
    assert ring.where(F.col("steps") == 0).first().neighbour == "hx10_0_-1"


def test_cell_checks_find_wrong_cells(spark):
    df = spark.createDataFrame(
        [(40.7, -74.0, "hx10_0_0"), (40.7, -74.0, "hx20_0_0"), (40.7, -74.0, "nonsense"), (40.7, -74.0, "hx10_5_5")],
        "lat double, lon double, cell string",
    )
    assert tuple(spatial.validate_cells(df, "lat", "lon", "cell", 10.0).first()) == (4, 3, 2, 1)


def _nearest(points):
    out = {}
    for i, x, y in points:
        others = [(math.hypot(x - u, y - v), j) for j, u, v in points if j != i]
        out[i] = min(others) if others else (None, None)
    return out


@pytest.mark.parametrize("case", ["uniform", "cluster", "grid", "copies", "one", "two"])
def test_nearest_point_equals_brute_force(spark, case):
    rng = random.Random(4)
    if case == "uniform":
        points = [(i, rng.uniform(-180, 180), rng.uniform(-90, 90)) for i in range(120)]
    elif case == "cluster":
        points = [(i, rng.gauss(-74, 1e-4), rng.gauss(40.7, 1e-4)) for i in range(150)]
        points += [(1000 + i, rng.uniform(-75, -73), rng.uniform(40, 41)) for i in range(20)] + [(5000, 120.0, -30.0)]
    elif case == "grid":
        points = [(i * 10 + j, i * 0.25, j * 0.25) for i in range(8) for j in range(8)]
    elif case == "copies":
        points = [(i, float(i % 3), 0.0) for i in range(30)] + [(100, 7.0, 7.0)]
    else:
        points = [(1, 0.0, 0.0), (2, -170.0, 80.0)][: 1 if case == "one" else 2]
    df = spark.createDataFrame(points, "id int, lon double, lat double")
    got = {r.id: (r.nearest_degrees, r.nearest_id) for r in neighbours.nearest_point(df, "id", "lon", "lat").collect()}
    want = _nearest(points)
    assert set(got) == set(want)
    for i, (d, j) in want.items():
        if d is None:
            assert got[i] == (None, None)
        else:
            assert math.isclose(got[i][0], d, rel_tol=1e-12, abs_tol=1e-15)
            if case != "grid":  # equal distances differ in the last bit there
                assert got[i][1] == j


def test_cell_flags_are_any_true_over_all_points(spark):
    points = spark.createDataFrame(
        [("c1", 0.5, 0.5), ("c1", 9.0, 9.0), ("c2", 9.0, 9.5), ("c1", 0.5, 0.5)], "h3_index string, lon double, lat double"
    )
    square = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]
    zones = spark.createDataFrame([(1, [square]), (2, [square])], f"zone_id int, rings array<{RING}>")
    lines = spark.createDataFrame([(1, [(9.0, 9.4), (9.0, 9.6)])], f"line_id int, path {RING}")
    sites = spark.createDataFrame(
        [(1, 9.0, 9.0, 10000.0), (2, 9.0, 9.5005, 10000.5)], "site_id int, site_lon double, site_lat double, measure double"
    )
    got = {r.h3_lookup_index: tuple(r)[1:] for r in spatial.cell_flags(points, zones, lines, sites, "lon", "lat").collect()}
    assert got == {"c1": (True, False, False), "c2": (False, True, True)}
