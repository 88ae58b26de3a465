import math
import random
from datetime import datetime

from pyspark.sql import functions as F

from tidegrid.config import COMPASS, SPEED_BUCKETS, WIND_BUCKETS
from tidegrid.functions import geo, hexgrid, stats, text, times


def column(spark, values, ddl, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {ddl}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_first_point_on_bad_input(spark):
    values = ["40.75,-73.98 40.76,-73.97", " ", "", None, "40.7", "40.7,x", "40.7,-74.0"]
    lat = column(spark, values, "string", lambda c: text.first_point(c)[0])
    lon = column(spark, values, "string", lambda c: text.first_point(c)[1])
    assert lat == [40.75, None, None, None, 40.7, 40.7, 40.7]
    assert lon == [-73.98, None, None, None, None, None, -74.0]


def test_number_and_first_int(spark):
    assert column(spark, ["abc", "", "-0.1", "0", None, "1e2"], "string", text.number) == [None, None, -0.1, 0.0, None, 100.0]
    assert column(spark, ["12 mph", "calm", None, "5 to 10 mph"], "string", text.first_int) == [12, None, None, 5]


def test_compass(spark):
    degrees = [0.0, 11.24, 11.25, 348.74, 348.75, 360.0, 180.0, None]
    assert column(spark, degrees, "double", text.compass) == ["N", "N", "NNE", "NNW", "N", "N", "S", None]
    assert column(spark, [22.5 * i for i in range(16)], "double", text.compass) == list(COMPASS)


def test_buckets(spark):
    labels = [b[1] for b in SPEED_BUCKETS]
    got = column(spark, [9.99, 10.0, 24.9, 25.0, 45.0], "double", lambda c: text.bucketize(c, SPEED_BUCKETS))
    assert got == [labels[0], labels[1], labels[1], labels[2], labels[3]]
    wind = column(spark, [-1, 5, 15], "int", lambda c: text.bucketize(c, WIND_BUCKETS))
    assert wind == [b[1] for b in WIND_BUCKETS]


def test_local_time_gap_and_overlap(spark):
    values = [
        "2026-04-25T20:00:00.000", "2024-03-10T02:30:00.000", "2024-11-03T01:30:00.000", "25/04/2026", None,
    ]
    got = column(spark, values, "string", lambda c: times.local_to_utc(c, "America/New_York"))
    assert got[0] == datetime(2026, 4, 26, 0, 0)
    assert got[1] is not None and got[2] in (datetime(2024, 11, 3, 5, 30), datetime(2024, 11, 3, 6, 30))
    assert got[3:] == [None, None]


def test_iso_utc(spark):
    values = ["2024-01-01T10:00:00Z", "2024-01-01T10:00:00-05:00", "later", "", None]
    assert column(spark, values, "string", times.to_iso_utc) == [
        "2024-01-01T10:00:00Z", "2024-01-01T15:00:00Z", None, None, None,
    ]


def test_time_bin_before_epoch(spark):
    values = [datetime(2024, 1, 1, 0, 14, 59, 999999), datetime(1969, 12, 31, 23, 59, 59)]
    got = column(spark, values, "timestamp", lambda c: times.time_bin(c, 900))
    assert got == [datetime(2024, 1, 1), datetime(1969, 12, 31, 23, 45)]
    assert column(spark, values, "timestamp", lambda c: times.slot(c, 10**6))[1] == -1


def test_mean_rounds_ties_whatever_the_order(spark):
    df = spark.createDataFrame([(1.01,), (1.02,)], "v double")
    assert df.agg(stats.mean("v")).first()[0] == 1.02
    assert df.agg(stats.pct(F.lit(1), F.lit(0))).first()[0] is None


def _python_cell(lat, lon, e):
    x = 6371000.0 * math.radians(lon + 74.0) * math.cos(math.radians(40.7))
    y = 6371000.0 * math.radians(lat - 40.7)
    best = None
    q0, r0 = (math.sqrt(3) / 3 * x - y / 3) / e, (2 * y / 3) / e
    for q in range(math.floor(q0) - 1, math.floor(q0) + 3):
        for r in range(math.floor(r0) - 1, math.floor(r0) + 3):
            cx, cy = e * math.sqrt(3) * (q + r / 2), 1.5 * e * r
            d = math.hypot(x - cx, y - cy)
            if best is None or d < best[0]:
                best = (d, f"hx{int(e)}_{q}_{r}")
    return best


def test_cell_is_the_nearest_hexagon_centre(spark):
    rng = random.Random(3)
    points = [(40.7, -74.0), (40.6999, -74.0001), (40.7001, -73.9999)]
    points += [(rng.uniform(40.4, 41.0), rng.uniform(-74.3, -73.6)) for _ in range(300)]
    df = spark.createDataFrame(points, "lat double, lon double")
    rows = df.select("lat", "lon", hexgrid.hex_cell(F.col("lat"), F.col("lon"), 1200.0).alias("c")).collect()
    for r in rows:
        distance, cell = _python_cell(r.lat, r.lon, 1200.0)
        assert r.c == cell and distance <= 1200.0 + 1e-6
        assert "-0_" not in r.c and not r.c.endswith("_-0")


def test_cell_of_bad_points_is_null(spark):
    df = spark.createDataFrame([(None, 1.0), (91.0, 1.0), (1.0, 181.0), (float("nan"), 1.0)], "lat double, lon double")
    assert [r[0] for r in df.select(hexgrid.hex_cell(F.col("lat"), F.col("lon"), 10.0)).collect()] == [None] * 4


def test_grid_distance(spark):
    df = spark.createDataFrame([("hx10_0_0", "hx10_2_-1", "hx20_0_0")], "a string, b string, c string")
    got = df.select(hexgrid.grid_distance(F.col("a"), F.col("b")), hexgrid.grid_distance(F.col("a"), F.col("c"))).first()
    assert tuple(got) == (2, None)


def test_haversine_known_values(spark):
    df = spark.range(1)
    one_degree = df.select(geo.haversine_m(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0))).first()[0]
    assert abs(one_degree - 6371000.0 * math.pi / 180) < 1e-6
    antipodal = df.select(geo.haversine_m(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0))).first()[0]
    assert abs(antipodal - 6371000.0 * math.pi) < 1e-6
