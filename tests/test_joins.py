import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidegrid.config import Skew
from tidegrid.operators import joins, skew
from tidegrid.operators.joins import interval_join

T0 = datetime(2024, 1, 1)
L = "k string, l_id bigint, l_ts timestamp"
R = "k string, r_id bigint, r_ts timestamp"


def rows(rng, n, keys, seconds, hot=None):
    out = []
    for i in range(n):
        key = hot if hot and rng.random() < 0.4 else rng.choice(keys)
        out.append((key, i, T0 + timedelta(seconds=rng.randrange(seconds), microseconds=rng.choice([0, 0, 1, 999999]))))
    return out


def brute(left, right, before, after, how):
    out = []
    for k, i, t in left:
        hits = [
            j for rk, j, u in right
            if k is not None and rk == k and u is not None
            and t - timedelta(seconds=before) <= u <= t + timedelta(seconds=after)
        ]
        out += [(i, j) for j in hits] or ([(i, None)] if how == "left" else [])
    return sorted(out, key=str)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("before,after,salt", [(900, 900, 1), (900, 900, 5), (0, 600, 3), (1200, 1, 1), (0.5, 1.5, 1)])
def test_interval_join_equals_brute_force(spark, how, before, after, salt):
    rng = random.Random(f"{how} {before} {salt}")
    left = rows(rng, 120, ["a", "b", None], 20000, hot="a")
    right = rows(rng, 150, ["a", "b", "c", None], 20000, hot="a") + [("a", 999, None)]
    want = brute(left, right, before, after, how)
    l, r = spark.createDataFrame(left, L), spark.createDataFrame(right, R)
    got = interval_join(l, r, ["k"], "l_ts", "r_ts", before, after, how, salt=salt).select("l_id", "r_id").collect()
    assert sorted(map(tuple, got), key=str) == want


@pytest.mark.parametrize("before,after", [(900, 900), (1800, 600), (7, 0), (0.000001, 0.000002)])
def test_left_join_with_cut_hot_groups_equals_brute_force(spark, before, after):
    rng = random.Random(11)
    span = 4000 if before > 100 else 30 if before > 1 else 2
    left = rows(rng, 150, ["a", "b"], span, hot="a")
    right = rows(rng, 200, ["a", "b"], span, hot="a")
    l, r = spark.createDataFrame(left, L), spark.createDataFrame(right, R)
    hot = skew.find_hot(r, ["k"], "r_ts", before, after, Skew(hot_rows=4))
    joined = interval_join(l, r, ["k"], "l_ts", "r_ts", before, after, "left", hot=hot, salt=2)
    got = sorted((tuple(x) for x in joined.select("l_id", "r_id").collect()), key=str)
    assert hot is not None
    assert got == brute(left, right, before, after, "left")


def test_equal_rows_are_divided_among_the_parts_and_come_back(spark):
    t = [T0 + timedelta(seconds=s) for s in (0, 10, 5000)]
    right = [("a", 1, t[0])] * 23 + [("a", 2, t[1])] * 2 + [("a", 3, t[1])] + [("b", 4, t[0])] * 3
    left = [("a", 1, t[0]), ("a", 1, t[0]), ("a", 2, t[2]), ("b", 3, t[0])]
    l, r = spark.createDataFrame(left, L), spark.createDataFrame(right, R)
    hot = skew.find_hot(r, ["k"], "r_ts", 900, 900, Skew(hot_rows=5))
    parts = skew._cut_right(skew.bucket_right(r, "r_ts", 900, 900), ["k", "_bucket"], hot)
    largest = parts.groupBy("k", "_bucket", "_part_r").agg(F.sum("_times").alias("n")).agg(F.max("n")).first()[0]
    assert largest < 10
    got = interval_join(l, r, ["k"], "l_ts", "r_ts", 900, 900, "left", hot=hot).select("l_id", "r_id").collect()
    assert sorted(map(tuple, got), key=str) == brute(left, right, 900, 900, "left")


def test_every_hot_group_is_listed(spark):
    rng = random.Random(5)
    left, right = rows(rng, 60, ["a", "b"], 3000), rows(rng, 100, ["a", "b"], 3000)
    l, r = spark.createDataFrame(left, L), spark.createDataFrame(right, R)
    hot = skew.find_hot(r, ["k"], "r_ts", 300, 300, Skew(hot_rows=2))
    groups = skew.bucket_right(r, "r_ts", 300, 300).groupBy("k", "_bucket").count().where("count > 2").count()
    assert hot.table.count() == groups > 5
    got = interval_join(l, r, ["k"], "l_ts", "r_ts", 300, 300, "left", hot=hot).select("l_id", "r_id").collect()
    assert sorted(map(tuple, got), key=str) == brute(left, right, 300, 300, "left")
    assert skew.find_hot(r, ["k"], "r_ts", 300, 300) is None


def test_window_is_closed_at_both_ends(spark):
    edge = timedelta(minutes=15)
    tick = timedelta(microseconds=1)
    right = [("a", i, T0 + d) for i, d in enumerate([edge, -edge, edge + tick, -edge - tick])]
    l, r = spark.createDataFrame([("a", 1, T0)], L), spark.createDataFrame(right, R)
    got = interval_join(l, r, ["k"], "l_ts", "r_ts", 900, 900).select("r_id").collect()
    assert sorted(x[0] for x in got) == [0, 1]


def test_whole_second_join_cuts_fractions(spark):
    right = [("a", 1, T0 + timedelta(seconds=900, microseconds=999999)), ("a", 2, T0 + timedelta(seconds=901))]
    l, r = spark.createDataFrame([("a", 1, T0)], L), spark.createDataFrame(right, R)
    got = joins.abs_seconds_join(l, r, ["k"], "l_ts", "r_ts", 900).select("r_id").collect()
    assert [x[0] for x in got] == [1]


def test_bad_arguments(spark):
    l, r = spark.createDataFrame([], L), spark.createDataFrame([], R)
    with pytest.raises(ValueError):
        interval_join(l, r, ["k"], "l_ts", "r_ts", 1, 1, "full")
    with pytest.raises(ValueError):
        interval_join(l, r, ["k"], "l_ts", "r_ts", 1, 1, "left", extra=F.lit(True))
    with pytest.raises(ValueError):
        interval_join(l, r.withColumnRenamed("r_id", "l_id"), ["k"], "l_ts", "r_ts", 1, 1)
    with pytest.raises(ValueError):
        interval_join(l, r, ["k"], "l_ts", "r_ts", 0, 0)


def metres(a, b):
    (la, lo), (lb, mo) = a, b
    h = math.sin(math.radians(lb - la) / 2) ** 2 + math.cos(math.radians(la)) * math.cos(math.radians(lb)) * math.sin(
        math.radians(mo - lo) / 2
    ) ** 2
    return 2 * 6371000.0 * math.asin(math.sqrt(min(h, 1.0)))


@pytest.mark.parametrize(
    "box,reach", [((40.4, 41.0, -74.3, -73.6), 2500.0), ((88.9, 90.0, -180, 180), 60000.0), ((-1, 1, 179.5, 180.5), 30000.0)]
)
def test_distance_join_equals_brute_force_anywhere(spark, box, reach):
    rng = random.Random(7)

    def points(n):
        out = []
        for i in range(n):
            lon = rng.uniform(box[2], box[3])
            out.append((i, rng.uniform(box[0], box[1]), lon - 360 if lon > 180 else lon, T0 + timedelta(seconds=rng.randrange(3600))))
        return out

    left, right = points(150), points(150)
    want = sorted(
        (a[0], b[0]) for a in left for b in right
        if abs((a[3] - b[3]).total_seconds()) <= 900 and metres(a[1:3], b[1:3]) <= reach
    )
    l = spark.createDataFrame(left, "l_id int, l_lat double, l_lon double, l_ts timestamp")
    r = spark.createDataFrame(right, "r_id int, r_lat double, r_lon double, r_ts timestamp")
    got = joins.distance_time_join(l, r, ("l_lat", "l_lon"), ("r_lat", "r_lon"), reach, "l_ts", "r_ts", 900)
    assert sorted(map(tuple, got.select("l_id", "r_id").collect())) == want
    assert want


def test_nearest_in_time_keeps_every_left_row_once(spark):
    rng = random.Random(9)
    left = rows(rng, 200, ["a", "b", None], 40000, hot="a")
    left += [left[0], left[1]]
    right = rows(rng, 60, ["a", "b"], 40000)
    right += [(k, i + 1000, t) for k, i, t in right[:10]]
    l, r = spark.createDataFrame(left, L), spark.createDataFrame(right, R)
    got = joins.nearest_in_time_join(l, r, ["k"], "l_ts", "r_ts", "r_id", 900).select("l_id", "r_id").collect()
    want = []
    for k, i, t in left:
        near = [(abs(u - t), u, j) for rk, j, u in right if rk == k and abs(u - t) <= timedelta(seconds=900)]
        want.append((i, min(near)[2] if near else None))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_lookup_join_fills_flags(spark):
    main = spark.createDataFrame([("x", 1), ("y", 2), (None, 3)], "cell string, id int")
    lookup = spark.createDataFrame([("x", True)], "c string, flag boolean")
    got = joins.enrich_lookup(main, lookup, "cell", "c", ["flag"]).orderBy("id").collect()
    assert [r.flag for r in got] == [True, False, False]
