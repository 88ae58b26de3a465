"""Runs of unchanged readings, the join with intervals, and flags that change over time."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidegrid.operators.runs import overlap_join, unchanged_runs
from tidegrid.plans import versions

DAY = datetime(2026, 5, 1)


def at(minutes):
    return DAY + timedelta(minutes=minutes)


def plain_runs(rows, gap):
    out = []
    for key in sorted({r[0] for r in rows}):
        last = None
        for _, ts, v in sorted((r for r in rows if r[0] == key and r[1]), key=lambda r: (r[1], r[2])):
            if last and last[1] == v and ts - last[3] <= timedelta(seconds=gap):
                last[3], last[4] = max(last[3], ts), last[4] + 1
            else:
                last = [key, v, ts, ts, 1]
                out.append(last)
    return sorted(map(tuple, out))


def test_runs_equal_a_plain_pass(spark):
    r = random.Random(2)
    # A hot key over several days, values that stay over midnight, repeated readings, equal times.
    rows = [("hot", at(r.randrange(0, 6000, 5)), r.choice([1, 1, 1, 2])) for _ in range(900)]
    rows += [("k", at(1430 + 5 * i), 7) for i in range(6)] + [("k", at(1430), 7), ("other", at(3), 1), ("other", None, 1)]
    df = spark.createDataFrame(rows, "key string, ts timestamp, v int").repartition(5)
    got = sorted(map(tuple, unchanged_runs(df, ["key"], "ts", ["v"], 1200).select("key", "v", "run_from", "run_to", "readings").collect()))
    assert got == plain_runs(rows, 1200)
    assert ("k", 7, at(1430), at(1455), 7) in got
    assert unchanged_runs(df.limit(0), ["key"], "ts", ["v"], 60).count() == 0


@pytest.mark.parametrize("how", ["inner", "left"])
def test_overlap_join_equals_brute_force(spark, how):
    r = random.Random(3)
    left = [(i, r.choice("aab"), at(r.randrange(3000))) for i in range(120)] + [(900, None, at(5)), (901, "a", None)]
    right = [(1000 + i, r.choice("aab"), at(s), at(s + r.choice([0, 3, 700]))) for i, s in enumerate(r.randrange(3000) for _ in range(80))]
    right += [(2000, "a", at(50), at(40)), (2001, None, at(5), at(6))]
    a = spark.createDataFrame(left, "id int, key string, ts timestamp")
    b = spark.createDataFrame(right, "rid int, key string, f timestamp, t timestamp")
    got = sorted(((x.id, x.rid) for x in overlap_join(a, b, ["key"], "ts", "f", "t", 600, 300, how).collect()), key=str)
    want = []
    for i, k, ts in left:
        hits = [rid for rid, rk, f, t in right if k and ts and rk == k and f <= t and f <= ts + timedelta(seconds=300) and t >= ts - timedelta(seconds=600)]
        want += [(i, h) for h in hits] or ([(i, None)] if how == "left" else [])
    assert got == sorted(want, key=str)
    with pytest.raises(ValueError):
        overlap_join(a, b.withColumnRenamed("rid", "id"), ["key"], "ts", "f", "t", 1, 1)


def lookup(spark, **cells):
    return spark.createDataFrame([(c, *f) for c, f in cells.items()], "h3_lookup_index string, " + ", ".join(f"{f} boolean" for f in versions.FLAGS))


def test_rows_get_the_flags_of_their_time(spark, tmp_path):
    path = str(tmp_path / "flags")
    assert versions.read_versions(spark, path).count() == 0
    versions.put_version(spark, path, lookup(spark, a=(True, False, False), b=(False, True, False)), at(0))
    versions.put_version(spark, path, lookup(spark, a=(True, False, False), c=(False, False, True)), at(100))
    versions.put_version(spark, path, lookup(spark, a=(True, False, False), c=(True, False, True)), at(200))
    versions.put_version(spark, path, lookup(spark, a=(True, False, False), c=(True, False, True)), at(200))  # again
    stored = versions.read_versions(spark, path)
    assert stored.where("h3_lookup_index = 'a'").count() == 1 and stored.count() == 5  # only what changes
    with pytest.raises(ValueError, match="later"):
        versions.put_version(spark, path, lookup(spark), at(150))
    rows = [(c, at(m)) for c in ("a", "b", "c", "d", None) for m in (-5, 0, 99, 100, 199, 200, 999)]
    df = spark.createDataFrame(rows, "h3_index string, traffic_event_ts timestamp")
    got = {(x.h3_index, x.traffic_event_ts): tuple(x[f] for f in versions.FLAGS) for x in versions.flags_as_of(df, stored).collect()}

    def want(c, m):
        return {
            "a": (m >= 0, False, False), "b": (False, 0 <= m < 100, False), "c": (m >= 200, False, m >= 100),
        }.get(c, (False, False, False))

    assert got == {(c, at(m)): want(c, m) for c in ("a", "b", "c", "d", None) for m in (-5, 0, 99, 100, 199, 200, 999)}
    now = {x.h3_lookup_index: tuple(x[f] for f in versions.FLAGS) for x in versions.current(stored).collect()}
    assert now == {"a": (True, False, False), "b": (False, False, False), "c": (True, False, True)}
    assert versions.with_validity(stored).where(F.col("valid_to").isNull()).count() == 3
