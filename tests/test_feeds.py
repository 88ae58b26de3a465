"""Parsing, refining, ingestion and quality on literal rows."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidegrid import Settings, schemas
from tidegrid.functions.times import as_of_literal
from tidegrid.operators import ingest, quality
from tidegrid.operators.parse import parse_json, quarantine, split_valid
from tidegrid.plans import refine

ARRIVED = datetime(2026, 4, 26, 0, 1)
GOOD = {"id": "1", "status": "0", "speed": "42", "travel_time": "60", "data_as_of": "2026-04-25T20:00:00.000", "link_points": "40.75,-73.98 40.76,-73.97"}


def topic(spark, *values):
    return spark.createDataFrame([(v, ARRIVED, "t") for v in values], schemas.TOPIC)


def valid(spark, schema, *records):
    return split_valid(parse_json(topic(spark, *(json.dumps(r) for r in records)), schema))[0]


def test_broken_null_and_empty_payloads_go_to_quarantine(spark):
    values = [json.dumps(GOOD), "{bad json payload", '{"bad_json": true', None, "", "  "]
    ok, bad = split_valid(parse_json(topic(spark, *values), schemas.TRAFFIC))
    assert ok.columns == [*schemas.TRAFFIC.fieldNames(), "kafka_timestamp"]
    assert [r.id for r in ok.collect()] == ["1"]
    assert sorted((r.raw_payload for r in bad.collect()), key=str) == sorted(values[1:], key=str)
    assert quarantine(bad, bad).count() == 10


def test_traffic_rules_at_the_edges(spark):
    cfg = Settings()
    speeds = {"abc": 0, "": 0, "-0.1": 0, "0": 1, "100": 1, "100.1": 0}
    points = {"40.4774,-74.2591": 1, "40.9176,-73.7004": 1, "40.4773,-74": 0, "40.9177,-74": 0, "40.7,-74.2592": 0, "40.7,-73.7003": 0, "": 0, "40.7": 0}
    records = [{**GOOD, "id": f"s{i}", "speed": s} for i, s in enumerate(speeds)]
    records += [{**GOOD, "id": f"p{i}", "link_points": p} for i, p in enumerate(points)]
    records += [{**GOOD, "id": None}, {**GOOD, "id": "t", "data_as_of": "soon"}]
    out = {r.id: r for r in refine.refine_traffic(valid(spark, schemas.TRAFFIC, *records), cfg).collect()}
    want = {f"s{i}" for i, keep in enumerate(speeds.values()) if keep} | {f"p{i}" for i, keep in enumerate(points.values()) if keep}
    assert set(out) == want
    row = out["s3"]
    assert row.traffic_event_ts == datetime(2026, 4, 26) and row.h3_index.startswith("hx1200_")


def test_air_quality_contract(spark):
    cfg = Settings()
    base = {"lat": 40.7, "lon": -74.0, "pm25": 1.0, "timestamp": "2026-04-25T20:00:00Z"}
    openaq = [
        {**base, "sensor_id": "9", "location_id": 5, "location_name": "n"},
        {**base, "location_id": 5, "location_name": "n"},
        {**base, "location_name": "n", "pm25": 0.0},
        base,
        {"sensor_id": "legacy", "latitude": 40.7, "longitude": -74.0, "value": 2000.0, "datetime_utc": "2026-04-25T20:00:00Z"},
        {**base, "sensor_id": "high", "pm25": 2000.1},
        {**base, "sensor_id": "late", "timestamp": "noon", "datetime_utc": None},
    ]
    purple = [{"name": "p", "latitude": 40.7, "longitude": -74.0, "pm2.5_10minute": 3.0, "temperature": 70, "humidity": 45}]
    rows = refine.refine_air_quality(valid(spark, schemas.OPENAQ, *openaq), valid(spark, schemas.PURPLEAIR, *purple), cfg)
    got = {r.aq_location_id: r for r in rows.collect()}
    assert set(got) == {"9", "5", "n", "legacy", "p"}
    assert got["p"].aq_event_ts == ARRIVED and got["p"].aq_source == "purpleair" and got["p"].aq_humidity == 45.0
    assert got["legacy"].aq_pm25_ugm3 == 2000.0 and got["legacy"].aq_source == "openaq"


def test_weather_defaults(spark):
    good = {"startTime": "2026-04-25T20:00:00Z", "temperature": "61", "windSpeed": "12 mph", "probabilityOfPrecipitation": {"value": "30"}}
    bad = {"startTime": "2026-04-25T20:00:00Z", "temperature": "warm", "windSpeed": "calm"}
    rows = refine.refine_weather(valid(spark, schemas.WEATHER, good, bad, {"name": "no time"})).orderBy("weather_wind_speed_mph").collect()
    assert [tuple(r)[1:] for r in rows] == [
        ("nyc", "Unknown", None, "F", -1, "Unknown", "Unknown", 0),
        ("nyc", "Unknown", 61, "F", 12, "Unknown", "Unknown", 30),
    ]
    keyed = refine.refine_weather(valid(spark, schemas.WEATHER, {**good, "borough": "Staten Island"}), Settings(region_key=True))
    assert keyed.first().weather_join_key == "staten_island"


def test_purpleair_rows_from_arrays(spark):
    fields = ["sensor_index", "name", "latitude", "longitude", "pm2.5_10minute", "temperature", "humidity"]
    data = [["3001", "valid-sensor", "40.72", "-73.98", "5.1", "70", "45"], ["3002", "invalid-sensor", "40.73", "-73.97", None, "71", "44"], ["3003", "short"]]
    polls = spark.createDataFrame([(fields, data, ARRIVED)], "fields array<string>, data array<array<string>>, fetched_at timestamp")
    ok, bad = quality.split_contract(ingest.normalize_purpleair(polls), ["sensor_id", "lat", "lon", "pm25"])
    assert [r.sensor_id for r in ok.collect()] == ["3001"] and bad.count() == 2
    assert ok.first()["pm2.5_10minute"] == 5.1


def test_openaq_locations_and_first_reading(spark):
    sensors = "array<struct<id: bigint, parameter: string>>"
    locations = spark.createDataFrame(
        [(1, "a", "40.71", "-74.0", [(101, '{"name": "pm25"}'), (102, "o3"), (None, "pm25")]), (2, None, None, "-74.0", [(201, "pm25")])],
        f"location_id bigint, location_name string, latitude string, longitude string, sensors {sensors}",
    )
    readings = spark.createDataFrame(
        [(101, [("8.4", "2026-04-25T20:00:00Z", "u"), ("9.9", "2026-04-25T19:00:00Z", "u")]), (201, [("1", "2026-04-25T20:00:00Z", "u")]), (102, [])],
        "sensor_id bigint, results array<struct<value: string, utc: string, units: string>>",
    )
    ok, bad = quality.split_contract(ingest.normalize_openaq(locations, readings), ["lat", "lon", "pm25", "timestamp"])
    assert [(r.sensor_id, r.pm25, r.location_name) for r in ok.collect()] == [("101", 8.4, "a")]
    assert [r.location_name for r in bad.collect()] == ["unknown"]


def test_incremental_takes_every_row_once(spark):
    hours = [0, 1, 1, 1, 2, 3, 3, 4]
    df = spark.createDataFrame([(i, datetime(2026, 5, 3, h)) for i, h in enumerate(hours)] + [(99, None)], "id int, ts timestamp")
    mark, polls = None, []
    for _ in range(10):
        batch, after = ingest.incremental(df, "ts", mark and F.lit(mark).cast("timestamp"), 2)
        polls.append(sorted(r.id for r in batch.collect()))
        mark = after.select(F.date_format("next_mark", "yyyy-MM-dd HH:mm:ss")).first()[0]
        if not polls[-1]:
            break
    # Two rows asked for, and all rows of the last time taken with them.
    assert polls == [[0, 1, 2, 3], [4, 5, 6], [7], []] and mark == "2026-05-03 04:00:00"
    batch, after = ingest.incremental(df, "ts", as_of_literal("2026-05-03 02:30:00"))
    assert sorted(r.id for r in batch.collect()) == [5, 6, 7]
    none, kept = ingest.incremental(df, "ts", as_of_literal("2026-05-03 09:00:00"), 5)
    assert none.count() == 0 and kept.first()[0] == datetime(2026, 5, 3, 9)


def test_odd_polls_do_not_end_the_job(spark):
    polls = spark.createDataFrame(
        [(["a", "a", None, "b"], [["1", "2", "3", "4"], ["5"], None, []])], "fields array<string>, data array<array<string>>"
    )
    rows = [r.record for r in ingest.rows_from_arrays(polls).collect()]
    assert rows[:2] == [{"a": "1", "b": "4"}, {"a": "5"}] and rows[3] == {}
    seen = [("x", 40.0, -74.0, 0, v, v, v, "d") for v in (float("nan"), 1e30, -1e30, float("inf"), None, 12.5)]
    df = spark.createDataFrame(seen, "borough string, source_lat double, source_lon double, dt bigint, temp double, wind_speed double, wind_deg double, description string")
    rows = ingest.normalize_weather(df).collect()
    assert [(r.temperature, r.windSpeed) for r in rows] == [(None, None)] * 5 + [(12, "12 mph")]
    assert [r.windDirection for r in rows] == [None] * 4 + ["N", "NNE"]


def test_text_behind_the_message_is_quarantined(spark):
    good = ['{"id": "1"}', ' {"id": "1"} ', '{"id": "]"}']
    bad = ['{"id": "1"}{"id": "2"}', '{"id": "1"}, {"id": "2"}', '{"id": "1"} x', '{"id": "1"}]', "", None, "[]", "{cut"]
    ok, broken = split_valid(parse_json(topic(spark, *good, *bad), schemas.TRAFFIC))
    assert ok.count() == len(good) and broken.count() == len(bad)


def test_empty_rings_hold_no_point(spark):
    from tidegrid.operators import spatial

    square = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]
    ddl = "zone_id int, rings array<array<struct<lon: double, lat: double>>>"
    zones = spark.createDataFrame([(1, [square, []]), (2, [[]]), (3, []), (4, None), (5, [[(0.5, None)]])], ddl)
    points = spark.createDataFrame([(1, 0.5, 0.5), (2, 5.0, 5.0)], "p int, lon double, lat double")
    found = spatial.points_in_zones(points, zones, "p", "lon", "lat", how="left").collect()
    assert sorted((r.p, r.zone_id) for r in found) == [(1, 1), (2, None)]


def test_rules_report_and_reasons(spark):
    df = spark.createDataFrame([("a", 1.0), (None, 5.0), (None, None)], "id string, v double")
    rules = {"id": F.col("id").isNotNull(), "v": F.col("v").between(0, 2)}
    report = {r.rule: (r.total_rows, r.invalid_rows) for r in quality.dq_report(df, rules).collect()}
    assert report == {"id": (3, 2), "v": (3, 2)}
    clean, rejected = quality.apply_rules(df, rules)
    assert clean.count() == 1 and [r.broken_rules for r in rejected.collect()] == [["id", "v"], ["id", "v"]]
    assert quality.dq_report(clean, rules).agg(F.sum("invalid_rows")).first()[0] == 0
    assert quality.missing_columns(df, ["id", "w"]) == ["w"]
    future = df.limit(1).select(F.lit("2026-01-01 00:10:00").cast("timestamp").alias("e"), F.lit("2026-01-01").cast("timestamp").alias("a"))
    assert future.where(quality.not_in_future("e", "a", 300)).count() == 0


@pytest.mark.parametrize("per_line", [False, True])
def test_layers(spark, tmp_path, per_line):
    from tidegrid.sources import layers

    square = [[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]
    shapes = [
        {"type": "Polygon", "coordinates": [square]}, {"type": "MultiPolygon", "coordinates": [[square], [square, square]]},
        {"type": "LineString", "coordinates": square}, {"type": "MultiLineString", "coordinates": [square, square[:2]]},
    ]
    features = [{"type": "Feature", "properties": {"n": i}, "geometry": g} for i, g in enumerate(shapes)]
    file = tmp_path / "layer.json"
    file.write_text("\n".join(json.dumps(f) for f in features) if per_line else json.dumps({"features": features}, indent=1))
    zones = layers.read_zones(spark, str(file), per_line).collect()
    assert sorted(len(z.rings) for z in zones) == [1, 1, 2] and zones[0].rings[0][1].lon == 1.0
    lines = layers.read_lines(spark, str(file), per_line).collect()
    assert sorted(len(x.path) for x in lines) == [2, 5, 5]


def test_sites_csv(spark, tmp_path):
    from tidegrid.sources import layers

    measure = "Total GHG Emissions (Metric Tons CO2e)"
    (tmp_path / "a.csv").write_text(f"Name,Latitude,Longitude,{measure}\nx,40.7,-74.0,12000.5\ny,,-74,1\nz,40.8,-74.1,Not Available\n")
    rows = layers.read_sites(spark, str(tmp_path / "*.csv"), "Longitude", "Latitude", measure).collect()
    assert sorted((r.site_lat, r.measure) for r in rows if r.measure) == [(40.7, 12000.5)] and len(rows) == 2
