"""Sources read back: layers, sites, topics, files, views and catalog tables, written from the given tables in the source's form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.catalogue import feeds
from tidegrid.catalogue import oracle as o
from tidegrid.catalogue.operators import sensors
from tidegrid.catalogue.oracle import num, rounded, upto
from tidegrid.catalogue.streams import message_files
from tidegrid.config import TOPICS
from tidegrid.functions import stats
from tidegrid.operators import spatial
from tidegrid.session import work_dir
from tidegrid.sources import layers
from tidegrid.sources.tables import read_table, register_views, sql_over_path
from tidegrid.sources.topics import TopicSource, read_topic_batch

QUERIES: dict = {}


def query(sql: str):
    def register(fn):
        QUERIES[fn.__name__] = (fn, sql)
        return fn

    return register


def _geojson(df: DataFrame, kind: str, coordinates, name: str) -> str:
    """One feature per line."""
    pairs = F.struct(F.lit(kind).alias("type"), coordinates.alias("coordinates"))
    feature = F.to_json(F.struct(F.lit("Feature").alias("type"), pairs.alias("geometry")))
    path = work_dir(df.sparkSession, name)
    df.select(feature.alias("value")).write.text(path)
    return path


def _pair(p):
    return F.array(p["lon"], p["lat"])


_CORNERS = ", ".join(
    f"({ring}, {i}, {num(x)}, {num(y)})" for ring, path in enumerate(feeds.ZONE_RINGS) for i, (x, y) in enumerate(path)
)


def _origin(key: str, origin, step) -> tuple[str, ...]:
    return tuple(f"{num(a)} + cast({key} as double) * {num(s)}" for a, s in zip(origin, step, strict=True))


_ZX, _ZY = _origin("r_regionkey", feeds.ZONE_ORIGIN, feeds.ZONE_STEP)
_LX, _LY = _origin("n_nationkey", feeds.ROUTE_ORIGIN, feeds.ROUTE_STEP)
_BENDS = ", ".join(f"({i}, {num(x)}, {num(y)})" for i, (x, y) in enumerate(feeds.ROUTE_PATH))


@query(f"SELECT ring, corner, {rounded(f'{_ZX} + x', 6)} AS lon, {rounded(f'{_ZY} + y', 6)} AS lat FROM region, (VALUES {_CORNERS}) AS c(ring, corner, x, y)")
def source_zones(spark, sf):
    """Polygons with a hole, written as GeoJSON and read as zones."""
    rings = F.transform("rings", lambda r: F.transform(r, _pair))
    path = _geojson(feeds.zones(spark, sf), "Polygon", rings, "zones-geojson")
    read = layers.read_zones(spark, path, per_line=True).select(F.posexplode("rings").alias("ring", "_r"))
    corners = read.select("ring", F.posexplode("_r").alias("corner", "p"))
    return corners.select("ring", "corner", stats.rounded(F.col("p.lon"), 6).alias("lon"), stats.rounded(F.col("p.lat"), 6).alias("lat"))


@query(f"SELECT bend, {rounded(f'{_LX} + x', 6)} AS lon, {rounded(f'{_LY} + y', 6)} AS lat FROM nation, (VALUES {_BENDS}) AS c(bend, x, y)")
def source_lines(spark, sf):
    path = _geojson(feeds.lines(spark, sf), "LineString", F.transform("path", _pair), "lines-geojson")
    bends = layers.read_lines(spark, path, per_line=True).select(F.posexplode("path").alias("bend", "p"))
    return bends.select("bend", stats.rounded(F.col("p.lon"), 6).alias("lon"), stats.rounded(F.col("p.lat"), 6).alias("lat"))


@query(upto("layers", f"SELECT {rounded('site_lon', 6)} AS site_lon, {rounded('site_lat', 6)} AS site_lat, measure FROM sites"))
def source_sites(spark, sf):
    """Sites as CSV files with a header; those without a position are left out."""
    path = work_dir(spark, "sites-csv")
    named = feeds.sites(spark, sf).select(F.col("site_lon").alias("Longitude"), F.col("site_lat").alias("Latitude"), F.col("measure").alias("Total (t)"))
    nowhere = named.limit(1).withColumn("Longitude", F.lit(None).cast("double"))
    named.unionByName(nowhere).write.option("header", "true").csv(path)
    sites = layers.read_sites(spark, path, "Longitude", "Latitude", "Total (t)")
    return sites.select(stats.rounded(F.col("site_lon"), 6).alias("site_lon"), stats.rounded(F.col("site_lat"), 6).alias("site_lat"), "measure")


@query(
    """SELECT CASE event_type WHEN 'view' THEN 'nyc_traffic_raw' WHEN 'click' THEN 'nyc_openaq_raw'
      WHEN 'error' THEN 'nyc_purpleair_raw' ELSE 'nyc_weather_raw' END AS topic, ts + INTERVAL 20 SECOND AS arrived,
      event_id % 10 = 0 AS is_cut FROM events WHERE event_type IN ('view', 'click', 'error', 'signup')"""
)
def source_topics(spark, sf):
    """All messages of the four topics, read once from the earliest to the latest."""
    source = TopicSource(message_files(spark, sf))
    parts = [read_topic_batch(spark, topic, source) for topic in TOPICS.values()]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    real = rows.where(~F.col("value").contains("sentinel"))
    return real.select("topic", F.col("timestamp").alias("arrived"), F.col("value").endswith('"cut": "').alias("is_cut"))


@query("SELECT event_type, count(*) AS n, max(value) AS largest FROM events GROUP BY 1")
def source_sql_over_files(spark, sf):
    return spark.sql(f"SELECT event_type, count(*) AS n, max(value) AS largest FROM {sql_over_path(f'{sf}/events.parquet')} GROUP BY 1")


@query("SELECT r_name, count(*) AS nations FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1")
def source_views(spark, sf):
    register_views(spark, sf, ["region", "nation"])
    return spark.sql("SELECT r_name, count(*) AS nations FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1")


def _catalog_table(spark: SparkSession, df: DataFrame) -> str:
    path = work_dir(spark, "catalog")
    name = f"default.t_{path.rsplit('-', 1)[1]}"
    df.write.option("path", path).saveAsTable(name)
    return name


@query("SELECT s_nationkey, count(*) AS suppliers FROM supplier GROUP BY 1")
def source_catalog_table(spark, sf):
    name = _catalog_table(spark, feeds.table(spark, sf, "supplier"))
    return read_table(spark, name).groupBy("s_nationkey").agg(F.count("*").alias("suppliers"))


_METRES, _COS = 400.0, 0.7581343362

_SCALED = f"m AS (SELECT DISTINCT user_id, lon * {num(_COS)} AS lon, lat FROM ev)"
_SEGMENTS_M = f"segments_m AS (SELECT line_id, x1 * {num(_COS)} AS x1, y1, x2 * {num(_COS)} AS x2, y2 FROM segments)"
_SITES_M = f"sites_m AS (SELECT site_id, site_lon * {num(_COS)} AS site_lon, site_lat, measure FROM sites)"
_DEGREE_M = 6371000.0 * 3.141592653589793 / 180.0
_HITS_L = o.line_hits("m", "user_id", _METRES / _DEGREE_M).replace(", segments)", ", segments_m)")
_HITS_S = o.site_hits("m", "user_id", _METRES / _DEGREE_M).replace(", sites", ", sites_m")


def _spots(spark, sf):
    return sensors(spark, sf).select("user_id", "lat", "lon")


@query(upto("ev", f"SELECT m.user_id, line_id, {rounded(f'd * {num(_DEGREE_M)}', 4)} AS line_metres FROM m LEFT JOIN ({_HITS_L}) h ON h.user_id = m.user_id", o.LAYERS, _SCALED, _SEGMENTS_M))
def near_lines_metres(spark, sf):
    found = spatial.near_lines_metres(_spots(spark, sf), feeds.lines(spark, sf), "user_id", "lon", "lat", _METRES, _COS, how="left")
    return found.select("user_id", "line_id", stats.rounded(F.col("line_metres"), 4).alias("line_metres"))


@query(upto("ev", f"SELECT m.user_id, site_id, {rounded(f'd * {num(_DEGREE_M)}', 4)} AS site_metres FROM m LEFT JOIN ({_HITS_S}) h ON h.user_id = m.user_id", o.LAYERS, _SCALED, _SITES_M))
def near_points_metres(spark, sf):
    found = spatial.near_sites_metres(_spots(spark, sf), feeds.sites(spark, sf), "user_id", "lon", "lat", _METRES, _COS, how="left")
    return found.select("user_id", "site_id", stats.rounded(F.col("site_metres"), 4).alias("site_metres"))


__all__ = ["QUERIES"]
