"""Static map layers: zones, lines and sites.

A GeoJSON document is one record and is read by one task; for layers of many
features store one feature per line and pass ``per_line=True``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_GEOMETRY = "struct<type: string, coordinates: string>"
_PAIRS = "array<array<double>>"


def _features(spark: SparkSession, path: str, per_line: bool) -> DataFrame:
    if per_line:
        return spark.read.schema(f"geometry {_GEOMETRY}").json(path).select("geometry.*")
    schema = f"features array<struct<geometry: {_GEOMETRY}>>"
    doc = spark.read.option("multiline", "true").schema(schema).json(path)
    return doc.select(F.explode("features").alias("f")).select("f.geometry.*")


def _points(pairs: Column) -> Column:
    return F.transform(pairs, lambda p: F.struct(F.get(p, F.lit(0)).alias("lon"), F.get(p, F.lit(1)).alias("lat")))


def _one_or_many(single: str, many: str, ddl: str) -> Column:
    """Coordinates of a simple geometry as a list of one, of a multi geometry as they are."""
    coords = F.col("coordinates")
    return F.when(F.col("type") == single, F.array(F.from_json(coords, ddl))).when(
        F.col("type") == many, F.from_json(coords, f"array<{ddl}>")
    )


def _shape_id(c: Column) -> Column:
    # From the geometry itself, so it is the same on every read.
    return F.sha2(F.to_json(F.struct(c)), 256)


def read_zones(spark: SparkSession, path: str, per_line: bool = False) -> DataFrame:
    """``zone_id, rings``; one row per polygon."""
    polygons = F.explode(_one_or_many("Polygon", "MultiPolygon", f"array<{_PAIRS}>"))
    rings = F.transform("poly", _points)
    return _features(spark, path, per_line).select(polygons.alias("poly")).select(
        _shape_id(F.col("poly")).alias("zone_id"), rings.alias("rings")
    )


def read_lines(spark: SparkSession, path: str, per_line: bool = False) -> DataFrame:
    """``line_id, path``; one row per polyline. A folder of Parquet files has these columns already."""
    if path.endswith(".parquet"):
        return spark.read.parquet(path).select("line_id", "path")
    paths = F.explode(_one_or_many("LineString", "MultiLineString", _PAIRS))
    return _features(spark, path, per_line).select(paths.alias("line")).select(
        _shape_id(F.col("line")).alias("line_id"), _points(F.col("line")).alias("path")
    )


def read_sites(spark: SparkSession, path: str, lon: str, lat: str, measure: str) -> DataFrame:
    """``site_id, site_lon, site_lat, measure`` from headered CSV files; rows without a point are dropped."""
    table = spark.read.option("header", "true").csv(path)
    cols = {n: F.col(f"`{c}`").try_cast("double") for n, c in (("site_lon", lon), ("site_lat", lat), ("measure", measure))}
    ident = F.sha2(F.to_json(F.struct("*")), 256)
    return table.select(ident.alias("site_id"), *(c.alias(n) for n, c in cols.items())).where(
        F.col("site_lon").isNotNull() & F.col("site_lat").isNotNull()
    )
