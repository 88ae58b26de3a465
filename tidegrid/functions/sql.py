"""Grid and distance functions for SQL users, as SQL expressions without Python workers."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidegrid.config import Settings
from tidegrid.functions.hexgrid import EARTH_M

HAVERSINE = """
CREATE OR REPLACE TEMPORARY FUNCTION haversine_m(lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE)
RETURNS DOUBLE
RETURN 12742000D * asin(sqrt(least(1D,
  pow(sin(radians(lat2 - lat1) / 2), 2)
  + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2))))
"""


# The rest of a coordinate behind its rounding, and the cell's two coordinates from the exact ones.
_REST = """
CREATE OR REPLACE TEMPORARY FUNCTION hex_rest(v DOUBLE) RETURNS DOUBLE RETURN v - floor(v + 0.5D)
"""
_STEP = """
CREATE OR REPLACE TEMPORARY FUNCTION hex_step(v DOUBLE, other DOUBLE, first BOOLEAN) RETURNS BIGINT
RETURN cast(floor(v + 0.5D) + IF(
  IF(first, abs(hex_rest(v)) >= abs(hex_rest(other)), abs(hex_rest(v)) > abs(hex_rest(other))),
  floor(hex_rest(v) + 0.5D * hex_rest(other) + 0.5D), 0) AS BIGINT)
"""
_CELL = """
CREATE OR REPLACE TEMPORARY FUNCTION hex_of(x DOUBLE, y DOUBLE, edge INT) RETURNS STRING
RETURN concat_ws('_', concat('hx', cast(edge AS STRING)),
  cast(hex_step((sqrt(3D) / 3D * x - y / 3D) / edge, (2D * y / 3D) / edge, true) AS STRING),
  cast(hex_step((2D * y / 3D) / edge, (sqrt(3D) / 3D * x - y / 3D) / edge, false) AS STRING))
"""
_HEX = """
CREATE OR REPLACE TEMPORARY FUNCTION hex_cell(lat DOUBLE, lon DOUBLE, edge INT) RETURNS STRING
RETURN CASE WHEN lat BETWEEN -90D AND 90D AND lon BETWEEN -180D AND 180D THEN hex_of(
  {radius}D * radians(lon - ({lon}D)) * cos(radians({lat}D)), {radius}D * radians(lat - ({lat}D)), edge) END
"""


def register_functions(spark: SparkSession, cfg: Settings = Settings()) -> None:
    """``haversine_m(lat1, lon1, lat2, lon2)`` and ``hex_cell(lat, lon, edge_m)``."""
    for definition in (HAVERSINE, _REST, _STEP, _CELL):
        spark.sql(definition)
    spark.sql(_HEX.format(radius=EARTH_M, lat=cfg.origin_lat, lon=cfg.origin_lon))
