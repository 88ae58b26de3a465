"""Cell lookup from a topic: the points of all messages against the map layers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.config import Settings
from tidegrid.functions import text
from tidegrid.functions.geo import in_box
from tidegrid.functions.hexgrid import hex_cell
from tidegrid.operators.spatial import cell_flags


def lookup_points(link_points: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """Distinct in-box first points with their cell, from a ``link_points`` column."""
    lat, lon = text.first_point(F.col("link_points"))
    return (
        link_points.select(lat.alias("traffic_lat"), lon.alias("traffic_lon"))
        .where(in_box(F.col("traffic_lat"), F.col("traffic_lon"), cfg.box))
        .distinct()
        .withColumn("h3_index", hex_cell(F.col("traffic_lat"), F.col("traffic_lon"), cfg.hex_edge_m, cfg, checked=True))
    )


def build_lookup(points: DataFrame, zones: DataFrame, lines: DataFrame, sites: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """Write the result as a table: streams then join it and Spark knows its size."""
    return cell_flags(points, zones, lines, sites, "traffic_lon", "traffic_lat", "h3_index", cfg)
