"""Exact nearest neighbour over all points, without comparing all pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegrid.functions.geo import planar_distance

_SPAN = 512.0  # degrees; the level-0 cell holds the whole globe
_FACTOR = 4
_LEVELS = 16  # finest cell is about 5e-7 degrees wide


def _cell(v: Column, level: Column) -> Column:
    # Shifted, so that the two signs do not fall into different level-0 cells.
    return F.floor((v + F.lit(_SPAN / 2)) / (F.lit(_SPAN) / F.pow(F.lit(float(_FACTOR)), level)))


def nearest_point(points: DataFrame, point_id: str, lon: str, lat: str) -> DataFrame:
    """``point_id, nearest_id, nearest_degrees`` by planar distance, self excluded.

    Ties go to the smallest id; a single point has no neighbour (NULL). Ids are
    unique. Several points may share a position: they are each other's nearest.
    The points are read several times, so pass a stored table.

    Positions are looked at in ever finer square cells. On the finest level
    where a position still shares its cell with another one, the neighbour is at
    most one cell diagonal away, so the 5 x 5 cells around hold it. A cell has
    few such positions (its finer cells hold one each), hence the candidates
    grow linearly with the data even if one cell holds most of the points.
    """
    pts = points.select(F.col(point_id).alias("_id"), F.col(lon).alias("_x"), F.col(lat).alias("_y")).where(
        F.col("_x").isNotNull() & F.col("_y").isNotNull()
    )
    # Two smallest ids per position; the rank limit is applied before the shuffle.
    by_spot = Window.partitionBy("_x", "_y").orderBy("_id")
    spots = (
        pts.withColumn("_n", F.row_number().over(by_spot))
        .where(F.col("_n") <= 2)
        .groupBy("_x", "_y")
        .agg(F.min("_id").alias("_first"), F.max("_id").alias("_second"))
    )
    alone = spots.where(F.col("_first") == F.col("_second")).select("_x", "_y", F.col("_first").alias("_id"))
    shared = spots.where(F.col("_first") != F.col("_second"))

    at_same_spot = pts.join(shared, ["_x", "_y"]).select(
        "_id",
        F.when(F.col("_id") == F.col("_first"), F.col("_second")).otherwise(F.col("_first")).alias("_near"),
        F.lit(0.0).alias("_d"),
    )

    found = _nearest_other(alone, spots.select("_x", "_y", F.col("_first").alias("_near")))
    apart = alone.join(found, ["_x", "_y"], "left").select("_id", "_near", "_d")
    return at_same_spot.unionByName(apart).select(
        F.col("_id").alias(point_id), F.col("_near").alias("nearest_id"), F.col("_d").alias("nearest_degrees")
    )


def _nearest_other(probes: DataFrame, spots: DataFrame) -> DataFrame:
    levels = F.explode(F.sequence(F.lit(0), F.lit(_LEVELS - 1)))
    on_level = (
        spots.withColumn("_l", levels)
        .withColumns({"_cx": _cell(F.col("_x"), F.col("_l")), "_cy": _cell(F.col("_y"), F.col("_l"))})
    )
    cell = ["_l", "_cx", "_cy"]
    lonely = (
        on_level.groupBy(*cell)
        .agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct("_x", "_y")).alias("_p"))
        .where(F.col("_n") == 1)
        .groupBy(F.col("_p._x").alias("_x"), F.col("_p._y").alias("_y"))
        .agg(F.min("_l").alias("_from"))
    )
    level = F.coalesce(F.col("_from"), F.lit(_LEVELS)) - 1
    around = F.array(*(F.lit(i) for i in range(-2, 3)))
    box = F.flatten(
        F.transform(around, lambda i: F.transform(around, lambda j: F.struct(i.alias("i"), j.alias("j"))))
    )
    wanted = (
        probes.select("_x", "_y")
        .join(lonely, ["_x", "_y"], "left")
        .withColumn("_l", level)
        .where(F.col("_l") >= 0)
        .withColumn("_o", F.explode(box))
        .select(
            F.col("_x").alias("_px"),
            F.col("_y").alias("_py"),
            "_l",
            (_cell(F.col("_x"), F.col("_l")) + F.col("_o.i")).alias("_cx"),
            (_cell(F.col("_y"), F.col("_l")) + F.col("_o.j")).alias("_cy"),
        )
    )
    distance = planar_distance(F.col("_px"), F.col("_py"), F.col("_x"), F.col("_y"))
    return (
        wanted.join(on_level, cell)
        .where((F.col("_x") != F.col("_px")) | (F.col("_y") != F.col("_py")))
        .select("_px", "_py", F.struct(distance.alias("d"), F.col("_near").alias("id")).alias("_b"))
        .groupBy("_px", "_py")
        .agg(F.min("_b").alias("_b"))
        .select(F.col("_px").alias("_x"), F.col("_py").alias("_y"), F.col("_b.id").alias("_near"), F.col("_b.d").alias("_d"))
    )
