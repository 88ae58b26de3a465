"""Cell flags that change over time.

A lookup is valid from a time on. Of each version only the cells are stored
whose flags differ from the version before, and a row gets the flags that were
valid at its own event time, however late it comes out of the joins.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegrid.operators.spatial import FLAGS
from tidegrid.sinks.parts import files, folders

CELL, VALID_FROM, VALID_TO = "h3_lookup_index", "valid_from", "valid_to"
_SCHEMA = f"{CELL} string, {', '.join(f'{f} boolean' for f in FLAGS)}, {VALID_FROM} timestamp"


def _name(valid_from: datetime) -> str:
    return f"version={valid_from:%Y%m%dT%H%M%S}"


def read_versions(spark: SparkSession, path: str) -> DataFrame:
    """All stored versions: cells, flags and ``valid_from``."""
    if not folders(spark, f"{path}/version=*"):
        return spark.createDataFrame([], _SCHEMA)
    return spark.read.schema(_SCHEMA).parquet(path).drop("version")


def with_validity(versions: DataFrame) -> DataFrame:
    """``versions`` with ``valid_to``: where the next one of the cell begins, NULL for the last."""
    following = Window.partitionBy(CELL).orderBy(VALID_FROM)
    return versions.withColumn(VALID_TO, F.lead(VALID_FROM).over(following))


def current(versions: DataFrame) -> DataFrame:
    """The latest flags of each cell."""
    newest = versions.groupBy(CELL).agg(F.max_by(F.struct(*FLAGS), VALID_FROM).alias("_f"))
    return newest.select(CELL, *(F.col(f"_f.{f}").alias(f) for f in FLAGS))


def put_version(spark: SparkSession, path: str, lookup: DataFrame, valid_from: datetime) -> None:
    """Stores what ``lookup`` changes from a time on; versions come in the order of their times.

    Cells that are no longer in the lookup have no flags from then on. Storing
    the same version again replaces it.
    """
    fs, at = files(spark, path)
    target = f"{path}/{_name(valid_from)}"
    before = read_versions(spark, path).where(F.col(VALID_FROM) < F.lit(valid_from))
    later = read_versions(spark, path).where(F.col(VALID_FROM) > F.lit(valid_from))
    if not later.isEmpty():
        raise ValueError(f"a version later than {valid_from} is stored")

    def flags(prefix: str) -> list[Column]:
        return [F.coalesce(F.col(f"{prefix}.{f}"), F.lit(False)) for f in FLAGS]

    joined = lookup.alias("new").join(current(before).alias("old"), CELL, "full")
    differs = F.lit(False)
    for a, b in zip(flags("new"), flags("old"), strict=True):
        differs = differs | (a != b)
    changed = joined.where(differs).select(CELL, *(c.alias(f) for c, f in zip(flags("new"), FLAGS, strict=True)), F.lit(valid_from).alias(VALID_FROM))
    waiting = f"{path}/_staging/{_name(valid_from)}"
    changed.write.mode("overwrite").parquet(waiting)
    fs.delete(at(target), True)
    if not fs.rename(at(waiting), at(target)):
        raise OSError(f"{waiting} cannot be moved to {target}")
    spark.catalog.refreshByPath(path)


def flags_as_of(rows: DataFrame, versions: DataFrame, ts: str = "traffic_event_ts", cell: str = "h3_index") -> DataFrame:
    """``rows`` with the flags of their cell at their time; false where no version says otherwise.

    An equi-join on the cell; a cell has as many versions as its flags changed,
    of which one fits. Spark broadcasts the versions while they are small.
    """
    spans = with_validity(versions).withColumnsRenamed({CELL: "_cell", VALID_FROM: "_from", VALID_TO: "_to", **{f: f"_{f}" for f in FLAGS}})
    fits = (F.col(cell) == F.col("_cell")) & (F.col(ts) >= F.col("_from")) & (F.col("_to").isNull() | (F.col(ts) < F.col("_to")))
    joined = rows.drop(*FLAGS).join(spans, fits, "left")
    return joined.withColumns({f: F.coalesce(F.col(f"_{f}"), F.lit(False)) for f in FLAGS}).drop("_cell", "_from", "_to", *(f"_{f}" for f in FLAGS))


def with_versioned_flags(rows: DataFrame, versions: DataFrame) -> DataFrame:
    """Business rows, in their columns, with the flags of their event time."""
    flagged = flags_as_of(rows, versions).withColumns({"is_congestion_zone": F.col(FLAGS[0]), "is_truck_route": F.col(FLAGS[1])})
    return flagged.select(rows.columns)
