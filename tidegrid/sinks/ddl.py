"""Definition and reset of the business table."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidegrid.schemas import BUSINESS
from tidegrid.sources.tables import PARTITION


def business_ddl(table: str, provider: str = "parquet", location: str | None = None) -> str:
    columns = [f"{f.name} {f.dataType.simpleString().upper()}" for f in BUSINESS.fields]
    if provider == "iceberg":
        partition, properties = "days(traffic_event_ts)", "'write.parquet.compression-codec' = 'snappy'"
    else:
        columns.append(f"{PARTITION} DATE")
        partition, properties = PARTITION, "'parquet.compression' = 'snappy'"
    where = f" LOCATION '{location}'" if location else ""
    return (
        f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(columns)}) USING {provider}"
        f" PARTITIONED BY ({partition}){where} TBLPROPERTIES ({properties})"
    )


def ensure_business_table(
    spark: SparkSession, table: str, provider: str = "parquet", location: str | None = None
) -> None:
    """Creates namespace and table where missing. An existing table is not altered."""
    namespace, _, name = table.rpartition(".")
    if not name:
        raise ValueError("a table name is needed")
    if namespace:
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}")
    spark.sql(business_ddl(table, provider, location))


def reset_table(spark: SparkSession, table: str, really: bool = False) -> None:
    """Drops a table for a full replay; the checkpoint has to be renewed as well."""
    if not really:
        raise ValueError("resetting drops all rows: pass really=True")
    spark.sql(f"DROP TABLE IF EXISTS {table}")
