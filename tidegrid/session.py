"""Session settings and the shared work folder."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

# State on local disk, and only its changes written to the checkpoint per batch.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app: str = "tidegrid", master: str | None = None, **conf: str) -> SparkSession:
    """Session for batch and streaming: UTC, AQE with skew joins, RocksDB state.

    Shuffle width is left to the cluster; for a streaming query it is frozen in
    the checkpoint, so set it before the first start.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.parquet.compression.codec": "snappy",
        "spark.sql.streaming.statefulOperator.allowMultiple": "true",
        **STATE_CONF,
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Event times are UTC instants, so text and timestamps must meet in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_root(spark: SparkSession) -> str | None:
    """The folder that the cluster names for intermediate data, or None."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def own_root(spark: SparkSession) -> None:
    """Names a folder in the warehouse for intermediate data where the session names none.

    Raises on a cluster whose warehouse is on the local disk: each machine would see its own files only.
    """
    if shared_root(spark):
        return
    root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    local = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getUri().getScheme() == "file"
    if local and not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share; the warehouse is a local folder")
    spark.sparkContext.setCheckpointDir(root)


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all executors must share.

    Raises where the session names none: a machine-local folder would lose
    rows on a cluster.
    """
    root = shared_root(spark)
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def without_zone(df: DataFrame) -> DataFrame:
    """Instants as plain UTC wall-clock times, for exchange with zone-less systems."""
    return df.select(
        *(
            F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, TimestampType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        )
    )
