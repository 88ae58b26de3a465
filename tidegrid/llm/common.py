"""Helpers of this subpackage: tables in the shared folder, free column names, shuffle width."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegrid.session import own_root, work_dir

#: White space that parts words: the six ASCII characters, as ``bytes.split`` takes them.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Folders that ``stored`` wrote, and those of the latest pipeline stage among them, per application.
_scratch: dict[str, list[str]] = {}
_stages: dict[str, list[str]] = {}


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to a new folder of the shared root and read again: cuts the lineage."""
    spark = df.sparkSession
    own_root(spark)
    path = work_dir(spark, name)
    df.write.parquet(path)
    _scratch.setdefault(spark.sparkContext.applicationId, []).append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Removes ``stored`` tables that nothing reads any more."""
    for df in tables:
        spark, path = df.sparkSession, df._stored_at
        remove(spark, path)
        mine = _scratch.get(spark.sparkContext.applicationId, [])
        if path in mine:
            mine.remove(path)


def remove(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def staged(work: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A pipeline stage that first removes what the stage before stored for itself.

    The documents that come in are that stage's stored output, so its
    intermediates have had their time; folders from which they are still read
    (a stage called on rows that nobody has stored) are left alone.
    """

    @wraps(work)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        mine = _scratch.setdefault(spark.sparkContext.applicationId, [])
        before = _stages.pop(spark.sparkContext.applicationId, [])
        read = "\n".join(docs.inputFiles()) if before else ""
        for path in before:
            if f"/{path.rsplit('/', 1)[-1]}/" not in read:
                remove(spark, path)
                if path in mine:
                    mine.remove(path)
        n = len(mine)
        out = work(spark, docs, sf_dir)
        _stages[spark.sparkContext.applicationId] = mine[n:]
        return out

    return run


def carried(columns: list[str]) -> list[Column]:
    """The columns under numbered names, which clash with no name of an operator."""
    return [F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(columns)]


def restored(columns: list[str]) -> list[Column]:
    """The carried columns under their own names."""
    return [F.col(f"_c{i}").alias(c) for i, c in enumerate(columns)]


def n_words(text: Column) -> Column:
    """Number of words; NULL counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def hashed_sample(rows: DataFrame, key: str, sample: int, *ties: str, by: str | None = None) -> DataFrame:
    """The ``sample`` rows with the smallest hashes of their key, the same in each run; with ``by`` as many of each of its values.

    Rows are counted by ranges of the hash first, and only those in the ranges
    that hold the smallest ones are sorted. So what tasks hand on does not grow
    with the number of rows, and repeated keys do not empty the sample.
    """
    span, ranges = 1 << 40, 1 << 12
    place = F.pmod(F.xxhash64(key), F.lit(span))
    part = F.floor(place / (span // ranges)).alias("_range")
    of = [F.col(by).alias("_by")] if by else [F.lit(0).alias("_by")]
    upto = Window.partitionBy("_by").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(*of, part).agg(F.count(F.lit(1)).alias("_n"))
    needed = counts.withColumn("_before", F.coalesce(F.sum("_n").over(upto), F.lit(0))).where(F.col("_before") < sample)
    # One row per value of ``by``.
    last = needed.groupBy("_by").agg(F.max("_range").alias("_last"))
    if by is None:
        bound = last.first()
        rows = rows.where(part <= (bound["_last"] if bound else -1))
        return rows.orderBy(place, key, *ties).limit(sample)
    columns = [F.col(f"`{c}`") for c in rows.columns]
    rows = rows.join(last.select(F.col("_by").alias(by), "_last"), by)  # rows without a value of ``by`` take no part
    order = Window.partitionBy(by).orderBy(place, key, *ties)
    some = rows.where(part <= F.col("_last")).withColumn("_row", F.row_number().over(order)).where(F.col("_row") <= sample)
    return some.select(*columns)


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, hot_keys: int = 2_000) -> DataFrame:
    """``rows`` with the columns of their group; ``groups``: one row per ``key``, with its number of rows in ``size``.

    A key with more than one in ``hot_keys`` of all rows is hot. There cannot be
    more than ``hot_keys`` of them, so their groups are broadcast, and rows of a
    hot key are not brought together. All other rows meet in an equi-join.
    """
    total = rows.count()
    hot = F.col(size) * F.lit(hot_keys) > F.lit(total)
    often, others = groups.where(hot), groups.where(~hot)
    rest = rows.join(F.broadcast(often.select(key)), key, "left_anti").join(others, key)
    return rows.join(F.broadcast(often), key).unionByName(rest)


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls into the held-out fold; a NULL id does not."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))
