from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidegrid.functions.times import as_of_literal
from tidegrid.session import own_root, work_dir
from tidegrid.sinks.streams import ONCE, with_event_date, write_daily, write_stream_parquet
from tidegrid.sources.tables import between, register_views, sql_over_path
from tidegrid.streaming.replay import finish
from tidegrid.upkeep import tables as upkeep


@pytest.fixture()
def table(spark, tmp_path):
    rows = [(i, datetime(2026, 5, 1) + timedelta(hours=i)) for i in range(100)]
    df = spark.createDataFrame(rows, "id int, traffic_event_ts timestamp").withColumn("event_date", F.to_date("traffic_event_ts"))
    path = str(tmp_path / "table")
    df.repartition(6).write.partitionBy("event_date").parquet(path)
    return path


def test_compaction_keeps_rows_and_reduces_files(spark, table):
    before = {tuple(r) for r in spark.read.parquet(table).collect()}
    done = upkeep.compact(spark, table)
    assert done.rows_before == done.rows_after == 100
    assert done.partitions == 5 and done.files_after == 5 < done.files_before
    assert {tuple(r) for r in spark.read.parquet(table).collect()} == before
    assert upkeep.compact(spark, table).partitions == 0


def test_stats(spark, table):
    stats = upkeep.table_stats(spark.read.parquet(table)).collect()
    assert len(stats) == 5 and sum(r.rows for r in stats) == 100 and all(r.bytes > 0 for r in stats)


def test_retention_drops_whole_days_only_when_asked(spark, table):
    assert upkeep.drop_days_before(spark, table, "2026-05-03") == ["2026-05-01", "2026-05-02"]
    assert spark.read.parquet(table).count() == 100
    upkeep.drop_days_before(spark, table, "2026-05-03", really=True)
    assert spark.read.parquet(table).agg(F.min("event_date").cast("string")).first()[0] == "2026-05-03"


def test_time_range_prunes_days(spark, table):
    df = between(spark.read.parquet(table), "traffic_event_ts", as_of_literal("2026-05-02 10:00:00"), as_of_literal("2026-05-03 01:00:00"))
    assert df.count() == 16
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "GreaterThanOrEqual(traffic_event_ts" in plan


def test_sql_over_files_and_views(spark, table):
    assert spark.sql(f"SELECT count(*) FROM {sql_over_path(table)}").first()[0] == 100
    register_views(spark, "/root/testdata/sf0.001", ["region", "nation"])
    assert spark.sql("SELECT count(*) FROM nation JOIN region ON n_regionkey = r_regionkey").first()[0] == 25


def test_iceberg_calls(spark):
    calls = upkeep.iceberg_upkeep("local", "db.t", "2026-05-01 00:00:00")
    assert len(calls) == 3 and "134217728" in calls[0]
    assert upkeep.has_iceberg(spark) is False


def test_file_sinks_are_refused_untouched(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [(i, datetime(2026, 5, 1 + i % 3)) for i in range(30)]
    spark.createDataFrame(rows, "id int, traffic_event_ts timestamp").repartition(4).write.parquet(source)
    stream = with_event_date(spark.readStream.schema("id int, traffic_event_ts timestamp").parquet(source))
    finish(write_stream_parquet(stream, out, str(tmp_path / "c"), trigger=ONCE, partition_by=("event_date",)))
    for job in (lambda: upkeep.compact(spark, out), lambda: upkeep.drop_days_before(spark, out, "2026-05-02", really=True)):
        with pytest.raises(upkeep.FileLogFound):
            job()
    assert spark.read.parquet(out).count() == 30


def test_streamed_table_goes_on_after_upkeep(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")

    def add(ids):
        rows = [(i, datetime(2026, 5, 1) + timedelta(hours=i)) for i in ids]
        spark.createDataFrame(rows, "id int, traffic_event_ts timestamp").coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = spark.readStream.schema("id int, traffic_event_ts timestamp").option("maxFilesPerTrigger", 1).parquet(source)
        finish(write_daily(stream, out, str(tmp_path / "c"), ONCE, "traffic_event_ts"))

    for part in (range(0, 60, 3), range(1, 60, 3), range(2, 60, 3)):
        add(part)
    run()
    newest = spark.read.parquet(out).where("batch_id like '%-000000000002'").count()
    done = upkeep.compact(spark, out)
    assert done.files_after < done.files_before and done.rows_after == 60
    assert spark.read.parquet(out).where("batch_id like '%-000000000002'").count() == newest > 0
    assert not list(tmp_path.glob("out.upkeep-*"))
    add(range(60, 80))
    run()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(80))
    assert upkeep.drop_days_before(spark, out, "2026-05-02", really=True) == ["2026-05-01"]
    add(range(80, 90))
    run()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(24, 90))


def daily(spark, source, out, checkpoint):
    stream = spark.readStream.schema("id int, traffic_event_ts timestamp").parquet(source)
    finish(write_daily(stream, out, checkpoint, ONCE, "traffic_event_ts"))


def test_a_new_version_replaces_nothing(spark, tmp_path):
    """Both versions number their batches from 0; the second one's land beside the first one's, also after compaction."""
    out, day = str(tmp_path / "out"), datetime(2026, 5, 1, 12)
    for version, ids in enumerate((range(100), range(100, 130), range(130, 150))):
        source = str(tmp_path / f"in{version}")
        spark.createDataFrame([(i, day) for i in ids], "id int, traffic_event_ts timestamp").write.parquet(source)
        daily(spark, source, out, str(tmp_path / f"ckpt_v{version}"))
        if version == 1:
            upkeep.compact(spark, out)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(150))
    assert upkeep.compact(spark, out).rows_after == 150  # the newest batch of each run stays as it is
    assert len({r[0] for r in spark.read.parquet(out).select("batch_id").distinct().collect()}) == 3


def test_parts_do_not_change_when_a_batch_is_repeated(spark, tmp_path):
    source, out, ckpt = str(tmp_path / "in"), str(tmp_path / "out"), tmp_path / "c"
    rows = [(i, datetime(2026, 5, 1 + i % 2)) for i in range(10)]
    spark.createDataFrame(rows, "id int, traffic_event_ts timestamp").write.parquet(source)
    daily(spark, source, out, str(ckpt))
    files = {str(f.relative_to(out)) for f in (tmp_path / "out").rglob("*.parquet")}
    # As after a failure before the commit, with one of the two parts moved in.
    for f in (ckpt / "commits").glob("*0*"):
        f.unlink()
    lost = next(iter((tmp_path / "out").glob("event_date=2026-05-02/batch_id=*")))
    for f in lost.iterdir():
        f.unlink()
    lost.rmdir()
    daily(spark, source, out, str(ckpt))
    again = {str(f.relative_to(out)) for f in (tmp_path / "out").rglob("*.parquet")}
    assert {f for f in files if "05-01" in f} == {f for f in again if "05-01" in f} and len(again) == len(files)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(10))


@pytest.mark.parametrize("stop", [0, 1, 2, 3, 4])
def test_a_swap_that_was_cut_off_is_brought_to_its_end(spark, table, monkeypatch, stop):
    """The renames of a compaction fail from the n-th on; afterwards nothing is lost or left behind."""
    before = {tuple(r) for r in spark.read.parquet(table).collect()}
    real, calls = upkeep.files, [0]

    class Failing:
        def __init__(self, fs):
            self._fs = fs

        def __getattr__(self, name):
            return getattr(self._fs, name)

        def rename(self, a, b):
            if str(a).endswith("days.json"):
                return self._fs.rename(a, b)
            calls[0] += 1
            if calls[0] > stop:
                raise OSError("cut off")
            return self._fs.rename(a, b)

    monkeypatch.setattr(upkeep, "files", lambda s, p: (Failing(real(s, p)[0]), real(s, p)[1]))
    with pytest.raises(OSError, match="cut off"):
        upkeep.compact(spark, table)
    monkeypatch.setattr(upkeep, "files", real)
    assert len(upkeep.resume(spark, table)) == 5
    spark.catalog.refreshByPath(table)
    assert {tuple(r) for r in spark.read.parquet(table).collect()} == before
    assert upkeep.compact(spark, table).partitions == 0 and upkeep.resume(spark, table) == []


def test_what_was_staged_without_a_marker_is_removed(spark, table, tmp_path):
    (tmp_path / "table.upkeep-1" / "new" / "event_date=2026-05-01").mkdir(parents=True)
    assert upkeep.resume(spark, table) == [] and not list(tmp_path.glob("table.upkeep-*"))
    assert spark.read.parquet(table).count() == 100


def test_a_day_with_too_few_staged_rows_is_not_swapped(spark, table):
    rows = spark.read.parquet(table).where("id > 3")
    with pytest.raises(upkeep.RowCountChanged):
        upkeep.swap_days(spark, table, rows.where("event_date = date'2026-05-01'"), ["2026-05-01"], ["event_date"], {"2026-05-01": 24})
    assert spark.read.parquet(table).count() == 100


def test_work_needs_a_shared_folder():
    class Conf:
        def get(self, _name, default):
            return default

    class Session:
        conf = Conf()
        sparkContext = type("C", (), {"getCheckpointDir": staticmethod(lambda: None)})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_dir(Session(), "x")


def test_a_cluster_with_a_local_warehouse_is_refused(spark, monkeypatch):
    """Where no shared folder is named, the warehouse serves on one machine only."""
    named = []

    class Context:
        master, _jvm, _jsc = "spark://host:7077", spark.sparkContext._jvm, spark.sparkContext._jsc
        getCheckpointDir = staticmethod(lambda: None)
        setCheckpointDir = staticmethod(named.append)

    class Conf:
        def get(self, name, *default):
            return default[0] if default else "file:/tmp/warehouse"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="local folder"):
        own_root(Session())
    Context.master = "local[4]"
    own_root(Session())
    assert named == ["file:/tmp/warehouse/_work"]
