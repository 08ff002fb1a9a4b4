"""Writes side by side, changes on record, and definitions that hold."""

import json

import pytest
from plans import explained, files_read
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidevault import TELEMETRY, ChunkedTable, KpiSpec, Rollup, compress_chunks, drop_chunks, upsert
from tidevault.functions.buckets import gapfill
from tidevault.operators import compact, rollup as rollups
from tidevault.plans.lifecycle import LifecycleConfig, kpi_rejects, lifecycle
from tidevault.schemas import split_valid
from tidevault.sources.generate import telemetry
from tidevault.sources.load import bulk_load


def make(spark, root, days=4, interval="1 day"):
    table = ChunkedTable(spark, root, TELEMETRY, "ts", interval, ["auto_id"]).create()
    table.append(telemetry(spark, "2026-05-01", 24 * days), "initial")
    return table


def hourly(table, root, **more):
    return Rollup(table, root, "1 hour", ["auto_id"], {"velocidad": "vel"}, **more)


@pytest.mark.parametrize("other", ["interval", "columns", "ts"])
def test_another_definition_is_refused(spark, root, other):
    make(spark, root, interval="3 days")
    schema, ts, interval = TELEMETRY, "ts", "3 days"
    if other == "interval":
        interval = "1 day"
    elif other == "columns":
        schema = T.StructType(TELEMETRY.fields[:5])
    else:
        schema = T.StructType([*TELEMETRY.fields, T.StructField("at", T.TimestampType(), False)])
        ts = "at"
    with pytest.raises(ValueError, match="exists with other"):
        ChunkedTable(spark, root, schema, ts, interval).create()
    again = ChunkedTable(spark, root, TELEMETRY, "ts", "3 days", []).create()
    assert again.scan("2026-05-02", "2026-05-03").count() == 240 and again.segment_by == ("auto_id",)


def test_a_rollup_keeps_its_definition(spark, root):
    table = make(spark, f"{root}/t")
    made = hourly(table, f"{root}/r", origin="2026-05-01 00:30").build()
    again = Rollup.open(table, f"{root}/r")
    assert again.view().exceptAll(made.view()).isEmpty() and again.width == made.width
    with pytest.raises(ValueError, match="another definition"):
        Rollup(table, f"{root}/r", "2 hours", ["auto_id"], {"velocidad": "vel"})


def test_appends_during_a_refresh_and_a_replacement_stay(spark, root, monkeypatch):
    table = make(spark, f"{root}/t", days=2)
    rollup = hourly(table, f"{root}/r").build()
    extra = rollup.table.scan("2026-05-01", "2026-05-02").withColumn("auto_id", F.col("auto_id") + 100)
    extra = spark.createDataFrame(extra.collect(), extra.schema)
    swap = ChunkedTable.swap_in

    def late(self, *args, **more):
        self.append(extra, "late")
        swap(self, *args, **more)

    monkeypatch.setattr(ChunkedTable, "swap_in", late)
    rollup.refresh("2026-05-01", "2026-05-03")
    monkeypatch.undo()
    assert rollup.view().count() == 480 + 240
    rollup.table.append(extra, "late")
    assert rollup.view().count() == 480 + 240


def test_other_rows_under_a_label_that_was_taken_in(spark, root):
    table = make(spark, root, days=2)
    table.append(telemetry(spark, "2026-05-01 00:30", 24), "nightly")
    assert table.load_rows("nightly").count() == 240
    compress_chunks(table, table.chunk_ids())
    with pytest.raises(ValueError, match="other rows"):
        table.append(telemetry(spark, "2026-05-01 00:30", 48), "nightly")
    with pytest.raises(ValueError, match="taken in"):
        table.load_rows("nightly")
    assert table.scan().count() == 720 and not table.folder.names("_append-*")


def test_the_policy_follows_changes(spark, root, monkeypatch):
    table = make(spark, f"{root}/t", days=8)
    rollup = hourly(table, f"{root}/r").build()
    spans = []
    refresh = Rollup._refresh

    def told(self, again, rows=None, added=(), *more):
        spans.append([*again, *added])
        refresh(self, again, rows, added, *more)

    monkeypatch.setattr(Rollup, "_refresh", told)
    files = set(rollup.table.read_chunks().inputFiles())
    rollup.refresh_due("2026-05-10")
    assert not spans and set(rollup.table.read_chunks().inputFiles()) == files
    table.append(telemetry(spark, "2026-05-03 05:30", 1, cars=3).withColumn("auto_id", F.col("auto_id") + 50))
    table.append(telemetry(spark, "2026-05-09 23:30", 1))  # of the bucket in progress
    compress_chunks(table, table.chunk_ids()[:6])
    rollup.refresh_due("2026-05-10", end_offset="1 hour")
    hour = 3_600_000_000
    assert [(hi - lo) for s in spans for lo, hi in s] == [hour]
    assert rollup.view("2026-05-03 05:00", "2026-05-03 06:00").count() == 13
    rollup.refresh_due("2026-05-11")
    assert len(spans) == 2 and rollup.view("2026-05-09", "2026-05-10").count() == 10
    fresh = hourly(table, f"{root}/r2").build()
    assert fresh.view().exceptAll(rollup.view()).isEmpty() and rollup.view().exceptAll(fresh.view()).isEmpty()
    rollup.refresh_due("2026-05-11")
    assert len(spans) == 2


def test_a_late_hour_reads_its_instants(spark, root, monkeypatch):
    table = make(spark, f"{root}/t", days=6, interval="3 days")
    rollup = hourly(table, f"{root}/r").build()
    table.append(telemetry(spark, "2026-05-02 07:30", 1), "late")
    plans = []
    aggregate = Rollup.aggregate

    def told(self, rows):
        plans.append((explained(rows), files_read(rows)))
        return aggregate(self, rows)

    monkeypatch.setattr(Rollup, "aggregate", told)
    assert rollup.refresh_changed(table.load_rows("late")) == 1
    plan, files = plans[0]
    assert "GreaterThanOrEqual(ts,2026-05-02" in plan and "LessThan(ts,2026-05-02" in plan
    assert files <= 3 and rollup.view("2026-05-02 07:00", "2026-05-02 08:00").count() == 10


def test_spans_are_joined():
    spans = [(i * 10, i * 10 + 1) for i in range(200)] + [(5, 12)]
    out = rollups._joined(spans)
    assert len(out) == 64 and out == sorted(out)
    assert all(any(a <= lo and hi <= b for a, b in out) for lo, hi in spans)


def test_retention_marks_before_it_deletes(spark, root, monkeypatch):
    table = make(spark, f"{root}/t", days=4)
    rollup = hourly(table, f"{root}/r").build()
    delete = type(table.folder).delete

    def dies(self, name):
        delete(self, name)
        if name.startswith("chunk_id="):
            raise OSError("the driver dies")

    monkeypatch.setattr(type(table.folder), "delete", dies)
    with pytest.raises(OSError, match="dies"):
        drop_chunks(table, "2026-05-03 12:00")
    monkeypatch.undo()
    drop_chunks(table, "2026-05-03 12:00")
    rollup.refresh("2026-05-01", "2026-05-05")
    assert rollup.view().count() == 4 * 240


@pytest.mark.parametrize("dies_at", [0, 1, 2, 3])
def test_a_replacement_is_carried_to_its_end(spark, root, monkeypatch, dies_at):
    table = make(spark, root, days=4)
    each = type(table.folder).each

    def dies(self, job, names):
        for i, name in enumerate(names):
            if i == dies_at:
                raise OSError("the driver dies")
            job(name)

    monkeypatch.setattr(type(table.folder), "each", dies)
    with pytest.raises(OSError, match="dies"):
        table.replace_chunks(table.scan().where("auto_id <= 4"), table.chunk_ids())
    monkeypatch.setattr(type(table.folder), "each", each)
    table.append(telemetry(spark, "2026-05-02", 1), "meanwhile")
    table.recover()
    assert table.scan().count() == 4 * 96 + 10
    assert not table.folder.names("_old-*") and not table.folder.names("_staging-*")


def test_null_keys(spark, root):
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.IntegerType(), False)])
    rows = spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "k int, v int")
    valid, rejects = split_valid(rows, schema, ["k"])
    assert [r.v for r in valid.collect()] == [3] and sorted(r.v for r in rejects.collect()) == [1, 2]
    loose = T.StructType([T.StructField("ts", T.TimestampType(), False), *schema.fields])
    table = ChunkedTable(spark, root, loose, "ts", "1 day").create()
    batch = rows.where("v <> 2").select(F.lit("2026-05-01").cast("timestamp").alias("ts"), "*")
    with pytest.raises(ValueError, match="null in the key"):
        upsert(table, batch, ("ts", "k"))
    for _ in range(2):
        assert upsert(table, batch, ("ts", "k"), null_keys=True) == 2
        assert sorted(r.v for r in table.scan().collect()) == [1, 3]


def test_an_hour_s_upsert_leaves_other_files_alone(spark, root):
    kpi = KpiSpec().create(spark, root, "30 days")

    def hour(at, n):
        plain = spark.createDataFrame([(at, 1, n, 1.0, 1)], "ventana string, auto_id int, lecturas int, vel_max double, rpm_max int")
        return plain.withColumn("ventana", F.col("ventana").cast("timestamp"))

    for h in (3, 4, 5):
        upsert(kpi, hour(f"2026-05-02 0{h}:00:00", 1), ("ventana", "auto_id"))
    files = set(kpi.read_chunks().inputFiles())
    assert len(files) == 3
    upsert(kpi, hour("2026-05-02 04:00:00", 9), ("ventana", "auto_id"))
    assert len(files & set(kpi.read_chunks().inputFiles())) == 2
    assert sorted(r.lecturas for r in kpi.scan().collect()) == [1, 1, 9]


def test_lifecycle_keeps_rejects(spark, root):
    table = make(spark, f"{root}/t", days=2)
    kpi = KpiSpec().create(spark, f"{root}/k")
    assert kpi_rejects(kpi).count() == 0
    table.append_rows([(77, "2026-05-02 23:10:00")], ["auto_id", "ts"])
    for _ in range(2):
        lifecycle(table, hourly(table, f"{root}/r"), kpi, "2026-05-03", LifecycleConfig())
    assert [(r.auto_id, r.lecturas) for r in kpi_rejects(kpi).collect()] == [(77, 1)]
    assert kpi.scan().count() == 10


def test_chunks_far_apart_get_tasks_of_their_own(spark, root, monkeypatch):
    table = ChunkedTable(spark, root, TELEMETRY, "ts", "1 hour", ["auto_id"]).create()
    table.append(telemetry(spark, "2026-05-01", 24, "48 hours"), "x")
    tasks = []
    stage = ChunkedTable.stage

    def told(self, rows, *args):
        tasks.extend(rows.groupBy(F.spark_partition_id()).count().collect())
        return stage(self, rows, *args)

    monkeypatch.setattr(ChunkedTable, "stage", told)
    compress_chunks(table, table.chunk_ids(), verify="counts")
    assert len(table.chunk_ids()) == 24
    assert len(tasks) == 24 and {r["count"] for r in tasks} == {10}


def test_many_chunks_make_several_passes(monkeypatch):
    monkeypatch.setattr(compact, "PASS_CHUNKS", 2)
    assert compact._passes({1: 1, 2: 1, 3: 1}) == [[1, 2], [3]]


def test_values_that_do_not_fit_stop_a_json_load(spark, root):
    table = make(spark, f"{root}/t")
    rows = [json.dumps({"auto_id": 1, "ts": "2026-05-01T00:00:00.000Z", "revoluciones": "abc"})]
    spark.createDataFrame([(r,) for r in rows], "value string").write.text(f"{root}/in")
    with pytest.raises(Exception, match="(?i)malformed"):
        bulk_load(table, f"{root}/in", "json", load="bad")
    assert table.scan().count() == 960


def test_gap_filling_keeps_rows_outside_its_range(spark):
    rows = spark.createDataFrame([("2026-05-01 05:00:00", 1), ("2026-05-03 00:00:00", 2)], "h string, n int")
    rows = rows.withColumn("h", F.col("h").cast("timestamp"))
    out = gapfill(rows, "h", "1 hour", "2026-05-01", "2026-05-02", fill={"n": 0}, outside="keep")
    assert out.count() == 25 and out.agg(F.sum("n")).first()[0] == 3


def test_odd_names_of_folders(spark, root):
    table = make(spark, f"{root}/a b,c{{d}}/chunk_id=3/x")
    assert len(table.chunk_ids()) == 4 and table.scan("2026-05-02", "2026-05-03").count() == 240
    compress_chunks(table, table.chunk_ids())
    assert table.scan().count() == 960
