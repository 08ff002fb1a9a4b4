import datetime as dt

import pytest
from plans import files_read
from pyspark.sql import functions as F

from tidevault import KPI, TELEMETRY, ChunkedTable, KpiSpec, run_kpi, upsert
from tidevault.operators.kpi import kpi_read
from tidevault.sources.generate import telemetry

KEY = ("ventana", "auto_id")


def kpi_table(spark, root, interval="1 day"):
    return KpiSpec().create(spark, root, interval)


def batch(spark, *rows):
    plain = spark.createDataFrame(rows, "ventana string, auto_id int, lecturas int, vel_max double, rpm_max int")
    return plain.withColumn("ventana", F.col("ventana").cast("timestamp"))


def state(table):
    return [(r.ventana.day, r.auto_id, r.lecturas) for r in kpi_read(table).collect()]


def test_insert_update_and_leave(spark, root):
    table = kpi_table(spark, root)
    first = batch(
        spark, ("2026-05-01 10:00:00", 1, 1, 1.0, 1), ("2026-05-01 10:00:00", 2, 1, 1.0, 1),
        ("2026-05-02 10:00:00", 1, 1, 1.0, 1),
    )
    assert upsert(table, first, KEY) == 3
    again = batch(spark, ("2026-05-01 10:00:00", 2, 9, 9.0, 9), ("2026-05-03 10:00:00", 5, 2, 1.0, 1))
    for _ in range(2):
        assert upsert(table, again, KEY) == 2
        assert state(table) == [(1, 1, 1), (1, 2, 9), (2, 1, 1), (3, 5, 2)]
    assert upsert(table, again.where("false"), KEY) == 0
    assert not table.folder.names("_batch-*")


def test_only_touched_chunks_are_rewritten(spark, root):
    table = kpi_table(spark, root)
    upsert(table, batch(spark, *[(f"2026-05-0{d} 10:00:00", 1, 1, 1.0, 1) for d in (1, 2, 3)]), KEY)
    untouched = set(table.scan("2026-05-02", "2026-05-04").inputFiles())
    upsert(table, batch(spark, ("2026-05-01 10:00:00", 1, 2, 1.0, 1)), KEY)
    assert set(table.scan("2026-05-02", "2026-05-04").inputFiles()) == untouched
    assert files_read(table.scan("2026-05-01", "2026-05-02")) == 1


def test_a_key_twice_in_a_batch(spark, root):
    table = kpi_table(spark, root)
    twice = batch(spark, ("2026-05-01 10:00:00", 1, 1, 1.0, 1), ("2026-05-01 10:00:00", 1, 2, 1.0, 1))
    with pytest.raises(ValueError, match="more than once"):
        upsert(table, twice, KEY)
    assert state(table) == []
    versioned = twice.withColumn("seq", -F.col("lecturas"))
    upsert(table, versioned, KEY, version="seq")
    assert state(table) == [(1, 1, 1)]


def test_nulls_and_keys_without_the_instant(spark, root):
    table = kpi_table(spark, root)
    bad = batch(spark, ("2026-05-01 10:00:00", 1, 1, 1.0, None))
    with pytest.raises(Exception, match="rpm_max, declared NOT NULL"):
        upsert(table, bad, KEY)
    with pytest.raises(ValueError, match="ventana"):
        upsert(table, bad, ["auto_id"])


def test_kpi_of_readings_without_engine_speed_is_rejected(spark, root):
    readings = ChunkedTable(spark, f"{root}/t", TELEMETRY, "ts", "1 day", ["auto_id"]).create()
    readings.append(telemetry(spark, "2026-05-01", 24))
    readings.append_rows([(77, "2026-05-01 10:30:00", "88.0")], ["auto_id", "ts", "velocidad"])
    kpi = kpi_table(spark, f"{root}/k")
    rejects = run_kpi(readings, kpi, "2026-05-01 11:59:59")
    assert [(r.auto_id, r.rpm_max) for r in rejects.collect()] == [(77, None)]
    rows = kpi_read(kpi).collect()
    assert [r.auto_id for r in rows] == list(range(1, 11))
    assert {r.ventana for r in rows} == {dt.datetime(2026, 5, 1, 10)}
    assert kpi.scan().schema.names == KPI.names
    # An hour without readings adds nothing.
    run_kpi(readings, kpi, "2026-06-01 11:59:59")
    assert kpi.scan().count() == 10


def test_many_copies_of_a_key_collapse(spark, root):
    table = kpi_table(spark, root)
    one = batch(spark, ("2026-05-01 10:00:00", 1, 1, 1.0, 1))
    copies = one.crossJoin(spark.range(50_000)).withColumn("lecturas", F.col("id").cast("int"))
    upsert(table, copies.withColumnRenamed("id", "seq"), KEY, version="seq")
    assert state(table) == [(1, 1, 49_999)]
