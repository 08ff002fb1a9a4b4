"""The lab's own queries on its own grids, with counts that follow from the grids."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidevault import TELEMETRY, ChunkedTable, KpiSpec, Rollup, compress_chunks, kpi_hour, run_kpi
from tidevault.functions.buckets import bucket_equals, date_floor, downsample
from tidevault.operators.compact import chunk_starting, oldest_chunks
from tidevault.operators.kpi import kpi_read
from tidevault.operators.reports import table_counts
from tidevault.operators.retention import drop_chunks
from tidevault.schemas import comments
from tidevault.session import work_dir
from tidevault.sources.generate import telemetry
from tidevault.sources.load import insert_each

# Sensors of the five readings that are inserted into compacted chunks.
FIVE = [
    ("2.45", 42, 68, "95.2", "31.4", "3.1", "83.5", 2200, "12.5", 320),
    ("2.44", 41, 68, "95.0", "31.3", "3.1", "84.0", 2250, "13.1", 320),
    ("2.46", 41, 67, "95.3", "31.5", "3.2", "83.9", 2300, "13.8", 318),
    ("2.45", 40, 67, "95.1", "31.4", "3.1", "84.5", 2350, "14.2", 318),
    ("2.43", 40, 66, "95.4", "31.6", "3.1", "84.2", 2400, "14.0", 317),
]


@pytest.fixture(scope="module")
def hourly(spark):
    return telemetry(spark, "2026-01-01", 24 * 1500).cache()


@pytest.fixture(scope="module")
def month(spark):
    """Thirty days in daily chunks."""
    table = ChunkedTable(spark, work_dir(spark, "lab"), TELEMETRY, "ts", "1 day", ["auto_id"])
    table.create().append(telemetry(spark, "2026-05-01", 24 * 30), "initial")
    return table


@pytest.fixture(scope="module")
def fine(spark):
    """The big table: five-second readings of nine days in three chunks."""
    table = ChunkedTable(spark, work_dir(spark, "fine"), TELEMETRY, "ts", "3 days", ["auto_id"])
    table.create().append(telemetry(spark, "2026-09-13", 9 * 17280, "5 seconds"), "initial")
    return table


def counted():
    return {"n": F.count(F.lit(1))}


def between(df, lo, hi):
    return df.where((F.col("ts") >= lo) & (F.col("ts") < hi))


def test_loader(hourly):
    assert table_counts({"a": hourly, "b": hourly}).collect() == [("a", 360_000), ("b", 360_000)]
    lo, hi, n = hourly.agg(F.min("ts"), F.max("ts"), F.count("ts")).first()
    assert (lo, hi, n) == (dt.datetime(2026, 1, 1), dt.datetime(2030, 2, 8, 23), 360_000)
    ranges = hourly.agg(
        *[F.min(c).alias(c) for c in TELEMETRY.names[2:]],
        *[F.max(c).alias(f"{c}_hi") for c in TELEMETRY.names[2:]],
    ).first()
    assert (ranges.velocidad, ranges.velocidad_hi) == (Decimal("0.0"), Decimal("140.0"))
    assert (ranges.revoluciones, ranges.revoluciones_hi) == (800, 6499)
    assert (ranges.consumo_potencia, ranges.consumo_potencia_hi) == (Decimal("-5.0"), Decimal("75.0"))
    assert [f.dataType for f in hourly.schema] == [f.dataType for f in TELEMETRY]
    assert len(comments(TELEMETRY)) == 12


def test_range_counts(hourly):
    assert between(hourly, "2026-05-15", "2026-05-16").count() == 240
    assert between(hourly, "2026-05-15", "2026-06-14").count() == 7200
    assert between(hourly, "2027-01-01", "2028-01-01").count() == 87_600


def test_ranges_from_the_data(month, hourly):
    hi = month.max_ts()
    assert hi == dt.datetime(2026, 5, 30, 23)
    day = month.last("24 hours")
    assert day.count() == 240
    assert day.agg(F.countDistinct(date_floor(day, "hour"))).first()[0] == 24
    assert month.last("24 hours", "both").count() == 250
    full = downsample(month.last_full_day(), "1 hour", counted(), "hora")
    assert [r.n for r in full.collect()] == [10] * 24
    assert full.agg(F.min("hora")).first()[0] == dt.datetime(2026, 5, 29)
    week = downsample(month.last("7 days", "both"), "1 day", counted(), "dia").orderBy("dia")
    assert [r.n for r in week.collect()] == [10] + [240] * 7
    assert month.last("30 days").count() == 7200


def test_buckets_of_a_day(month):
    day = month.scan("2026-05-15", "2026-05-16")
    assert sorted(r.n for r in downsample(day, "1 hour", counted(), "b").collect()) == [10] * 24
    assert sorted(r.n for r in downsample(day, "2 hours", counted(), "b").collect()) == [20] * 12
    six = month.scan("2026-05-15", "2026-05-21")
    assert sorted(r.n for r in downsample(six, "6 hours", counted(), "b").collect()) == [60] * 24
    at = "2026-05-15 00:30"
    assert bucket_equals(day, "90 minutes", at, origin=at).count() == 10
    assert month.bucket("90 minutes", at, origin=at).count() == 10
    top = month.at("2026-05-15").orderBy("auto_id").limit(3)
    assert [r.auto_id for r in top.collect()] == [1, 2, 3]


def test_rollup_is_stale_until_refreshed(spark, root, month):
    table = ChunkedTable(spark, root, TELEMETRY, "ts", "1 day", ["auto_id"]).create()
    table.append(month.scan(), "initial")
    rollup = Rollup(table, work_dir(spark, "cag"), "1 hour", ["auto_id"], {"velocidad": "vel"})
    rollup.build()
    assert rollup.view().count() == 7200
    table.append_rows([(1, "2026-06-01 23:00:00", "88.0")], ["auto_id", "ts", "velocidad"])
    new = ("2026-06-01 23:00", "2026-06-02 00:00")
    assert rollup.view(*new).count() == 0
    rollup.refresh("2026-05-31", "2026-06-02")
    row = rollup.view(*new).first()
    assert (row.lecturas, row.vel_media) == (1, Decimal("88.0"))
    assert rollup.view().count() == 7201
    raw = table.scan("2026-05-10", "2026-05-20").agg(F.sum("velocidad"), F.count("velocidad")).first()
    shown = rollup.weighted_avg("vel", "2026-05-10", "2026-05-20").first()[0]
    assert shown == rollup.avg_of_avgs("vel", "2026-05-10", "2026-05-20").first()[0]
    assert abs(shown - raw[0] / raw[1]) <= Decimal("0.05")


def test_kpi_twice(spark, month):
    kpi = KpiSpec().create(spark, work_dir(spark, "kpi"))
    for _ in range(2):
        assert run_kpi(month, kpi, "2026-05-20 12:40").isEmpty()
        rows = kpi_read(kpi).collect()
        assert [(r.ventana, r.auto_id, r.lecturas) for r in rows] == [
            (dt.datetime(2026, 5, 20, 11), a, 1) for a in range(1, 11)
        ]
    assert kpi_hour(month, "2026-05-20 12:40").schema["lecturas"].dataType.simpleString() == "int"


def test_the_big_table_from_load_to_purge(fine):
    """Load, compact two, insert into them, merge one, purge the oldest."""
    starts = [r.range_start for r in fine.show_chunks().orderBy("chunk_id").collect()]
    assert starts == [dt.datetime(2026, 9, d) for d in (13, 16, 19)]
    assert [r.n_rows for r in fine.chunks().collect()] == [518_400] * 3

    report = compress_chunks(fine, oldest_chunks(fine, 2)).collect()
    assert [r.rows_after for r in report] == [518_400] * 2
    state = fine.chunks().orderBy("chunk_id").collect()
    assert [(r.is_compressed, r.n_files) for r in state[:2]] == [(True, 1)] * 2
    assert not state[2].is_compressed
    assert fine.scan().count() == 1_555_200

    fine.append_rows(
        [(5, f"2026-09-14 12:0{i}:00", *row) for i, row in enumerate(FIVE)], TELEMETRY.names
    )
    insert_each(fine, [(6 + i, f"2026-09-17 12:00:0{i}", *row) for i, row in enumerate(FIVE)])
    state = fine.chunks().orderBy("chunk_id").collect()
    assert [r.overflow_rows for r in state] == [5, 5, 0]
    assert all(r.is_compressed for r in state[:2])

    compress_chunks(fine, chunk_starting(fine, "2026-09-16"))
    state = fine.chunks().orderBy("chunk_id").collect()
    assert [r.overflow_rows for r in state] == [5, 0, 0]
    assert fine.scan().count() == 1_555_210
    assert fine.scan("2026-09-16", "2026-09-20").count() == 691_205
    assert fine.last("3 days", "both").count() == 518_410

    assert len(drop_chunks(fine, "2026-09-17")) == 1
    assert fine.scan().count() == 1_036_805
    assert len(fine.chunk_ids()) == 2
