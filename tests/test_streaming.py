import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidevault import TELEMETRY, ChunkedTable, KpiSpec, Rollup
from tidevault.sources.generate import telemetry
from tidevault.streaming.ingest import (
    stream_into,
    stream_rollup,
    stream_upsert,
    stream_with_late,
)


def tables(spark, root):
    table = ChunkedTable(spark, f"{root}/t", TELEMETRY, "ts", "1 day", ["auto_id"]).create()
    rollup = Rollup(table, f"{root}/r", "1 hour", ["auto_id"], {"velocidad": "vel"})
    return table, rollup


def arrive(spark, root, rows):
    rows.write.mode("append").parquet(f"{root}/in")
    return spark.readStream.schema(TELEMETRY).parquet(f"{root}/in")


def test_late_rows_reach_the_rollup_by_refresh(spark, root):
    table, rollup = tables(spark, root)

    def step(rows):
        source = arrive(spark, root, rows)
        stream_into(source, table, "in", f"{root}/ck-in").awaitTermination()
        stream_rollup(source, rollup, "roll", f"{root}/ck-roll").awaitTermination()

    step(telemetry(spark, "2026-05-01", 24))
    # The latest reading is of 23:00, the watermark 22:00: buckets up to 21:00 are out.
    assert rollup.view().agg(F.max("hora")).first()[0] == dt.datetime(2026, 5, 1, 21)
    assert rollup.view().count() == 22 * 10
    step(telemetry(spark, "2026-05-01 03:30", 1).withColumn("auto_id", F.col("auto_id") + 100))
    assert table.scan().count() == 250
    assert rollup.view().count() == 22 * 10
    assert rollup.refresh_changed(table.load_rows("in-1")) == 1
    assert rollup.view().count() == 23 * 10
    step(telemetry(spark, "2026-05-02", 24))
    assert rollup.view("2026-05-01", "2026-05-02").count() == 25 * 10
    done = rollup.view(end="2026-05-02 22:00")
    assert done.exceptAll(rollup.view()).isEmpty()
    rebuilt = Rollup(table, f"{root}/r2", "1 hour", ["auto_id"], {"velocidad": "vel"}).build()
    assert rebuilt.view(end="2026-05-02 22:00").exceptAll(rollup.view()).isEmpty()
    assert rollup.view().exceptAll(rebuilt.view()).isEmpty()


def _closed(table, root, end, name):
    fresh = Rollup(table, f"{root}/{name}", "1 hour", ["auto_id"], {"velocidad": "vel"}).build()
    return sorted(map(tuple, fresh.view(end=end).collect()))


def test_late_rows_are_kept_apart_and_count_once(spark, root):
    import glob
    import os

    table, rollup = tables(spark, root)
    late = ChunkedTable(spark, f"{root}/late", TELEMETRY, "ts", "1 day", ["auto_id"]).create()

    def step(rows=None):
        source = arrive(spark, root, rows) if rows is not None else spark.readStream.schema(TELEMETRY).parquet(f"{root}/in")
        stream_with_late(source, rollup, late, "in", f"{root}/ck").awaitTermination()

    def again():
        """The sink wrote, the commit was lost."""
        last = max(int(os.path.basename(n)) for n in glob.glob(f"{folder}/commits/[0-9]*") if n[-1].isdigit())
        for n in [*glob.glob(f"{folder}/commits/{last}"), *glob.glob(f"{folder}/commits/.{last}.crc")]:
            os.rename(n, f"{n}.lost")
        step()

    folder = f"{root.removeprefix('file:')}/ck"
    step(telemetry(spark, "2026-05-01", 24))
    # The latest reading is of 23:00, the watermark 22:00: buckets from 22:00 on are withheld.
    assert sorted(map(tuple, rollup.view().collect())) == _closed(table, root, "2026-05-01 22:00", "a")
    assert late.scan().count() == 0
    again()
    extra = telemetry(spark, "2026-05-01 03:30", 1).withColumn("auto_id", F.col("auto_id") + 100)
    step(extra.unionByName(telemetry(spark, "2026-05-01 22:15", 1)))  # the first is late, the second is not
    assert late.scan().count() == 10 and table.scan().count() == 260
    assert sorted(map(tuple, rollup.view().collect())) == _closed(table, root, "2026-05-01 22:00", "b")
    again()
    assert late.scan().count() == 10 and table.scan().count() == 260
    assert sorted(map(tuple, rollup.view().collect())) == _closed(table, root, "2026-05-01 22:00", "c")
    step(telemetry(spark, "2026-05-02", 24).limit(0))  # an empty file moves no mark
    step(telemetry(spark, "2026-05-02", 24))
    again()
    assert late.scan().count() == 10
    assert sorted(map(tuple, rollup.view().collect())) == _closed(table, root, "2026-05-02 22:00", "d")


def test_a_running_stream_takes_up_new_files(spark, root):
    table, _ = tables(spark, root)
    source = arrive(spark, root, telemetry(spark, "2026-05-01", 24))
    stream = stream_into(source, table, "in", f"{root}/ck", interval="1 second")
    try:
        stream.processAllAvailable()
        assert table.scan().count() == 240
        arrive(spark, root, telemetry(spark, "2026-05-02", 24))
        stream.processAllAvailable()
        assert table.scan().count() == 480
    finally:
        stream.stop()


def test_a_batch_run_again_does_not_double(spark, root):
    """The sink wrote, the commit was lost: the same batch comes once more."""
    import glob
    import os

    table, rollup = tables(spark, root)
    source = arrive(spark, root, telemetry(spark, "2026-05-01", 24))
    stream_into(source, table, "in", f"{root}/ck").awaitTermination()
    assert table.scan().count() == 240
    for name in glob.glob(f"{root.removeprefix('file:')}/ck/commits/*0*"):
        os.rename(name, f"{name}.lost")
    for name in glob.glob(f"{root.removeprefix('file:')}/ck/commits/.*crc"):
        os.rename(name, f"{name}.lost")
    stream_into(source, table, "in", f"{root}/ck").awaitTermination()
    assert table.scan().count() == 240


def test_streamed_kpi_is_updated(spark, root):
    kpi = KpiSpec().create(spark, f"{root}/k", "1 day")
    first = telemetry(spark, "2026-05-01", 6, "10 minutes")
    more = telemetry(spark, "2026-05-01 00:05", 12, "10 minutes")
    for rows in (first, more):
        stream_upsert(
            arrive(spark, root, rows),
            kpi,
            ("ventana", "auto_id"),
            "1 hour",
            "ts",
            [
                F.count(F.lit(1)).alias("lecturas"),
                F.max("velocidad").alias("vel_max"),
                F.max("revoluciones").alias("rpm_max"),
            ],
            "kpi",
            f"{root}/ck",
            delay="2 hours",
        ).awaitTermination()
    got = {(r.ventana.hour, r.auto_id): r.lecturas for r in kpi.scan().collect()}
    assert got == {(h, a): n for a in range(1, 11) for h, n in ((0, 12), (1, 6))}


def test_rejected_rows_of_a_stream_are_kept(spark, root):
    kpi = KpiSpec().create(spark, f"{root}/k", "1 day")
    rows = telemetry(spark, "2026-05-01", 2)
    rows = rows.withColumn("revoluciones", F.when(F.col("auto_id") != 3, F.col("revoluciones")))
    stream_upsert(
        arrive(spark, root, rows),
        kpi,
        ("ventana", "auto_id"),
        "1 hour",
        "ts",
        [
            F.count(F.lit(1)).alias("lecturas"),
            F.max("velocidad").alias("vel_max"),
            F.max("revoluciones").alias("rpm_max"),
        ],
        "kpi",
        f"{root}/ck",
        reject_path=f"{root}/rejects",
    ).awaitTermination()
    assert kpi.scan().count() == 18
    rejects = spark.read.parquet(f"{root}/rejects")
    assert [r.auto_id for r in rejects.collect()] == [3, 3]


def test_a_streamed_rollup_needs_a_grid(spark, root):
    table, _ = tables(spark, root)
    source = arrive(spark, root, telemetry(spark, "2026-05-01", 1))
    rollup = Rollup(table, f"{root}/1", "1 month", ["auto_id"], {"velocidad": "vel"})
    with pytest.raises(ValueError, match="grid"):
        stream_rollup(source, rollup, "x", f"{root}/ck")


@pytest.mark.parametrize(("width", "origin"), [("7 days", None), ("90 minutes", "2026-05-01 00:20")])
def test_streamed_buckets_lie_on_the_grid(spark, root, width, origin):
    table, _ = tables(spark, root)
    rows = telemetry(spark, "2026-05-01", 24 * 30)
    table.append(rows, "all")
    made = {}
    for name in ("built", "streamed"):
        made[name] = Rollup(table, f"{root}/{name}", width, ["auto_id"], {"velocidad": "vel"}, origin=origin)
    made["built"].build()
    stream_rollup(arrive(spark, root, rows), made["streamed"], "s", f"{root}/ck").awaitTermination()
    out = made["streamed"].view()
    assert out.count() > 30 and out.exceptAll(made["built"].view()).isEmpty()


def test_stream_and_refresh_may_bring_the_same_buckets(spark, root):
    table, rollup = tables(spark, root)
    rows = telemetry(spark, "2026-05-01", 48)
    table.append(rows, "all")
    rollup.build()
    before = rollup.view()
    counted = before.count()
    stream_rollup(arrive(spark, root, rows), rollup, "roll", f"{root}/ck").awaitTermination()
    assert rollup.view().count() == counted
    assert rollup.view().select("hora", "auto_id").distinct().count() == counted


def test_another_checkpoint_is_another_stream(spark, root):
    table, _ = tables(spark, root)
    first = arrive(spark, f"{root}/a", telemetry(spark, "2026-05-01", 24))
    second = arrive(spark, f"{root}/b", telemetry(spark, "2026-05-01", 12))
    stream_into(first, table, "in", f"{root}/ck-a").awaitTermination()
    stream_into(second, table, "in", f"{root}/ck-b").awaitTermination()
    assert table.scan().count() == 360
    assert table.load_rows("in-0").count() == 360
