"""Rollups that add what was added, rollups on rollups, sketches, and notes that go away."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidevault import TELEMETRY, ChunkedTable, Rollup, compact_due, drop_chunks
from tidevault.operators.rollup import SKETCH_ERROR, refresh_chain
from tidevault.operators.upsert import upsert
from tidevault.sources.generate import telemetry

T0 = dt.datetime(2026, 5, 1)
AS_OF = "2026-05-20"


def make(spark, root, days=4, width="1 hour", **options):
    table = ChunkedTable(spark, f"{root}/t", TELEMETRY, "ts", "1 day", ["auto_id"]).create()
    table.append(telemetry(spark, "2026-05-01", 24 * days), "initial")
    return table, Rollup(table, f"{root}/r", width, ["auto_id"], {"velocidad": "vel"}, **options).build()


def rows(spark, *values):
    kinds = "auto_id int, ts string, velocidad string"
    df = spark.createDataFrame([(a, str(t), v) for a, t, v in values], kinds)
    return df.withColumn("ts", F.col("ts").cast("timestamp")).withColumn("velocidad", F.col("velocidad").cast("decimal(6,1)"))


def fresh(rollup, below=None):
    out = rollup.aggregate(rollup.source.scan())
    if below:
        out = out.where(F.col(rollup.bucket) < below)
    return sorted(map(tuple, out.collect()), key=repr)


def kept(rollup):
    return sorted(map(tuple, rollup.table.scan().collect()), key=repr)


def sealed(monkeypatch, table):
    """From now on nothing but loads named outright can be read of the table."""
    monkeypatch.setattr(table, "read_chunks", lambda ids=None: pytest.fail(f"read {ids}"))


def test_added_rows_are_read_alone(spark, root, monkeypatch):
    table, rollup = make(spark, root)
    table.append(rows(spark, (1, "2026-05-02 03:10", "7.5"), (500, "2026-05-02 03:20", None)), "late")
    table.append(rows(spark, (1, "2026-05-02 03:40", "999.9"), (1, "2026-05-04 00:00", "0.1")), "later")
    want = fresh(rollup)
    sealed(monkeypatch, table)
    rollup.refresh_due(AS_OF)
    rollup.refresh_due(AS_OF)
    monkeypatch.undo()
    assert kept(rollup) == want


def test_a_late_load_opens_no_older_file(spark, root, monkeypatch):
    table, rollup = make(spark, root)
    table.append(rows(spark, (1, "2026-05-02 03:10", "7.5")), "late")
    opened = []
    real = table.read_paths
    monkeypatch.setattr(table, "read_paths", lambda paths: opened.extend(paths) or real(paths))
    rollup.refresh_due(AS_OF)
    assert len(opened) == 1 and opened[0].endswith("/load=late")


def test_replaced_rows_are_computed_anew(spark, root):
    table, rollup = make(spark, root)
    table.append(rows(spark, (1, "2026-05-02 03:10", "7.5")), "again")
    rollup.refresh_due(AS_OF)
    table.append(rows(spark, (1, "2026-05-02 03:10", "2.5"), (2, "2026-05-03 03:10", "2.5")), "again")
    table.append(rows(spark, (3, "2026-05-02 03:50", "8.5")), "beside")
    rollup.refresh_due(AS_OF)
    assert kept(rollup) == fresh(rollup)


def test_rows_still_to_come_count_once(spark, root):
    table, rollup = make(spark, root)
    table.append(rows(spark, (1, "2026-05-03 10:10", "7.5"), (1, "2026-05-03 11:10", "7.5")), "both")
    rollup.refresh_due("2026-05-03 12:00")  # the second hour is still in progress
    table.append(rows(spark, (1, "2026-05-03 10:20", "1.5")), "more")
    rollup.refresh_due("2026-05-03 12:00")
    rollup.refresh_due(AS_OF)
    assert kept(rollup) == fresh(rollup)


def test_a_refresh_out_of_turn_is_not_added_to(spark, root):
    table, rollup = make(spark, root)
    table.append(rows(spark, (1, "2026-05-02 03:10", "7.5")), "a")
    rollup.refresh("2026-05-02", "2026-05-03")
    rollup.refresh_due(AS_OF)
    assert kept(rollup) == fresh(rollup)
    table.append(rows(spark, (1, "2026-05-02 04:10", "7.5")), "b")
    rollup.refresh_changed(table.load_rows("b"))
    rollup.refresh_due(AS_OF)
    assert kept(rollup) == fresh(rollup)
    table.append(rows(spark, (1, "2026-05-02 05:10", "7.5")), "c")
    rollup.build()
    rollup.refresh_due(AS_OF)
    assert kept(rollup) == fresh(rollup)


def test_rows_that_arrive_while_others_are_computed_count_once(spark, root, monkeypatch):
    table, rollup = make(spark, root)
    table.append(rows(spark, (1, "2026-05-02 03:10", "7.5")), "x")
    table.append(rows(spark, (1, "2026-05-02 03:10", "8.5")), "x")  # replaced: has to be computed
    real, once = table.read_chunks, []

    def late(ids=None):
        if not once:
            once.append(table.append(rows(spark, (1, "2026-05-02 03:30", "1.5")), "meanwhile"))
        return real(ids)

    monkeypatch.setattr(table, "read_chunks", late)
    rollup.refresh_due(AS_OF)
    monkeypatch.undo()
    assert once and kept(rollup) != fresh(rollup)
    rollup.refresh_due(AS_OF)
    assert kept(rollup) == fresh(rollup)


@pytest.mark.parametrize("after", [0, 1, 2, 3, 4, 5])
def test_a_run_that_dies_adds_nothing_twice(spark, root, monkeypatch, after):
    table, rollup = make(spark, root, days=2)
    table.append(rows(spark, (1, "2026-05-02 03:10", "7.5")), "late")
    folder, calls = rollup.table.folder, []
    real = folder.rename

    def failing(old, new):
        calls.append(new)
        if len(calls) > after:
            raise OSError("gone")
        real(old, new)

    monkeypatch.setattr(folder, "rename", failing)
    try:
        rollup.refresh_due(AS_OF)
    except OSError:
        pass
    monkeypatch.setattr(folder, "rename", real)
    again = Rollup.open(table, rollup.table.root)
    again.refresh_due(AS_OF)
    assert kept(again) == fresh(again)


@pytest.mark.parametrize("seed", range(3))
def test_any_order_of_writes_gives_the_group_by(spark, root, seed):
    r = random.Random(seed)
    table, rollup = make(spark, root, days=3, distinct={"revoluciones": "rpm"})
    daily = Rollup(rollup, f"{root}/d", "1 day", ["auto_id"], {"velocidad": "vel"}, "dia").build()

    def some(n=3):
        at = lambda: T0 + dt.timedelta(minutes=r.randrange(0, 4 * 24 * 60, 7))
        return rows(spark, *[(r.randrange(1, 9), at(), f"{r.randrange(99)}.5") for _ in range(n)])

    for step in range(12):
        kind = r.choice(["append", "append", "repeat", "refresh", "due", "due", "compact", "upsert", "part"])
        if kind == "append":
            table.append(some(), f"s{step}")
        elif kind == "repeat":
            table.append(some(), "same")
        elif kind == "refresh":
            rollup.refresh("2026-05-02", "2026-05-03 12:00")
        elif kind == "due":
            rollup.refresh_due(T0 + dt.timedelta(hours=r.randrange(20, 100)))
        elif kind == "compact":
            compact_due(table, T0 + dt.timedelta(days=r.randrange(1, 5)), "1 hour")
        elif kind == "upsert":
            upsert(table, some(1), ("auto_id", "ts"))
        else:
            daily.refresh_due(T0 + dt.timedelta(hours=r.randrange(20, 100)))
    refresh_chain([rollup, daily], AS_OF)
    got = [x[:-1] for x in kept(rollup)]
    assert got == [x[:-1] for x in fresh(rollup)]
    by_day = Rollup(table, f"{root}/x", "1 day", ["auto_id"], {"velocidad": "vel"}, "dia").build()
    assert [tuple(x) for x in kept(daily)] == [tuple(x) for x in kept(by_day)]


def test_added_rows_count_where_the_rest_was_dropped(spark, root):
    table, rollup = make(spark, root)
    before = {(x[0], x[1]): x for x in kept(rollup)}
    drop_chunks(table, "2026-05-03 12:00")
    table.append(rows(spark, (1, "2026-05-01 03:10", "7.5"), (700, "2026-05-01 03:10", "1.0")), "late")
    rollup.refresh_due(AS_OF)
    after = {(x[0], x[1]): x for x in kept(rollup)}
    assert len(after) == len(before) + 1
    changed = {k for k in before if before[k] != after[k]}
    assert changed == {(dt.datetime(2026, 5, 1, 3), 1)}
    assert all(after[k][2] == before[k][2] + 1 for k in changed)


# -- rollups on rollups ---------------------------------------------------------------------


@pytest.mark.parametrize("width,keys", [("1 day", ["auto_id"]), ("6 hours", []), ("1 week", []), ("1 month", ["auto_id"])])
def test_a_rollup_on_a_rollup_has_the_figures_of_the_readings(spark, root, width, keys):
    table, hourly = make(spark, root)
    coarse = Rollup(hourly, f"{root}/c", width, keys, {"velocidad": "vel"}, "desde").build()
    plain = Rollup(table, f"{root}/p", width, keys, {"velocidad": "vel"}, "desde").build()
    assert kept(coarse) == kept(plain)
    table.append(rows(spark, (1, "2026-05-02 03:10", "7.5"), (900, "2026-05-03 01:00", "3.5")), "late")
    refresh_chain([hourly, Rollup.open(hourly, f"{root}/c")], "2026-07-01", "3 months")
    plain.build()
    assert kept(coarse) == kept(plain)
    assert coarse.view().count() == plain.view().count()


def test_a_late_hour_reaches_one_day_alone(spark, root, monkeypatch):
    table, hourly = make(spark, root, interval="1 day")
    daily = Rollup(hourly, f"{root}/d", "1 day", ["auto_id"], {"velocidad": "vel"}, "dia", interval="1 day").build()
    table.append(rows(spark, (1, "2026-05-02 03:10", "7.5")), "late")
    hourly.refresh_due(AS_OF)
    names = {p for p in daily.table.read_chunks().inputFiles()}
    daily.refresh_due(AS_OF)
    after = {p for p in daily.table.read_chunks().inputFiles()}
    gone = {p.split("chunk_id=")[1].split("/")[0] for p in names - after}
    assert len(gone) == 1 and len(names & after) >= 3


def test_coarser_buckets_outlive_the_finer_ones(spark, root):
    table, hourly = make(spark, root)
    daily = Rollup(hourly, f"{root}/d", "1 day", ["auto_id"], {"velocidad": "vel"}, "dia").build()
    want = kept(daily)
    drop_chunks(table, "2026-06-01")
    hourly.build()
    refresh_chain([hourly, daily], AS_OF)
    assert kept(daily) == want


@pytest.mark.parametrize(
    "width,keys,values",
    [
        ("90 minutes", ["auto_id"], {"velocidad": "vel"}),
        ("1 day", ["ts"], {"velocidad": "vel"}),
        ("1 day", [], {"revoluciones": "rpm"}),
        ("1 day", [], {"velocidad": "v"}),
    ],
)
def test_what_the_finer_rollup_does_not_give_is_refused(spark, root, width, keys, values):
    _, hourly = make(spark, root, days=1)
    with pytest.raises(ValueError):
        Rollup(hourly, f"{root}/x", width, keys, values)


# -- distinct counts --------------------------------------------------------------------------


def test_distinct_counts_are_within_their_error(spark, root):
    table = ChunkedTable(spark, f"{root}/t", TELEMETRY, "ts", "1 day", ["auto_id"]).create()
    cars = spark.range(40_000).select(
        F.pmod(F.xxhash64("id"), F.lit(9000)).cast("int").alias("auto_id"),
        (F.lit(T0).cast("timestamp") + F.make_dt_interval(mins=(F.col("id") % 2880).cast("int"))).alias("ts"),
        F.lit(1).cast("decimal(6,1)").alias("velocidad"),
    )
    table.append(cars, "a")
    rollup = Rollup(table, f"{root}/r", "1 hour", [], {}, distinct={"auto_id": "autos"}).build()
    table.append(cars.withColumn("auto_id", F.col("auto_id") + 4500), "b")
    rollup.refresh_due(AS_OF)
    exact = {
        r[0]: r[1] for r in table.scan().groupBy(F.date_trunc("hour", "ts")).agg(F.countDistinct("auto_id")).collect()
    }
    shown = {r["hora"]: r["autos_distintos"] for r in rollup.view().collect()}
    assert shown.keys() == exact.keys()
    assert all(abs(shown[k] - n) <= 4 * SKETCH_ERROR * n for k, n in exact.items())
    whole = table.scan().agg(F.countDistinct("auto_id")).first()[0]
    assert abs(rollup.distinct_count("autos").first()[0] - whole) <= 4 * SKETCH_ERROR * whole
    daily = Rollup(rollup, f"{root}/d", "1 day", [], {}, "dia", distinct={"auto_id": "autos"}).build()
    assert daily.distinct_count("autos").first()[0] == rollup.distinct_count("autos").first()[0]


# -- notes ----------------------------------------------------------------------------------


def notes(table):
    return table.folder.names("_changes/*")


def test_notes_go_when_every_rollup_has_them(spark, root):
    table, rollup = make(spark, root, days=1)
    other = Rollup(table, f"{root}/o", "6 hours", ["auto_id"], {"velocidad": "vel"}).build()
    for i in range(5):
        table.append(rows(spark, (1, f"2026-05-01 0{i}:10", "7.5")), f"l{i}")
    rollup.refresh_due(AS_OF)
    assert len([n for n in notes(table) if not n.endswith(".done")]) >= 5  # the other is behind
    other.refresh_due(AS_OF)
    rollup.refresh_due(AS_OF)
    assert notes(table) == []
    assert kept(rollup) == fresh(rollup) and kept(other) == fresh(other)
    table.append(rows(spark, (1, "2026-05-01 09:10", "7.5")), "next")
    table.folder.delete("../o")  # a rollup that is gone holds nothing back
    rollup.refresh_due(AS_OF)
    assert notes(table) == []
    assert kept(rollup) == fresh(rollup)


def test_notes_of_dropped_chunks_go(spark, root):
    table = ChunkedTable(spark, f"{root}/t", TELEMETRY, "ts", "1 day", ["auto_id"]).create()
    rollup = Rollup(table, f"{root}/r", "1 hour", ["auto_id"], {"velocidad": "vel"}).build()
    for i in range(4):
        table.append(rows(spark, (1, f"2026-05-0{i + 1} 00:10", "7.5")), f"l{i}")
    drop_chunks(table, "2026-05-04")
    assert len([n for n in notes(table) if not n.endswith(".done")]) == 2
    rollup.refresh_due(AS_OF)
    drop_chunks(table, "2026-06-01")
    assert notes(table) == []


def test_a_repeat_is_still_known_without_its_note(spark, root):
    table = ChunkedTable(spark, f"{root}/t", TELEMETRY, "ts", "1 day", ["auto_id"]).create()
    own = rows(spark, (1, "2026-05-01 00:10", "7.5"), (2, "2026-05-01 00:10", "7.5"))
    table.append(own, "a")
    compact_due(table, AS_OF, "1 day")
    drop_chunks(table, "2026-01-01")  # takes the notes along
    assert notes(table) == []
    table.append(own, "a")
    assert table.scan().count() == 2
    with pytest.raises(ValueError, match="other rows"):
        table.append(rows(spark, (1, "2026-05-01 00:10", "8.5")), "a")
    with pytest.raises(ValueError, match="taken in"):
        table.load_rows("a")
