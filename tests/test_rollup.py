import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidevault import TELEMETRY, ChunkedTable, Rollup, compact_due, drop_chunks
from tidevault.sources.generate import telemetry


def make(spark, root, days=6, width="6 hours", **options):
    table = ChunkedTable(spark, f"{root}/t", TELEMETRY, "ts", "1 day", ["auto_id"]).create()
    table.append(telemetry(spark, "2026-05-01", 24 * days), "initial")
    rollup = Rollup(table, f"{root}/r", width, ["auto_id"], {"velocidad": "vel"}, **options)
    return table, rollup.build()


def fresh_rows(rollup):
    return sorted(rollup.aggregate(rollup.source.scan()).collect(), key=repr)


def kept_rows(rollup):
    return sorted(rollup.table.scan().collect(), key=repr)


def insert(table, *rows):
    return table.append_rows(rows, ["auto_id", "ts", "velocidad"])


@pytest.mark.parametrize("width", ["1 hour", "6 hours", "1 day", "1 week", "1 month"])
def test_build_equals_the_group_by(spark, root, width):
    _, rollup = make(spark, root, width=width)
    assert kept_rows(rollup) == fresh_rows(rollup)
    rollup.build()
    assert kept_rows(rollup) == fresh_rows(rollup)


def test_figures(spark, root):
    table, rollup = make(spark, root)
    insert(table, (99, "2026-05-02 01:00:00", "61.6"), (99, "2026-05-02 02:00:00", "61.7"))
    insert(table, (99, "2026-05-02 03:00:00", None))
    rollup.refresh("2026-05-02", "2026-05-03")
    row = rollup.view().where("auto_id = 99").first()
    assert row.lecturas == 3 and row.vel_media == Decimal("61.7")
    assert (row.vel_max, row.vel_min) == (Decimal("61.7"), Decimal("61.6"))
    insert(table, (98, "2026-05-02 03:00:00", None))
    rollup.refresh("2026-05-02", "2026-05-03")
    row = rollup.view().where("auto_id = 98").first()
    assert row.lecturas == 1 and row.vel_media is None and row.vel_max is None


def test_weighted_and_unweighted_averages_differ(spark, root):
    table = ChunkedTable(spark, f"{root}/t", TELEMETRY, "ts", "1 day").create()
    insert(table, *[(1, f"2026-05-01 00:0{i}:00", "10.0") for i in range(3)])
    insert(table, (1, "2026-05-01 07:00:00", "20.0"))
    rollup = Rollup(table, f"{root}/r", "6 hours", ["auto_id"], {"velocidad": "vel"}).build()
    assert rollup.avg_of_avgs("vel").first()[0] == Decimal("15.0")
    assert rollup.weighted_avg("vel").first()[0] == Decimal("12.5")


def test_refresh_of_a_window_is_a_rebuild_restricted_to_it(spark, root):
    table, rollup = make(spark, root)
    before = kept_rows(rollup)
    insert(table, *[(a, f"2026-05-0{d} 0{h}:30:00", "99.9") for a in (1, 77) for d in (1, 3, 5) for h in (1, 7)])
    # Partial buckets at both ends are left alone: only 3 May 00:00 to 18:00 is recomputed.
    used = rollup.refresh("2026-05-02 20:00", "2026-05-03 19:00")
    assert used == (dt.datetime(2026, 5, 3), dt.datetime(2026, 5, 3, 18))
    inside = lambda r: used[0] <= r.hora < used[1]
    expected = [r for r in before if not inside(r)] + [r for r in fresh_rows(rollup) if inside(r)]
    assert kept_rows(rollup) == sorted(expected, key=repr)
    assert rollup.refresh("2026-05-03 01:00", "2026-05-03 06:30") is None
    rollup.refresh("2026-04-01", "2026-06-01")
    assert kept_rows(rollup) == fresh_rows(rollup)


def test_vanished_source_rows_vanish_from_the_rollup(spark, root):
    table, rollup = make(spark, root)
    table.replace_chunks(table.scan("2026-05-02", "2026-05-03").where("auto_id < 4"), [20575])
    rollup.refresh("2026-05-01", "2026-05-07")
    assert kept_rows(rollup) == fresh_rows(rollup)
    assert rollup.view("2026-05-02", "2026-05-03").select("auto_id").distinct().count() == 3


def test_what_retention_dropped_stays_rolled_up(spark, root):
    table, rollup = make(spark, root, width="1 day")
    before = kept_rows(rollup)
    drop_chunks(table, "2026-05-04 12:00")
    assert rollup.refresh("2026-05-01", "2026-05-07") == (
        dt.datetime(2026, 5, 4), dt.datetime(2026, 5, 7),
    )
    assert kept_rows(rollup) == before
    # A straggler older than the retention line does not replace the history either.
    insert(table, (1, "2026-05-02 10:00:00", "1.0"))
    rollup.refresh("2026-05-01", "2026-05-07")
    assert rollup.refresh_changed(table.scan()) == 3
    assert kept_rows(rollup) == before
    assert kept_rows(rollup.build()) == before
    later = Rollup(table, f"{root}/later", "1 day", ["auto_id"], {"velocidad": "vel"}).build()
    assert kept_rows(later) == fresh_rows(later)


def test_a_bucket_half_dropped_keeps_its_figures(spark, root):
    table, rollup = make(spark, root, width="3 days", origin="2026-05-01")
    before = kept_rows(rollup)
    drop_chunks(table, "2026-05-02 12:00")
    rollup.refresh("2026-05-01", "2026-05-07")
    assert kept_rows(rollup) == before


@pytest.mark.parametrize("width", ["6 hours", "1 week", "1 month"])
def test_refresh_of_changed_buckets(spark, root, width):
    table, rollup = make(spark, root, width=width)
    load = insert(
        table, (1, "2026-05-02 01:00:00", "1.0"), (5, "2026-05-02 02:00:00", "2.0"), (1, "2026-07-01", "3.0")
    )
    changed = table.load_rows(load)
    assert rollup.refresh_changed(changed) == 2
    assert kept_rows(rollup) == fresh_rows(rollup)
    assert rollup.refresh_changed(changed.where("false")) == 0
    assert not rollup.table.folder.names("_touched-*")


def test_changed_buckets_inside_a_window(spark, root):
    table, rollup = make(spark, root)
    load = insert(table, (1, "2026-05-02 01:00:00", "1.0"), (1, "2026-05-05 01:00:00", "1.0"))
    assert rollup.refresh_changed(table.load_rows(load), "2026-05-04", "2026-05-06") == 1
    assert rollup.view("2026-05-02", "2026-05-02 06:00").where("auto_id = 1").first().lecturas == 6
    assert rollup.view("2026-05-05", "2026-05-05 06:00").where("auto_id = 1").first().lecturas == 7


def test_policy_leaves_out_the_bucket_in_progress(spark, root):
    table, rollup = make(spark, root, width="1 hour")
    insert(table, (1, "2026-05-07 10:10:00", "1.0"), (1, "2026-05-07 11:10:00", "1.0"))
    used = rollup.refresh_due("2026-05-07 12:20", "1 month", "1 hour")
    assert used == (dt.datetime(2026, 4, 7, 13), dt.datetime(2026, 5, 7, 11))
    assert rollup.view("2026-05-07").count() == 1


def test_a_compacted_rollup_can_be_refreshed(spark, root):
    table, rollup = make(spark, root, interval="2 days")
    compact_due(rollup.table, "2026-06-01", "7 days")
    assert all(r.is_compressed for r in rollup.table.chunks().collect())
    insert(table, (1, "2026-05-02 01:00:00", "1.0"))
    rollup.refresh("2026-05-02", "2026-05-03")
    assert kept_rows(rollup) == fresh_rows(rollup)


def test_several_values_and_no_keys(spark, root):
    table, _ = make(spark, root)
    rollup = Rollup(
        table, f"{root}/r2", "1 day", [], {"velocidad": "vel", "revoluciones": "rpm"}, "dia"
    ).build()
    row = rollup.view().orderBy("dia").first()
    raw = table.scan("2026-05-01", "2026-05-02").agg(F.count("ts"), F.max("revoluciones")).first()
    assert (row.lecturas, row.rpm_max) == (raw[0], raw[1])
    sizes = {r.tabla: r for r in rollup.sizes().collect()}
    assert sizes["rollup"].n_rows == 6 and sizes["source"].n_rows == 1440
