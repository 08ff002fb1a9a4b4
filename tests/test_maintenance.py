"""Compaction, retention and recovery."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidevault import TELEMETRY, ChunkedTable, compact_due, compress_chunks, drop_chunks, preview, retain
from tidevault.operators import compact
from tidevault.operators.compact import chunk_starting, fingerprint, oldest_chunks
from tidevault.sources.generate import telemetry


def make(spark, root, days=6, interval="1 day"):
    table = ChunkedTable(spark, root, TELEMETRY, "ts", interval, ["auto_id"]).create()
    table.append(telemetry(spark, "2026-05-01", 24 * days), "initial")
    return table


def prints(table):
    return sorted(fingerprint(table, table.read_chunks()).collect())


def test_lossless_and_few_files(spark, root):
    table = make(spark, root)
    for part in range(3):
        table.append(telemetry(spark, "2026-05-01", 24, cars=part + 1))
    before = prints(table)
    report = {r.chunk_id: r for r in compress_chunks(table, oldest_chunks(table, 2)).collect()}
    assert prints(table) == before
    first = min(report)
    assert (report[first].files_before, report[first].files_after) == (4, 1)
    state = table.chunks().orderBy("chunk_id").collect()
    assert [r.is_compressed for r in state] == [True, True, False, False, False, False]


def test_rows_are_clustered(spark, root):
    table = make(spark, root, days=2)
    compress_chunks(table, table.chunk_ids())
    rows = table.read_chunks(oldest_chunks(table, 1)).select("auto_id", "ts").collect()
    assert rows == sorted(rows, key=lambda r: (r.auto_id, -r.ts.timestamp()))


def test_compacting_again_changes_nothing(spark, root):
    table = make(spark, root, days=3)
    compress_chunks(table, table.chunk_ids())
    files = sorted(table.read_chunks().inputFiles())
    assert compress_chunks(table, table.chunk_ids()).count() == 0
    assert sorted(table.read_chunks().inputFiles()) == files


def test_overflow_is_kept_apart_and_merged(spark, root):
    table = make(spark, root, days=3)
    compress_chunks(table, table.chunk_ids())
    files = set(table.read_chunks().inputFiles())
    table.append_rows([(7, "2026-05-02 12:00:00"), (7, "2026-05-02 12:00:00")], ["auto_id", "ts"])
    assert files < set(table.read_chunks().inputFiles())
    state = table.chunks().orderBy("chunk_id").collect()
    assert [r.overflow_rows for r in state] == [0, 2, 0] and all(r.is_compressed for r in state)
    before = prints(table)
    compress_chunks(table, chunk_starting(table, "2026-05-02"))
    assert prints(table) == before
    assert [r.overflow_rows for r in table.chunks().collect()] == [0, 0, 0]


def test_large_chunks_are_cut_whatever_fills_them(spark, root):
    """One vehicle and one mass of equal rows hold most of one chunk: files stay even."""
    table = ChunkedTable(spark, root, TELEMETRY, "ts", "1 day", ["auto_id"]).create()
    even = telemetry(spark, "2026-05-01", 2000, "40 seconds", cars=6)
    hot = telemetry(spark, "2026-05-01", 8000, "10 seconds", cars=1)
    copies = telemetry(spark, "2026-05-01 06:00", 1, cars=1).crossJoin(spark.range(12_000)).drop("id")
    table.append(even.unionByName(hot).unionByName(copies), "initial")
    before = prints(table)
    size = table.chunks().agg(F.sum("bytes")).first()[0]
    compress_chunks(table, table.chunk_ids(), target_file_bytes=size // 8)
    assert prints(table) == before
    files = (
        table.read_chunks()
        .groupBy(F.input_file_name())
        .agg(F.count(F.lit(1)).alias("n"))
    )
    counts = [r.n for r in files.collect()]
    assert len(counts) >= 8
    assert max(counts) < 3 * sum(counts) / len(counts)


def test_a_difference_stops_the_swap(spark, root, monkeypatch):
    table = make(spark, root, days=2)
    before = prints(table)
    monkeypatch.setattr(compact, "_order", lambda t: [F.lit(1)])
    stage = ChunkedTable.stage
    monkeypatch.setattr(
        ChunkedTable, "stage", lambda self, rows, *a, **k: stage(self, rows.where("auto_id > 1"), *a, **k)
    )
    with pytest.raises(RuntimeError, match="differ"):
        compress_chunks(table, table.chunk_ids())
    assert prints(table) == before
    assert not table.folder.names("_staging-*")


def test_passes_bound_the_work(monkeypatch):
    monkeypatch.setattr(compact, "PASS_BYTES", 100)
    assert compact._passes({1: 60, 2: 40, 3: 1, 4: 500, 5: 10}) == [[1, 2], [3], [4], [5]]
    assert compact._passes({}) == []


def test_policy_leaves_the_active_chunk(spark, root):
    table = make(spark, root, days=6)
    compact_due(table, "2026-05-06 12:00", "3 days")
    state = table.chunks().orderBy("chunk_id").collect()
    # 2 May ends on 3 May 00:00, before the cut-off of 3 May 12:00; 3 May does not.
    assert [r.is_compressed for r in state] == [True, True, False, False, False, False]
    compact_due(table, "2026-05-06", dt.timedelta(microseconds=259200000000))
    assert sum(r.is_compressed for r in table.chunks().collect()) == 2
    assert compact_due(table, "2026-05-01", "7 days").count() == 0


def test_retention_by_whole_chunk(spark, root):
    table = make(spark, root, days=9, interval="3 days")
    # Chunks start on the epoch grid: 1, 4 and 7 May.
    listed = preview(table, "2026-05-08")
    assert [r.range_end for r in listed.orderBy("chunk_id").collect()] == [
        dt.datetime(2026, 5, 4), dt.datetime(2026, 5, 7),
    ]
    total, gone = table.scan().count(), table.scan(end="2026-05-07").count()
    assert drop_chunks(table, "2026-05-08") == sorted(r.chunk_id for r in listed.collect())
    assert table.scan().count() == total - gone
    assert drop_chunks(table, "2026-05-08") == []
    assert retain(table, "2026-05-15", "5 days") == []
    assert table.min_ts() == dt.datetime(2026, 5, 7)
    assert len(retain(table, "2026-05-15 00:00:00.000001", "5 days")) == 1
    assert table.scan().count() == 0


def test_a_cut_off_at_the_end_of_a_chunk_keeps_it(spark, root):
    table = make(spark, root, days=2)
    assert drop_chunks(table, "2026-05-02") == []
    assert len(drop_chunks(table, "2026-05-02 00:00:00.000001")) == 1


def test_recovery(spark, root):
    """A driver that died between two moves loses nothing."""
    table = make(spark, root, days=3)
    before = prints(table)
    first, second, third = table.chunk_ids()
    for name in ("_old-dead", "_staging-dead", "_append-dead", "_batch-dead"):
        table.folder.mkdirs(name)
    # The first chunk was moved aside and not replaced, while another load arrived.
    table.folder.rename(f"chunk_id={first}", f"_old-dead/chunk_id={first}")
    table.append_rows([(1, "2026-05-01 10:00:00")], ["auto_id", "ts"])
    # The second was replaced: its old rows must not come back.
    table.folder.mkdirs(f"_old-dead/chunk_id={second}")
    table.folder.rename(f"chunk_id={second}/load=initial", f"chunk_id={second}/load=compacted-dead")
    table.folder.mkdirs(f"_old-dead/chunk_id={second}/load=initial")
    assert table.scan().count() == 481
    table.recover()
    after = {r.chunk_id: r for r in prints(table)}
    assert after[first].n_rows == 241
    assert [after[second], after[third]] == before[1:]
    assert table.folder.names("_append-*") == ["_append-dead"]
    table.sweep()
    for kind in ("old", "staging", "append", "batch"):
        assert table.folder.names(f"_{kind}-*") == []


def test_rows_that_arrive_during_compaction_stay(spark, root, monkeypatch):
    table = make(spark, root, days=2)
    swap = ChunkedTable.swap_in

    def late(self, *args):
        self.append_rows([(42, "2026-05-01 10:00:00")], ["auto_id", "ts"])
        self.append(telemetry(spark, "2026-05-02 00:30", 1), "late")
        swap(self, *args)

    monkeypatch.setattr(ChunkedTable, "swap_in", late)
    compress_chunks(table, table.chunk_ids())
    monkeypatch.undo()
    assert table.scan().count() == 480 + 11
    state = table.chunks().orderBy("chunk_id").collect()
    assert [r.overflow_rows for r in state] == [1, 10] and all(r.is_compressed for r in state)
    compress_chunks(table, table.chunk_ids())
    assert [r.overflow_rows for r in table.chunks().collect()] == [0, 0]
    assert table.scan().count() == 491


def test_a_load_run_again_after_compaction(spark, root):
    """What a rewrite took in is not added once more; chunks that missed it get it."""
    table = make(spark, root, days=2)
    rows = telemetry(spark, "2026-05-01 00:30", 72)
    table.append(rows, "nightly")
    before = prints(table)
    compress_chunks(table, oldest_chunks(table, 2))
    table.append(rows, "nightly")
    assert prints(table) == before
    compress_chunks(table, table.chunk_ids())
    table.folder.delete(f"chunk_id={table.chunk_ids()[2]}")
    table.append(rows, "nightly")
    assert prints(table) == before
    table.replace_chunks(table.scan(), table.chunk_ids())
    table.append(rows, "nightly")
    assert prints(table) == before


@pytest.mark.parametrize("verify", ["counts", "off"])
def test_cheaper_checks(spark, root, verify):
    table = make(spark, root, days=2)
    before = prints(table)
    compress_chunks(table, table.chunk_ids(), verify=verify)
    assert prints(table) == before
    with pytest.raises(ValueError):
        compress_chunks(table, [], verify="maybe")


def test_appends_may_run_side_by_side(spark, root):
    from concurrent.futures import ThreadPoolExecutor

    table = make(spark, root, days=1)

    def one(i):
        table.append(telemetry(spark, "2026-05-01", 48, cars=2), f"job-{i}")

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(one, range(4)))
    assert table.scan().count() == 240 + 4 * 96


def test_replace_may_read_what_it_replaces(spark, root):
    table = make(spark, root, days=3)
    ids = table.chunk_ids()
    table.replace_chunks(table.scan().where("auto_id <= 3"), ids)
    assert table.scan().count() == 3 * 72
    table.replace_chunks(table.scan("2026-05-02", "2026-05-03"), ids[:2])
    assert table.chunk_ids() == ids[1:]
