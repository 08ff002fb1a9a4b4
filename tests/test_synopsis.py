"""Aggregates from synopses, and recompaction that leaves other files alone."""

import datetime as dt
import random

import pytest
from plans import files_read
from pyspark.sql import functions as F

from tidevault import TELEMETRY, ChunkedTable, compress_chunks
from tidevault.operators import synopsis
from tidevault.operators.synopsis import aggregate_range

DAY = dt.timedelta(days=1)
T0 = dt.datetime(2026, 3, 1)


def make(spark, root, days=6, cars=12, every=30):
    t = ChunkedTable(spark, root, TELEMETRY, "ts", "1 day", ["auto_id"]).create()
    n = days * 24 * 60 // every
    rows = spark.range(n * cars).select(
        (F.col("id") % cars + 1).cast("int").alias("auto_id"),
        (F.lit(T0).cast("timestamp") + F.make_dt_interval(mins=(F.col("id") / cars).cast("int") * every)).alias("ts"),
        F.when(F.col("id") % 7 != 0, (F.xxhash64("id") % 900 / 10)).cast("decimal(6,1)").alias("velocidad"),
        (F.pmod(F.xxhash64("id"), F.lit(3000))).cast("short").alias("revoluciones"),
    )
    t.append(rows, "first")
    return t


def few(spark, t, *rows):
    return t.append_rows([(a, str(at), v) for a, at, v in rows], ["auto_id", "ts", "velocidad"])


AGGS = {
    "n": ("count", None),
    "known": ("count", "velocidad"),
    "total": ("sum", "velocidad"),
    "least": ("min", "velocidad"),
    "most": ("max", "revoluciones"),
    "last": ("max", "ts"),
}


def by_scan(t, lo, hi, keys):
    return t.scan(lo, hi).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.count("velocidad").alias("known"),
        F.sum("velocidad").alias("total"),
        F.min("velocidad").alias("least"),
        F.max("revoluciones").alias("most"),
        F.max("ts").alias("last"),
    )


def same(t, lo, hi, keys):
    got = aggregate_range(t, lo, hi, AGGS, keys)
    want = by_scan(t, lo, hi, keys)
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(
        map(repr, (tuple(r) for r in want.collect()))
    )
    return got


@pytest.mark.parametrize("keys", [[], ["auto_id"]])
def test_whole_chunks_are_not_opened(spark, root, keys):
    t = make(spark, root, days=6)
    lo, hi = T0 + DAY / 2, T0 + 5.25 * DAY
    same(t, lo, hi, keys)  # nothing compacted yet
    compress_chunks(t, t.chunk_ids())
    got = same(t, lo, hi, keys)
    # Two edges, and the synopses, which one rewrite has written in one folder.
    assert files_read(got.select("*")) <= 2 + 8
    paths = [p for p in got.inputFiles() if "/chunk_id=" in p and "_synopsis" not in p]
    assert len(paths) == 2
    # A range of whole chunks opens none of them.
    whole = same(t, T0 + DAY, T0 + 4 * DAY, keys)
    assert not [p for p in whole.inputFiles() if "/load=" in p]


def test_overflow_and_files_without_synopsis_are_read(spark, root):
    t = make(spark, root, days=4)
    compress_chunks(t, t.chunk_ids())
    few(spark, t, (3, T0 + DAY * 1.5, "999.9"), (77, T0 + DAY * 2.1, None))
    got = same(t, T0, T0 + 4 * DAY, ["auto_id"])
    assert len([p for p in got.inputFiles() if "/load=" in p]) == 2
    compress_chunks(t, t.chunk_ids())
    got = same(t, T0, T0 + 4 * DAY, ["auto_id"])
    assert not [p for p in got.inputFiles() if "/load=" in p]
    for name in t.folder.names("_synopsis/*"):
        t.folder.delete(name)
    got = same(t, T0, T0 + 4 * DAY, ["auto_id"])
    assert len([p for p in got.inputFiles() if "/load=" in p]) == 4


def test_replaced_chunks_have_no_synopsis(spark, root):
    t = make(spark, root, days=3)
    compress_chunks(t, t.chunk_ids())
    ids = t.chunk_ids()
    t.replace_chunks(t.scan(T0, T0 + DAY).where("auto_id > 4"), ids[:1])
    same(t, T0, T0 + 3 * DAY, ["auto_id"])
    t.drop(ids[:1])
    same(t, T0, T0 + 3 * DAY, [])


def test_empty_ranges_and_tables(spark, root):
    t = ChunkedTable(spark, root, TELEMETRY, "ts", "1 day", ["auto_id"]).create()
    same(t, T0, T0 + DAY, [])
    same(t, T0, T0 + DAY, ["auto_id"])
    same(t, T0 + DAY, T0, [])


def test_what_is_not_kept_is_refused(spark, root):
    t = make(spark, root, days=1)
    for aggs, keys in [
        ({"x": ("avg", "velocidad")}, []),
        ({"x": ("sum", "ts")}, []),
        ({"x": ("sum", None)}, []),
        ({"x": ("max", "auto_id")}, []),
        (AGGS, ["velocidad"]),
    ]:
        with pytest.raises(ValueError):
            aggregate_range(t, T0, T0 + DAY, aggs, keys)


def test_many_rewrites_leave_few_folders(spark, root, monkeypatch):
    monkeypatch.setattr(synopsis, "_MOST_FOLDERS", 2)
    t = make(spark, root, days=3)
    for i in t.chunk_ids():
        compress_chunks(t, [i])
    few(spark, t, (1, T0 + DAY / 3, "5.5"))
    compress_chunks(t, t.chunk_ids())
    assert len(t.folder.names("_synopsis/*")) <= 3
    got = same(t, T0, T0 + 3 * DAY, ["auto_id"])
    assert not [p for p in got.inputFiles() if "/load=" in p]


# -- recompaction by key range ----------------------------------------------------------------


def names(t, chunk):
    return {name for c, _, name, _ in t.files_read(t.read_chunks([chunk]))}


def in_order(t, chunk):
    """Every file is sorted by vehicle, latest first, and the files' ranges do not overlap."""
    ranges = []
    for _, _, _, path in t.files_read(t.read_chunks([chunk])):
        rows = [(r["auto_id"], -r["ts"].timestamp()) for r in t.read_paths([path]).collect()]
        assert rows == sorted(rows)
        ranges.append((rows[0], rows[-1]))
    ranges.sort()
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:], strict=False))


@pytest.mark.parametrize("verify", ["hashes", "counts", "off"])
def test_overflow_rewrites_the_files_it_meets(spark, root, verify):
    t = make(spark, root, days=2, every=5)
    a, b = t.chunk_ids()
    compress_chunks(t, [a, b], target_file_bytes=4000)
    before = names(t, a)
    assert len(before) >= 4
    rows = sorted(map(repr, t.scan().collect()))
    # Five rows of one vehicle, at instants of one file.
    extra = [(5, T0 + DAY / 2 + dt.timedelta(seconds=i), f"{i}.5") for i in range(5)]
    few(spark, t, *extra)
    compress_chunks(t, [a, b], verify=verify, target_file_bytes=40_000)
    after = names(t, a)
    assert len(before & after) == len(before) - 1 and len(after - before) == 1
    in_order(t, a)
    assert t.chunks([a]).first()["overflow_rows"] == 0
    assert len(t.scan().collect()) == len(rows) + 5
    same(t, T0, T0 + 2 * DAY, ["auto_id"])
    assert {r["load"] for r in t.read_chunks([a]).select("load").distinct().collect()} == set(
        t.folder.loads(f"chunk_id={a}")[a]
    )


def test_rows_before_all_and_after_all_files_find_one(spark, root):
    t = make(spark, root, days=1, every=5)
    (a,) = t.chunk_ids()
    compress_chunks(t, [a], target_file_bytes=4000)
    few(spark, t, (0, T0, "1.0"), (99, T0, "2.0"), (1, T0 + DAY - dt.timedelta(seconds=1), None))
    n = t.scan().count()
    compress_chunks(t, [a], target_file_bytes=40_000)
    assert t.scan().count() == n
    in_order(t, a)
    same(t, T0, T0 + DAY, ["auto_id"])


def test_much_overflow_rewrites_the_chunk(spark, root):
    t = make(spark, root, days=1, every=5)
    (a,) = t.chunk_ids()
    compress_chunks(t, [a], target_file_bytes=4000)
    before = names(t, a)
    t.append(t.scan().withColumn("velocidad", F.lit("1.0").cast("decimal(6,1)")), "second")
    compress_chunks(t, [a], target_file_bytes=4000)
    assert not before & names(t, a)
    in_order(t, a)


def test_a_merge_that_dies_half_way_is_carried_on(spark, root, monkeypatch):
    t = make(spark, root, days=1, every=5)
    (a,) = t.chunk_ids()
    compress_chunks(t, [a], target_file_bytes=4000)
    before = names(t, a)
    few(spark, t, (5, T0 + DAY / 2, "7.5"))
    rows = sorted(map(repr, t.scan().collect()))
    real, calls = t.folder.rename, []

    def failing(old, new):
        calls.append(old)
        if len(calls) > r:
            raise OSError("gone")
        real(old, new)

    for r in random.Random(1).sample(range(2, 6), 3):
        calls.clear()
        monkeypatch.setattr(t.folder, "rename", failing)
        with pytest.raises(OSError):
            compress_chunks(t, [a], target_file_bytes=40_000)
        monkeypatch.setattr(t.folder, "rename", real)
        t.recover()
        assert sorted(map(repr, t.scan().collect())) == rows
        if t.chunks([a]).first()["overflow_rows"] == 0:
            break
    compress_chunks(t, [a], target_file_bytes=40_000)
    assert sorted(map(repr, t.scan().collect())) == rows
    assert len(before & names(t, a)) == len(before) - 1
    in_order(t, a)


def test_few_lists_for_a_short_range(spark, root, monkeypatch):
    t = make(spark, root, days=4)
    asked = []
    real = t.folder.matches
    monkeypatch.setattr(t.folder, "matches", lambda p: asked.append(p) or real(p))
    assert t.scan(T0 + DAY, T0 + 2 * DAY).count() == 12 * 48
    assert t.scan(T0 - 30 * DAY, T0 - 2 * DAY).count() == 0
    assert not asked
    assert t.scan(T0 - 300 * DAY, T0 + DAY).count() == 12 * 48
    assert asked == ["chunk_id=*"]
