"""Keys against stored rows, chunk catalogues under LATERAL, carried and weighted values."""

import datetime as dt
import random

import pytest
from plans import explained, rows_scanned
from pyspark.sql import functions as F

from tidevault import KPI, TELEMETRY, ChunkedTable, compress_chunks
from tidevault.functions.buckets import gapfill
from tidevault.functions.filling import carry_forward, time_weighted
from tidevault.operators.catalogue import create_functions
from tidevault.operators.keys import bloom_options
from tidevault.schemas import KPI_KEY

T0 = dt.datetime(2026, 5, 1)
H = dt.timedelta(hours=1)


def keyed(spark, root, interval="1 day"):
    return ChunkedTable(spark, root, KPI, "ventana", interval, ["auto_id"], key=KPI_KEY).create()


def kpis(spark, *rows):
    df = spark.createDataFrame([(str(t), a, n) for t, a, n in rows], "ventana string, auto_id int, lecturas int")
    return df.select(
        F.col("ventana").cast("timestamp").alias("ventana"),
        "auto_id",
        "lecturas",
        F.lit("1.0").cast("decimal(6,1)").alias("vel_max"),
        F.lit(5).alias("rpm_max"),
    )


def held(t):
    return sorted((r["ventana"], r["auto_id"], r["lecturas"]) for r in t.scan().collect())


def test_a_stored_key_goes_to_the_rejects(spark, root):
    t = keyed(spark, root)
    t.append(kpis(spark, (T0, 1, 10), (T0, 2, 20), (T0 + 30 * H, 1, 30)), "a")
    t.append(kpis(spark, (T0, 1, 99), (T0 + H, 1, 40), (T0 + 30 * H, 2, 50), (T0, 7, 1), (T0, 7, 2)), "b")
    assert held(t) == sorted(
        [(T0, 1, 10), (T0, 2, 20), (T0 + 30 * H, 1, 30), (T0 + H, 1, 40), (T0 + 30 * H, 2, 50)]
    )
    out = {(r["auto_id"], r["lecturas"], r["reason"]) for r in t.rejects("b").collect()}
    assert out == {(1, 99, "stored"), (7, 1, "repeated"), (7, 2, "repeated")}
    assert t.rejects("a").count() == 0 and t.rejects().count() == 3


def test_a_repeated_append_decides_the_same(spark, root):
    t = keyed(spark, root)
    t.append(kpis(spark, (T0, 1, 10)), "a")
    batch = kpis(spark, (T0, 1, 99), (T0 + H, 1, 40))
    t.append(batch, "b")
    want = held(t)
    t.append(batch, "b")
    assert held(t) == want and t.rejects("b").count() == 1
    compress_chunks(t, t.chunk_ids())
    t.append(batch, "b")
    assert held(t) == want and t.rejects("b").count() == 1
    t.append(batch, "c")  # another load of the same rows brings none
    assert held(t) == want and t.rejects("c").count() == 2


def test_other_chunks_and_row_groups_stay_unopened(spark, root, monkeypatch):
    t = keyed(spark, root)
    rows = [(T0 + i * H, a, i) for i in range(24 * 4) for a in range(1, 30, 2)]
    t.append(kpis(spark, *rows), "a")
    asked, plans = [], []
    real = t.read_chunks

    def told(ids=None):
        asked.append(ids)
        df = real(ids)
        plans.append(df)
        return df

    monkeypatch.setattr(t, "read_chunks", told)
    t.append(kpis(spark, (T0 + 50 * H, 4, 1), (T0 + 50 * H, 3, 1)), "b")
    assert asked == [[t.id_of(int((T0 + 50 * H).replace(tzinfo=dt.timezone.utc).timestamp() * 1e6))]]
    monkeypatch.undo()
    assert t.rejects("b").count() == 1 and t.scan().count() == len(rows) + 1
    # A value between a file's least and greatest that the file does not hold: no row group is read.
    files = t.read_paths([f"{t.root}/chunk_id={t.chunk_ids()[0]}/load=a"])
    assert rows_scanned(files.where(F.col("auto_id").isin([4]))) == 0
    assert rows_scanned(files.where(F.col("auto_id").isin([3]))) > 0
    assert bloom_options(KPI_KEY, "ventana") == {"parquet.bloom.filter.enabled#auto_id": "true"}


def test_the_definition_holds_the_key(spark, root):
    t = keyed(spark, root)
    assert ChunkedTable.open(spark, root).key == KPI_KEY == keyed(spark, root).key == t.key
    with pytest.raises(ValueError, match="other key"):
        ChunkedTable(spark, root, KPI, "ventana", "1 day", ["auto_id"]).create()
    with pytest.raises(ValueError, match="ventana"):
        ChunkedTable(spark, root, KPI, "ventana", "1 day", key=["auto_id"])


def test_nulls_in_a_key_are_equal(spark, root):
    t = ChunkedTable(spark, root, TELEMETRY, "ts", "1 day", key=["ts", "velocidad"]).create()
    names = ["auto_id", "ts", "velocidad"]
    t.append_rows([(1, str(T0), None), (1, str(T0), "2.0")], names)
    t.append_rows([(2, str(T0), None), (2, str(T0), "3.0")], names)
    assert {(r["auto_id"], r["velocidad"] and float(r["velocidad"])) for r in t.scan().collect()} == {
        (1, None),
        (1, 2.0),
        (2, 3.0),
    }


# -- chunks under LATERAL -----------------------------------------------------------------


def test_show_chunks_per_row_of_another_table(spark, root):
    a = keyed(spark, f"{root}/a")
    b = keyed(spark, f"{root}/b", "6 hours")
    rows = kpis(spark, *[(T0 + i * 6 * H, 1, i) for i in range(8)])
    a.append(rows, "x")
    b.append(rows, "x")
    compress_chunks(b, b.chunk_ids()[:2])
    create_functions({"a": a, "b": b})
    asked = [("a", None), ("b", str(T0 + 24 * H)), ("c", None)]
    spark.createDataFrame(asked, "name string, until string").createOrReplaceTempView("asked_for")
    got = spark.sql(
        """SELECT t.name, c.chunk_id, c.range_start, c.range_end
           FROM asked_for t, LATERAL show_chunks(t.name, CAST(t.until AS TIMESTAMP)) c"""
    ).collect()
    want = [("a", r) for r in a.show_chunks().collect()]
    want += [("b", r) for r in b.show_chunks(older_than=T0 + 24 * H).collect()]
    assert {(r["name"], r["chunk_id"]) for r in got} == {(n, r["chunk_id"]) for n, r in want}
    assert len([r for r in got if r["name"] == "b"]) == 3
    newer = spark.sql("SELECT * FROM show_chunks('b', newer_than => TIMESTAMP '2026-05-02 00:00:00')").count()
    assert newer == b.show_chunks(newer_than="2026-05-02").count() == 3
    sizes = spark.sql(
        """SELECT t.name, sum(s.n_rows) AS n, count_if(s.is_compressed) AS done
           FROM asked_for t, LATERAL chunk_sizes(t.name) s GROUP BY t.name"""
    ).collect()
    assert {tuple(r) for r in sizes} == {("a", 8, 0), ("b", 8, 2)}
    assert "Cartesian" not in explained(spark.sql("SELECT * FROM asked_for t, LATERAL show_chunks(t.name) c"))


# -- carried and weighted values ------------------------------------------------------------


def readings(spark, seed, keys=3, n=120, span=300):
    r = random.Random(seed)
    rows = []
    for k in [*range(keys), None]:
        for _ in range(n if k != 1 else 4):
            at = T0 + dt.timedelta(minutes=r.randrange(-200, span * 10), seconds=r.choice([0, 0, 30]))
            rows.append((k, at, r.choice([None, r.randrange(100), r.randrange(100)])))
    return rows, spark.createDataFrame(rows, "k int, ts timestamp_ntz, v int")


@pytest.mark.parametrize("block", [1, 3, 50, 4096])
def test_values_are_carried_over_blocks(spark, block):
    rows, df = readings(spark, block)
    hourly = df.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("h"), "k").agg(
        F.max("v").alias("v"), F.min("v").alias("w")
    )
    grid = gapfill(hourly, "h", "1 hour", T0, T0 + 60 * H, ["k"])
    got = {(r["k"], r["h"]): (r["v"], r["w"]) for r in carry_forward(grid, "h", "1 hour", ["k"], ["v", "w"], block).collect()}
    before = sorted(((r["k"] is None, r["k"] or 0), r["h"], r["v"], r["w"]) for r in grid.collect() if r["v"] is not None)
    assert len(got) == grid.count() == 60 * len({r[0] for r in rows})
    for (k, h), values in got.items():
        known = [x[2:] for x in before if x[0] == (k is None, k or 0) and x[1] <= h]
        assert values == (known[-1] if known else (None, None))


def test_a_long_gap_of_one_key_is_no_single_window(spark):
    one = spark.createDataFrame([(1, T0, 7), (1, T0 + 20_000 * H, 9)], "k int, h timestamp_ntz, v int")
    grid = gapfill(one, "h", "1 hour", T0, T0 + 20_001 * H, ["k"])
    out = carry_forward(grid, "h", "1 hour", ["k"], ["v"], 512)
    assert {r["v"]: r["count"] for r in out.groupBy("v").count().collect()} == {7: 20_000, 9: 1}
    plan = explained(out)
    assert plan.count("Window") >= 2 and "_block" in plan


def weigh(rows, lo, hi, width):
    out = {}
    for k in {r[0] for r in rows}:
        steps = {}
        for kk, t, v in rows:
            if kk == k and v is not None and t < hi:
                steps[t] = max(v, steps.get(t, v))
        steps = sorted(steps.items())
        at = lo
        while at < hi:
            end, total, micros = min(at + width, hi), 0, 0
            for i, (t, v) in enumerate(steps):
                until = steps[i + 1][0] if i + 1 < len(steps) else hi
                a, b = max(t, at), min(until, end)
                if a < b:
                    us = (b - a) // dt.timedelta(microseconds=1)
                    total, micros = total + v * us, micros + us
            out[k, at] = (total, micros) if micros else (None, None)
            at += width
    return out


@pytest.mark.parametrize("seed,block", [(1, 2), (2, 4096), (3, 7)])
def test_time_weights(spark, seed, block):
    rows, df = readings(spark, seed, n=40, span=200)
    lo, hi = T0, T0 + 33 * H + dt.timedelta(minutes=20)
    out = time_weighted(df, "1 hour", lo, hi, "v", ["k"], block=block).collect()
    got = {(r["k"], r["bucket"]): (r["weighted"] and int(r["weighted"]), r["micros"]) for r in out}
    want = {k: (w and int(w), m) for k, (w, m) in weigh(rows, lo, hi, H).items()}
    assert {k: (w or 0, m) for k, (w, m) in got.items()} == {k: (w or 0, m) for k, (w, m) in want.items()}


def test_time_weights_without_keys_and_without_rows(spark):
    rows, df = readings(spark, 9, keys=1, n=30, span=100)
    out = time_weighted(df.where("k = 0"), "2 hours", T0, T0 + 10 * H, "v").collect()
    want = weigh([r for r in rows if r[0] == 0], T0, T0 + 10 * H, 2 * H)
    assert {(0, r["bucket"]): (int(r["weighted"] or 0), r["micros"]) for r in out} == {
        k: (w or 0, m) for k, (w, m) in want.items()
    }
    assert time_weighted(df.where("false"), "2 hours", T0, T0 + 10 * H, "v", ["k"]).count() == 0
