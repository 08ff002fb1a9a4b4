"""Synopses, keys, rollups kept by what was added, chunks under LATERAL, filled values."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidevault.functions.buckets import downsample, gapfill
from tidevault.functions.filling import carry_forward, time_weighted
from tidevault.functions.times import from_micros, to_micros
from tidevault.operators.catalogue import create_functions
from tidevault.operators.chunks import ChunkedTable
from tidevault.operators.compact import compress_chunks
from tidevault.operators.reports import with_readable_size
from tidevault.operators.rollup import SKETCH_ERROR, Rollup, refresh_chain
from tidevault.operators.synopsis import aggregate_range
from tidevault.plans.registry import (
    TELE,
    VEL_MEAN,
    dbl,
    empty_table,
    loaded_table,
    query,
    readings,
    shared_table,
)
from tidevault.plans.stream_queries import _arrivals, _late, _stream
from tidevault.plans.table_queries import (
    _BATCH,
    _BATCH_COLUMNS,
    _BIG,
    _CHUNK,
    _LATE,
    _PER_CHUNK,
    _PLUS_BATCH,
    _VIEW,
    _late_rows,
    _per_chunk,
    _shown,
)
from tidevault.session import work_dir
from tidevault.streaming.ingest import stream_with_late

# Errors are read once more after compaction, so some chunks have overflow.
_TWICE = f"""{TELE}, twice AS (SELECT * FROM tele UNION ALL SELECT * FROM tele WHERE event_type = 'error'),
    edges AS (SELECT date_trunc('day', min(ts)) + INTERVAL '29 hours' AS lo,
                     date_trunc('day', max(ts)) - INTERVAL '7 hours' AS hi FROM tele)"""


@query(
    f"""WITH {_TWICE} SELECT auto_id, count(*) AS lecturas, count(revoluciones) AS conocidas,
          CAST(sum(CAST(velocidad * 100 AS BIGINT)) AS BIGINT) AS centimos,
          CAST(min(velocidad) AS DOUBLE) AS vel_min, CAST(max(velocidad) AS DOUBLE) AS vel_max,
          max(ts) AS ultima
        FROM twice, edges WHERE ts >= lo AND ts < hi GROUP BY 1"""
)
def agg_from_synopsis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures per vehicle of all but the edges of the month, from synopses and overflow."""
    t = loaded_table(spark, sf_dir, "synopsis", "1 day")
    compress_chunks(t, t.chunk_ids())
    t.append(readings(spark, sf_dir).where("event_type = 'error'"), "again")
    day = lambda at: at.replace(hour=0, minute=0, second=0, microsecond=0)
    lo, hi = day(t.min_ts()) + dt.timedelta(hours=29), day(t.max_ts()) - dt.timedelta(hours=7)
    aggs = {
        "lecturas": ("count", None),
        "conocidas": ("count", "revoluciones"),
        "total": ("sum", "velocidad"),
        "vel_min": ("min", "velocidad"),
        "vel_max": ("max", "velocidad"),
        "ultima": ("max", "ts"),
    }
    out = aggregate_range(t, lo, hi, aggs, ["auto_id"])
    return out.select(
        "auto_id",
        "lecturas",
        "conocidas",
        (F.col("total") * 100).cast("long").alias("centimos"),
        dbl("vel_min").alias("vel_min"),
        dbl("vel_max").alias("vel_max"),
        "ultima",
    )


@query(
    f"""WITH {_PLUS_BATCH} {_PER_CHUNK}, CAST(0 AS BIGINT) AS overflow_rows FROM plus GROUP BY ALL"""
)
def recompact_by_key_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overflow taken into the files whose key ranges it meets; all rows are still there."""
    t = loaded_table(spark, sf_dir, "merged")
    compress_chunks(t, t.chunk_ids(), target_file_bytes=4 << 10)
    t.append_rows(_BATCH, _BATCH_COLUMNS)
    compress_chunks(t, t.chunk_ids(), target_file_bytes=64 << 10)
    return _per_chunk(t).join(t.chunks().select("chunk_id", "overflow_rows"), "chunk_id")


@query(
    f"""WITH {TELE} SELECT {_BIG} AS chunk_id, true AS same_rows, true AS fewer_files,
          true AS ratio_holds FROM tele GROUP BY 1"""
)
def compaction_sizes_hold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of a compaction against the chunks as they are afterwards."""
    t = loaded_table(spark, sf_dir, "hold")
    report = compress_chunks(t, t.chunk_ids())
    after = t.chunks().select("chunk_id", "n_rows", "n_files", "bytes", "is_compressed")
    return report.join(after, "chunk_id").select(
        "chunk_id",
        ((F.col("rows_before") == F.col("n_rows")) & F.col("is_compressed")).alias("same_rows"),
        (F.col("n_files") <= F.col("files_before")).alias("fewer_files"),
        (
            (F.col("bytes") == F.col("bytes_after"))
            & (F.abs(F.col("ratio") * F.col("bytes") - F.col("bytes_before")) <= 0.006 * F.col("bytes"))
        ).alias("ratio_holds"),
    )


@query(
    f"""WITH {TELE} SELECT {_CHUNK} AS chunk_id, true AS bytes_hold, true AS size_holds
        FROM tele GROUP BY 1"""
)
def chunk_sizes_hold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue's bytes against the lengths of the files themselves."""
    t = shared_table(spark, sf_dir)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
    files = files.option("recursiveFileLookup", "true").load(f"{t.root}/chunk_id=*").select("path", "length")
    chunk = F.regexp_extract("path", "chunk_id=(-?[0-9]+)", 1).cast("long").alias("chunk_id")
    found = files.groupBy(chunk).agg(F.sum("length").alias("found"))
    shown = with_readable_size(t.chunks()).join(found, "chunk_id")
    number = F.regexp_extract("size", "^([0-9]+)", 1).cast("double")
    scale = F.when(F.col("size").endswith("bytes"), 1).when(F.col("size").endswith("kB"), 1 << 10)
    scale = scale.when(F.col("size").endswith("MB"), 1 << 20).otherwise(1 << 30)
    return shown.select(
        "chunk_id",
        (F.col("bytes") == F.col("found")).alias("bytes_hold"),
        (F.abs(number * scale - F.col("bytes")) <= scale / 2).alias("size_holds"),
    )


# -- rollups kept by what was added ---------------------------------------------------------

_PLUS = f"{TELE}, {_LATE}, plus AS (SELECT * FROM tele UNION ALL SELECT * FROM late)"


def _after(t: ChunkedTable) -> dt.datetime:
    return from_micros(to_micros(t.max_ts()) + 7_200_000_000)


def _hourly(t: ChunkedTable, spark: SparkSession, **options) -> Rollup:
    return Rollup(t, work_dir(spark, "hourly"), "1 hour", ["event_type"], {"velocidad": "vel"}, **options)


@query(f"WITH {_PLUS} {_VIEW} FROM plus GROUP BY 1, 2")
def rollup_merge_added(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late rows read alone and merged into the figures that are there."""
    t = loaded_table(spark, sf_dir, "added")
    r = _hourly(t, spark).build()
    t.append(_late_rows(spark, sf_dir), "late")
    r.refresh_due(_after(t), "1200 months")
    return _shown(r.view())


@query(
    f"""WITH {_PLUS} SELECT time_bucket(INTERVAL '1 day', ts) AS hora, event_type, count(*) AS lecturas,
          {VEL_MEAN} AS vel_media, CAST(round(max(velocidad), 1) AS DOUBLE) AS vel_max,
          CAST(round(min(velocidad), 1) AS DOUBLE) AS vel_min
        FROM plus GROUP BY 1, 2"""
)
def rollup_daily_of_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily figures from hourly ones, after a late load that went through both."""
    t = loaded_table(spark, sf_dir, "chain")
    hourly = _hourly(t, spark).build()
    daily = Rollup(hourly, work_dir(spark, "daily"), "1 day", ["event_type"], {"velocidad": "vel"}).build()
    t.append(_late_rows(spark, sf_dir), "late")
    refresh_chain([hourly, daily], from_micros(to_micros(t.max_ts()) + 172_800_000_000), "1200 months")
    return _shown(daily.view())


@query(
    f"""WITH {_PLUS} SELECT time_bucket(INTERVAL '1 day', ts) AS hora, event_type,
          count(DISTINCT auto_id) AS autos, true AS dentro
        FROM plus GROUP BY 1, 2"""
)
def rollup_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily vehicles from hourly sketches, with the exact counts and whether they agree within
    four standard errors and a half."""
    t = loaded_table(spark, sf_dir, "sketch")
    hourly = _hourly(t, spark, distinct={"auto_id": "autos"}).build()
    daily = Rollup(hourly, work_dir(spark, "days"), "1 day", ["event_type"], {}, distinct={"auto_id": "autos"})
    daily.build()
    t.append(_late_rows(spark, sf_dir), "late")
    refresh_chain([hourly, daily], from_micros(to_micros(t.max_ts()) + 172_800_000_000), "1200 months")
    exact = downsample(t.scan(), "1 day", {"autos": F.countDistinct("auto_id")}, "hora", ["event_type"])
    off = F.abs(F.col("autos_distintos") - F.col("autos"))
    within = off <= 4.5 * SKETCH_ERROR * F.col("autos") + 0.5
    both = daily.view().join(exact, ["hora", "event_type"], "full")
    return both.select("hora", "event_type", "autos", F.coalesce(within, F.lit(False)).alias("dentro"))


@query(
    f"""WITH {TELE}, v AS ({_VIEW}, count(*) FILTER (event_type = 'error'
            AND ts < TIMESTAMP '2024-01-16') AS tarde FROM tele GROUP BY 1, 2)
        SELECT * FROM v WHERE hora < (SELECT date_trunc('hour', max(ts) - INTERVAL '1 hour') FROM tele)"""
)
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed buckets of a stream, and how many of their rows came after they had closed."""
    folder, rows = _arrivals(spark, sf_dir, "latearrive")
    t, late = empty_table(spark, sf_dir, "latesource"), empty_table(spark, sf_dir, "late")
    r = _hourly(t, spark)
    parts = _late(rows)
    for part in (False, True):
        parts.where(F.col("_late") == part).drop("_late").write.mode("append").parquet(folder)
        stream = _stream(spark, folder, rows.schema)
        stream_with_late(stream, r, late, "in", f"{t.root}/_progress").awaitTermination()
    behind = downsample(late.scan(), "1 hour", {"tarde": F.count(F.lit(1))}, "hora", ["event_type"])
    return _shown(r.view()).join(behind, ["hora", "event_type"], "left").fillna(0, ["tarde"])


# -- keys and catalogues --------------------------------------------------------------------


@query(
    f"""WITH {TELE}, k AS (SELECT *, count(*) OVER (PARTITION BY auto_id, ts) AS n FROM tele)
        SELECT 'table' AS donde, {_BIG} AS chunk_id, count(*) AS filas FROM k WHERE n = 1 GROUP BY ALL
        UNION ALL
        SELECT 'stored', {_BIG}, count(*) FROM k WHERE n = 1 AND event_type <> 'error' GROUP BY ALL
        UNION ALL
        SELECT 'repeated', {_BIG}, count(*) FROM k WHERE n > 1 GROUP BY ALL"""
)
def append_with_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second append that repeats most keys of the first: what came in, and the rejects."""
    like = empty_table(spark, sf_dir, "unkeyed")
    t = ChunkedTable(
        spark, work_dir(spark, "keyed"), like.schema, "ts", "3 days", ["auto_id"], key=["auto_id", "ts"]
    ).create()
    rows = readings(spark, sf_dir)
    once = rows.join(rows.groupBy("auto_id", "ts").count().where("count = 1"), ["auto_id", "ts"], "left_semi")
    t.append(once.where("event_type <> 'error'"), "most")
    t.append(rows, "all")
    kept = t.read_chunks().select(F.lit("table").alias("donde"), "chunk_id")
    out = t.rejects("all").select(F.col("reason").alias("donde"), t.id_column(F.col("ts")).alias("chunk_id"))
    return kept.unionByName(out).groupBy("donde", "chunk_id").agg(F.count(F.lit(1)).alias("filas"))


@query(
    f"""WITH {TELE}, c AS (
          SELECT DISTINCT 'day' AS tabla, {_CHUNK} AS chunk_id, 86400000000 AS us FROM tele
          UNION ALL SELECT DISTINCT 'three', {_BIG}, 3 * 86400000000 FROM tele)
        SELECT tabla, chunk_id, make_timestamp(chunk_id * us) AS range_start,
               make_timestamp((chunk_id + 1) * us) AS range_end
        FROM c, (SELECT date_trunc('day', max(ts)) - INTERVAL '10 days' AS cut FROM tele)
        WHERE tabla = 'day' OR (chunk_id + 1) * us < epoch_us(cut)"""
)
def lateral_show_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chunks of each table that a row of another table names, up to its own bound."""
    three = loaded_table(spark, sf_dir, "three")
    create_functions({"day": shared_table(spark, sf_dir), "three": three})
    cut = three.max_ts().replace(hour=0, minute=0, second=0, microsecond=0) - dt.timedelta(days=10)
    asked = [("day", None), ("three", str(cut)), ("none", None)]
    spark.createDataFrame(asked, "tabla string, cut string").createOrReplaceTempView("asked_chunks")
    return spark.sql(
        """SELECT a.tabla, c.chunk_id, CAST(c.range_start AS TIMESTAMP_NTZ) AS range_start,
                  CAST(c.range_end AS TIMESTAMP_NTZ) AS range_end
           FROM asked_chunks a, LATERAL show_chunks(a.tabla, CAST(a.cut AS TIMESTAMP)) c"""
    )


# -- filled values --------------------------------------------------------------------------


@query(
    f"""WITH {TELE}, agg AS (SELECT time_bucket(INTERVAL '1 hour', ts) AS hora, auto_id,
          CAST(max(velocidad) AS DOUBLE) AS vel_max FROM tele GROUP BY 1, 2),
        grid AS (SELECT h.hora, k.auto_id
          FROM (SELECT unnest(generate_series((SELECT min(hora) FROM agg), (SELECT max(hora) FROM agg),
                INTERVAL '1 hour')) AS hora) h, (SELECT DISTINCT auto_id FROM agg) k)
        SELECT hora, auto_id, last_value(vel_max IGNORE NULLS) OVER (
          PARTITION BY auto_id ORDER BY hora ROWS UNBOUNDED PRECEDING) AS vel_max
        FROM grid LEFT JOIN agg USING (hora, auto_id)"""
)
def gapfill_carried(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vehicle's last known highest speed for every hour between the first and the last."""
    agg = downsample(
        readings(spark, sf_dir), "1 hour", {"vel_max": dbl(F.max("velocidad"))}, "hora", ["auto_id"]
    )
    grid = gapfill(agg, "hora", "1 hour", keys=["auto_id"])
    return carry_forward(grid, "hora", "1 hour", ["auto_id"], ["vel_max"], 168)


@query(
    f"""WITH {TELE}, lim AS (SELECT date_trunc('day', min(ts)) + INTERVAL '36 hours' AS lo,
                                    date_trunc('hour', max(ts)) AS hi FROM tele),
        r AS (SELECT auto_id, ts, max(velocidad) AS v FROM tele, lim
              WHERE velocidad IS NOT NULL AND ts < hi GROUP BY 1, 2),
        steps AS (SELECT auto_id, ts, v, coalesce(lead(ts) OVER (PARTITION BY auto_id ORDER BY ts), hi) AS until
                  FROM r, lim),
        days AS (SELECT unnest(generate_series(time_bucket(INTERVAL '1 day', lo - INTERVAL '1 microsecond')
                   + INTERVAL '1 day', hi - INTERVAL '1 microsecond', INTERVAL '1 day')) AS dia FROM lim),
        grid AS (SELECT dia, auto_id FROM days, (SELECT DISTINCT auto_id FROM r)),
        parts AS (SELECT dia, auto_id, v, epoch_us(least(until, dia + INTERVAL '1 day', hi))
                         - epoch_us(greatest(ts, dia)) AS us
                  FROM steps, days, lim WHERE ts < dia + INTERVAL '1 day' AND until > dia),
        sums AS (SELECT dia, auto_id, sum(CAST(v * 100 AS BIGINT) * us) AS w, sum(us) AS us
                 FROM parts WHERE us > 0 GROUP BY 1, 2)
        SELECT dia, auto_id, CAST(w AS BIGINT) AS ponderado, CAST(us AS BIGINT) AS micros
        FROM grid LEFT JOIN sums USING (dia, auto_id)"""
)
def time_weighted_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Speed times how long it held, per vehicle and day; each reading holds until the next."""
    t = shared_table(spark, sf_dir)
    first, last = t.min_ts(), t.max_ts()
    lo = first.replace(hour=0, minute=0, second=0, microsecond=0) + dt.timedelta(hours=36)
    hi = last.replace(minute=0, second=0, microsecond=0)
    out = time_weighted(t.scan(end=hi), "1 day", lo, hi, "velocidad", ["auto_id"], bucket="dia", block=10)
    return out.select("dia", "auto_id", (F.col("weighted") * 100).cast("long").alias("ponderado"), "micros")
