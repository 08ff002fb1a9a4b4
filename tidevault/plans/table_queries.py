"""Chunked tables: scans, catalogue, compaction, retention, rollups, KPI, lifecycle."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidevault.functions.buckets import downsample
from tidevault.functions.sql import register
from tidevault.operators.chunks import ChunkedTable
from tidevault.operators.compact import (
    chunk_starting,
    compact_due,
    compress_chunks,
    oldest_chunks,
)
from tidevault.operators.kpi import KpiSpec, kpi_hour, kpi_read, run_kpi
from tidevault.operators.reports import pruning_report, with_readable_size
from tidevault.operators.retention import drop_chunks, preview, retain
from tidevault.operators.rollup import Rollup
from tidevault.operators.upsert import upsert
from tidevault.plans.lifecycle import LifecycleConfig, kpi_rejects, lifecycle
from tidevault.plans.registry import (
    TELE,
    VEL,
    VEL_MEAN,
    dbl,
    empty_table,
    loaded_table,
    mean,
    query,
    readings,
    shared_table,
    sql_mean,
    table,
)
from tidevault.schemas import split_valid
from tidevault.session import work_dir
from tidevault.sources.load import append_all, bulk_load, insert_each

_DAY_US = 86_400_000_000
_CHUNK = f"epoch_us(ts) // {_DAY_US}"
# Queries that change their table use chunks of three days.
_BIG_US = 3 * _DAY_US
_BIG = f"epoch_us(ts) // {_BIG_US}"
_STARTS = f"make_timestamp(chunk_id * {_DAY_US})"
_ENDS = f"make_timestamp((chunk_id + 1) * {_DAY_US})"


def _n():
    return F.count(F.lit(1))


# -- ranges ---------------------------------------------------------------------


@query(f"WITH {TELE} SELECT min(ts) AS min_ts, max(ts) AS max_ts, count(*) AS total FROM tele")
def extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_table(spark, sf_dir).extent()


@query(
    f"""WITH {TELE} SELECT count(*) AS filas FROM tele
        WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-11'"""
)
def range_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_table(spark, sf_dir).scan("2024-01-10", "2024-01-11").agg(_n().alias("filas"))


@query(
    f"""WITH {TELE} SELECT auto_id, ts, event_type, CAST(velocidad AS DOUBLE) AS velocidad
        FROM tele WHERE ts >= TIMESTAMP '2024-01-10 06:00:00' AND ts < TIMESTAMP '2024-01-12 18:00:00'"""
)
def chunk_range_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shared_table(spark, sf_dir).scan("2024-01-10 06:00", "2024-01-12 18:00")
    return rows.select("auto_id", "ts", "event_type", dbl("velocidad").alias("velocidad"))


@query(
    f"""WITH {TELE} SELECT count(*) AS ultimas_24h,
          count(DISTINCT date_trunc('hour', ts)) AS horas_distintas
        FROM tele WHERE ts > (SELECT max(ts) FROM tele) - INTERVAL '24 hours'
                    AND ts <= (SELECT max(ts) FROM tele)"""
)
def last_24h(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shared_table(spark, sf_dir).last("24 hours")
    return rows.agg(
        _n().alias("ultimas_24h"),
        F.countDistinct(F.date_trunc("hour", "ts")).alias("horas_distintas"),
    )


@query(
    f"""WITH {TELE} SELECT count(*) AS filas FROM tele
        WHERE ts >= (SELECT max(ts) FROM tele) - INTERVAL '24 hours'
          AND ts <= (SELECT max(ts) FROM tele)"""
)
def last_24h_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_table(spark, sf_dir).last("24 hours", "both").agg(_n().alias("filas"))


@query(
    f"""WITH {TELE} SELECT time_bucket(INTERVAL '1 hour', ts) AS hora, count(*) AS lecturas,
          {VEL_MEAN} AS vel_media, CAST(max(velocidad) AS DOUBLE) AS vel_max
        FROM tele
        WHERE ts >= (SELECT date_trunc('day', max(ts)) FROM tele) - INTERVAL '1 day'
          AND ts < (SELECT date_trunc('day', max(ts)) FROM tele)
        GROUP BY 1 ORDER BY 1"""
)
def last_full_day_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    aggs = {"lecturas": _n(), "vel_media": mean("velocidad"), "vel_max": dbl(F.max("velocidad"))}
    rows = shared_table(spark, sf_dir).last_full_day()
    return downsample(rows, "1 hour", aggs, "hora").orderBy("hora")


@query(
    f"""WITH {TELE} SELECT time_bucket(INTERVAL '1 day', ts) AS dia, count(*) AS lecturas,
          {VEL_MEAN} AS vel_media
        FROM tele WHERE ts >= (SELECT max(ts) FROM tele) - INTERVAL '7 days'
        GROUP BY 1 ORDER BY 1"""
)
def last_7d_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shared_table(spark, sf_dir).last("7 days", "both")
    aggs = {"lecturas": _n(), "vel_media": mean("velocidad")}
    return downsample(rows, "1 day", aggs, "dia").orderBy("dia")


@query(
    f"""WITH {TELE} SELECT count(*) AS filas FROM tele
        WHERE ts > (SELECT max(ts) FROM tele) - INTERVAL '30 days'"""
)
def last_30d_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_table(spark, sf_dir).last("30 days").agg(_n().alias("filas"))


@query(
    f"""WITH {TELE} SELECT auto_id, ts, event_type, revoluciones FROM tele
        WHERE ts = (SELECT max(ts) FROM tele) ORDER BY auto_id"""
)
def chunk_point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = shared_table(spark, sf_dir)
    hit = t.at(t.max_ts()).select("auto_id", "ts", "event_type", "revoluciones")
    return hit.orderBy("auto_id")


@query(
    f"""WITH {TELE} SELECT count(*) AS filas FROM tele
        WHERE time_bucket(INTERVAL '6 hours', ts) = TIMESTAMP '2024-01-12 06:00:00'"""
)
def chunk_bucket_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shared_table(spark, sf_dir).bucket("6 hours", "2024-01-12 06:00")
    return rows.agg(_n().alias("filas"))


@query(
    f"""WITH {TELE} SELECT auto_id, count(*) AS lecturas, CAST(max(velocidad) AS DOUBLE) AS vel_max
        FROM tele WHERE ts > (SELECT max(ts) FROM tele) - INTERVAL '24 hours' GROUP BY 1"""
)
def last_24h_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL over a view: the subqueries on ``chunk_id`` prune folders at run time."""
    t = shared_table(spark, sf_dir)
    t.create_view("lecturas_por_chunk", with_chunk_id=True)
    t.show_chunks().createOrReplaceTempView("lista_de_chunks")
    newest = "(SELECT max(chunk_id) FROM lista_de_chunks)"
    latest = f"(SELECT max(ts) FROM lecturas_por_chunk WHERE chunk_id = {newest})"
    return spark.sql(
        f"""SELECT auto_id, count(*) AS lecturas, CAST(max(velocidad) AS DOUBLE) AS vel_max
            FROM lecturas_por_chunk
            WHERE chunk_id >= {newest} - 1 AND ts > {latest} - INTERVAL '24' HOUR
            GROUP BY auto_id"""
    )


@query(
    f"""WITH {TELE} SELECT time_bucket(INTERVAL '6 hours', ts) AS ventana, count(*) AS lecturas,
          max(revoluciones) AS rpm_max
        FROM tele WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-19'
        GROUP BY 1 ORDER BY 1"""
)
def sql_range_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark)
    shared_table(spark, sf_dir).create_range_function("lecturas_entre")
    return spark.sql(
        """SELECT time_bucket(INTERVAL '6' HOUR, ts) AS ventana, count(*) AS lecturas,
                  max(revoluciones) AS rpm_max
           FROM lecturas_entre(TIMESTAMP_NTZ '2024-01-05', TIMESTAMP_NTZ '2024-01-19')
           GROUP BY 1 ORDER BY 1"""
    )


# -- catalogue --------------------------------------------------------------------


@query(
    f"""WITH {TELE}, c AS (SELECT {_CHUNK} AS chunk_id, count(*) AS n_rows FROM tele GROUP BY 1)
        SELECT chunk_id, {_STARTS} AS range_start, {_ENDS} AS range_end, n_rows,
               false AS is_compressed, CAST(0 AS BIGINT) AS overflow_rows
        FROM c ORDER BY range_start"""
)
def chunk_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        shared_table(spark, sf_dir)
        .chunks()
        .select("chunk_id", "range_start", "range_end", "n_rows", "is_compressed", "overflow_rows")
        .orderBy("range_start")
    )


@query(
    f"""WITH {TELE}, c AS (SELECT {_CHUNK} AS chunk_id, count(*) AS n FROM tele GROUP BY 1),
        r AS (SELECT epoch_us(TIMESTAMP '2024-01-10') // {_DAY_US} AS lo,
                     (epoch_us(TIMESTAMP '2024-01-17') - 1) // {_DAY_US} AS hi)
        SELECT count(*) FILTER (chunk_id BETWEEN lo AND hi) AS chunks_touched,
               count(*) AS chunks_total,
               CAST(sum(n) FILTER (chunk_id BETWEEN lo AND hi) AS BIGINT) AS rows_read,
               CAST(sum(n) AS BIGINT) AS rows_total
        FROM c, r""",
    name="pruning_report",
)
def pruning_report_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = pruning_report(shared_table(spark, sf_dir), "2024-01-10", "2024-01-17")
    return report.select("chunks_touched", "chunks_total", "rows_read", "rows_total")


@query(
    f"""WITH {TELE} SELECT DISTINCT {_CHUNK} AS chunk_id FROM tele
        WHERE ({_CHUNK} + 1) * {_DAY_US} < epoch_us(TIMESTAMP '2024-01-08 12:00:00')"""
)
def show_chunks_older(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = shared_table(spark, sf_dir).show_chunks(older_than="2024-01-08 12:00")
    return listed.select("chunk_id")


@query()
def chunk_sizes_readable(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = with_readable_size(shared_table(spark, sf_dir).chunks())
    return sized.select("chunk_id", "n_files", "bytes", "size").orderBy("chunk_id")


@query(
    f"""WITH {TELE}, c AS (SELECT DISTINCT {_CHUNK} AS chunk_id FROM tele)
        SELECT chunk_id, {_STARTS} AS range_start FROM c ORDER BY chunk_id LIMIT 2"""
)
def oldest_two_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = shared_table(spark, sf_dir)
    listed = t.show_chunks().where(F.col("chunk_id").isin(oldest_chunks(t, 2)))
    return listed.select("chunk_id", "range_start").orderBy("chunk_id")


@query(
    f"""WITH {TELE} SELECT {_CHUNK} AS chunk_id, count(*) AS n_rows FROM tele
        WHERE {_CHUNK} = epoch_us(TIMESTAMP '2024-01-16') // {_DAY_US} GROUP BY 1"""
)
def chunk_by_range_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = shared_table(spark, sf_dir)
    return t.chunks(chunk_starting(t, "2024-01-16")).select("chunk_id", "n_rows")


# -- loading ----------------------------------------------------------------------

# Five readings of one vehicle, a minute apart.
_BATCH = [
    (5, "2024-01-14 12:00:00", Decimal("83.5"), 2200),
    (5, "2024-01-14 12:01:00", Decimal("84.0"), 2250),
    (5, "2024-01-14 12:02:00", Decimal("83.9"), 2300),
    (5, "2024-01-14 12:03:00", Decimal("84.5"), 2350),
    (5, "2024-01-14 12:04:00", Decimal("84.2"), 2400),
]
_BATCH_COLUMNS = ["auto_id", "ts", "velocidad", "revoluciones"]
_BATCH_SQL = ", ".join(
    f"({a}, TIMESTAMP '{t}', CAST(NULL AS VARCHAR), CAST({v} AS DECIMAL(10,2)), {r})"
    for a, t, v, r in _BATCH
)
_PLUS_BATCH = f"{TELE}, plus AS (SELECT * FROM tele UNION ALL SELECT * FROM (VALUES {_BATCH_SQL}))"

_FIGURES = f"""count(*) AS lecturas, CAST(sum({VEL}) AS BIGINT) AS centi_vel,
    CAST(sum(revoluciones) AS BIGINT) AS rpm, count(event_type) AS con_tipo"""
_PER_CHUNK = f"SELECT {_BIG} AS chunk_id, {_FIGURES}"


def _per_chunk(t: ChunkedTable) -> DataFrame:
    return (
        t.read_chunks()
        .groupBy("chunk_id")
        .agg(
            _n().alias("lecturas"),
            F.sum((F.col("velocidad") * 100).cast("long")).alias("centi_vel"),
            F.sum("revoluciones").alias("rpm"),
            F.count("event_type").alias("con_tipo"),
        )
    )


@query(f"WITH {TELE} SELECT {_CHUNK} AS chunk_id, {_FIGURES} FROM tele GROUP BY 1")
def insert_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = empty_table(spark, sf_dir, "inserted", "1 day")
    t.append(readings(spark, sf_dir))
    return _per_chunk(t)


@query(f"WITH {TELE} {_PER_CHUNK} FROM tele GROUP BY 1")
def append_repeated_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = loaded_table(spark, sf_dir, "repeated")
    t.append(readings(spark, sf_dir), "initial")
    return _per_chunk(t)


@query(f"WITH {_PLUS_BATCH} {_PER_CHUNK} FROM plus GROUP BY 1")
def insert_values_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = loaded_table(spark, sf_dir, "values")
    t.append_rows(_BATCH, _BATCH_COLUMNS)
    return _per_chunk(t)


@query(f"WITH {_PLUS_BATCH} {_PER_CHUNK} FROM plus GROUP BY 1")
def insert_row_by_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = loaded_table(spark, sf_dir, "rowwise")
    insert_each(t, _BATCH[:2], _BATCH_COLUMNS)
    rest = T.StructType([T.StructField(c, T.StringType()) for c in _BATCH_COLUMNS])
    one_row_each = [
        spark.createDataFrame([tuple(str(v) for v in row)], rest) for row in _BATCH[2:]
    ]
    append_all(t, one_row_each)
    return _per_chunk(t)


@query(
    f"""WITH {TELE}, plus AS (SELECT * FROM tele UNION ALL
          SELECT auto_id, ts + INTERVAL '30 days', NULL, velocidad, NULL FROM tele)
        {_PER_CHUNK} FROM plus GROUP BY 1"""
)
def insert_partial_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = loaded_table(spark, sf_dir, "partial")
    later = (F.col("ts") + F.expr("INTERVAL '30' DAY")).alias("ts")
    t.append(readings(spark, sf_dir).select("auto_id", later, "velocidad"), "later")
    return _per_chunk(t)


@query(f"WITH {TELE} {_PER_CHUNK} FROM tele GROUP BY 1")
def bulk_load_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = work_dir(spark, "csv")
    readings(spark, sf_dir).write.option("header", "true").csv(files)
    t = empty_table(spark, sf_dir, "bulk")
    bulk_load(t, files, "csv", load="csv")
    return _per_chunk(t)


@query(f"WITH {TELE} {_PER_CHUNK} FROM tele GROUP BY 1")
def bulk_load_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = work_dir(spark, "json")
    readings(spark, sf_dir).write.json(files)
    t = empty_table(spark, sf_dir, "bulkjson")
    bulk_load(t, files, "json", load="json")
    return _per_chunk(t)


@query(
    f"""WITH {TELE} SELECT auto_id, ts, event_type, CAST(velocidad AS DOUBLE) AS velocidad, revoluciones
        FROM tele WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-12'"""
)
def create_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Created again by the same definition, and opened by the stored one."""
    t = loaded_table(spark, sf_dir, "again").create()
    rows = ChunkedTable.open(spark, t.root).scan("2024-01-10", "2024-01-12")
    return rows.withColumn("velocidad", dbl("velocidad"))


# -- compaction --------------------------------------------------------------------


def _state(t: ChunkedTable) -> DataFrame:
    return t.chunks().select("chunk_id", "n_rows", "is_compressed", "overflow_rows")


def _first(n: int) -> str:
    return f"(SELECT min({_BIG}) + {n} FROM tele)"


@query(
    f"""WITH {TELE} {_PER_CHUNK}, {_BIG} < {_first(2)} AS is_compressed FROM tele GROUP BY ALL"""
)
def compact_lossless(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = loaded_table(spark, sf_dir, "lossless")
    compress_chunks(t, oldest_chunks(t, 2))
    flags = t.chunks().select("chunk_id", "is_compressed")
    return _per_chunk(t).join(flags, "chunk_id")


_JAN14 = f"epoch_us(TIMESTAMP '2024-01-14') // {_BIG_US}"


@query(
    f"""WITH {_PLUS_BATCH}
        SELECT {_BIG} AS chunk_id, count(*) AS n_rows, true AS is_compressed,
               CAST(CASE WHEN {_BIG} = {_JAN14} THEN 5 ELSE 0 END AS BIGINT) AS overflow_rows
        FROM plus GROUP BY 1"""
)
def overflow_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = loaded_table(spark, sf_dir, "overflow")
    compress_chunks(t, t.chunk_ids())
    t.append_rows(_BATCH, _BATCH_COLUMNS)
    return _state(t)


@query(
    f"""WITH {_PLUS_BATCH} {_PER_CHUNK}, true AS is_compressed, CAST(0 AS BIGINT) AS overflow_rows
        FROM plus GROUP BY ALL"""
)
def recompact_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = loaded_table(spark, sf_dir, "recompact")
    compress_chunks(t, t.chunk_ids())
    t.append_rows(_BATCH, _BATCH_COLUMNS)
    compress_chunks(t, chunk_starting(t, "2024-01-12"))
    flags = t.chunks().select("chunk_id", "is_compressed", "overflow_rows")
    return _per_chunk(t).join(flags, "chunk_id")


@query(
    f"""WITH {TELE}, cut AS (SELECT epoch_us(max(ts) - INTERVAL '7 days') AS us FROM tele)
        SELECT {_BIG} AS chunk_id, count(*) AS n_rows,
               ({_BIG} + 1) * {_BIG_US} < us AS is_compressed, CAST(0 AS BIGINT) AS overflow_rows
        FROM tele, cut GROUP BY ALL""",
    name="compact_due",
)
def compact_due_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = loaded_table(spark, sf_dir, "due")
    compact_due(t, t.max_ts(), "7 days")
    return _state(t)


@query(
    f"""WITH {TELE} SELECT {_BIG} AS chunk_id, count(*) AS rows_before, count(*) AS rows_after
        FROM tele GROUP BY 1"""
)
def compaction_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = loaded_table(spark, sf_dir, "report")
    return compress_chunks(t, t.chunk_ids()).select("chunk_id", "rows_before", "rows_after")


@query()
def compaction_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = loaded_table(spark, sf_dir, "sizes")
    return compress_chunks(t, t.chunk_ids())


@query(
    f"""WITH {TELE} SELECT 'tele/' || CAST({_BIG} AS VARCHAR) AS chunk_name, count(*) AS n_rows
        FROM tele WHERE {_BIG} < {_first(3)} GROUP BY 1"""
)
def compacted_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = loaded_table(spark, sf_dir, "listing")
    compress_chunks(t, oldest_chunks(t, 3))
    label = F.concat_ws("/", F.lit("tele"), F.col("chunk_id").cast("string"))
    return t.chunks().where("is_compressed").select(label.alias("chunk_name"), "n_rows")


# -- retention ----------------------------------------------------------------------

_CUT = "(SELECT epoch_us(max(ts) - INTERVAL '5 days') FROM tele)"


@query(
    f"""WITH {TELE} SELECT DISTINCT {_CHUNK} AS chunk_id FROM tele WHERE ({_CHUNK} + 1) * {_DAY_US} < {_CUT}"""
)
def retention_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = shared_table(spark, sf_dir)
    return preview(t, t.max_ts() - dt.timedelta(days=5)).select("chunk_id")


@query(f"WITH {TELE} {_PER_CHUNK} FROM tele WHERE ({_BIG} + 1) * {_BIG_US} >= {_CUT} GROUP BY 1")
def retention_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = loaded_table(spark, sf_dir, "retention")
    as_of = t.max_ts()
    retain(t, as_of, "5 days")
    retain(t, as_of, "5 days")
    return _per_chunk(t)


# -- rollups --------------------------------------------------------------------------


def _rollup(t: ChunkedTable, spark: SparkSession, width: str = "1 hour") -> Rollup:
    return Rollup(
        t, work_dir(spark, "rollup"), width, ["event_type"], {"velocidad": "vel"}
    )


def _shown(rows: DataFrame) -> DataFrame:
    return rows.select(
        "hora", "event_type", "lecturas", *[dbl(f"vel_{f}").alias(f"vel_{f}") for f in ("media", "max", "min")]
    )


_VIEW = f"""SELECT time_bucket(INTERVAL '1 hour', ts) AS hora, event_type, count(*) AS lecturas,
    {VEL_MEAN} AS vel_media, CAST(max(velocidad) AS DOUBLE) AS vel_max,
    CAST(min(velocidad) AS DOUBLE) AS vel_min"""
# The figures are shown with one decimal, the readings have two.
_VIEW = _VIEW.replace("max(velocidad)", "round(max(velocidad), 1)").replace(
    "min(velocidad)", "round(min(velocidad), 1)"
)


@query(f"WITH {TELE} {_VIEW} FROM tele GROUP BY 1, 2")
def rollup_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_rollup(shared_table(spark, sf_dir), spark).build().view())


def _late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings once more, a month on for half of the kinds and a year on for the rest."""
    month = F.col("ts") + F.expr("INTERVAL '30' DAY")
    year = F.col("ts") + F.expr("INTERVAL '366' DAY")
    early = F.col("event_type").isin("error", "click")
    return readings(spark, sf_dir).withColumn("ts", F.when(early, month).otherwise(year))


_LATE = """late AS (SELECT auto_id,
    CASE WHEN event_type IN ('error', 'click') THEN ts + INTERVAL '30 days'
         ELSE ts + INTERVAL '366 days' END AS ts, event_type, velocidad, revoluciones FROM tele)"""


@query(f"WITH {TELE} {_VIEW} FROM tele GROUP BY 1, 2")
def rollup_stale(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = loaded_table(spark, sf_dir, "stale")
    r = _rollup(t, spark).build()
    t.append(_late_rows(spark, sf_dir), "late")
    return _shown(r.view())


@query(
    f"""WITH {TELE}, {_LATE}, plus AS (
          SELECT * FROM tele UNION ALL
          SELECT * FROM late WHERE ts >= TIMESTAMP '2024-02-05 01:00:00'
                               AND ts < TIMESTAMP '2024-02-20 13:00:00')
        {_VIEW} FROM plus GROUP BY 1, 2"""
)
def rollup_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = loaded_table(spark, sf_dir, "refresh")
    r = _rollup(t, spark).build()
    t.append(_late_rows(spark, sf_dir), "late")
    # Half-hours at both ends: only whole buckets are recomputed.
    r.refresh("2024-02-05 00:30", "2024-02-20 13:30")
    return _shown(r.view())


@query(
    f"""WITH {TELE}, {_LATE}, plus AS (SELECT * FROM tele UNION ALL SELECT * FROM late)
        {_VIEW} FROM plus GROUP BY 1, 2"""
)
def rollup_refresh_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = loaded_table(spark, sf_dir, "changed")
    r = _rollup(t, spark).build()
    load = t.append(_late_rows(spark, sf_dir), "late")
    r.refresh_changed(t.load_rows(load))
    return _shown(r.view())


@query(
    f"""WITH {TELE}, win AS (
          SELECT time_bucket(INTERVAL '1 hour', max(ts) - INTERVAL '1 month' - INTERVAL '1 microsecond')
                   + INTERVAL '1 hour' AS lo,
                 time_bucket(INTERVAL '1 hour', max(ts) - INTERVAL '1 hour') AS hi FROM tele)
        {_VIEW} FROM tele, win WHERE ts >= lo AND ts < hi GROUP BY 1, 2"""
)
def rollup_policy_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = shared_table(spark, sf_dir)
    r = _rollup(t, spark)
    r.refresh_due(t.max_ts(), "1 month", "1 hour")
    return _shown(r.view())


@query(
    f"""WITH {TELE}, v AS ({_VIEW} FROM tele GROUP BY 1, 2)
        SELECT * FROM v WHERE hora = TIMESTAMP '2024-01-20 08:00:00'"""
)
def rollup_bucket_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _rollup(shared_table(spark, sf_dir), spark).build()
    at = "2024-01-20 08:00"
    return _shown(r.view(at, at, closed="both"))


@query(
    f"""WITH {TELE}, v AS (
          SELECT CAST({VEL_MEAN} * 10 AS BIGINT) * 10 AS c FROM tele
          GROUP BY time_bucket(INTERVAL '1 hour', ts), event_type)
        SELECT {sql_mean('c')} AS vel_media FROM v"""
)
def rollup_avg_of_avgs(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _rollup(shared_table(spark, sf_dir), spark).build()
    return r.avg_of_avgs("vel").select(dbl("vel_media").alias("vel_media"))


@query(f"WITH {TELE} SELECT {VEL_MEAN} AS vel_media FROM tele")
def rollup_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _rollup(shared_table(spark, sf_dir), spark).build()
    return r.weighted_avg("vel").select(dbl("vel_media").alias("vel_media"))


@query(
    f"""WITH {TELE}, r AS (SELECT DISTINCT time_bucket(INTERVAL '1 hour', ts) AS hora, event_type
                           FROM tele)
        SELECT 'source' AS tabla, count(DISTINCT {_CHUNK}) AS n_chunks, count(*) AS n_rows FROM tele
        UNION ALL
        SELECT 'rollup', count(DISTINCT epoch_us(hora) // {10 * _DAY_US}), count(*) FROM r"""
)
def rollup_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _rollup(shared_table(spark, sf_dir), spark).build()
    return r.sizes().select("tabla", "n_chunks", "n_rows")


@query(f"WITH {TELE} {_VIEW} FROM tele GROUP BY 1, 2")
def rollup_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = shared_table(spark, sf_dir)
    r = _rollup(t, spark).build()
    compact_due(r.table, t.max_ts(), "7 days")
    return _shown(r.view())


@query(f"WITH {TELE} {_VIEW} FROM tele GROUP BY 1, 2")
def rollup_outlives_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = loaded_table(spark, sf_dir, "outlive")
    r = _rollup(t, spark).build()
    drop_chunks(t, "2024-01-20 12:00")
    r.refresh("2024-01-01", "2024-02-01")
    return _shown(r.view())


# -- KPI --------------------------------------------------------------------------------

_KPI_SCHEMA = T.StructType(
    [
        T.StructField("ventana", T.TimestampNTZType(), False),
        T.StructField("auto_id", T.IntegerType(), False),
        T.StructField("lecturas", T.IntegerType(), False),
        T.StructField("vel_max", T.DecimalType(10, 2), False),
        T.StructField("rpm_max", T.IntegerType(), False),
    ]
)
_SPEC = KpiSpec(schema=_KPI_SCHEMA)

_KPI = """SELECT v AS ventana, auto_id, CAST(count(*) AS INTEGER) AS lecturas,
    CAST(max(velocidad) AS DOUBLE) AS vel_max, max(revoluciones) AS rpm_max
    FROM tele, hour WHERE ts >= v AND ts < v + INTERVAL '1 hour' GROUP BY ALL"""
_HOUR = "hour AS (SELECT date_trunc('hour', max(ts) - INTERVAL '1 hour') AS v FROM tele)"


def _kpi_shown(rows: DataFrame) -> DataFrame:
    return rows.withColumn("vel_max", dbl("vel_max"))


@query(f"WITH {TELE}, {_HOUR} {_KPI}")
def kpi_last_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = shared_table(spark, sf_dir)
    return _kpi_shown(kpi_hour(t, t.max_ts(), _SPEC))


@query(f"WITH {TELE}, {_HOUR} {_KPI} HAVING max(revoluciones) IS NOT NULL")
def kpi_upsert_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = shared_table(spark, sf_dir)
    kpi = _SPEC.create(spark, work_dir(spark, "kpi"))
    for _ in range(2):
        run_kpi(t, kpi, t.max_ts(), _SPEC)
    return _kpi_shown(kpi_read(kpi, _SPEC))


def _kpi_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    aggs = {"lecturas": _n(), "vel_max": F.max("velocidad"), "rpm_max": F.max("revoluciones")}
    rows = shared_table(spark, sf_dir).scan()
    return downsample(rows, "1 hour", aggs, "ventana", keys=["auto_id"])


_KPI_ALL = """SELECT time_bucket(INTERVAL '1 hour', ts) AS ventana, auto_id,
    CAST(count(*) AS INTEGER) AS lecturas, CAST(max(velocidad) AS DOUBLE) AS vel_max,
    max(revoluciones) AS rpm_max FROM tele GROUP BY 1, 2"""


@query(
    f"""WITH {TELE}, k AS ({_KPI_ALL} HAVING max(revoluciones) IS NOT NULL)
        SELECT ventana, auto_id,
          CAST(CASE WHEN ventana < TIMESTAMP '2024-01-16' THEN lecturas ELSE lecturas + 100 END
               AS INTEGER) AS lecturas, vel_max, rpm_max FROM k"""
)
def upsert_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All hours at once, then the second half again with other counts: those win."""
    kpi = _SPEC.create(spark, work_dir(spark, "backfill"), "5 days")
    valid, _ = split_valid(_kpi_all(spark, sf_dir), _KPI_SCHEMA)
    upsert(kpi, valid, ("ventana", "auto_id"))
    half = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    again = valid.where(F.col("ventana") >= half)
    upsert(kpi, again.withColumn("lecturas", F.col("lecturas") + 100), ("ventana", "auto_id"))
    return _kpi_shown(kpi.scan())


@query(f"WITH {TELE}, k AS ({_KPI_ALL}) SELECT * FROM k WHERE rpm_max IS NULL")
def not_null_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejects = split_valid(_kpi_all(spark, sf_dir), _KPI_SCHEMA)
    return _kpi_shown(rejects.withColumn("lecturas", F.col("lecturas").cast("int")))


_ORDER_KEY = T.StructType(
    [T.StructField("o_custkey", T.LongType(), False), T.StructField("o_orderdate", T.TimestampNTZType(), False)]
)


@query(
    """SELECT o_orderkey, o_custkey, o_orderdate FROM orders
       WHERE (o_custkey, o_orderdate) IN (
         SELECT (o_custkey, o_orderdate) FROM orders GROUP BY o_custkey, o_orderdate HAVING count(*) > 1)"""
)
def duplicate_key_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    _, rejects = split_valid(orders, _ORDER_KEY, ["o_custkey", "o_orderdate"])
    return rejects


@query("SELECT o_orderkey, o_orderdate, o_custkey FROM orders")
def valid_plus_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid rows and rejects are the input again, with nulls in the key among them."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_custkey")
    part = F.when(F.col("o_custkey") % 3 > 0, F.col("o_custkey")).alias("k")
    schema = T.StructType([T.StructField("o_orderdate", T.TimestampNTZType(), False)])
    both = split_valid(orders.select("*", part), schema, ["k", "o_orderdate"])
    return both[0].unionByName(both[1]).drop("k")


# -- lifecycle ----------------------------------------------------------------------------


def _lived(spark: SparkSession, sf_dir: str) -> tuple[ChunkedTable, Rollup, ChunkedTable]:
    t = empty_table(spark, sf_dir, "life")
    r = _rollup(t, spark)
    kpi = _SPEC.create(spark, work_dir(spark, "lifekpi"))
    config = LifecycleConfig("7 days", "20 days", "1 month", "1 hour", _SPEC)
    lifecycle(t, r, kpi, "2024-01-31", config, readings(spark, sf_dir), "initial")
    return t, r, kpi


@query(
    f"""WITH {TELE} SELECT {_BIG} AS chunk_id, count(*) AS n_rows,
          ({_BIG} + 1) * {_BIG_US} < epoch_us(TIMESTAMP '2024-01-24') AS is_compressed,
          CAST(0 AS BIGINT) AS overflow_rows
        FROM tele WHERE ({_BIG} + 1) * {_BIG_US} >= epoch_us(TIMESTAMP '2024-01-11') GROUP BY 1"""
)
def lifecycle_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _state(_lived(spark, sf_dir)[0])


@query(
    f"""WITH {TELE} {_VIEW} FROM tele WHERE ts < TIMESTAMP '2024-01-30 23:00:00' GROUP BY 1, 2"""
)
def lifecycle_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_lived(spark, sf_dir)[1].view())


@query(
    f"""WITH {TELE}, hour AS (SELECT TIMESTAMP '2024-01-30 23:00:00' AS v)
        {_KPI} HAVING max(revoluciones) IS NOT NULL"""
)
def lifecycle_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kpi_shown(kpi_read(_lived(spark, sf_dir)[2], _SPEC))


@query(
    f"""WITH {TELE}, hour AS (SELECT TIMESTAMP '2024-01-30 23:00:00' AS v)
        {_KPI} HAVING max(revoluciones) IS NULL"""
)
def lifecycle_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kpi_shown(kpi_rejects(_lived(spark, sf_dir)[2]))


@query(f"WITH {TELE} {_VIEW} FROM tele GROUP BY 1, 2")
def rollup_refresh_after_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late rows are compacted away before the policy runs; their change is on record."""
    t = empty_table(spark, sf_dir, "compactedlate")
    rows = readings(spark, sf_dir)
    late = F.col("event_type") == "error"
    t.append(rows.where(~late), "initial")
    r = Rollup.open(t, _rollup(t, spark).build().table.root)
    t.append(rows.where(late), "late")
    compress_chunks(t, t.chunk_ids())
    r.refresh_due("2024-02-10", "2 months")
    return _shown(r.view())


@query(
    f"WITH {TELE} {_VIEW} FROM tele WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-22'"
    " GROUP BY 1, 2"
)
def sql_rollup_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _rollup(loaded_table(spark, sf_dir, "sqlrollup"), spark).build()
    r.create_range_function("hourly_figures")
    lo, hi = "TIMESTAMP_NTZ'2024-01-08'", "TIMESTAMP_NTZ'2024-01-22'"
    return _shown(spark.sql(f"SELECT * FROM hourly_figures({lo}, {hi})"))
