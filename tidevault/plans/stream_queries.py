"""Streams over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidevault.operators.chunks import ChunkedTable
from tidevault.operators.rollup import Rollup
from tidevault.plans.registry import TELE, dbl, empty_table, loaded_table, query, readings
from tidevault.plans.table_queries import _PER_CHUNK, _VIEW, _per_chunk, _shown
from tidevault.session import work_dir
from tidevault.streaming.ingest import stream_into, stream_rollup, stream_upsert

# A bucket is out once the watermark, an hour behind the latest reading, has passed its end.
_EMITTED = """hora + INTERVAL '2 hours'
    <= (SELECT date_trunc('millisecond', max(ts)) FROM tele)"""


def _arrivals(spark: SparkSession, sf_dir: str, name: str) -> tuple[str, DataFrame]:
    folder = work_dir(spark, name)
    return folder, readings(spark, sf_dir)


def _stream(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    return spark.readStream.schema(schema).parquet(folder)


def _late(rows: DataFrame) -> DataFrame:
    """Errors of the first half of the month are reported late."""
    half = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    return rows.withColumn("_late", (F.col("event_type") == "error") & (F.col("ts") < half))


@query(f"WITH {TELE} {_PER_CHUNK} FROM tele GROUP BY 1")
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, rows = _arrivals(spark, sf_dir, "arrive")
    t = empty_table(spark, sf_dir, "streamed")
    parts = _late(rows)
    for late in (False, True):
        parts.where(F.col("_late") == late).drop("_late").write.mode("append").parquet(folder)
        stream_into(
            _stream(spark, folder, rows.schema), t, "ingest", f"{t.root}/_progress"
        ).awaitTermination()
    return _per_chunk(t)


@query(
    f"WITH {TELE}, v AS ({_VIEW} FROM tele GROUP BY 1, 2) SELECT * FROM v WHERE {_EMITTED}",
    name="stream_rollup",
)
def stream_rollup_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, rows = _arrivals(spark, sf_dir, "rollarrive")
    rows.write.parquet(folder)
    t = empty_table(spark, sf_dir, "rollsource")
    r = Rollup(t, work_dir(spark, "streamroll"), "1 hour", ["event_type"], {"velocidad": "vel"})
    stream_rollup(
        _stream(spark, folder, rows.schema), r, "roll", f"{r.table.root}/_progress"
    ).awaitTermination()
    return _shown(r.view())


@query(f"WITH {TELE}, v AS ({_VIEW} FROM tele GROUP BY 1, 2) SELECT * FROM v WHERE {_EMITTED}")
def stream_late_then_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, rows = _arrivals(spark, sf_dir, "latearrive")
    t = empty_table(spark, sf_dir, "latesource")
    r = Rollup(t, work_dir(spark, "lateroll"), "1 hour", ["event_type"], {"velocidad": "vel"})
    parts = _late(rows)
    for late in (False, True):
        parts.where(F.col("_late") == late).drop("_late").write.mode("append").parquet(folder)
        source = _stream(spark, folder, rows.schema)
        stream_into(source, t, "ingest", f"{t.root}/_progress").awaitTermination()
        stream_rollup(source, r, "roll", f"{r.table.root}/_progress").awaitTermination()
    # The second micro-batch came too late for the stream; its buckets are recomputed.
    r.refresh_changed(t.load_rows("ingest-1"))
    return _shown(r.view())


_FIGURES = T.StructType(
    [
        T.StructField("ventana", T.TimestampNTZType(), False),
        T.StructField("auto_id", T.IntegerType(), False),
        T.StructField("lecturas", T.IntegerType(), False),
        T.StructField("vel_max", T.DecimalType(10, 2), False),
    ]
)


@query(
    f"""WITH {TELE} SELECT time_bucket(INTERVAL '1 hour', ts) AS ventana, auto_id,
          CAST(count(*) AS INTEGER) AS lecturas, CAST(max(velocidad) AS DOUBLE) AS vel_max
        FROM tele GROUP BY 1, 2"""
)
def stream_kpi_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, rows = _arrivals(spark, sf_dir, "kpiarrive")
    kpi = ChunkedTable(
        spark, work_dir(spark, "streamkpi"), _FIGURES, "ventana", "10 days", ["auto_id"]
    ).create()
    half = F.lit("2024-01-16 00:30:00").cast("timestamp_ntz")
    # The second part continues in the middle of an hour: that hour's rows are updated.
    for part in (F.col("ts") < half, F.col("ts") >= half):
        rows.where(part).write.mode("append").parquet(folder)
        stream_upsert(
            _stream(spark, folder, rows.schema),
            kpi,
            ("ventana", "auto_id"),
            "1 hour",
            "ts",
            [F.count(F.lit(1)).alias("lecturas"), F.max("velocidad").alias("vel_max")],
            "kpi",
            f"{kpi.root}/_progress",
        ).awaitTermination()
    return kpi.scan().withColumn("vel_max", dbl("vel_max"))


@query(f"WITH {TELE} {_VIEW} FROM tele GROUP BY 1, 2")
def rollup_stream_and_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Built, then streamed over the same rows, then refreshed: one row per key."""
    folder, rows = _arrivals(spark, sf_dir, "botharrive")
    rows.write.parquet(folder)
    t = loaded_table(spark, sf_dir, "bothsource")
    r = Rollup(t, work_dir(spark, "bothroll"), "1 hour", ["event_type"], {"velocidad": "vel"}).build()
    stream_rollup(
        _stream(spark, folder, rows.schema), r, "roll", f"{r.table.root}/_progress"
    ).awaitTermination()
    r.refresh("2024-01-01", "2024-02-01")
    return _shown(r.view())


@query(f"WITH {TELE} {_PER_CHUNK} FROM (SELECT * FROM tele UNION ALL SELECT * FROM tele) GROUP BY 1")
def stream_two_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files by two streams of one name: neither replaces the other's rows."""
    folder, rows = _arrivals(spark, sf_dir, "twicearrive")
    rows.write.parquet(folder)
    t = empty_table(spark, sf_dir, "twicestreamed")
    for n in (1, 2):
        source = _stream(spark, folder, rows.schema)
        stream_into(source, t, "ingest", f"{t.root}/_progress{n}").awaitTermination()
    return _per_chunk(t)


@query(
    f"""WITH {TELE} SELECT time_bucket(INTERVAL '7 days', ts) AS semana, event_type,
          count(*) AS lecturas, CAST(round(max(velocidad), 1) AS DOUBLE) AS vel_max
        FROM tele GROUP BY 1, 2 HAVING time_bucket(INTERVAL '7 days', ts) + INTERVAL '7 days 1 hour'
          <= (SELECT date_trunc('millisecond', max(ts)) FROM tele)"""
)
def stream_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weeks from Monday, as ``time_bucket`` has them; the last one is still open."""
    folder, rows = _arrivals(spark, sf_dir, "weekarrive")
    rows.write.parquet(folder)
    t = empty_table(spark, sf_dir, "weeksource")
    r = Rollup(t, work_dir(spark, "weekroll"), "7 days", ["event_type"], {"velocidad": "vel"}, "semana")
    stream_rollup(
        _stream(spark, folder, rows.schema), r, "week", f"{r.table.root}/_progress"
    ).awaitTermination()
    return r.view().select("semana", "event_type", "lecturas", dbl("vel_max").alias("vel_max"))
