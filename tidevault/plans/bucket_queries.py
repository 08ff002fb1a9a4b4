"""Buckets, gap filling, generators and flat-table queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidevault.functions.buckets import (
    bucket_equals,
    date_floor,
    downsample,
    gapfill,
)
from tidevault.functions.scalars import pretty_bytes
from tidevault.functions.sql import register
from tidevault.functions.times import Width, from_micros, to_micros
from tidevault.operators.reports import sizing, table_counts
from tidevault.plans.registry import (
    TELE,
    VEL_MEAN,
    dbl,
    mean,
    query,
    readings,
    shared_table,
    table,
)
from tidevault.sources.generate import SENSOR_NUMBER, SENSORS, telemetry_for, time_series



def _lecturas():
    return F.count(F.lit(1))


def _bucket_sql(width: str, name: str, origin: str = "", extra: str = "") -> str:
    at = f"time_bucket(INTERVAL '{width}', ts{origin})"
    return f"""WITH {TELE}
      SELECT {at} AS {name}, count(*) AS lecturas{extra} FROM tele GROUP BY 1 ORDER BY 1"""


@query(
    _bucket_sql(
        "1 hour",
        "hora",
        extra=f", {VEL_MEAN} AS vel_media, CAST(max(velocidad) AS DOUBLE) AS vel_max",
    )
)
def hourly_downsample(spark: SparkSession, sf_dir: str) -> DataFrame:
    aggs = {"lecturas": _lecturas(), "vel_media": mean("velocidad"), "vel_max": dbl(F.max("velocidad"))}
    return downsample(readings(spark, sf_dir), "1 hour", aggs, "hora").orderBy("hora")


@query(_bucket_sql("2 hours", "ventana", extra=f", {VEL_MEAN} AS vel_media"))
def bucket_2h(spark: SparkSession, sf_dir: str) -> DataFrame:
    aggs = {"lecturas": _lecturas(), "vel_media": mean("velocidad")}
    return downsample(readings(spark, sf_dir), "2 hours", aggs, "ventana").orderBy("ventana")


@query(_bucket_sql("90 minutes", "ventana", ", TIMESTAMP '2024-01-01 00:30:00'"))
def bucket_90m_origin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return downsample(
        readings(spark, sf_dir),
        "90 minutes",
        {"lecturas": _lecturas()},
        "ventana",
        origin="2024-01-01 00:30",
    ).orderBy("ventana")


@query(_bucket_sql("6 hours", "ventana"))
def bucket_6h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return downsample(
        readings(spark, sf_dir), "6 hours", {"lecturas": _lecturas()}, "ventana"
    ).orderBy("ventana")


@query(
    _bucket_sql(
        "1 day",
        "dia",
        extra=f""", {VEL_MEAN} AS vel_media,
        CAST((2*sum(revoluciones) + count(revoluciones)) // (2*count(revoluciones)) AS DOUBLE)
          AS rpm_media""",
    )
)
def bucket_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    aggs = {
        "lecturas": _lecturas(),
        "vel_media": mean("velocidad"),
        "rpm_media": mean("revoluciones", 0),
    }
    return downsample(readings(spark, sf_dir), "1 day", aggs, "dia").orderBy("dia")


@query(
    """SELECT time_bucket(INTERVAL '1 week', l_shipdate) AS semana, count(*) AS lineas,
         CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS cantidad
       FROM lineitem GROUP BY 1 ORDER BY 1"""
)
def bucket_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    aggs = {"lineas": _lecturas(), "cantidad": F.sum(F.col("l_quantity").cast("long"))}
    lines = table(spark, sf_dir, "lineitem")
    return downsample(lines, "1 week", aggs, "semana", ts="l_shipdate").orderBy("semana")


def _orders_by_months(spark: SparkSession, sf_dir: str, width: str, name: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    aggs = {"pedidos": _lecturas(), "centimos": F.sum(cents)}
    return downsample(orders, width, aggs, name, ts="o_orderdate").orderBy(name)


def _orders_sql(width: str, name: str) -> str:
    return f"""SELECT time_bucket(INTERVAL '{width}', o_orderdate) AS {name}, count(*) AS pedidos,
         CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS centimos
       FROM orders GROUP BY 1 ORDER BY 1"""


@query(_orders_sql("1 month", "mes"))
def bucket_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_by_months(spark, sf_dir, "1 month", "mes")


@query(_orders_sql("3 months", "trimestre"))
def bucket_3_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_by_months(spark, sf_dir, "3 months", "trimestre")


@query(
    f"""WITH {TELE} SELECT count(*) AS filas_en_bucket FROM tele
        WHERE time_bucket(INTERVAL '90 minutes', ts, TIMESTAMP '2024-01-15 00:30:00')
              = TIMESTAMP '2024-01-15 00:30:00'"""
)
def bucket_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = "2024-01-15 00:30"
    hit = bucket_equals(readings(spark, sf_dir), "90 minutes", at, origin=at)
    return hit.agg(F.count(F.lit(1)).alias("filas_en_bucket"))


@query(
    f"""WITH {TELE} SELECT time_bucket(INTERVAL '1 hour', ts) AS hora, auto_id,
          count(*) AS lecturas, {VEL_MEAN} AS vel_media
        FROM tele GROUP BY 1, 2 ORDER BY 1, 2"""
)
def hourly_by_vehicle(spark: SparkSession, sf_dir: str) -> DataFrame:
    aggs = {"lecturas": _lecturas(), "vel_media": mean("velocidad")}
    return downsample(
        readings(spark, sf_dir), "1 hour", aggs, "hora", keys=["auto_id"]
    ).orderBy("hora", "auto_id")


@query(
    f"""WITH {TELE}, agg AS (
          SELECT time_bucket(INTERVAL '1 hour', ts) AS hora, auto_id,
                 count(*) AS lecturas, {VEL_MEAN} AS vel_media
          FROM tele GROUP BY 1, 2),
        grid AS (
          SELECT h.hora, k.auto_id
          FROM (SELECT unnest(generate_series((SELECT min(hora) FROM agg),
                  (SELECT max(hora) FROM agg), INTERVAL '1 hour')) AS hora) h,
               (SELECT DISTINCT auto_id FROM agg) k)
        SELECT g.hora, g.auto_id, coalesce(a.lecturas, 0) AS lecturas, a.vel_media
        FROM grid g LEFT JOIN agg a ON a.hora = g.hora AND a.auto_id = g.auto_id"""
)
def gapfill_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    agg = hourly_by_vehicle(spark, sf_dir)
    return gapfill(agg, "hora", "1 hour", keys=["auto_id"], fill={"lecturas": 0})


@query(
    f"""WITH {TELE}, agg AS (
          SELECT time_bucket(INTERVAL '5 minutes', ts) AS franja, count(*) AS lecturas
          FROM tele GROUP BY 1)
        SELECT g.franja, coalesce(a.lecturas, 0) AS lecturas
        FROM (SELECT unnest(generate_series((SELECT min(franja) FROM agg),
                (SELECT max(franja) FROM agg), INTERVAL '5 minutes')) AS franja) g
        LEFT JOIN agg a ON a.franja = g.franja"""
)
def gapfill_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    agg = downsample(
        readings(spark, sf_dir), "5 minutes", {"lecturas": _lecturas()}, "franja"
    )
    return gapfill(agg, "franja", "5 minutes", fill={"lecturas": 0})


@query(
    f"""WITH {TELE}, hours AS (
          SELECT unnest(generate_series((SELECT date_trunc('hour', min(ts)) FROM tele),
                 (SELECT date_trunc('hour', max(ts)) FROM tele), INTERVAL '1 hour')) AS hora)
        SELECT h.hora, count(t.ts) AS lecturas
        FROM hours h LEFT JOIN tele t ON date_trunc('hour', t.ts) = h.hora GROUP BY 1"""
)
def hour_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = shared_table(spark, sf_dir)
    hour = Width.parse("1 hour")
    first, last = (from_micros(hour.floor(to_micros(at))) for at in (t.min_ts(), t.max_ts()))
    hours = time_series(spark, first, last, "1 hour", "hora")
    hours = hours.select(F.col("hora").cast("timestamp_ntz").alias("hora"))
    counted = downsample(t.scan(), "1 hour", {"lecturas": _lecturas()}, "hora")
    return hours.join(counted, "hora", "left").fillna({"lecturas": 0})


@query(_bucket_sql("90 minutes", "ventana", extra=f", {VEL_MEAN} AS vel_media"))
def sql_time_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark)
    readings(spark, sf_dir).createOrReplaceTempView("lecturas_sql")
    return spark.sql(
        """SELECT time_bucket(INTERVAL '90' MINUTE, ts) AS ventana, count(*) AS lecturas,
                  CAST(round(CAST(sum(velocidad) AS DECIMAL(38,12)) / count(velocidad), 1)
                       AS DOUBLE) AS vel_media
           FROM lecturas_sql GROUP BY 1 ORDER BY 1"""
    )


@query(_orders_sql("6 months", "semestre"))
def sql_time_bucket_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark)
    table(spark, sf_dir, "orders").createOrReplaceTempView("pedidos_sql")
    return spark.sql(
        """SELECT time_bucket_months(6, o_orderdate) AS semestre, count(*) AS pedidos,
                  sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS centimos
           FROM pedidos_sql GROUP BY 1 ORDER BY 1"""
    )


# -- flat tables ---------------------------------------------------------------


@query(
    """SELECT 'events' AS tabla, count(*) AS registros FROM events
       UNION ALL SELECT 'orders', count(*) FROM orders
       UNION ALL SELECT 'lineitem', count(*) FROM lineitem""",
    name="table_counts",
)
def table_counts_stacked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_counts({n: table(spark, sf_dir, n) for n in ("events", "orders", "lineitem")})


@query(
    """SELECT o_orderkey, o_orderdate, o_orderpriority FROM orders
       WHERE o_orderdate = TIMESTAMP '1998-10-03 00:00:00' ORDER BY o_orderkey LIMIT 3"""
)
def instant_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.lit("1998-10-03 00:00:00").cast("timestamp_ntz")
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderdate") == at)
    return orders.select("o_orderkey", "o_orderdate", "o_orderpriority").orderBy("o_orderkey").limit(3)


@query(
    """SELECT event_type, count(*) AS lecturas, count(DISTINCT user_id) AS vehiculos FROM events
       WHERE event_type IN ('error', 'click', 'view') GROUP BY 1"""
)
def in_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readings(spark, sf_dir).where(F.col("event_type").isin("error", "click", "view"))
    return rows.groupBy("event_type").agg(
        _lecturas().alias("lecturas"), F.countDistinct("auto_id").alias("vehiculos")
    )


@query(
    """SELECT p_brand, count(*) AS piezas FROM part
       WHERE p_brand LIKE 'Brand_1%' GROUP BY 1 ORDER BY 1"""
)
def like_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = table(spark, sf_dir, "part").where(F.col("p_brand").like("Brand_1%"))
    return hits.groupBy("p_brand").agg(_lecturas().alias("piezas")).orderBy("p_brand")


@query(
    f"""WITH {TELE} SELECT count(*) AS lecturas,
          count(DISTINCT date_trunc('hour', ts)) AS horas_distintas,
          count(DISTINCT CAST(ts AS DATE)) AS dias_distintos FROM tele"""
)
def distinct_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readings(spark, sf_dir)
    return rows.agg(
        _lecturas().alias("lecturas"),
        F.countDistinct(date_floor(rows, "hour")).alias("horas_distintas"),
        F.countDistinct(F.to_date("ts")).alias("dias_distintos"),
    )


@query(
    f"""WITH {TELE}, w AS (
          SELECT time_bucket(INTERVAL '1 hour', ts) AS hora, count(*) AS n FROM tele GROUP BY 1)
        SELECT CAST(hora AS DATE) AS dia, CAST(sum(n) AS BIGINT) AS lecturas, max(n) AS pico
        FROM (SELECT * FROM w) x GROUP BY 1"""
)
def downsample_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    hourly = downsample(readings(spark, sf_dir), "1 hour", {"n": _lecturas()}, "hora")
    return hourly.groupBy(F.to_date("hora").alias("dia")).agg(
        F.sum("n").alias("lecturas"), F.max("n").alias("pico")
    )


_INTERVALS = {"1 day": 1, "3 days": 3, "7 days": 7}


@query(
    " UNION ALL ".join(
        f"""SELECT '{name}' AS chunk_interval, count(*) AS n_chunks,
              CAST(quantile_cont(n, 0.5) AS DOUBLE) AS rows_p50, max(n) AS rows_max
            FROM (SELECT floor(epoch(l_shipdate) / (86400.0 * {days})) AS c, count(*) AS n
                  FROM lineitem GROUP BY 1)"""
        for name, days in _INTERVALS.items()
    )
)
def chunk_sizing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sizing(table(spark, sf_dir, "lineitem"), list(_INTERVALS), "l_shipdate")


def _pretty_sql(n: str) -> str:
    label = f"CAST({n} AS VARCHAR) || ' bytes'"
    for power, unit in enumerate(("kB", "MB", "GB", "TB", "PB"), start=1):
        scaled = f"CAST(CAST(round({n} / {1024**power}.0) AS BIGINT) AS VARCHAR)"
        label = f"CASE WHEN {n} < {10 * 1024**power} THEN {label} ELSE {scaled} || ' {unit}' END"
    return label


@query(f"SELECT doc_id, {_pretty_sql('(CAST(n_chars AS BIGINT) * doc_id)')} AS size FROM documents")
def readable_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    size = F.col("n_chars").cast("long") * F.col("doc_id").cast("long")
    return docs.select("doc_id", pretty_bytes(size).alias("size"))


# -- telemetry: ten sensors of one vehicle per customer, hourly ---------------------


def _sensor_sql(name: str, car: str, step: str) -> str:
    lo, n, _ = SENSORS[name]
    k = SENSOR_NUMBER[name]
    h = f"((({car}) * 73856093 + ({step}) * 19349663 + {k * 83492791}) % 1000003)"
    return f"({lo} + ((({h} * {h} + {k}) % 1000003) * {n}) // 1000003)"


def _fleet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("int").alias("auto_id"))


def _totals() -> list:
    return [
        F.sum((F.col(name) * F.lit(scale)).cast("long")).alias(name)
        for name, (_, _, scale) in SENSORS.items()
    ]


@query(
    "SELECT TIMESTAMP '2026-01-01 00:00:00' + s * INTERVAL '1 hour' AS ts, count(*) AS lecturas, "
    + ", ".join(
        f"CAST(sum({_sensor_sql(n, 'c_custkey', 's')}) AS BIGINT) AS {n}" for n in SENSORS
    )
    + " FROM customer, (SELECT unnest(generate_series(0, 47)) AS s) GROUP BY 1"
)
def telemetry_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = telemetry_for(_fleet(spark, sf_dir), "2026-01-01", 48, "1 hour")
    out = rows.groupBy(F.col("ts").cast("timestamp_ntz").alias("ts"))
    return out.agg(_lecturas().alias("lecturas"), *_totals())


# -- readings in the lab's two grains: hourly, and 5-second steps in small chunks -----------------


@query(
    f"""WITH {TELE} SELECT time_bucket(INTERVAL '1 hour', ts) AS ts, count(*) AS lecturas,
          CAST(sum(CAST(velocidad * 100 AS BIGINT)) AS BIGINT) AS velocidad,
          CAST(sum(revoluciones) AS BIGINT) AS revoluciones
        FROM tele GROUP BY 1"""
)
def hourly_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = {
        "lecturas": _lecturas(),
        "velocidad": F.sum((F.col("velocidad") * 100).cast("long")),
        "revoluciones": F.sum("revoluciones"),
    }
    rows = readings(spark, sf_dir).withColumnRenamed("ts", "at")
    return downsample(rows, "1 hour", totals, "ts", ts="at")


@query(
    f"""WITH {TELE} SELECT epoch_us(ts) // 900000000 AS chunk_id, count(*) AS lecturas,
          count(DISTINCT epoch_us(ts) // 5000000) AS pasos,
          CAST(sum(CAST(velocidad * 100 AS BIGINT)) AS BIGINT) AS velocidad
        FROM tele GROUP BY 1"""
)
def telemetry_5s_by_chunk(spark: SparkSession, sf_dir: str) -> DataFrame:
    each = {"n": _lecturas(), "v": F.sum((F.col("velocidad") * 100).cast("long"))}
    steps = downsample(readings(spark, sf_dir), "5 seconds", each, "paso")
    chunk = F.call_function("div", F.unix_micros(F.col("paso").cast("timestamp")), F.lit(900_000_000))
    return steps.groupBy(chunk.alias("chunk_id")).agg(
        F.sum("n").alias("lecturas"), _lecturas().alias("pasos"), F.sum("v").alias("velocidad")
    )
