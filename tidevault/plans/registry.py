"""Named queries over the given tables, each with the SQL that checks it where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidevault.functions.scalars import avg_rounded
from tidevault.operators.chunks import ChunkedTable
from tidevault.session import work_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name`` or its function's own, with the SQL that checks it."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)

        key = name or fn.__name__
        QUERIES[key] = run
        if oracle is not None:
            ORACLES[key] = oracle
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` seen as telemetry; the engine speed is unknown where an error was sent."""
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("int").alias("auto_id"),
        "ts",
        "event_type",
        F.col("value").cast("decimal(10,2)").alias("velocidad"),
        F.when(F.col("event_type") != "error", k).alias("revoluciones"),
    )


# The same view for the checking SQL.
TELE = """tele AS (
  SELECT CAST(user_id AS INTEGER) AS auto_id, ts, event_type,
         CAST(value AS DECIMAL(10,2)) AS velocidad,
         CASE WHEN event_type <> 'error'
              THEN CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) END AS revoluciones
  FROM events)"""


def sql_mean(cents: str, digits: int = 1) -> str:
    """Rounded average of a column of whole hundredths, in integers, half away from zero."""
    total, count = f"sum({cents})", f"count({cents})"
    scale = 10**digits
    step = 100 // scale
    return f"CAST((2*{total} + {step}*{count}) // (2*{step}*{count}) AS DOUBLE) / {scale}"


VEL = "CAST(velocidad * 100 AS BIGINT)"
VEL_MEAN = sql_mean(VEL)


def mean(column: str, digits: int = 1) -> Column:
    return avg_rounded(column, digits).cast("double")


def dbl(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("double")


def empty_table(
    spark: SparkSession, sf_dir: str, name: str, interval: str = "3 days"
) -> ChunkedTable:
    schema = readings(spark, sf_dir).schema
    for f in schema.fields:
        f.nullable = f.name not in ("auto_id", "ts")
    return ChunkedTable(
        spark, work_dir(spark, name), schema, "ts", interval, ["auto_id"]
    ).create()


def loaded_table(
    spark: SparkSession, sf_dir: str, name: str, interval: str = "3 days"
) -> ChunkedTable:
    """A chunked copy of the readings, for queries that change it."""
    out = empty_table(spark, sf_dir, name, interval)
    out.append(readings(spark, sf_dir), "initial")
    return out


_SHARED: dict[tuple[str, str], ChunkedTable] = {}


def shared_table(spark: SparkSession, sf_dir: str) -> ChunkedTable:
    """One chunked copy per session for the queries that only read."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _SHARED:
        _SHARED[key] = loaded_table(spark, sf_dir, "readings", "1 day")
    return _SHARED[key]
