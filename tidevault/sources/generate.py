"""Synthetic telemetry that Spark and any SQL engine compute alike."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidevault.functions.times import Instant, Width, fixed_micros, to_micros
from tidevault.schemas import TELEMETRY, conform
from tidevault.session import spread

# Per sensor, lowest value and number of values in units of the last decimal.
SENSORS = {
    "presion_ruedas": (2300, 301, 1000),
    "nivel_combustible": (5, 95, 1),
    "carga_bateria": (15, 85, 1),
    "temperatura_motor": (8500, 2001, 100),
    "temperatura_bateria": (2500, 2001, 100),
    "presion_aceite": (250, 201, 100),
    "velocidad": (0, 1401, 10),
    "revoluciones": (800, 5700, 1),
    "consumo_potencia": (-50, 801, 10),
    "autonomia": (150, 350, 1),
}
# Steps made per generated block of one car.
_BLOCK = 4096
SENSOR_NUMBER = {name: k for k, name in enumerate(SENSORS, start=1)}


def sensor_units(name: str, car: Column, step: Column) -> Column:
    """The value of a sensor in units of its last decimal, from integers alone."""
    lo, n, _ = SENSORS[name]
    k = SENSOR_NUMBER[name]
    h = (
        car.cast("long") * 73856093 + step.cast("long") * 19349663 + F.lit(k * 83492791)
    ) % 1000003
    u = (h * h + k) % 1000003
    return F.lit(lo) + F.call_function("div", u * n, F.lit(1000003))


def _with_sensors(grid: DataFrame, start: int, step_us: int) -> DataFrame:
    """``grid`` holds auto_id and s, the step number."""
    ts = F.timestamp_micros(F.lit(start) + F.col("s").cast("long") * step_us)
    columns = [F.col("auto_id"), ts.alias("ts")]
    for name, (_, _, scale) in SENSORS.items():
        units = sensor_units(name, F.col("auto_id"), F.col("s"))
        exact = units.cast("decimal(12,0)") / F.lit(scale) if scale > 1 else units
        columns.append(exact.alias(name))
    return conform(grid.select(*columns), TELEMETRY)


def series(spark: SparkSession, first: int, last: int, name: str = "value") -> DataFrame:
    """Consecutive integers, both ends included."""
    return spark.range(first, last + 1).withColumnRenamed("id", name)


def time_series(
    spark: SparkSession,
    first: Instant,
    last: Instant,
    step: str | dt.timedelta | Width,
    name: str = "ts",
) -> DataFrame:
    """Instants from ``first`` to ``last``, both ends included, spread over tasks."""
    lo, hi, size = to_micros(first), to_micros(last), fixed_micros(step)
    at = F.timestamp_micros(F.lit(lo) + F.col("id") * size)
    return spark.range(0, max((hi - lo) // size + 1, 0)).select(at.alias(name))


def product(spark: SparkSession, **sizes: int) -> DataFrame:
    """Every combination of the indices ``0..size-1``.

    One range is numbered through and split into its indices by division, so the
    combinations come out spread over tasks and nothing is joined. The first name
    varies slowest.
    """
    total = 1
    for size in sizes.values():
        total *= size
    columns, stride = [], total
    for name, size in sizes.items():
        stride //= max(size, 1)
        index = F.call_function("div", F.col("id"), F.lit(max(stride, 1))) % max(size, 1)
        columns.append(index.alias(name))
    return spark.range(total).select(*columns)


def telemetry(
    spark: SparkSession,
    start: Instant,
    steps: int,
    step: str | dt.timedelta | Width = "1 hour",
    cars: int = 10,
) -> DataFrame:
    """Readings of cars ``1..cars`` at every step; in time order, so tasks meet few chunks."""
    grid = product(spark, s=steps, car=cars)
    grid = grid.select((F.col("car") + 1).alias("auto_id"), "s")
    return _with_sensors(grid, to_micros(start), fixed_micros(step))


def telemetry_for(
    cars: DataFrame, start: Instant, steps: int, step: str | dt.timedelta | Width = "1 hour"
) -> DataFrame:
    """Readings at every step for the cars of a table with the column ``auto_id``.

    Steps are made in blocks, so that even one car's readings are made by many tasks.
    """
    last = max(steps - 1, 0)
    blocks = F.sequence(F.lit(0), F.lit(last), F.lit(_BLOCK)) if steps > 0 else F.array()
    starts = cars.select("auto_id", F.explode(blocks.cast("array<int>")).alias("_first"))
    inside = F.sequence(F.col("_first"), F.least(F.col("_first") + (_BLOCK - 1), F.lit(last)))
    grid = spread(starts, "auto_id", "_first").select("auto_id", F.explode(inside).alias("s"))
    return _with_sensors(grid, to_micros(start), fixed_micros(step))
