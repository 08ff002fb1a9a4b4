"""Hourly KPI per vehicle, upserted so that a repeated run changes nothing."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidevault.functions.times import Instant, Width, ago, from_micros, now, to_micros, ts_lit
from tidevault.operators.chunks import ChunkedTable
from tidevault.operators.upsert import upsert
from tidevault.schemas import KPI, conform, split_valid

_HOUR = Width.parse("1 hour")


@dataclass(frozen=True)
class KpiSpec:
    """Names of the KPI's columns and of the readings they come from."""

    schema: T.StructType = field(default_factory=lambda: KPI)
    key: str = "auto_id"
    maxima: Mapping[str, str] = field(
        default_factory=lambda: {"vel_max": "velocidad", "rpm_max": "revoluciones"}
    )

    def create(self, spark, root: str, interval: str = "1 day") -> ChunkedTable:
        return ChunkedTable(
            spark, root, self.schema, "ventana", interval, [self.key]
        ).create()


def kpi_hour(
    source: ChunkedTable, as_of: Instant | None = None, spec: KpiSpec = KpiSpec()
) -> DataFrame:
    """Count and maxima per vehicle over the last complete hour before ``as_of``."""
    hour = _HOUR.floor(to_micros(ago(as_of or now(), "1 hour")))
    rows = source.scan(from_micros(hour), from_micros(_HOUR.add(hour, 1)))
    ventana = ts_lit(hour, spec.schema["ventana"].dataType)
    return conform(
        rows.groupBy(spec.key)
        .agg(
            F.count(F.lit(1)).alias("lecturas"),
            *[F.max(source_name).alias(name) for name, source_name in spec.maxima.items()],
        )
        .withColumn("ventana", ventana),
        spec.schema,
    )


def run_kpi(
    source: ChunkedTable,
    kpi: ChunkedTable,
    as_of: Instant | None = None,
    spec: KpiSpec = KpiSpec(),
) -> DataFrame:
    """The KPI job: compute the hour and upsert it. Returns the rows that break NOT NULL."""
    as_of = as_of or now()
    valid, rejects = split_valid(kpi_hour(source, as_of, spec), spec.schema)
    upsert(kpi, valid, ("ventana", spec.key))
    return rejects


def kpi_read(kpi: ChunkedTable, spec: KpiSpec = KpiSpec()) -> DataFrame:
    return kpi.scan().orderBy("ventana", spec.key)
