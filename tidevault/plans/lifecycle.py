"""The whole life of a table, as one sequence of jobs."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidevault.functions.times import Instant, Width, ago, now, to_micros
from tidevault.operators.chunks import ChunkedTable
from tidevault.operators.compact import compact_due
from tidevault.operators.kpi import KpiSpec, run_kpi
from tidevault.operators.retention import retain
from tidevault.operators.rollup import Rollup

_REJECTS = "_rejects"


@dataclass(frozen=True)
class LifecycleConfig:
    compress_after: str = "7 days"
    drop_after: str = "30 days"
    start_offset: str = "1 month"
    end_offset: str = "1 hour"
    kpi: KpiSpec = field(default_factory=KpiSpec)


def lifecycle(
    table: ChunkedTable,
    rollup: Rollup,
    kpi: ChunkedTable,
    as_of: Instant | None = None,
    config: LifecycleConfig = LifecycleConfig(),
    batch: DataFrame | None = None,
    load: str | None = None,
) -> DataFrame:
    """Ingest, roll up, compact, drop and compute the KPI, as of one instant.

    The rollup is refreshed before retention, so that what is dropped has been
    rolled up. Every step may be run again. KPI rows that break NOT NULL are written to
    the KPI table's folder, where :func:`kpi_rejects` finds them. Returns the chunk catalogue.
    """
    as_of = as_of or now()
    if batch is not None:
        table.append(batch, load)
    rollup.refresh_due(as_of, config.start_offset, config.end_offset)
    compact_due(table, as_of, config.compress_after)
    retain(table, as_of, config.drop_after)
    rejects = run_kpi(table, kpi, as_of, config.kpi)
    hour = Width.parse("1 hour").floor(to_micros(ago(as_of, "1 hour")))
    rejects.write.mode("overwrite").parquet(f"{kpi.root}/{_REJECTS}/hour={hour}")
    return table.chunks()


def kpi_rejects(kpi: ChunkedTable) -> DataFrame:
    """The KPI rows that runs of :func:`lifecycle` have rejected."""
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in kpi.schema])
    if not kpi.folder.names(f"{_REJECTS}/hour=*"):
        return kpi.spark.createDataFrame([], schema)
    return kpi.spark.read.schema(schema).parquet(f"{kpi.folder.plain_root}/{_REJECTS}/hour=*")
