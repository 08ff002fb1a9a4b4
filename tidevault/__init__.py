"""Time-chunked tables, time buckets and rollups on Spark."""

from tidevault.functions.buckets import (
    bucket_equals,
    downsample,
    gapfill,
    time_bucket,
    with_bucket,
)
from tidevault.operators.chunks import ChunkedTable
from tidevault.operators.compact import compact_due, compress_chunks
from tidevault.operators.kpi import KpiSpec, kpi_hour, run_kpi
from tidevault.operators.retention import drop_chunks, preview, retain
from tidevault.operators.rollup import Rollup
from tidevault.operators.upsert import upsert
from tidevault.plans.lifecycle import LifecycleConfig, lifecycle
from tidevault.schemas import KPI, TELEMETRY

__all__ = [
    "KPI",
    "TELEMETRY",
    "ChunkedTable",
    "KpiSpec",
    "LifecycleConfig",
    "Rollup",
    "bucket_equals",
    "compact_due",
    "compress_chunks",
    "downsample",
    "drop_chunks",
    "gapfill",
    "kpi_hour",
    "lifecycle",
    "preview",
    "retain",
    "run_kpi",
    "time_bucket",
    "upsert",
    "with_bucket",
]
