"""Reports on the chunk layout of a table."""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidevault.functions.scalars import pretty_bytes
from tidevault.functions.times import Instant, Width, fixed_micros, to_micros
from tidevault.operators.chunks import ChunkedTable


def with_readable_size(chunks: DataFrame) -> DataFrame:
    return chunks.withColumn("size", pretty_bytes("bytes"))


def pruning_report(table: ChunkedTable, start: Instant, end: Instant) -> DataFrame:
    """Chunks, files, rows and bytes a half-open range touches, against the whole table.

    The last two columns are what an unpartitioned copy would have to read.
    """
    first, last = table.id_of(to_micros(start)), table.id_of(to_micros(end) - 1)
    hit = F.col("chunk_id").between(first, last)

    def part(column: str):
        return F.coalesce(F.sum(F.when(hit, F.col(column))), F.lit(0))

    return table.chunks().agg(
        F.count(F.when(hit, 1)).alias("chunks_touched"),
        F.count(F.lit(1)).alias("chunks_total"),
        part("n_files").alias("files_touched"),
        part("n_rows").alias("rows_read"),
        part("bytes").alias("bytes_read"),
        F.sum("n_rows").alias("rows_total"),
        F.sum("bytes").alias("bytes_total"),
    )


def sizing(
    df: DataFrame,
    intervals: Sequence[str | dt.timedelta | Width],
    ts: str = "ts",
    bytes_per_row: float | None = None,
) -> DataFrame:
    """How many chunks each interval would make, and how large they would be.

    The rows are counted once, on the finest grid that all intervals share; the
    candidates are then derived from those counts.
    """
    sizes = {str(i): fixed_micros(i) for i in intervals}
    unit = math.gcd(*sizes.values())
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    cell = F.call_function("div", us - F.pmod(us, F.lit(unit)), F.lit(unit))
    counts = df.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("rows"))
    options = F.array(
        *[
            F.struct(F.lit(name).alias("chunk_interval"), F.lit(size // unit).alias("cells"))
            for name, size in sizes.items()
        ]
    )
    each = counts.select("cell", "rows", F.explode(options).alias("o")).select(
        "cell", "rows", "o.chunk_interval", "o.cells"
    )
    chunk = F.call_function("div", F.col("cell") - F.pmod("cell", "cells"), F.col("cells"))
    per_chunk = each.groupBy("chunk_interval", chunk.alias("chunk_id")).agg(
        F.sum("rows").alias("rows")
    )
    out = per_chunk.groupBy("chunk_interval").agg(
        F.count(F.lit(1)).alias("n_chunks"),
        F.percentile("rows", 0.5).alias("rows_p50"),
        F.max("rows").alias("rows_max"),
    )
    if bytes_per_row is not None:
        out = out.withColumn("bytes_p50", F.col("rows_p50") * bytes_per_row)
        out = out.withColumn("bytes_max", F.col("rows_max") * bytes_per_row)
    return out


def sizing_of(table: ChunkedTable, intervals: Sequence[str | dt.timedelta | Width]) -> DataFrame:
    """:func:`sizing` of a table, with bytes from its present bytes per row."""
    total = table.chunks().agg(F.sum("bytes"), F.sum("n_rows")).first()
    per_row = total[0] / total[1] if total[1] else None
    return sizing(table.scan(), intervals, table.ts, per_row)


def table_sizes(tables: dict[str, ChunkedTable]) -> DataFrame:
    """Chunks, rows and bytes per table, summed over each table's chunk listing."""
    stacked = None
    for name, table in tables.items():
        one = table.chunks().agg(
            F.lit(name).alias("tabla"),
            F.count(F.lit(1)).alias("n_chunks"),
            F.sum("n_rows").alias("n_rows"),
            F.sum("bytes").alias("bytes"),
        )
        stacked = one if stacked is None else stacked.unionByName(one)
    return with_readable_size(stacked)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: its name and its row count."""
    stacked = None
    for name, df in tables.items():
        one = df.agg(F.lit(name).alias("tabla"), F.count(F.lit(1)).alias("registros"))
        stacked = one if stacked is None else stacked.unionByName(one)
    return stacked
