"""Bulk load of files and batches into chunked tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame

from tidevault.operators.chunks import ChunkedTable


def read_files(table: ChunkedTable, path: str, fmt: str = "csv", **options: str) -> DataFrame:
    """Files under the table's declared schema; nothing is inferred."""
    reader = table.spark.read.schema(table.schema)
    if fmt in ("csv", "json"):  # a value that does not fit stops the load
        options = {"mode": "FAILFAST", **options}
    if fmt == "csv":
        options = {"header": "true", **options}
    return reader.options(**options).format(fmt).load(path)


def bulk_load(
    table: ChunkedTable,
    path: str,
    fmt: str = "csv",
    load: str | None = None,
    arranged: bool = False,
    **options: str,
) -> str:
    """Load csv, json, parquet or orc files; the same ``load`` label makes it repeatable.

    Files in time order are best loaded as ``arranged``, without a shuffle.
    """
    return table.append(read_files(table, path, fmt, **options), load, arranged)


def append_all(table: ChunkedTable, batches: Iterable[DataFrame], load: str | None = None) -> str:
    """Single-row or small inserts gathered into one append."""
    return table.append(
        reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches), load
    )


def insert_each(
    table: ChunkedTable, rows: Iterable[tuple], columns: Sequence[str] | None = None
) -> list[str]:
    """One append per row: the same outcome as one batch, at a much higher price."""
    return [table.append_rows([row], columns) for row in rows]
