"""The chunks of several tables under SQL, as table functions that take a row of another table."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidevault.operators.chunks import ChunkedTable

_COLUMNS = "chunk_id BIGINT, chunk_name STRING, range_start TIMESTAMP, range_end TIMESTAMP"
_SIZES = "n_rows BIGINT, n_files BIGINT, bytes BIGINT, is_compressed BOOLEAN, overflow_rows BIGINT"


def catalogue(tables: Mapping[str, ChunkedTable], sizes: bool = False) -> DataFrame:
    """One row per table (``relation``) and chunk; without ``sizes`` from folder names alone."""
    each = []
    for name, table in tables.items():
        rows = table.show_chunks()
        if sizes:
            more = ("n_rows", "n_files", "bytes", "is_compressed", "overflow_rows")
            rows = rows.join(table.chunks().select("chunk_id", *more), "chunk_id")
        zoned = [F.col(c).cast("timestamp").alias(c) for c in ("range_start", "range_end")]
        rest = [c for c in rows.columns if c not in ("chunk_id", "chunk_name", "range_start", "range_end")]
        each.append(rows.select(F.lit(name).alias("relation"), "chunk_id", "chunk_name", *zoned, *rest))
    return reduce(DataFrame.unionByName, each)


def create_functions(
    tables: Mapping[str, ChunkedTable], show: str = "show_chunks", detailed: str = "chunk_sizes"
) -> None:
    """Table functions for ``spark.sql`` over the tables, by their names:

    ``show(relation, older_than, newer_than)`` gives the chunks wholly before or wholly after the
    instants (null: no bound), and ``detailed(relation)`` their rows, files and bytes as well. Both may follow
    ``LATERAL`` with arguments from an outer table; Catalyst turns the calls into one join. They show
    the tables as they are now; call this again after chunks have come or gone.
    """
    spark = next(iter(tables.values())).spark
    for name, sizes in ((show, False), (detailed, True)):
        rows = catalogue(tables, sizes)
        rows.createOrReplaceTempView(f"{name}_rows")
        bounds = "" if sizes else ", older_than TIMESTAMP DEFAULT NULL, newer_than TIMESTAMP DEFAULT NULL"
        within = (
            ""
            if sizes
            else f""" AND ({name}.older_than IS NULL OR range_end < {name}.older_than)
                      AND ({name}.newer_than IS NULL OR range_start > {name}.newer_than)"""
        )
        shown = ", ".join(c for c in rows.columns if c != "relation")
        spark.sql(
            f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(relation STRING{bounds})
                RETURNS TABLE({_COLUMNS}{', ' + _SIZES if sizes else ''})
                RETURN SELECT {shown} FROM {name}_rows AS r WHERE r.relation = {name}.relation{within}"""
        )
