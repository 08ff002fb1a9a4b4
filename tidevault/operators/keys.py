"""Primary keys that hold against stored rows: what an append may bring, and what is rejected."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidevault.functions.times import ts_lit
from tidevault.schemas import split_valid
from tidevault.session import micros_timestamps
from tidevault.sources.folders import fresh

_REJECTS = "_rejects"
# Up to this many values of a key column are looked for by name, which Bloom filters answer.
_FEW_VALUES = 10


def bloom_options(key: Sequence[str], ts: str) -> dict[str, str]:
    """Writer options: Bloom filters for the key's columns, but for the instant, which is ordered."""
    return {f"parquet.bloom.filter.enabled#{c}": "true" for c in key if c != ts}


def same_key(left: str, right: str, key: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in key])


def stored_keys(table, batch: DataFrame, label: str) -> DataFrame:
    """The keys of a written batch that the table holds already, outside the load ``label``.

    Only the batch's chunks are read, in them only its instants, and where the batch has few
    values of a key column, only row groups that can hold one of them.
    """
    us = F.unix_micros(F.col(table.ts).cast("timestamp"))
    others = [k for k in table.key if k != table.ts]
    few = batch.select(*others).distinct().limit(_FEW_VALUES + 1).collect() if others else []
    # One row per chunk comes to the driver.
    bounds = batch.groupBy("chunk_id").agg(F.min(us), F.max(us)).collect()
    stored = table.read_chunks([b[0] for b in bounds]).where(F.col("load") != label)
    if bounds:
        lo, hi = min(b[1] for b in bounds), max(b[2] for b in bounds)
        stored = stored.where(F.col(table.ts).between(ts_lit(lo, table.ts_type), ts_lit(hi, table.ts_type)))
    if 0 < len(few) <= _FEW_VALUES:
        for k in others:
            values = {r[k] for r in few}
            if None not in values:
                stored = stored.where(F.col(k).isin(sorted(values)))
    return batch.alias("b").join(stored.alias("s"), same_key("b", "s", table.key), "left_semi").select(*table.key)


def admit(table, rows: DataFrame, label: str) -> tuple[DataFrame, str]:
    """The rows of an append that keep the key, and the folder that holds its batch meanwhile.

    Rows whose key is stored already, or occurs more than once among them, go to the rejects
    of the load instead; nulls in a key are equal. What was rejected under a label stays
    decided, so a repeated append brings the same rows.
    """
    kept = fresh("batch")
    with micros_timestamps(rows):
        rows.write.parquet(f"{table.root}/{kept}")
    batch = table.spark.read.schema(rows.schema).parquet(f"{table.folder.plain_root}/{kept}")
    home = f"{_REJECTS}/load={label}"
    if not table.folder.exists(f"{home}/_SUCCESS"):
        once, repeated = split_valid(batch, rows.schema, table.key)
        found = stored_keys(table, batch, label).distinct()
        why = repeated.withColumn("reason", F.lit("repeated"))
        held = once.alias("r").join(found.alias("f"), same_key("r", "f", table.key), "left_semi")
        why = why.unionByName(held.withColumn("reason", F.lit("stored"))).drop("chunk_id")
        with micros_timestamps(why):
            why.write.mode("overwrite").parquet(f"{table.root}/{home}")
    out = rejects(table, label).select(*table.key).distinct()
    return batch.alias("r").join(out.alias("x"), same_key("r", "x", table.key), "left_anti"), kept


def rejects(table, label: str | None = None) -> DataFrame:
    """Rows that appends did not bring in, with the ``reason``: ``stored`` or ``repeated``."""
    schema = table.schema.fieldNames()
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema) + ", reason string"
    where = f"{_REJECTS}/load={label}" if label else _REJECTS
    if not table.folder.exists(where):
        return table.spark.createDataFrame([], kinds)
    found = table.spark.read.schema(kinds).parquet(f"{table.folder.plain_root}/{where}")
    return found.select(*schema, "reason")
