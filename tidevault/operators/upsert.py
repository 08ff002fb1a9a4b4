"""Keyed upsert into a chunked table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidevault.functions.times import ts_lit
from tidevault.operators.chunks import ChunkedTable
from tidevault.schemas import conform
from tidevault.session import micros_timestamps
from tidevault.sources.folders import fresh


def latest_per_key(batch: DataFrame, key: Sequence[str], version: str) -> DataFrame:
    """The row of the highest version per key; copies collapse before the shuffle."""
    columns = [c for c in batch.columns if c != version]
    newest = batch.groupBy(*key).agg(F.max_by(F.struct(*columns), version).alias("_row"))
    return newest.select("_row.*")


def _same_key(left: str, right: str, key: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in key])


def upsert(
    table: ChunkedTable,
    batch: DataFrame,
    key: Sequence[str],
    version: str | None = None,
    null_keys: bool = False,
) -> int:
    """Rows of ``batch`` replace those of the same key or are added; other keys stay.

    The batch is written once to the table's folder, so each step sees the same
    rows, also when a task is run again. Of the chunks the batch touches, the keys within
    its instants are read, and only the loads that hold one of its keys are rewritten: what
    an upsert costs follows the batch. Without ``version`` a key may occur once per batch;
    with it the highest version wins. A null in the key is refused, or with ``null_keys``
    equal to another null. Returns the number of rows written from the batch.
    """
    if table.ts not in key:
        raise ValueError(f"the key has to hold {table.ts!r}, which decides the chunk")
    if version is not None:
        batch = latest_per_key(batch, key, version)
    kept = fresh("batch")
    path = f"{table.root}/{kept}"
    rows = table.routed(batch)
    with micros_timestamps(rows):
        rows.write.parquet(path)
    staged = table.spark.read.parquet(f"{table.folder.plain_root}/{kept}")
    try:
        us = F.unix_micros(F.col(table.ts).cast("timestamp"))
        has_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
        per_key = staged.groupBy("chunk_id", *key).count()
        touched = per_key.groupBy("chunk_id").agg(
            F.sum("count"), F.max("count"), F.min(us), F.max(us), F.max(has_null)
        )
        touched = touched.collect()  # one row per chunk
        if not touched:
            return 0
        if not null_keys and any(null for *_, null in touched):
            raise ValueError(f"the batch holds a null in the key {tuple(key)}")
        if max(most for _, _, most, *_ in touched) > 1:
            raise ValueError(f"the batch holds a key of {tuple(key)} more than once")
        ids = [chunk for chunk, *_ in touched]
        table.recover()
        existing = table.read_chunks(ids)
        lo, hi = min(t[3] for t in touched), max(t[4] for t in touched)
        within = F.col(table.ts).between(ts_lit(lo, table.ts_type), ts_lit(hi, table.ts_type))
        keys = staged.select(*key).alias("b")
        on = _same_key("a", "b", key)
        met = existing.where(within).select("chunk_id", "load", *key).alias("a").join(keys, on, "left_semi")
        seen: dict[int, set[str]] = {i: set() for i in ids}
        for chunk, load in met.select("chunk_id", "load").distinct().collect():  # as many as loads
            seen[chunk].add(load)
        rows = conform(staged.drop("chunk_id"), table.schema)
        if any(seen.values()):
            hit = [(c, label) for c, loads in seen.items() for label in loads]
            hits = F.broadcast(table.spark.createDataFrame(hit, "chunk_id long, load string"))
            old = existing.join(hits, ["chunk_id", "load"], "left_semi").alias("a")
            old = old.join(keys, on, "left_anti").select(*[f"a.{c}" for c in table.schema.names])
            rows = old.unionByName(rows)
        table.replace_chunks(rows, ids, seen, [(lo, hi)])
        return sum(rows for _, rows, *_ in touched)
    finally:
        table.folder.delete(kept)
