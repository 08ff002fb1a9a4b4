"""Compaction: old chunks rewritten in clustered order, without loss."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidevault.functions.times import Instant, Width, ago, now, to_micros
from tidevault.operators.chunks import COMPACTED, ChunkedTable
from tidevault.operators.synopsis import (
    first_keys,
    forget,
    has_place_key,
    keep,
    key_order,
    of_files,
    place_key,
    tidy,
)
from tidevault.session import micros_timestamps
from tidevault.sources.folders import fresh

TARGET_FILE_BYTES = 256 << 20
# One pass rewrites about this much, which bounds the staging space and the work at stake.
PASS_BYTES = 4 << 40
PASS_CHUNKS = 20_000


def _order(table: ChunkedTable) -> list[Column]:
    by = [F.col(c) for c in table.segment_by]
    return by + [F.desc(c) if d == "desc" else F.asc(c) for c, d in table.order_by]


def fingerprint(table: ChunkedTable, rows: DataFrame, hashes: bool = True) -> DataFrame:
    """Rows and an order-free hash sum per chunk; without hashes no column is read."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    if hashes:
        row_hash = F.xxhash64(*table.schema.names).cast("decimal(38,0)")
        aggs.append(F.sum(row_hash).alias("hash_sum"))
    return rows.groupBy("chunk_id").agg(*aggs)


def _hash_sum(table: ChunkedTable) -> Column:
    """An order-free sum over rows that depends on all their columns and their chunk."""
    return F.sum(F.xxhash64("chunk_id", *table.schema.names).cast("decimal(38,0)"))


def _passes(sizes: dict[int, int]) -> list[list[int]]:
    passes: list[list[int]] = []
    room = 0
    for chunk, size in sorted(sizes.items()):
        if not passes or size > room or len(passes[-1]) == PASS_CHUNKS:
            passes.append([])
            room = PASS_BYTES
        passes[-1].append(chunk)
        room -= size
    return passes


def _encodings(table: ChunkedTable) -> dict[str, str]:
    """Version 2 pages; ordered instants and integers as differences, not as a dictionary."""
    options = {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0"}
    for name, _ in table.order_by:
        if isinstance(
            table.schema[name].dataType,
            (T.TimestampType, T.TimestampNTZType, T.IntegerType, T.LongType),
        ):
            options[f"parquet.enable.dictionary#{name}"] = "false"
    return options


class _Staging:
    """Rows on their way into a rewrite: counted and summed in the tasks that write them."""

    def __init__(self, table: ChunkedTable, verify: str):
        self.table, self.verify = table, verify
        self.name = fresh("staging")
        self.options = _encodings(table)
        self.told: list[Observation] = []

    def add(self, rows: DataFrame, rows_per_file: int = 0) -> None:
        """Write rows; a task with more than ``rows_per_file``, if given, makes several files."""
        if self.verify == "hashes":
            self.told.append(Observation())
            rows = rows.observe(self.told[-1], F.count(F.lit(1)).alias("n"), _hash_sum(self.table).alias("h"))
        cut = {"maxRecordsPerFile": str(rows_per_file)} if rows_per_file else {}
        self.table.stage(rows, self.name, "append", self.options | cut)

    def put_in_place(
        self, before: dict[int, int], seen: dict[int, set[str]], kept: dict[int, list[str]] | None = None
    ) -> None:
        """Keep the synopses, compare rows per chunk and hash sums, and swap the chunks."""
        table, token = self.table, self.name.removeprefix("_")
        written = table.spark.read.schema(table.stored).option(
            "basePath", f"{table.root}/{self.name}"
        ).parquet(f"{table.folder.plain_root}/{self.name}")
        # The synopses read every row that was written, so they carry the comparison too.
        hashed = [_hash_sum(table).alias("_hash")] if self.verify == "hashes" else []
        synopses = keep(table, written, token, hashed)
        if self.verify != "off":
            facts = [F.sum("n").alias("n"), *([F.sum("_hash").alias("h")] if hashed else [])]
            after = synopses.groupBy("chunk_id").agg(*facts).collect()  # one row per chunk
            same = {r["chunk_id"]: r["n"] for r in after} == before
            if same and hashed:
                same = sum(t.get.get("h") or 0 for t in self.told) == sum(r["h"] or 0 for r in after)
            if not same:
                forget(table, token)
                table.folder.delete(self.name)
                raise RuntimeError("rewritten chunks differ from the live ones; nothing was changed")
        table.swap_in(self.name, list(before), COMPACTED, seen, kept)
        tidy(table)


def _range_tasks(table: ChunkedTable, size: int, target: int) -> int:
    """How many tasks cut chunks of a size in all into files of the target size.

    Every task sends its outcome, and every range a sample of its keys, to the driver. So
    files far smaller than ``TARGET_FILE_BYTES`` are made many to a task, as long as all cores
    have work: the driver's share follows the bytes, not the number of files.
    """
    enough = max(2 * table.spark.sparkContext.defaultParallelism, -(-size // TARGET_FILE_BYTES))
    return min(-(-size // target), enough)


def _rewrite(
    table: ChunkedTable, sizes: dict[int, int], n_rows: dict[int, int], verify: str, target: int
) -> None:
    """Rewrite whole chunks, of these sizes and numbers of rows."""
    staging = _Staging(table, verify)
    small = [i for i, size in sizes.items() if size <= target]
    large = [i for i, size in sizes.items() if size > target]
    order = _order(table)
    # One listing serves all steps: loads that arrive from now on are left alone.
    live = table.read_chunks(list(sizes))
    seen = table.loads_read(live)
    if small:
        # Each of these fits one task by its measured size: one file per chunk. The place in
        # the list of chunks gives each a task of its own, however they lie in time.
        places = [(chunk, i) for i, chunk in enumerate(sorted(small))]
        places = table.spark.createDataFrame(places, "chunk_id long, _place int")
        rows = live.join(F.broadcast(places), "chunk_id").drop("load")
        rows = rows.repartitionById(len(small), F.col("_place"))
        staging.add(rows.sortWithinPartitions("chunk_id", *order).select(*table.schema.names, "chunk_id"))
    if large:
        # Ranges of (chunk, segment, order) cut a chunk into files of the target size
        # whatever its share of the data. The row's own position breaks ties, so
        # neither one busy segment nor a mass of equal rows can fill one task.
        size = sum(sizes[i] for i in large)
        n, files = _range_tasks(table, size, target), -(-size // target)
        per_file = -(-sum(n_rows[i] for i in large) // files) if n < files else 0
        rows = live.where(F.col("chunk_id").isin(large)).select(
            "*", F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("_tie")
        )
        rows = rows.drop("load").repartitionByRange(n, "chunk_id", *order, "_tie")
        staging.add(rows.sortWithinPartitions("chunk_id", *order).drop("_tie"), per_file)
    # One row per chunk comes to the driver; the counts are in the files' footers.
    counts = fingerprint(table, live, False).collect() if verify != "off" else []
    before = {r["chunk_id"]: r["n_rows"] for r in counts} or dict.fromkeys(sizes, 0)
    staging.put_in_place(before, seen)


def _merge_overflow(table: ChunkedTable, ids: Sequence[int], verify: str, target: int) -> list[int]:
    """Take overflow into the files whose key ranges it meets; the other files stay.

    Only chunks of several compacted files that all have synopses, none of them far above the
    target, and with overflow of one task's size are done so; their numbers are returned.
    """
    files = [r.asDict() for r in table.files(ids).collect()] if has_place_key(table) else []  # a listing
    for f in files:
        f["file"] = f["file_path"].rsplit("/", 1)[1]
        f["old"] = f["load"].startswith(COMPACTED)
    _, have = of_files(table, [(f["chunk_id"], f["file"]) for f in files if f["old"]])
    done: list[int] = []
    for chunk in ids:
        own = [f for f in files if f["chunk_id"] == chunk]
        old, new = [f for f in own if f["old"]], [f for f in own if not f["old"]]
        if (
            len(old) > 1
            and new
            and sum(f["file_size"] for f in new) <= target
            and all((chunk, f["file"]) in have and f["file_size"] <= 2 * target for f in old)
        ):
            done.append(chunk)
    if not done:
        return []
    files = [f for f in files if f["chunk_id"] in done]
    batch = fresh("batch")
    try:
        synopses, _ = of_files(table, [(f["chunk_id"], f["file"]) for f in files if f["old"]])
        starts = first_keys(table, synopses).withColumn("_row", F.lit(None).cast(_row_type(table)))
        arrived = table.read_paths([f["file_path"] for f in files if not f["old"]])
        arrived = arrived.select(
            "chunk_id",
            F.lit(None).cast("string").alias("file"),
            place_key(table).alias("at"),
            F.struct(*table.schema.names).alias("_row"),
        )
        # A row belongs to the last file that begins at or before its key, or to the first file.
        # Overflow of one task's size and one row per file make the window of a chunk.
        order = Window.partitionBy("chunk_id").orderBy(*key_order(table, "at"), F.col("_row").isNotNull())
        back = order.rowsBetween(Window.unboundedPreceding, 0)
        ahead = order.rowsBetween(0, Window.unboundedFollowing)
        meets = F.coalesce(F.last("file", True).over(back), F.first("file", True).over(ahead))
        placed = starts.unionByName(arrived).withColumn("_file", meets).where("_row IS NOT NULL")
        placed = placed.select("chunk_id", "_file", "_row.*")
        with micros_timestamps(placed):
            placed.write.parquet(f"{table.root}/{batch}")
        placed = table.spark.read.parquet(f"{table.folder.plain_root}/{batch}")
        met = {(r[0], r[1]) for r in placed.select("chunk_id", "_file").distinct().collect()}  # files
        places = [(*m, i) for i, m in enumerate(sorted(met))]
        places = table.spark.createDataFrame(places, "chunk_id long, _file string, _place int")
        rewritten = [f for f in files if f["old"] and (f["chunk_id"], f["file"]) in met]
        old = table.read_paths([f["file_path"] for f in rewritten])
        old = old.withColumn("_file", F.col("_metadata.file_name")).drop("load")
        rows = old.unionByName(placed).join(F.broadcast(places), ["chunk_id", "_file"])
        rows = rows.repartitionById(len(met), F.col("_place"))
        staging = _Staging(table, verify)
        staging.add(
            rows.sortWithinPartitions("chunk_id", *_order(table)).select(*table.schema.names, "chunk_id")
        )
        before: dict[int, int] = dict.fromkeys(done, 0)
        kept: dict[int, list[str]] = {i: [] for i in done}
        seen: dict[int, set[str]] = {i: set() for i in done}
        for f in files:
            chunk = f["chunk_id"]
            seen[chunk].add(f["load"])
            if f["old"] and (chunk, f["file"]) not in met:
                kept[chunk].append(f"load={f['load']}/{f['file']}")
            else:
                before[chunk] += f["rows"]
        staging.put_in_place(before, seen, kept)
    finally:
        table.folder.delete(batch)
    return done


def _row_type(table: ChunkedTable) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in table.schema])


def compress_chunks(
    table: ChunkedTable,
    ids: Sequence[int],
    verify: str = "hashes",
    target_file_bytes: int = TARGET_FILE_BYTES,
) -> DataFrame:
    """Rewrite the given chunks, and report their size and files before and after.

    Chunks already compacted and without overflow are left as they are. In a chunk of several
    files, overflow rewrites those files alone whose key ranges it meets. Before anything
    live is moved, ``verify`` compares the ``hashes`` and counts of every chunk, or the
    ``counts`` alone (from file footers), or is ``off``.
    """
    if verify not in ("hashes", "counts", "off"):
        raise ValueError(f"verify is hashes, counts or off, not {verify!r}")
    table.recover()
    state = table.chunks(ids).where("NOT is_compressed OR overflow_rows > 0")
    state = [r.asDict() for r in state.collect()]  # one row per chunk
    sizes = {r["chunk_id"]: r["bytes"] for r in state}
    n_rows = {r["chunk_id"]: r["n_rows"] for r in state}
    overflowing = [r["chunk_id"] for r in state if r["overflow_rows"]]
    merged = set(_merge_overflow(table, overflowing, verify, target_file_bytes) if overflowing else [])
    for group in _passes({i: size for i, size in sizes.items() if i not in merged}):
        _rewrite(table, {i: sizes[i] for i in group}, n_rows, verify, target_file_bytes)
    before = table.spark.createDataFrame(
        [(r["chunk_id"], r["n_rows"], r["n_files"], r["bytes"]) for r in state],
        "chunk_id long, rows_before long, files_before long, bytes_before long",
    )
    after = table.chunks(list(sizes)).select(
        "chunk_id",
        F.col("n_rows").alias("rows_after"),
        F.col("n_files").alias("files_after"),
        F.col("bytes").alias("bytes_after"),
    )
    ratio = F.round(F.col("bytes_before") / F.col("bytes_after"), 2)
    return before.join(after, "chunk_id").withColumn("ratio", ratio)


def oldest_chunks(table: ChunkedTable, n: int) -> list[int]:
    """The ``n`` chunks that start first."""
    return table.chunk_ids()[:n]


def chunk_starting(table: ChunkedTable, start: Instant) -> list[int]:
    """The live chunk whose range starts at ``start``; found by time, never by name."""
    us = to_micros(start)
    return [i for i in table.chunk_ids() if i * table.interval_us == us]


def compact_due(
    table: ChunkedTable,
    as_of: Instant | None = None,
    compress_after: str | dt.timedelta | Width = "7 days",
    **options,
) -> DataFrame:
    """The compaction policy, as of one instant.

    Chunks that ended long enough ago are rewritten when they are not compacted or
    have overflow; the active chunk is not touched.
    """
    return compress_chunks(table, table.older_than(ago(as_of or now(), compress_after)), **options)
