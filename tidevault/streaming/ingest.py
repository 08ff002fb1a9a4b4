"""Streams into chunked tables. Every sink can take the same micro-batch twice."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidevault.functions.times import Instant, Width, fixed_micros, from_micros, ts_lit
from tidevault.operators.chunks import ChunkedTable
from tidevault.operators.rollup import Rollup
from tidevault.operators.upsert import upsert
from tidevault.schemas import conform, split_valid
from tidevault.sources.folders import Folder


def _start(
    df: DataFrame,
    mode: str,
    each: Callable[[DataFrame, int], None],
    name: str,
    checkpoint: str,
    interval: str | None,
) -> StreamingQuery:
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if interval is None:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=interval)
    return writer.queryName(name).foreachBatch(each).start()


def _labels(table: ChunkedTable, name: str, checkpoint: str) -> Callable[[int], str]:
    """Labels of micro-batches, which hold the identity that a stream's checkpoint keeps."""
    identity: list[str] = []

    def label(batch_id: int) -> str:
        if not identity:
            about = Folder(table.spark, checkpoint).read_text("metadata")
            identity.append(json.loads(about)["id"].replace("-", "")[:16])
        return f"{name}-{batch_id}.{identity[0]}"

    return label


def stream_into(
    rows: DataFrame, table: ChunkedTable, name: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Append a stream to its chunks.

    Each micro-batch is a load of its own label, so a batch run again after a failure
    replaces its first attempt. The label holds the stream's identity, which its checkpoint
    keeps: another checkpoint counts from 0 again, but is another stream.
    """
    label_of = _labels(table, name, checkpoint)

    def each(batch: DataFrame, batch_id: int) -> None:
        table.append(batch, label_of(batch_id), same_rows=True)

    return _start(rows, "append", each, name, checkpoint, interval)


def stream_with_late(
    rows: DataFrame,
    rollup: Rollup,
    late: ChunkedTable,
    name: str,
    checkpoint: str,
    delay: str = "1 hour",
    start_offset: str = "1200 months",
    interval: str | None = None,
) -> StreamingQuery:
    """Feed a rollup's source, the rollup, and a table of the rows that came too late.

    The watermark of a micro-batch is the latest instant of all batches before it, less the
    ``delay``; it is written beside the checkpoint before the batch, so that a batch that
    is run again has the same one. Rows whose bucket had closed by then are late: they go to
    ``late`` as well as to the source. After each batch the rollup takes in, once, what has
    been added to buckets that are closed: for late rows it adds to figures that are there. So
    no row is lost to the watermark and none counts twice; the bucket in progress is withheld.
    """
    source, width = rollup.source, rollup.width
    us = F.unix_micros(F.col(source.ts).cast("timestamp"))
    marks = Folder(source.spark, f"{checkpoint}/marks")
    label_of = _labels(source, name, checkpoint)

    def each(batch: DataFrame, batch_id: int) -> None:
        label = label_of(batch_id)
        source.append(batch, label, same_rows=True)
        # Read back what was stored: the batch itself is not computed again.
        stored = source.read_chunks(c for c, loads in source.folder.loads().items() if label in loads)
        stored = stored.where(F.col("load") == label).select(*source.schema.names)
        mark = _mark(marks, batch_id)
        newest = stored.agg(F.max(us)).first()[0]
        if mark is not None:
            closed = width.floor(mark - fixed_micros(delay), rollup.origin)
            behind = stored.where(F.col(source.ts) < ts_lit(closed, source.ts_type))
            late.append(behind, label, same_rows=True)
        after = max((m for m in (mark, newest) if m is not None), default=None)
        if after is not None:
            if not marks.exists(str(batch_id + 1)):
                marks.mkdirs()
                marks.write_text(str(batch_id + 1), str(after))
            rollup.refresh_due(from_micros(after), start_offset, delay)

    return _start(rows, "append", each, name, checkpoint, interval)


def _mark(marks: Folder, batch_id: int) -> int | None:
    """The latest instant before a batch, in microseconds; a batch without rows hands it on."""
    known = [int(n) for n in marks.names("*") if n.isdigit() and int(n) <= batch_id]
    return int(marks.read_text(str(max(known)))) if known else None


def windowed(
    rows: DataFrame,
    ts: str,
    width: str | Width,
    keys: Sequence[str],
    delay: str,
    aggs: Sequence[Column],
    origin: Instant | None = None,
) -> DataFrame:
    """Tumbling windows with a watermark; the stream needs a zoned timestamp.

    They lie on the same grid as ``time_bucket``'s, which is the origin's.
    """
    zoned = rows.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    width = Width.parse(width)
    if width.months or not width.micros:
        raise ValueError("streamed windows need a grid of fixed width")
    size = f"{width.micros} microseconds"
    start = f"{width.origin(origin) % width.micros} microseconds"
    grouped = zoned.groupBy(F.window(ts, size, startTime=start).alias("_window"), *keys).agg(*aggs)
    return grouped.withColumn("_start", F.col("_window.start")).drop("_window")


def stream_rollup(
    rows: DataFrame,
    rollup: Rollup,
    name: str,
    checkpoint: str,
    delay: str = "1 hour",
    interval: str | None = None,
) -> StreamingQuery:
    """Feed a rollup from a stream.

    A bucket is written once, after the watermark has passed its end: the bucket in
    progress is withheld. It replaces what the rollup has for that bucket and those keys, so
    stream and refresh may both bring it. Readings later than that are left out here; ingest
    keeps them in the source, and ``Rollup.refresh_changed`` brings them in.
    """
    width = rollup.width
    aggs = [F.count(F.lit(1)).alias("n")]
    for value, label in rollup.values.items():
        aggs += [
            F.count(value).alias(f"{label}_n"),
            F.sum(value).alias(f"{label}_sum"),
            F.min(value).alias(f"{label}_min"),
            F.max(value).alias(f"{label}_max"),
        ]
    closed = windowed(rows, rollup.source.ts, width, rollup.keys, delay, aggs, rollup.origin)
    closed = closed.withColumnRenamed("_start", rollup.bucket)

    def each(batch: DataFrame, batch_id: int) -> None:
        rows = conform(batch, rollup.table.schema)
        upsert(rollup.table, rows, (rollup.bucket, *rollup.keys), null_keys=True)

    return _start(closed, "append", each, name, checkpoint, interval)


def stream_upsert(
    rows: DataFrame,
    table: ChunkedTable,
    key: Sequence[str],
    width: str,
    ts: str,
    aggs: Sequence[Column],
    name: str,
    checkpoint: str,
    delay: str = "1 hour",
    interval: str | None = None,
    reject_path: str | None = None,
) -> StreamingQuery:
    """Keep a keyed table of window figures up to date; changed windows are upserted.

    Rows with a null the table does not allow stop the stream, or go to
    ``reject_path``, one folder per micro-batch.
    """
    keys = [k for k in key if k != table.ts]
    changing = windowed(rows, ts, width, keys, delay, aggs).withColumnRenamed("_start", table.ts)

    def each(batch: DataFrame, batch_id: int) -> None:
        valid = conform(batch, table.schema)
        if reject_path is not None:
            valid, rejects = split_valid(valid, table.schema)
            rejects.write.mode("overwrite").parquet(f"{reject_path}/batch={batch_id}")
        upsert(table, valid, key)

    return _start(changing, "update", each, name, checkpoint, interval)
