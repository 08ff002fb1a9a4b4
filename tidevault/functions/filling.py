"""Values carried over gaps, and averages weighted by time, without a window over a whole key.

Time is cut into blocks of buckets. Within a block a value is carried by a window; what a
block hands on to the next ones is worked out from one row per key and block. So the longest
gap of the busiest key is filled by as many tasks as it has blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidevault.functions.buckets import WidthLike, gapfill, time_bucket
from tidevault.functions.times import Instant, Width, from_micros, to_micros, ts_lit

BLOCK = 4096  # rows of one key that a window holds


def _block(bucket: str, step_us: int, block: int) -> Column:
    us = F.unix_micros(F.col(bucket).cast("timestamp"))
    return F.floor(us / (step_us * block)).cast("long")


def carry_forward(
    rows: DataFrame,
    bucket: str,
    width: WidthLike,
    keys: Sequence[str],
    values: Sequence[str],
    block: int = BLOCK,
) -> DataFrame:
    """Nulls in ``values`` become the last known value before, by key; leading ones stay null.

    ``rows`` hold at most one row for each key and bucket, as ``gapfill`` gives them; nulls in a key
    are equal. A block is ``block`` buckets long (a month counts as its shortest).
    """
    width = Width.parse(width)
    step = width.micros or width.months * 28 * 86_400_000_000
    blocked = rows.withColumn("_block", _block(bucket, step, block))
    # The last known value of each block, one row per key and block.
    known = lambda v: F.struct(F.col(bucket).alias("at"), F.col(v).alias("value"))
    ends = blocked.groupBy(*keys, "_block").agg(
        *[F.max(F.when(F.col(v).isNotNull(), known(v))).alias(f"_end_{v}") for v in values]
    )
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    handed = ends.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys],
        F.col("_block").alias("_key_block"),
        *[F.last(f"_end_{v}", True).over(before)["value"].alias(f"_from_{v}") for v in values],
    )
    on = F.col("_block") == F.col("_key_block")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    inside = Window.partitionBy(*keys, "_block").orderBy(bucket).rowsBetween(Window.unboundedPreceding, 0)
    joined = blocked.join(handed, on, "left")
    return joined.select(
        *[
            F.coalesce(F.last(c, True).over(inside), F.col(f"_from_{c}")).alias(c) if c in values else F.col(c)
            for c in rows.columns
        ]
    )


def time_weighted(
    df: DataFrame,
    width: WidthLike,
    start: Instant,
    end: Instant,
    value: str,
    keys: Sequence[str] = (),
    ts: str = "ts",
    bucket: str = "bucket",
    origin: Instant | None = None,
    block: int = BLOCK,
) -> DataFrame:
    """``bucket``, keys, ``weighted`` and ``micros``: each reading holds until the next one.

    For every bucket of ``[start, end)`` that begins on the grid and every key, ``weighted`` is the
    sum of value times microseconds, and ``micros`` how long a value was known; their ratio
    is the time-weighted average. The value that a bucket begins with is carried from the
    readings before, also from those before ``start``. Null values are no readings; of several
    readings at one instant the highest value holds. Buckets before a key's first reading are null.
    """
    width = Width.parse(width)
    kind = df.schema[ts].dataType
    lo, hi = width.ceil(to_micros(start), origin), to_micros(end)
    stop = ts_lit(hi, kind)
    readings = df.where(F.col(value).isNotNull() & (F.col(ts) < stop)).select(*keys, ts, value)
    readings = readings.groupBy(*keys, ts).agg(F.max(value).alias(value))
    first = ts_lit(lo, kind)
    inside = readings.where(F.col(ts) >= first)
    inside = inside.withColumn(bucket, time_bucket(inside, width, ts, origin))
    latest = lambda rows, *by: rows.groupBy(*by).agg(F.max_by(value, ts).alias("_last"))
    # The last value of every bucket, and one row before the first for what came earlier.
    per_bucket = latest(inside, bucket, *keys)
    earlier = latest(readings.where(F.col(ts) < first), *keys)
    known = readings.select(*keys).distinct() if keys else None
    grid = gapfill(per_bucket, bucket, width, from_micros(lo), end, keys, origin=origin, key_rows=known)
    us = F.unix_micros(F.col(bucket).cast("timestamp"))
    grid = grid.where(us >= F.lit(lo))
    back = F.timestamp_micros(F.lit(lo - 1)).cast(kind).alias(bucket)
    grid = grid.unionByName(earlier.select(back, *keys, "_last"))
    carried = carry_forward(grid, bucket, width, keys, ["_last"], block)
    # What a bucket begins with is what the one before it ends with.
    if width.months:
        close = F.add_months(F.col(bucket).cast("date"), width.months).cast(kind)
    else:
        close = F.timestamp_micros(us + width.micros).cast(kind)
    after = F.when(us < F.lit(lo), first).otherwise(close)
    begins = carried.select(after.alias(bucket), *keys, F.col("_last").alias(value))
    begins = begins.where((F.col(bucket) < stop) & F.col(value).isNotNull())
    # A reading at the very start of a bucket takes the carried value's place.
    steps = inside.select(bucket, *keys, F.col(ts).alias("_at"), value, F.lit(1).alias("_own")).unionByName(
        begins.select(bucket, *keys, F.col(bucket).alias("_at"), value, F.lit(0).alias("_own"))
    )
    order = Window.partitionBy(bucket, *keys).orderBy("_at", "_own")
    until = F.coalesce(F.lead("_at").over(order), F.least(close, stop))
    lasts = F.unix_micros(until.cast("timestamp")) - F.unix_micros(F.col("_at").cast("timestamp"))
    sums = steps.withColumn("_us", lasts).groupBy(bucket, *keys).agg(
        F.sum(F.col(value) * F.col("_us").cast("decimal(20,0)")).alias("weighted"), F.sum("_us").alias("micros")
    )
    return gapfill(sums, bucket, width, from_micros(lo), end, keys, origin=origin, key_rows=known)

