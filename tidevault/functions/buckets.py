"""Time buckets as native expressions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidevault.functions.times import Instant, Width, from_micros, to_micros, ts_lit
from tidevault.session import spread

WidthLike = Width | str | dt.timedelta

# Buckets made per generated block of a gap-fill grid; keeps each array small.
_GRID_BLOCK = 4096


def time_bucket(
    df: DataFrame, width: WidthLike, ts: str = "ts", origin: Instant | None = None
) -> Column:
    """Start of the bucket of ``ts``, in the column's own type.

    Fixed widths use ``F.window``, which stays inside generated code for both
    timestamp types; month widths, which ``F.window`` refuses, use date arithmetic.
    """
    width = Width.parse(width)
    start = width.origin(origin)
    if width.months:
        first = from_micros(start)
        gap = F.year(ts) * 12 + F.month(ts) - (first.year * 12 + first.month)
        back = F.pmod(gap, F.lit(width.months))
        return F.add_months(F.trunc(ts, "month"), -back).cast(df.schema[ts].dataType)
    size = f"{width.micros} microseconds"
    shift = f"{start % width.micros} microseconds"
    return F.window(ts, size, size, shift)["start"]


def date_floor(df: DataFrame, unit: str, ts: str = "ts") -> Column:
    """Calendar truncation that keeps the column's type."""
    return F.date_trunc(unit, F.col(ts)).cast(df.schema[ts].dataType)


def with_bucket(
    df: DataFrame,
    name: str,
    width: WidthLike,
    ts: str = "ts",
    origin: Instant | None = None,
) -> DataFrame:
    return df.withColumn(name, time_bucket(df, width, ts, origin))


def downsample(
    df: DataFrame,
    width: WidthLike,
    aggs: Mapping[str, Column],
    bucket: str = "bucket",
    keys: Sequence[str] = (),
    ts: str = "ts",
    origin: Instant | None = None,
) -> DataFrame:
    """One row per bucket (and key); partial aggregation runs before the shuffle."""
    grouped = df.groupBy(time_bucket(df, width, ts, origin).alias(bucket), *keys)
    return grouped.agg(*[agg.alias(name) for name, agg in aggs.items()])


def bucket_bounds(
    width: WidthLike, at: Instant, origin: Instant | None = None
) -> tuple[dt.datetime, dt.datetime] | None:
    """``bucket(ts) = at`` as a half-open range of ``ts``; None when no bucket starts at ``at``."""
    width = Width.parse(width)
    us = to_micros(at)
    if width.floor(us, origin) != us:
        return None
    return from_micros(us), from_micros(width.add(us, 1))


def bucket_equals(
    df: DataFrame, width: WidthLike, at: Instant, ts: str = "ts", origin: Instant | None = None
) -> DataFrame:
    """Rows of the bucket that starts at ``at``, filtered by a range the scan can use."""
    bounds = bucket_bounds(width, at, origin)
    if bounds is None:
        return df.where(F.lit(False))
    dtype = df.schema[ts].dataType
    lo, hi = (ts_lit(to_micros(b), dtype) for b in bounds)
    return df.where((F.col(ts) >= lo) & (F.col(ts) < hi))


def gapfill(
    agg: DataFrame,
    bucket: str,
    width: WidthLike,
    start: Instant | None = None,
    end: Instant | None = None,
    keys: Sequence[str] = (),
    fill: Mapping[str, object] | None = None,
    origin: Instant | None = None,
    key_rows: DataFrame | None = None,
    outside: str = "drop",
) -> DataFrame:
    """Every bucket of ``[start, end)`` for every key of ``agg``; absent ones are null or ``fill``.

    An end that is not given is that of the data: its first bucket, or the end of its last.
    Rows of ``agg`` outside the range are left out, or with ``outside="keep"`` stay as they
    are, so that nothing is lost to a range that is too short. Keys come from ``agg`` (which is then computed for them as well) or, if given,
    from ``key_rows``, a table of the known keys.

    The grid grows out of the distinct keys with ``explode`` in two steps (blocks,
    spread over all tasks, then buckets), so no row ever holds the whole time range
    and nothing is cross joined. The left join then shuffles on bucket and key together, so one busy
    key is spread over all tasks.
    """
    if outside not in ("drop", "keep"):
        raise ValueError(f"outside is drop or keep, not {outside!r}")
    width = Width.parse(width)
    if start is None or end is None:
        us = F.unix_micros(F.col(bucket).cast("timestamp"))
        least, most = agg.agg(F.min(us), F.max(us)).first()
        if least is None:
            return agg
        start = from_micros(least) if start is None else start
        end = from_micros(width.add(most, 1)) if end is None else end
    lo, hi = width.floor(to_micros(start), origin), to_micros(end)
    if width.months:
        first, last = from_micros(lo), from_micros(max(hi - 1, lo))
        n = ((last.year - first.year) * 12 + last.month - first.month) // width.months + 1
    else:
        n = -(-(hi - lo) // width.micros)
    dtype = agg.schema[bucket].dataType
    spark: SparkSession = agg.sparkSession
    if keys:
        base = (agg if key_rows is None else key_rows).select(*keys).distinct()
    else:
        base = spark.range(1).select()
    if hi <= lo:
        base, n = base.where(F.lit(False)), 1
    blocks = -(-n // _GRID_BLOCK)
    numbers = F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))
    blocked = spread(base.select("*", F.explode(numbers).alias("_block")), *keys, "_block")
    step = blocked.select(
        *keys,
        F.explode(
            F.sequence(
                F.col("_block") * _GRID_BLOCK,
                F.least((F.col("_block") + 1) * _GRID_BLOCK, F.lit(n).cast("long")) - 1,
            )
        ).alias("_k"),
    )
    if width.months:
        edge = F.add_months(
            ts_lit(lo, dtype).cast("date"), (F.col("_k") * width.months).cast("int")
        )
    else:
        edge = F.timestamp_micros(F.lit(lo) + F.col("_k") * width.micros)
    grid = step.select(edge.cast(dtype).alias(bucket), *keys)
    on = (F.col(f"g.{bucket}") == F.col(f"a.{bucket}"))
    for key in keys:
        on = on & F.col(f"g.{key}").eqNullSafe(F.col(f"a.{key}"))
    values = [c for c in agg.columns if c != bucket and c not in keys]
    joined = grid.alias("g").join(agg.alias("a"), on, "left")
    filled = joined.select(
        *[F.col(f"g.{c}").alias(c) for c in (bucket, *keys)], *[F.col(f"a.{c}") for c in values]
    )
    filled = filled.fillna(dict(fill)) if fill else filled
    if outside == "drop":
        return filled
    edges = [ts_lit(edge, dtype) for edge in (lo, hi)]
    outside = agg.where((F.col(bucket) < edges[0]) | (F.col(bucket) >= edges[1]) | F.col(bucket).isNull())
    return filled.unionByName(outside.select(*filled.columns))
