"""Synopses of compacted files: counts, sums, minima and maxima per segment.

Compaction writes, for each file and segment, how many rows and values there are, their sums,
minima and maxima. An aggregate over a range takes chunks that lie wholly inside it from
their synopses, and reads rows only at the edges of the range, of loads that came after the
compaction, and of files without a synopsis. A synopsis holds for its file by name: one
whose file is gone is not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidevault.functions.times import Instant, to_micros, ts_lit
from tidevault.operators.chunks import COMPACTED, ChunkedTable

_SYNOPSIS = "_synopsis"
# So many rewrites may leave synopses of their own before they are put together.
_MOST_FOLDERS = 16
_PARTIALS = {"count": "n", "sum": "sum", "min": "min", "max": "max"}


def _summed(table: ChunkedTable) -> dict[str, tuple[str, ...]]:
    """The partial figures that are kept of each column outside the segment."""
    out: dict[str, tuple[str, ...]] = {}
    for f in table.schema:
        if f.name in table.segment_by:
            continue
        if isinstance(f.dataType, T.NumericType):
            out[f.name] = ("n", "sum", "min", "max")
        elif isinstance(f.dataType, (T.DatetimeType, T.TimestampNTZType)):
            out[f.name] = ("n", "min", "max")
        else:
            out[f.name] = ("n",)
    return out


def _named(column: str, figure: str) -> str:
    return f"{column}.{figure}"


def _figures(column: str, figures: Sequence[str]) -> list[Column]:
    make = {"n": F.count, "sum": F.sum, "min": F.min, "max": F.max}
    return [make[f](F.col(f"`{column}`")).alias(_named(column, f)) for f in figures]


def summarise(table: ChunkedTable, rows: DataFrame, more: Sequence[Column] = ()) -> DataFrame:
    """One row per chunk, file and segment of stored rows."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for column, figures in _summed(table).items():
        aggs += _figures(column, figures)
    at = F.col("_metadata.file_name").alias("file")
    return rows.groupBy("chunk_id", at, *table.segment_by).agg(*aggs, *more)


def keep(table: ChunkedTable, rows: DataFrame, token: str, more: Sequence[Column] = ()) -> DataFrame:
    """Write the synopses of staged rows; they hold once the files are in place."""
    summarise(table, rows, more).write.parquet(f"{table.root}/{_SYNOPSIS}/{token}")
    return table.spark.read.parquet(f"{table.folder.plain_root}/{_SYNOPSIS}/{token}")


def forget(table: ChunkedTable, token: str) -> None:
    table.folder.delete(f"{_SYNOPSIS}/{token}")


def known(table: ChunkedTable) -> DataFrame | None:
    """All synopses written, also those whose files are gone; None where there are none."""
    folders = [n for n in table.folder.names(f"{_SYNOPSIS}/*") if table.folder.exists(f"{n}/_SUCCESS")]
    if not folders:
        return None
    return table.spark.read.parquet(*[f"{table.folder.plain_root}/{n}" for n in folders])


def _listed(table: ChunkedTable, files: Iterable[tuple[int, str]]) -> DataFrame:
    return F.broadcast(table.spark.createDataFrame(list(files), "chunk_id long, file string"))


def of_files(table: ChunkedTable, files: Sequence[tuple[int, str]]) -> tuple[DataFrame | None, set[tuple[int, str]]]:
    """The synopses of some files (chunk, name), and which of these have one."""
    every = known(table) if files else None
    if every is None:
        return None, set()
    chunks = sorted({chunk for chunk, _ in files})
    within = every.where(F.col("chunk_id").between(chunks[0], chunks[-1]))
    own = within.join(_listed(table, files), ["chunk_id", "file"], "left_semi")
    # One row per file, as in any listing.
    have = {(r["chunk_id"], r["file"]) for r in own.select("chunk_id", "file").distinct().collect()}
    return own, have


def tidy(table: ChunkedTable) -> None:
    """Put the synopses of many rewrites together, without those whose files are gone."""
    folders = table.folder.names(f"{_SYNOPSIS}/*")
    if len(folders) <= _MOST_FOLDERS:
        return
    files = [(c, name) for c, load, name, _ in table.files_read(table.read_chunks()) if load.startswith(COMPACTED)]
    own, _ = of_files(table, files)
    if own is not None:
        token = f"tidy-{len(folders)}-{max(f.rsplit('/', 1)[1] for f in folders)[-24:]}"
        own.coalesce(max(1, len(files) // 10_000)).write.parquet(f"{table.root}/{_SYNOPSIS}/{token}")
    for folder in folders:
        table.folder.delete(folder)


def aggregate_range(
    table: ChunkedTable,
    start: Instant,
    end: Instant,
    aggs: Mapping[str, tuple[str, str | None]],
    keys: Sequence[str] = (),
) -> DataFrame:
    """Figures of ``[start, end)`` by ``keys`` (of the table's segment), whole chunks unread.

    ``aggs`` names each result with a function (``count``, ``sum``, ``min`` or ``max``) and
    its column; ``("count", None)`` counts rows. The result equals that of the same
    aggregates over ``scan(start, end)``, where sums of binary fractions may differ in their
    last place. Without keys there is always one row.
    """
    other = [k for k in keys if k not in table.segment_by]
    if other:
        raise ValueError(f"synopses are kept by {list(table.segment_by)}, not by {other}")
    kept = _summed(table)
    for name, (fn, column) in aggs.items():
        figure = _PARTIALS.get(fn)
        if figure is None or (column is None and fn != "count"):
            raise ValueError(f"{name}: count, sum, min or max of a column, not {fn} of {column}")
        if column is not None and column not in table.segment_by and figure not in kept[column]:
            raise ValueError(f"{name}: no {fn} is kept of {column}")
    if any(column in table.segment_by for _, column in aggs.values()):
        raise ValueError("columns of the segment are keys, not values")
    lo, hi = to_micros(start), to_micros(end)
    first, last = table.id_of(lo), table.id_of(hi - 1)
    stored = table.read_range(first, last) if lo < hi else table.read_paths([])
    size = table.interval_us
    whole = lambda chunk: chunk * size >= lo and (chunk + 1) * size <= hi
    files = table.files_read(stored)
    done = [(c, name) for c, load, name, _ in files if whole(c) and load.startswith(COMPACTED)]
    synopses, have = of_files(table, done)
    paths = [path for c, load, name, path in files if (c, name) not in have or not load.startswith(COMPACTED)]
    kind = table.ts_type
    rows = table.read_paths(paths)
    rows = rows.where((F.col(table.ts) >= ts_lit(lo, kind)) & (F.col(table.ts) < ts_lit(hi, kind)))

    def name_of(fn: str, column: str | None) -> str:
        return "n" if column is None else _named(column, _PARTIALS[fn])

    wanted = sorted(set(aggs.values()), key=str)
    counted = [F.count(F.lit(1)).alias("n")]
    for column in sorted({c for _, c in wanted if c is not None}):
        counted += _figures(column, sorted({_PARTIALS[fn] for fn, c in wanted if c == column}))
    columns = [*keys, *sorted({name_of(*w) for w in wanted})]
    picked = [F.col(f"`{c}`") for c in columns]
    partials = rows.groupBy(*keys).agg(*counted).select(*picked)
    if synopses is not None:
        partials = synopses.select(*picked).unionByName(partials)
    merged = []
    for name, (fn, column) in aggs.items():
        value = F.col(f"`{name_of(fn, column)}`")
        if fn == "count":
            merged.append(F.coalesce(F.sum(value), F.lit(0)).alias(name))
        else:
            merged.append({"sum": F.sum, "min": F.min, "max": F.max}[fn](value).alias(name))
    return partials.groupBy(*keys).agg(*merged)


def first_keys(table: ChunkedTable, synopses: DataFrame) -> DataFrame:
    """``chunk_id, file, at``: the clustering key that each file begins with, as ``place_key``."""
    if not table.order_by:
        first: Column = F.lit(None).cast("long")
    else:
        column, direction = table.order_by[0]
        first = _ascending(table, F.col(f"`{_named(column, 'max' if direction == 'desc' else 'min')}`"))
    at = F.struct(*[F.col(c) for c in table.segment_by], first.alias("_first"))
    return synopses.groupBy("chunk_id", "file").agg(F.min(at).alias("at"))


def place_key(table: ChunkedTable) -> Column:
    """The clustering key of a row up to the first ordered column, comparable in file order."""
    first = _ascending(table, F.col(table.order_by[0][0])) if table.order_by else F.lit(None).cast("long")
    return F.struct(*[F.col(c) for c in table.segment_by], first.alias("_first"))


def has_place_key(table: ChunkedTable) -> bool:
    """Whether files can be told apart by synopses: the order begins with an instant or a number."""
    if not table.order_by:
        return True
    kind = table.schema[table.order_by[0][0]].dataType
    return isinstance(kind, (T.NumericType, T.TimestampType, T.TimestampNTZType))


def _ascending(table: ChunkedTable, value: Column) -> Column:
    column, direction = table.order_by[0]
    kind = table.schema[column].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        value = F.unix_micros(value.cast("timestamp"))
    return -value if direction == "desc" else value


def key_order(table: ChunkedTable, key: str) -> list[Column]:
    """Sort columns of a place key; nulls lie as compaction puts them."""
    last = bool(table.order_by) and table.order_by[0][1] == "desc"
    first = F.col(f"{key}._first")
    return [F.col(f"{key}.`{c}`").asc() for c in table.segment_by] + [
        first.asc_nulls_last() if last else first.asc()
    ]
