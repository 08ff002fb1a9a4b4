"""Materialised rollups that are refreshed by window."""

from __future__ import annotations

import bisect
import datetime as dt
import json
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidevault.functions.buckets import time_bucket
from tidevault.functions.scalars import avg_rounded, ratio_rounded
from tidevault.functions.times import (
    Instant,
    Width,
    ago,
    from_micros,
    now,
    to_micros,
    ts_lit,
)
from tidevault.operators.chunks import ChunkedTable
from tidevault.operators.reports import table_sizes
from tidevault.sources.folders import Folder, fresh

_DEFINITION = "_rollup.json"
_APPLIED = "_applied"
# Distinct counts are kept as sketches of 2^12 registers: their standard error is 1.04 / 2^6, or 1.6 %.
SKETCH_BITS = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)
_DAY = 86_400_000_000
# Stretches of time recomputed in one refresh; more are joined with their neighbours.
_MOST_SPANS = 64
# Up to this many touched buckets, readings are filtered by bucket before they are aggregated.
_FEW_BUCKETS = 10_000


class Rollup:
    """A bucketed GROUP BY of a chunked table, kept in a chunked table of its own.

    What is stored are partials (count, sum, minimum, maximum and, for the columns in
    ``distinct``, a sketch of the different values), so that coarser figures can be derived;
    :meth:`view` shows the rounded figures. Reads see what was last materialised;
    :meth:`refresh` brings in changes.

    The source may be another rollup, whose partials are then merged: its keys and values have
    to hold those of this one, and its buckets have to fill this one's.
    """

    def __init__(
        self,
        source: ChunkedTable | Rollup,
        root: str,
        width: str | dt.timedelta | Width,
        keys: Sequence[str],
        values: Mapping[str, str],
        bucket: str = "hora",
        digits: int = 1,
        interval: str | dt.timedelta | Width | None = None,
        origin: Instant | None = None,
        distinct: Mapping[str, str] | None = None,
    ):
        self.parent = source if isinstance(source, Rollup) else None
        source = source.table if isinstance(source, Rollup) else source
        self.source = source
        self.width = Width.parse(width)
        self.keys = list(keys)
        self.values = dict(values)
        self.bucket = bucket
        self.digits = digits
        self.origin = origin
        self.distinct = dict(distinct or {})
        self._check_parent()
        empty = source.spark.createDataFrame([], source.schema)
        fields = [
            T.StructField(f.name, f.dataType, f.name != bucket) for f in self.aggregate(empty).schema
        ]
        # Buckets hold less than readings do, so a chunk of the rollup spans more time.
        interval = interval or dt.timedelta(microseconds=10 * source.interval_us)
        self.table = ChunkedTable(
            source.spark, root, T.StructType(fields), bucket, interval, self.keys
        ).create()
        about = {
            "source": source.root,
            "width": [self.width.months, self.width.micros],
            "keys": self.keys,
            "values": self.values,
            "bucket": bucket,
            "digits": digits,
            "interval_us": self.table.interval_us,
            "origin": None if origin is None else to_micros(origin),
        }
        if self.distinct:
            about["distinct"] = self.distinct
        folder = self.table.folder
        if not folder.exists(_DEFINITION):
            folder.write_text(_DEFINITION, json.dumps(about))
        kept = json.loads(folder.read_text(_DEFINITION))
        other = [
            k
            for k in {*about, *kept}
            if k not in ("digits", "source") and kept.get(k) != about.get(k)
        ]
        if other:
            raise ValueError(f"{root} exists with another definition: {sorted(other)}")
        source.followed_by(self.table.root)

    def _check_parent(self) -> None:
        if self.parent is None:
            return
        parent = self.parent
        lacking = [k for k in self.keys if k not in parent.keys]
        lacking += [v for v, label in self.values.items() if parent.values.get(v) != label]
        lacking += [v for v, label in self.distinct.items() if parent.distinct.get(v) != label]
        if lacking:
            raise ValueError(f"the rollup below does not keep {lacking}")
        fine, own = parent.width, self.width
        if fine.months:
            fits = own.months > 0 and own.months % fine.months == 0
            fits = fits and fine.floor(own.origin(self.origin), parent.origin) == own.origin(self.origin)
        else:
            # Months begin at midnight; fixed buckets at their origin and every width from there.
            step = _DAY if own.months else own.micros
            start = own.origin(self.origin) - fine.origin(parent.origin)
            fits = step % fine.micros == 0 and start % fine.micros == 0
        if not fits:
            raise ValueError("buckets of the rollup below do not fill this one's")

    @classmethod
    def open(cls, source: ChunkedTable | Rollup, root: str) -> Rollup:
        """A rollup made earlier, by its stored definition."""
        spark = (source.table if isinstance(source, Rollup) else source).spark
        about = json.loads(Folder(spark, root).read_text(_DEFINITION))
        months, micros = about["width"]
        width = Width.parse(f"{months} months" if months else dt.timedelta(microseconds=micros))
        origin = about["origin"]
        return cls(
            source,
            root,
            width,
            about["keys"],
            about["values"],
            about["bucket"],
            about["digits"],
            dt.timedelta(microseconds=about["interval_us"]),
            None if origin is None else from_micros(origin),
            about.get("distinct"),
        )

    def partials(self) -> list[Column]:
        """The stored figures, as aggregates of readings."""
        aggs = [F.count(F.lit(1)).alias("n")]
        for value, label in self.values.items():
            aggs += [
                F.count(value).alias(f"{label}_n"),
                F.sum(value).alias(f"{label}_sum"),
                F.min(value).alias(f"{label}_min"),
                F.max(value).alias(f"{label}_max"),
            ]
        for value, label in self.distinct.items():
            kind = self.source.schema[value].dataType
            whole = isinstance(kind, T.IntegralType)
            plain = F.col(value) if isinstance(kind, T.BinaryType) else F.col(value).cast("long" if whole else "string")
            aggs.append(F.hll_sketch_agg(plain, SKETCH_BITS).alias(f"{label}_hll"))
        return aggs

    def merges(self, of: T.StructType) -> list[Column]:
        """The stored figures, as aggregates of such figures; each keeps its type."""
        merge = {"sum": F.sum, "min": F.min, "max": F.max, "hll": F.hll_union_agg}
        aggs = []
        for name in ["n"] + [f"{x}_{k}" for x in self.values.values() for k in ("n", "sum", "min", "max")]:
            fn = merge.get(name.rsplit("_", 1)[-1], F.sum)
            aggs.append(fn(name).cast(of[name].dataType).alias(name))
        return aggs + [F.hll_union_agg(f"{x}_hll").alias(f"{x}_hll") for x in self.distinct.values()]

    def aggregate(self, rows: DataFrame) -> DataFrame:
        at = time_bucket(rows, self.width, self.source.ts, self.origin)
        aggs = self.partials() if self.parent is None else self.merges(rows.schema)
        return rows.groupBy(at.alias(self.bucket), *self.keys).agg(*aggs)

    # -- materialising --------------------------------------------------------

    def build(self) -> Rollup:
        """Materialise the whole history, replacing what is there.

        Buckets kept from before retention emptied the source stay as they are.
        """
        self.table.recover()
        shown, noted = self.source.changes_shown(), self.source.changes()
        ids, floor = self.table.chunk_ids(), self.source.dropped_below()
        rows = self.source.read_chunks()
        record = self._record(shown & set(noted), set(self.source.changes()) - shown)
        if floor is None or not ids:
            self.table.replace_chunks(self.aggregate(self._settled(rows, noted)), ids, then=record)
            self._clear()
            return self
        lo = self.width.ceil(floor, self.origin)
        ids = [i for i in ids if i >= self.table.id_of(lo)]
        current = self.table.read_chunks(ids)
        older = current.where(F.col(self.bucket) < ts_lit(lo, self.table.ts_type))
        since = rows.where(F.col(self.source.ts) >= ts_lit(lo, self.source.ts_type))
        renewed = self.aggregate(self._settled(since, noted))
        kept = older.select(*self.table.schema.names)
        self.table.replace_chunks(kept.unionByName(renewed), ids, self._seen(current, ids), then=record)
        self._clear()
        return self

    def _settled(self, rows: DataFrame, noted: Sequence[str]) -> DataFrame:
        """Rows that were listed, without loads whose change was noted only after ``noted``.

        A change is noted before it shows, so what is left is what those changes brought; the
        others are due later, and may then be added without counting a row twice.
        """
        late = {n.split("@")[0] for n in set(self.source.changes()) - set(noted)}
        rows = rows.where(~F.col("load").isin(sorted(late))) if late else rows
        return rows.select(*self.source.schema.names)

    def _seen(self, current: DataFrame, ids: Iterable[int]) -> dict[int, set[str]]:
        """The loads read of the chunks, none where there is nothing to read."""
        return {i: set() for i in ids} | self.table.loads_read(current)

    def window(self, start: Instant, end: Instant) -> tuple[int, int] | None:
        """The buckets wholly inside ``[start, end)`` whose source retention has not dropped."""
        lo = self.width.ceil(to_micros(start), self.origin)
        hi = self.width.floor(to_micros(end), self.origin)
        floor = self.source.dropped_below()
        if floor is not None:
            lo = max(lo, self.width.ceil(floor, self.origin))
        return (lo, hi) if lo < hi else None

    def refresh(self, start: Instant, end: Instant) -> tuple[dt.datetime, dt.datetime] | None:
        """Recompute the buckets of a window from the source; returns the window used.

        The scan is pruned to the window's source chunks, and only the rollup chunks
        the window meets are rewritten. Buckets without source rows disappear, but
        for those that retention took the source of.
        """
        span = self.window(start, end)
        if span is None:
            return None
        self.table.recover()
        self._refresh([span], then=self._all_again())
        self._clear()
        return from_micros(span[0]), from_micros(span[1])

    def _all_again(self) -> dict[str, str] | None:
        """The record after a recomputation out of turn: what is still due is not added later."""
        applied = self._applied()
        if applied is None:
            return None
        return self._record(applied, set(self.source.changes()) - applied)

    def _refresh(
        self,
        spans: Sequence[tuple[int, int]],
        added: DataFrame | None = None,
        added_spans: Sequence[tuple[int, int]] = (),
        noted: Sequence[str] | None = None,
        then: Mapping[str, str] | None = None,
    ) -> None:
        """Recompute the buckets of stretches of whole buckets, in order and apart.

        Figures of ``added`` rows, in buckets outside those, are merged with what is kept.
        """
        noted = self.source.changes() if noted is None else noted
        kind, at = self.table.ts_type, F.col(self.bucket)
        own, src, inside, read = set(), set(), F.lit(False), F.lit(False)
        for lo, hi in spans:
            own |= set(self.table.ids_between(self.table.id_of(lo), self.table.id_of(hi - 1)))
            src |= set(self.source.ids_between(self.source.id_of(lo), self.source.id_of(hi - 1)))
            inside = inside | ((at >= ts_lit(lo, kind)) & (at < ts_lit(hi, kind)))
            ts, ts_kind = F.col(self.source.ts), self.source.ts_type
            read = read | ((ts >= ts_lit(lo, ts_kind)) & (ts < ts_lit(hi, ts_kind)))
        for lo, hi in added_spans:
            own |= set(self.table.ids_between(self.table.id_of(lo), self.table.id_of(hi - 1)))
        ids, names = sorted(own), self.table.schema.names
        current = self.table.read_chunks(ids)
        result = current.where(~inside).select(*names)
        if added is not None:
            both = result.unionByName(self.aggregate(added).select(*names))
            result = both.groupBy(self.bucket, *self.keys).agg(*self.merges(self.table.schema))
        if spans:
            rows = self._settled(self.source.read_chunks(src).where(read), noted)
            result = result.select(*names).unionByName(self.aggregate(rows).select(*names))
        touched = [(lo, hi - 1) for lo, hi in sorted([*spans, *added_spans])]
        self.table.replace_chunks(result, ids, self._seen(current, ids), touched, then)

    def refresh_changed(
        self, changed: DataFrame, start: Instant | None = None, end: Instant | None = None
    ) -> int:
        """Recompute only the buckets that rows of ``changed`` fall in; returns how many."""
        at = time_bucket(changed, self.width, self.source.ts, self.origin)
        touched = changed.select(at.alias(self.bucket)).distinct()
        lo = None if start is None else self.width.ceil(to_micros(start), self.origin)
        hi = None if end is None else self.width.floor(to_micros(end), self.origin)
        floor = self.source.dropped_below()
        if floor is not None:
            floor = self.width.ceil(floor, self.origin)
            lo = floor if lo is None else max(lo, floor)
        kind = self.table.ts_type
        if lo is not None:
            touched = touched.where(F.col(self.bucket) >= ts_lit(lo, kind))
        if hi is not None:
            touched = touched.where(F.col(self.bucket) < ts_lit(hi, kind))
        kept = fresh("touched")
        path = f"{self.table.root}/{kept}"
        touched.write.parquet(path)
        touched = self.table.spark.read.parquet(f"{self.table.folder.plain_root}/{kept}")
        try:
            first = F.col(self.bucket)
            last = (first + self.width.interval()) - F.expr("INTERVAL '0.000001' SECOND")
            spans = touched.select(
                self.table.id_column(first).alias("own"),
                F.explode(
                    F.sequence(self.source.id_column(first), self.source.id_column(last))
                ).alias("src"),
            )
            # Chunk numbers only: as many as there are chunks.
            pairs = spans.distinct().collect()
            if not pairs:
                return 0
            own, src = sorted({p["own"] for p in pairs}), sorted({p["src"] for p in pairs})
            count, first, last = touched.agg(
                F.count(F.lit(1)),
                *(F.unix_micros(pick(self.bucket).cast("timestamp")) for pick in (F.min, F.max)),
            ).first()
            ts, ts_kind = F.col(self.source.ts), self.source.ts_type
            hi = ts_lit(self.width.add(last, 1), ts_kind)
            rows = self.source.read_chunks(src).where((ts >= ts_lit(first, ts_kind)) & (ts < hi))
            rows = rows.select(*self.source.schema.names)
            if count <= _FEW_BUCKETS:
                at = time_bucket(rows, self.width, self.source.ts, self.origin)
                few = F.broadcast(touched.withColumnRenamed(self.bucket, "_bucket"))
                rows = rows.withColumn("_bucket", at).join(few, "_bucket", "left_semi").drop("_bucket")
                renewed = self.aggregate(rows)
            else:
                # Readings are aggregated before the join, so it moves buckets, not readings.
                renewed = self.aggregate(rows).join(touched, self.bucket, "left_semi")
            current = self.table.read_chunks(own)
            others = current.select(*self.table.schema.names).join(touched, self.bucket, "left_anti")
            names = self.table.schema.names
            self.table.recover()
            self.table.replace_chunks(
                others.select(*names).unionByName(renewed.select(*names)),
                own,
                self._seen(current, own),
                then=self._all_again(),
            )
            self._clear()
            return count
        finally:
            self.table.folder.delete(kept)

    def refresh_due(
        self,
        as_of: Instant | None = None,
        start_offset: str | Width = "1 month",
        end_offset: str | Width = "1 hour",
    ) -> tuple[dt.datetime, dt.datetime] | None:
        """The refresh policy: a sliding window that leaves out the bucket in progress.

        Rows that were only added since the last run are read alone and merged into the
        figures that are there, each change once: the record of the changes taken in is put in
        place together with the figures. Buckets that other changes touch are recomputed
        from the source. The first run, which has no record, does the whole window. Added rows
        count even where retention has dropped the rest of their chunk. Returns the window.
        """
        as_of = as_of or now()
        lo, hi = ago(as_of, start_offset), ago(as_of, end_offset)
        span = self.window(lo, hi)
        if span is None:
            return None
        self.table.recover()
        noted, shown = self.source.changes(), self.source.changes_shown()
        applied, again = self._applied(), self._again()
        if applied is None:
            spans: list[tuple[int, int]] = [span]
            due = {n: self._buckets(n) for n in noted}
            done = {n for n, own in due.items() if n in shown and all(b <= span[1] for _, b in own)}
            self._refresh(spans, noted=noted, then=self._record(done, set(noted) - done))
        else:
            due = {n: self._buckets(n) for n in noted if n not in applied}
            widest = self.width.ceil(to_micros(lo), self.origin), span[1]
            added: dict[str, list[str]] = {}
            for name, own in due.items():
                if name in shown and name not in again and own:
                    if all(widest[0] <= a and b <= widest[1] for a, b in own):
                        folders = self.source.added_rows(name)
                        if folders is not None:
                            added[name] = folders
            while True:
                spans = _joined(
                    (max(a, span[0]), min(b, span[1]))
                    for name, own in due.items()
                    if name not in added
                    for a, b in own
                    if max(a, span[0]) < min(b, span[1])
                )
                met = {n for n in added if _meet(due[n], spans)}
                if not met:
                    break
                for name in met:  # their buckets are recomputed anyway
                    del added[name]
            # What is still to come stays due; what is too old to be recomputed does not.
            done = {n for n, own in due.items() if n in shown and all(b <= span[1] for _, b in own)}
            left = {n for n in due if n not in done}
            again = (again & left) | {n for n in left if _meet(due[n], spans)}
            record = self._record(applied | done, again)
            if spans or added:
                paths = [f"{self.source.folder.plain_root}/{f}" for own in added.values() for f in own]
                rows = self.source.read_paths(paths).select(*self.source.schema.names) if added else None
                where = _joined(b for n in added for b in due[n])
                self._refresh(spans, rows, where, noted, record)
            else:
                self._write_record(record)
        self._clear()
        self.source.prune_changes(lambda root: applied_of(self.table.spark, root))
        return from_micros(span[0]), from_micros(span[1])

    def _buckets(self, change: str) -> list[tuple[int, int]]:
        """The stretches of whole buckets that a change may have touched."""
        spans = self.source.change_spans(change)
        return [(self.width.floor(a, self.origin), self.width.ceil(b + 1, self.origin)) for a, b in spans]

    # -- record of changes taken in ----------------------------------------------

    def _applied(self) -> set[str] | None:
        """Names of the source's changes that the rollup has; None without a record."""
        return _read_record(self.table.folder)[0]

    def _again(self) -> set[str]:
        """Names of changes that are due and of which the rollup may already have a part."""
        return _read_record(self.table.folder)[1]

    def _record(self, applied: Iterable[str], again: Iterable[str]) -> dict[str, str]:
        """The next version of the record, as a file's name and text."""
        number = max((int(v.rsplit("v", 1)[1]) for v in _versions(self.table.folder)), default=0) + 1
        noted = set(self.source.changes())
        lines = sorted(noted & set(applied)) + [f"!{n}" for n in sorted(noted & set(again))]
        return {f"{_APPLIED}/v{number:012d}": "\n".join(lines)}

    def _write_record(self, record: Mapping[str, str]) -> None:
        self.table.folder.mkdirs(_APPLIED)
        for name, text in record.items():
            self.table.folder.write_text(name, text)

    def _clear(self) -> None:
        """Remove the earlier versions of the record."""
        for version in _versions(self.table.folder)[:-1]:
            self.table.folder.delete(version)

    # -- reading ----------------------------------------------------------------

    def view(
        self, start: Instant | None = None, end: Instant | None = None, closed: str = "left"
    ) -> DataFrame:
        """The materialised figures, rounded."""
        return self._rounded(self.table.scan(start, end, closed))

    def _rounded(self, rows: DataFrame, *more: str) -> DataFrame:
        shown = [F.col(self.bucket), *self.keys, F.col("n").alias("lecturas")]
        for label in self.values.values():
            mean = ratio_rounded(F.col(f"{label}_sum"), F.col(f"{label}_n"), self.digits)
            shown += [
                F.when(F.col(f"{label}_n") > 0, mean).alias(f"{label}_media"),
                F.round(f"{label}_max", self.digits).alias(f"{label}_max"),
                F.round(f"{label}_min", self.digits).alias(f"{label}_min"),
            ]
        for label in self.distinct.values():
            shown.append(F.hll_sketch_estimate(f"{label}_hll").alias(f"{label}_distintos"))
        return rows.select(*shown, *more)

    def create_view(self, name: str) -> None:
        """A temporary view of the rounded figures for ``spark.sql``.

        Its filters on the bucket reach the files' statistics; :meth:`create_range_function`
        prunes whole chunks.
        """
        self.view().createOrReplaceTempView(name)

    def create_range_function(self, name: str) -> None:
        """``name(lo, hi)`` under ``spark.sql``: the rounded figures of a range, pruned by chunk."""
        self.table.create_range_function(name, lambda rows: self._rounded(rows, "chunk_id"))

    def avg_of_avgs(
        self, label: str, start: Instant | None = None, end: Instant | None = None
    ) -> DataFrame:
        """Average of the buckets' rounded averages: each bucket weighs the same."""
        return self.view(start, end).agg(
            avg_rounded(f"{label}_media", self.digits).alias(f"{label}_media")
        )

    def weighted_avg(
        self, label: str, start: Instant | None = None, end: Instant | None = None
    ) -> DataFrame:
        """The average of the readings themselves, from the stored sums and counts."""
        total, count = F.sum(f"{label}_sum"), F.sum(f"{label}_n")
        return self.table.scan(start, end).agg(
            ratio_rounded(total, count, self.digits).alias(f"{label}_media")
        )

    def distinct_count(
        self, label: str, keys: Sequence[str] = (), start: Instant | None = None, end: Instant | None = None
    ) -> DataFrame:
        """Different values over all buckets of a range, by ``keys``: sketches merged, then read.

        The estimate's standard error is ``SKETCH_ERROR``, however many buckets are merged.
        """
        merged = F.hll_sketch_estimate(F.hll_union_agg(f"{label}_hll"))
        return self.table.scan(start, end).groupBy(*keys).agg(merged.alias(f"{label}_distintos"))

    def sizes(self) -> DataFrame:
        """Chunks, rows and bytes of the source and of the rollup."""
        return table_sizes({"source": self.source, "rollup": self.table})


def refresh_chain(
    rollups: Sequence[Rollup],
    as_of: Instant | None = None,
    start_offset: str | Width = "1 month",
    end_offset: str | Width = "1 hour",
) -> None:
    """Refresh rollups that stand on each other, the finest first: a change of the readings
    reaches each next one through the buckets that it changed in the one below."""
    as_of = as_of or now()
    for rollup in rollups:
        rollup.refresh_due(as_of, start_offset, end_offset)


def applied_of(spark: SparkSession, root: str) -> set[str] | None:
    """The changes that the rollup of a root has taken in; None if it is gone."""
    folder = Folder(spark, root)
    return (_read_record(folder)[0] or set()) if folder.exists(_DEFINITION) else None


def _versions(folder: Folder) -> list[str]:
    names = sorted(folder.names(f"{_APPLIED}/v*"))
    return [v for v in names if "." not in v.rsplit("/", 1)[1]]


def _read_record(folder: Folder) -> tuple[set[str] | None, set[str]]:
    versions = _versions(folder)
    if not versions:
        return None, set()
    lines = folder.read_text(versions[-1]).split()
    return {n for n in lines if n[0] != "!"}, {n[1:] for n in lines if n[0] == "!"}


def _meet(spans: Iterable[tuple[int, int]], others: Sequence[tuple[int, int]]) -> bool:
    """Whether any stretch overlaps one of the others, which are in order and apart."""
    starts = [a for a, _ in others]
    for lo, hi in spans:
        at = bisect.bisect_left(starts, hi) - 1
        if at >= 0 and others[at][1] > lo:
            return True
    return False


def _joined(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Stretches in order and apart; too many are joined where the gaps are least."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = out[-1][0], max(hi, out[-1][1])
        else:
            out.append((lo, hi))
    if len(out) > _MOST_SPANS:
        gaps = sorted(range(1, len(out)), key=lambda i: out[i][0] - out[i - 1][1], reverse=True)
        cuts = sorted(gaps[: _MOST_SPANS - 1])
        out = [(out[a][0], out[b - 1][1]) for a, b in zip([0, *cuts], [*cuts, len(out)], strict=True)]
    return out
