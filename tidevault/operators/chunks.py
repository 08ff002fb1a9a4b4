"""Time-chunked Parquet tables: routing, pruned scans and the chunk catalogue.

Layout: ``root/chunk_id=N/load=LABEL/*.parquet``. ``chunk_id`` is the chunk's number
on the epoch grid; ``load`` names the append that brought the rows, or the rewrite
that put them in order. Both are hidden from readers of the table.

Every write is staged beside the table and put in place by folder renames, so appends
do not disturb each other, and may go on while chunks are compacted, replaced or dropped. Two
maintenance calls on one table may not run at the same time.

What an append or a replacement touched (chunks and instants) is noted in ``_changes``
before it shows, so that rollups can follow whatever becomes of the files.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import re
import time
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidevault.functions.times import (
    Instant,
    Width,
    fixed_micros,
    from_micros,
    to_micros,
    ts_lit,
)
from tidevault.operators.keys import admit, bloom_options
from tidevault.operators.keys import rejects as rejects_of
from tidevault.schemas import conform, enforce_not_null
from tidevault.session import micros_timestamps, require_utc
from tidevault.sources.folders import Folder, fresh

COMPACTED = "compacted"
REPLACED = "replace"
# Labels of these kinds are made here and never given by callers.
_OWN_LABELS = ("append-", f"{COMPACTED}-", f"{REPLACED}-")
_ABSORBED = "_absorbed"
_DEFINITION = "_table.json"
_DROPPED = "_dropped"
_CHANGES = "_changes"
_FOLLOWERS = "_followers"
_COMMIT = "_commit"
# Chunks that one path pattern names; a scan of more chunks has more patterns.
_NAMED_CHUNKS = 400
# Up to this many chunks are looked up one by one, without a listing of the table.
_FEW_CHUNKS = 64


def _chunk_glob(ids: Iterable[int]) -> str:
    return "chunk_id={" + ",".join(str(i) for i in sorted(ids)) + "}"


class ChunkedTable:
    """A table whose rows live in chunks of a fixed time interval."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: T.StructType,
        ts: str = "ts",
        interval: str | dt.timedelta | Width = "1 day",
        segment_by: Sequence[str] = (),
        order_by: Sequence[tuple[str, str]] | None = None,
        key: Sequence[str] = (),
    ):
        require_utc(spark)
        self.spark = spark
        self.folder = Folder(spark, root)
        self.root = self.folder.root
        self.schema = schema
        self.ts = ts
        self.ts_type = schema[ts].dataType
        self.interval_us = fixed_micros(interval)
        self.segment_by = tuple(segment_by)
        self.order_by = tuple(order_by) if order_by is not None else ((ts, "desc"),)
        self.key = tuple(key)
        if self.key and ts not in self.key:
            raise ValueError(f"the key has to hold {ts!r}, which decides the chunk")
        self.stored = T.StructType(
            [
                *schema.fields,
                T.StructField("chunk_id", T.LongType()),
                T.StructField("load", T.StringType()),
            ]
        )

    # -- definition ---------------------------------------------------------

    def _definition(self) -> dict:
        return {
            "schema": self.schema.jsonValue(),
            "ts": self.ts,
            "interval_us": self.interval_us,
            "segment_by": list(self.segment_by),
            "order_by": [list(o) for o in self.order_by],
            "key": list(self.key),
        }

    def create(self) -> ChunkedTable:
        """Create the table unless it exists; the definition is kept beside the data.

        A table that exists has to have the same columns, ``ts``, interval and key: under others
        its rows would not be found. Its stored clustering and comments hold.
        """
        if not self.folder.exists(_DEFINITION):
            self.folder.mkdirs()
            self.folder.write_text(_DEFINITION, json.dumps(self._definition()))
            return self
        kept = ChunkedTable.open(self.spark, self.root)

        def columns(schema: T.StructType) -> list[tuple]:
            return [(f.name, f.dataType, f.nullable) for f in schema]

        mine, theirs = (
            (columns(t.schema), t.ts, t.interval_us, t.key) for t in (self, kept)
        )
        for name, own, stored in zip(("columns", "ts", "interval", "key"), mine, theirs, strict=True):
            if own != stored:
                raise ValueError(f"{self.root} exists with other {name}: {stored}, not {own}")
        return kept

    @classmethod
    def open(cls, spark: SparkSession, root: str) -> ChunkedTable:
        """A table created earlier, by this session or another."""
        about = json.loads(Folder(spark, root).read_text(_DEFINITION))
        return cls(
            spark,
            root,
            T.StructType.fromJson(about["schema"]),
            about["ts"],
            dt.timedelta(microseconds=about["interval_us"]),
            about["segment_by"],
            [tuple(o) for o in about["order_by"]],
            about.get("key", ()),
        )

    # -- routing and writing ------------------------------------------------

    def id_of(self, us: int) -> int:
        return us // self.interval_us

    def id_column(self, ts: Column) -> Column:
        us = F.unix_micros(ts.cast("timestamp"))
        # Exact integer floor, also before 1970.
        return F.call_function("div", us - F.pmod(us, F.lit(self.interval_us)), F.lit(self.interval_us))

    def routed(self, df: DataFrame) -> DataFrame:
        """Checked rows with their chunk number."""
        checked = enforce_not_null(conform(df, self.schema), self.schema)
        return checked.withColumn("chunk_id", self.id_column(F.col(self.ts)))

    def append(
        self,
        df: DataFrame,
        load: str | None = None,
        arranged: bool = False,
        same_rows: bool = False,
    ) -> str:
        """Append rows, each to the chunk of its ``ts``.

        A repeated append under the same ``load`` label replaces its own rows. Where a
        rewrite has taken them in since, a repeat of the same rows adds nothing there: a job
        or micro-batch that is run again does not double them. Other rows under such a
        label are refused, because the earlier ones can no longer be told apart.

        ``REBALANCE`` gathers small chunks into few files and lets AQE split a chunk
        that holds much of the data over several tasks. Rows that are ``arranged``, so
        that each task already holds few chunks (files in time order), skip this shuffle.
        Where a repeat always brings the ``same_rows``, as a micro-batch does, only the
        chunks of those rows are looked at for an earlier attempt.

        In a table with a ``key``, rows whose key is stored already, or repeated among them, go
        to the ``rejects`` instead. Two appends of one key at the same time are not told apart.
        """
        if load is not None and (load.startswith(_OWN_LABELS) or not re.fullmatch(r"[\w.-]+", load)):
            raise ValueError(f"not a label for a load: {load!r}")
        label = load or f"append-{uuid.uuid4().hex[:12]}"
        staging = fresh("append")
        rows, batch = self.routed(df), None
        if self.key:
            rows, batch = admit(self, rows, label)
        try:
            facts = self._staged(rows if arranged else rows.hint("rebalance", F.col("chunk_id")), staging)
        finally:
            if batch:
                self.folder.delete(batch)
        staged = set(self.folder.chunk_ids(staging))
        earlier: set[int] = set()
        absorbed: set[int] = set()
        if load is not None and (staged or not same_rows):
            for where in self._patterns(staged) if same_rows else ["chunk_id=*"]:
                earlier |= set(self.folder.chunk_ids(pattern=f"{where}/load={label}"))
                for chunk in self.folder.chunk_ids(pattern=f"{where}/{_ABSORBED}"):
                    if label in self.absorbed(f"chunk_id={chunk}"):
                        absorbed.add(chunk)
            known = [self._facts_of(label, chunk) for chunk in sorted(absorbed)[:1]]
            if known and known[0] != (facts["rows"], facts["hash"]):
                self.folder.delete(staging)
                raise ValueError(
                    f"load {label!r} brings other rows than before, and a rewrite has taken those in"
                )
        touched = sorted(staged | earlier)
        note = self._note(label, touched, facts)
        for chunk in earlier:  # rows of an earlier attempt may lie outside the new instants
            self._note(label, [chunk], {**facts, "lo": None, "hi": None})

        def place(chunk: int) -> None:
            name = f"chunk_id={chunk}"
            if chunk in earlier:
                self.folder.mkdirs(f"{staging}/_earlier")
                self.folder.rename(f"{name}/load={label}", f"{staging}/_earlier/{chunk}")
            elif chunk in absorbed:
                return
            if chunk in staged:
                self.folder.mkdirs(name)
                self.folder.rename(f"{staging}/{name}", f"{name}/load={label}")

        self.folder.each(place, touched)
        self._shown(note)
        self.folder.delete(staging)
        return label

    def _staged(self, rows: DataFrame, staging: str) -> dict:
        """Stage rows; their number, hash sum and first and last instant come with the write."""
        seen = Observation()
        us = F.unix_micros(F.col(self.ts).cast("timestamp"))
        hashes = F.xxhash64(*self.schema.names).cast("decimal(38,0)")
        observed = rows.observe(
            seen,
            F.count(F.lit(1)).alias("rows"),
            F.sum(hashes).cast("string").alias("hash"),
            F.min(us).alias("lo"),
            F.max(us).alias("hi"),
        )
        self.stage(observed, staging)
        return {k: seen.get.get(k) for k in ("rows", "hash", "lo", "hi")}

    # -- what has changed -----------------------------------------------------

    def _facts_of(self, label: str, chunk: int) -> tuple[int, str | None] | None:
        """Number and hash sum of the rows a load brought that a rewrite has taken in."""
        noted = self.changes(label)
        if noted:
            change = self._change(noted[-1])
            return change["rows"], change["hash"]
        return self._absorbed_facts(f"chunk_id={chunk}").get(label)

    def _note(
        self,
        label: str,
        chunks: Sequence[int],
        facts: Mapping,
        spans: Sequence[tuple[int, int]] | None = None,
    ) -> str:
        """Note a change that is about to show; ``_shown`` says that it did."""
        name = f"{_CHANGES}/{label}@{time.time_ns()}-{uuid.uuid4().hex[:6]}"
        about = {k: facts.get(k) for k in ("rows", "hash", "lo", "hi")}
        if spans is not None:
            about["spans"] = [list(s) for s in spans]
        self.folder.mkdirs(_CHANGES)
        self.folder.write_text(name, json.dumps({"chunks": list(chunks), **about}))
        return name

    def _shown(self, note: str) -> None:
        self.folder.mkdirs(f"{note}.done")

    def _change(self, name: str) -> dict:
        return json.loads(self.folder.read_text(f"{_CHANGES}/{name}"))

    def changes(self, label: str | None = None) -> list[str]:
        """Names of the changes noted, or of those of a load; oldest first."""
        stem = f"{_CHANGES}/{label}@*" if label else f"{_CHANGES}/*"
        names = [n.removeprefix(f"{_CHANGES}/") for n in self.folder.names(stem)]
        # Text files are written under a longer name first.
        names = [n for n in names if re.fullmatch(r"[^@]+@\d+-[0-9a-f]{6}", n)]
        return sorted(names, key=lambda n: int(n.rsplit("@", 1)[1].split("-")[0]))

    def changes_shown(self) -> set[str]:
        """Names of the changes that have come to show."""
        names = self.folder.names(f"{_CHANGES}/*")
        return {n.removeprefix(f"{_CHANGES}/").removesuffix(".done") for n in names if n.endswith(".done")}

    def change_spans(self, name: str) -> list[tuple[int, int]]:
        """First and last microsecond that a change may have touched, chunk by chunk."""
        change = self._change(name)
        if change.get("spans") is not None:
            return [(lo, hi) for lo, hi in change["spans"]]
        out = []
        for chunk in change["chunks"]:
            lo, hi = chunk * self.interval_us, (chunk + 1) * self.interval_us - 1
            lo = lo if change["lo"] is None else max(lo, change["lo"])
            hi = hi if change["hi"] is None else min(hi, change["hi"])
            if lo <= hi:
                out.append((lo, hi))
        return out

    def added_rows(self, name: str) -> list[str] | None:
        """Folders of exactly the rows that a change has added; None if they cannot be told.

        A load that was repeated, replaced or taken in by a rewrite cannot be.
        """
        label = name.split("@")[0]
        change = self._change(name)
        if label.startswith((f"{COMPACTED}-", f"{REPLACED}-")) or len(self.changes(label)) > 1:
            return None
        if change["lo"] is None and change["rows"]:
            return None
        folders = [f"chunk_id={chunk}/load={label}" for chunk in change["chunks"]]
        return folders if all(map(self.folder.exists, folders)) else None

    # -- notes that nobody needs any more ------------------------------------------

    def followed_by(self, root: str) -> None:
        """Remember a rollup that follows the notes of changes."""
        name = f"{_FOLLOWERS}/{hashlib.sha256(root.encode()).hexdigest()[:16]}"
        if not self.folder.exists(name):
            self.folder.mkdirs(_FOLLOWERS)
            self.folder.write_text(name, root)

    def followers(self) -> list[str]:
        """Roots of the rollups that follow the notes."""
        names = [n for n in self.folder.names(f"{_FOLLOWERS}/*") if "." not in n.rsplit("/", 1)[1]]
        return [self.folder.read_text(n) for n in names]

    def prune_changes(self, applied: Callable[[str], set[str] | None]) -> int:
        """Remove the notes that no rollup needs: those all followers have taken in, and those
        whose chunks are gone. ``applied`` tells what the rollup of a root has, None if the
        rollup is gone. Returns how many were removed.
        """
        shown = self.changes_shown()
        names = [n for n in self.changes() if n in shown]
        if not names:
            return 0
        have = [a for a in map(applied, self.followers()) if a is not None]
        live = set(self.chunk_ids())

        def needless(name: str) -> bool:
            if all(name in a for a in have):
                return True
            return not live.intersection(self._change(name)["chunks"])

        gone = [n for n in names if needless(n)]

        def remove(name: str) -> None:
            self.folder.delete(f"{_CHANGES}/{name}")
            self.folder.delete(f"{_CHANGES}/{name}.done")

        self.folder.each(remove, gone)
        return len(gone)

    def absorbed(self, name: str) -> set[str]:
        """Labels whose rows a rewrite of the chunk folder has taken in."""
        return set(self._absorbed_facts(name))

    def _absorbed_facts(self, name: str) -> dict[str, tuple[int, str | None] | None]:
        path = f"{name}/{_ABSORBED}"
        lines = self.folder.read_text(path).splitlines() if self.folder.exists(path) else []
        out: dict[str, tuple[int, str | None] | None] = {}
        for line in lines:
            label, *facts = line.split()
            out[label] = (int(facts[0]), facts[1] if facts[1] != "-" else None) if facts else None
        return out

    def rejects(self, load: str | None = None) -> DataFrame:
        """Rows that appends, or that of a load, left out for the key's sake, with the reason."""
        return rejects_of(self, load)

    def append_rows(self, rows: Iterable[tuple], columns: Sequence[str] | None = None) -> str:
        """Insert literal rows; columns that are not named become NULL."""
        names = list(columns or self.schema.names)
        fields = [self.schema[c] for c in names]
        plain = T.StructType([T.StructField(f.name, T.StringType()) for f in fields])
        text = [tuple(None if v is None else str(v) for v in row) for row in rows]
        return self.append(self.spark.createDataFrame(text, plain))

    # -- reading ------------------------------------------------------------

    def chunk_ids(self) -> list[int]:
        return self.folder.chunk_ids()

    def _patterns(self, ids: Iterable[int]) -> list[str]:
        """Path patterns that name the chunks, a bounded number of chunks each."""
        ids = sorted(ids)
        return [_chunk_glob(ids[i : i + _NAMED_CHUNKS]) for i in range(0, len(ids), _NAMED_CHUNKS)]

    def read_chunks(self, ids: Iterable[int] | None = None) -> DataFrame:
        """Stored rows, with ``chunk_id`` and ``load``, of some chunks or of all.

        Chunks that are asked for are named, however many, and only they are listed. Few are
        looked up one by one; for more the table's folder is listed once.
        """
        if ids is None:
            if not self.folder.exists():
                return self.spark.createDataFrame([], self.stored)
            return self.read_paths([self.folder.plain_root])
        return self._read_live(self._live(set(ids)))

    def _live(self, ids: set[int]) -> set[int]:
        if len(ids) <= _FEW_CHUNKS:
            return {i for i in ids if self.folder.exists(f"chunk_id={i}")}
        return ids.intersection(self.chunk_ids())

    def _read_live(self, live: Iterable[int]) -> DataFrame:
        live = sorted(live)
        names = [f"chunk_id={i}" for i in live] if len(live) <= _FEW_CHUNKS else self._patterns(live)
        return self.read_paths([f"{self.folder.plain_root}/{n}" for n in names])

    def read_paths(self, paths: Sequence[str]) -> DataFrame:
        """Stored rows of folders or files of the table; none without paths."""
        if not paths:
            return self.spark.createDataFrame([], self.stored)
        return self.spark.read.schema(self.stored).option("basePath", self.root).parquet(*paths)

    def ids_between(self, first: int | None, last: int | None) -> list[int]:
        """The chunks ``first..last`` that are there."""
        if first is not None and last is not None and last - first < _FEW_CHUNKS:
            return sorted(self._live(set(range(first, last + 1))))
        return [
            i
            for i in self.chunk_ids()
            if (first is None or i >= first) and (last is None or i <= last)
        ]

    def read_range(self, first: int | None, last: int | None) -> DataFrame:
        """Stored rows of the chunks ``first..last``."""
        if first is None and last is None:
            return self.read_chunks()
        df = self._read_live(self.ids_between(first, last))
        if first is not None:
            df = df.where(F.col("chunk_id") >= first)
        if last is not None:
            df = df.where(F.col("chunk_id") <= last)
        return df

    def files_read(self, rows: DataFrame) -> list[tuple[int, str, str, str]]:
        """Chunk, load, name and path of the files of this table that a DataFrame will read."""
        below = re.compile(r"/chunk_id=(-?\d+)/load=([^/]+)/([^/]+)$")
        found = [(path, below.search(path)) for path in rows.inputFiles()]
        return [(int(m[1]), m[2], m[3], path) for path, m in found if m and self.folder.holds(path)]

    def loads_read(self, rows: DataFrame) -> dict[int, set[str]]:
        """The loads, by chunk, of this table that a DataFrame has listed and will read."""
        out: dict[int, set[str]] = {}
        for chunk, load, *_ in self.files_read(rows):
            out.setdefault(chunk, set()).add(load)
        return out

    def scan(
        self, start: Instant | None = None, end: Instant | None = None, closed: str = "left"
    ) -> DataFrame:
        """Rows between two instants; ``closed`` is left, right, both or neither.

        The ``ts`` filter alone would open every chunk. The bounds are also turned
        into ``chunk_id`` bounds, so chunks outside the range are not even listed.
        """
        if closed not in ("left", "right", "both", "neither"):
            raise ValueError(f"closed is left, right, both or neither, not {closed!r}")
        lo = None if start is None else to_micros(start)
        hi = None if end is None else to_micros(end)
        keep, first, last = F.lit(True), None, None
        if lo is not None:
            bound = ts_lit(lo, self.ts_type)
            inclusive = closed in ("left", "both")
            keep = keep & (F.col(self.ts) >= bound if inclusive else F.col(self.ts) > bound)
            first = self.id_of(lo if inclusive else lo + 1)
        if hi is not None:
            bound = ts_lit(hi, self.ts_type)
            inclusive = closed in ("right", "both")
            keep = keep & (F.col(self.ts) <= bound if inclusive else F.col(self.ts) < bound)
            last = self.id_of(hi if inclusive else hi - 1)
        if first is not None and last is not None and first > last:
            return self.spark.createDataFrame([], self.schema)
        return self.read_range(first, last).where(keep).select(*self.schema.names)

    def at(self, instant: Instant) -> DataFrame:
        """Rows of one instant; one chunk is read."""
        return self.scan(instant, instant, closed="both")

    def bucket(self, width: Width | str, at: Instant, origin: Instant | None = None) -> DataFrame:
        """Rows of the bucket that starts at ``at``, as a pruned range."""
        width = Width.parse(width)
        us = to_micros(at)
        if width.floor(us, origin) != us:
            return self.spark.createDataFrame([], self.schema)
        return self.scan(from_micros(us), from_micros(width.add(us, 1)))

    def load_rows(self, load: str) -> DataFrame:
        """Rows one append brought, as long as they have not been compacted.

        Rows that a rewrite has taken in can no longer be told apart, which is an error. A
        micro-batch is found by its stream's name and its number.
        """
        own = (F.col("load") == load) | F.col("load").startswith(f"{load}.")
        rows = self.read_chunks().where(own)
        for chunk in self.folder.chunk_ids(pattern=f"chunk_id=*/{_ABSORBED}"):
            for label in self.absorbed(f"chunk_id={chunk}"):
                if label == load or label.startswith(f"{load}."):
                    raise ValueError(f"load {label!r} has been taken in by a rewrite of chunk {chunk}")
        return rows.select(*self.schema.names)

    def create_view(self, name: str, with_chunk_id: bool = False) -> None:
        """A temporary view for ``spark.sql``; filters on its ``chunk_id`` prune folders.

        A view of :meth:`show_chunks` beside it gives SQL the chunk numbers without a scan.
        """
        shown = [*self.schema.names, *(["chunk_id"] if with_chunk_id else [])]
        self.read_chunks().select(*shown).createOrReplaceTempView(name)

    def create_range_function(
        self, name: str, shown: Callable[[DataFrame], DataFrame] | None = None
    ) -> None:
        """A temporary table function for ``spark.sql``: rows from ``lo`` up to before ``hi``.

        Catalyst inlines it, so its bounds on ``chunk_id`` prune folders as a scan's do.
        ``shown`` may give other columns; it has to keep ``chunk_id`` and the instant.
        """
        rows = self.read_chunks()
        rows = rows.select(*self.schema.names, "chunk_id") if shown is None else shown(rows)
        rows.createOrReplaceTempView(f"{name}_rows")
        kind = self.ts_type.simpleString()
        fields = [f for f in rows.schema if f.name != "chunk_id"]
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        shown_columns = ", ".join(f"`{f.name}`" for f in fields)

        def chunk(us: str) -> str:
            return f"({us} - pmod({us}, {self.interval_us})) DIV {self.interval_us}"

        lo, hi = (f"unix_micros(CAST({name}.{b} AS TIMESTAMP))" for b in ("lo", "hi"))
        self.spark.sql(
            f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(lo {kind}, hi {kind})
                RETURNS TABLE({columns})
                RETURN SELECT {shown_columns} FROM {name}_rows
                       WHERE chunk_id >= {chunk(lo)} AND chunk_id <= {chunk(f'({hi} - 1)')}
                         AND `{self.ts}` >= {name}.lo AND `{self.ts}` < {name}.hi"""
        )

    # -- bounds taken from the data -----------------------------------------

    def _edge(self, pick, order: list[int]) -> dt.datetime | None:
        for chunk in order:
            value = (
                self.read_chunks([chunk])
                .agg(pick(F.unix_micros(F.col(self.ts).cast("timestamp"))))
                .first()[0]
            )
            if value is not None:
                return from_micros(value)
        return None

    def max_ts(self) -> dt.datetime | None:
        """Latest instant; chunks do not overlap, so only the newest one is read."""
        return self._edge(F.max, self.chunk_ids()[::-1])

    def min_ts(self) -> dt.datetime | None:
        return self._edge(F.min, self.chunk_ids())

    def extent(self) -> DataFrame:
        """Earliest and latest instant and the row count (which Parquet footers answer)."""
        lo, hi = self.min_ts(), self.max_ts()

        def edge(value: dt.datetime | None) -> Column:
            if value is None:
                return F.lit(None).cast(self.ts_type)
            return ts_lit(to_micros(value), self.ts_type)

        counted = self.read_chunks().agg(F.count(F.lit(1)).alias("total"))
        return counted.select(edge(lo).alias("min_ts"), edge(hi).alias("max_ts"), "total")

    def last(self, length: str | dt.timedelta, closed: str = "right") -> DataFrame:
        """Rows of the last stretch of the data, measured back from its own latest instant."""
        hi = self.max_ts()
        if hi is None:
            return self.spark.createDataFrame([], self.schema)
        lo = from_micros(to_micros(hi) - fixed_micros(length))
        return self.scan(lo, hi, closed)

    def last_full_day(self) -> DataFrame:
        hi = self.max_ts()
        if hi is None:
            return self.spark.createDataFrame([], self.schema)
        midnight = hi.replace(hour=0, minute=0, second=0, microsecond=0)
        return self.scan(midnight - dt.timedelta(days=1), midnight)

    # -- chunk catalogue ----------------------------------------------------

    def range_columns(self, chunk_id: Column | str = "chunk_id") -> tuple[Column, Column]:
        chunk_id = F.col(chunk_id) if isinstance(chunk_id, str) else chunk_id
        size = F.lit(self.interval_us)
        start = F.timestamp_micros(chunk_id * size).cast(self.ts_type)
        end = F.timestamp_micros((chunk_id + 1) * size).cast(self.ts_type)
        return start, end

    def chunks(self, ids: Sequence[int] | None = None) -> DataFrame:
        """One row per chunk: range, rows, files, bytes, compacted or not, overflow rows.

        No data column is read: the row counts come from the Parquet footers and the
        sizes from the file listing.
        """
        per_file = self.files(ids)
        is_new = ~F.col("load").startswith(COMPACTED)
        per_chunk = per_file.groupBy("chunk_id").agg(
            F.sum("rows").alias("n_rows"),
            F.count(F.lit(1)).alias("n_files"),
            F.sum("file_size").alias("bytes"),
            F.max(~is_new).alias("is_compressed"),
            F.sum(F.when(is_new, F.col("rows")).otherwise(0)).alias("_appended"),
        )
        start, end = self.range_columns()
        return per_chunk.select(
            "chunk_id",
            start.alias("range_start"),
            end.alias("range_end"),
            "n_rows",
            "n_files",
            "bytes",
            "is_compressed",
            F.when(F.col("is_compressed"), F.col("_appended")).otherwise(0).alias("overflow_rows"),
        )

    def files(self, ids: Sequence[int] | None = None) -> DataFrame:
        """Chunk, load, path, size and rows of every file, from the listing and the footers."""
        live = self.chunk_ids() if ids is None else self._live(set(ids))
        if not live:
            return self.spark.createDataFrame(
                [], "chunk_id long, load string, file_path string, file_size long, rows long"
            )
        rows = self.read_chunks() if ids is None else self._read_live(live)
        size = F.col("_metadata.file_size").alias("file_size")
        path = F.col("_metadata.file_path").alias("file_path")
        return rows.groupBy("chunk_id", "load", path, size).agg(F.count(F.lit(1)).alias("rows"))

    def older_than(self, cutoff: Instant) -> list[int]:
        """Chunks that end before the cut-off; one that ends just then stays."""
        us = to_micros(cutoff)
        return [i for i in self.chunk_ids() if (i + 1) * self.interval_us < us]

    def show_chunks(
        self, older_than: Instant | None = None, newer_than: Instant | None = None
    ) -> DataFrame:
        """Chunks wholly before or wholly after an instant, from the folder names alone."""
        ids = self.chunk_ids()
        if older_than is not None:
            ids = self.older_than(older_than)
        if newer_than is not None:
            ids = [i for i in ids if i * self.interval_us > to_micros(newer_than)]
        listed = self.spark.createDataFrame([(i,) for i in ids], "chunk_id long")
        start, end = self.range_columns()
        name = F.concat_ws("/", F.lit(self.root), F.concat(F.lit("chunk_id="), F.col("chunk_id")))
        return listed.select(
            "chunk_id", name.alias("chunk_name"), start.alias("range_start"), end.alias("range_end")
        )

    # -- replacing and dropping whole chunks ---------------------------------

    def recover(self) -> None:
        """Finish the replacements whose driver died half-way; clear what was only staged.

        A replacement that had begun is carried on to its end, chunk by chunk, so that it is
        seen in full or, if it had not begun, not at all.
        """
        for staging in self.folder.names("_staging-*"):
            if self.folder.exists(f"{staging}/{_COMMIT}"):
                self._carry_out(staging)
            else:
                self.folder.delete(staging)
        for aside in self.folder.names("_old-*"):
            token = aside.removeprefix("_old-")
            done = set(self.folder.chunk_ids(pattern=f"chunk_id=*/load=*-{token}"))
            for chunk in set(self.folder.chunk_ids(aside)) - done:
                name = f"chunk_id={chunk}"
                self.folder.mkdirs(name)
                for part in [*self.folder.names(f"{aside}/{name}/load=*"), f"{aside}/{name}/{_ABSORBED}"]:
                    home = part.removeprefix(f"{aside}/")
                    if self.folder.exists(part) and not self.folder.exists(home):
                        self.folder.rename(part, home)
            self.folder.delete(aside)

    def sweep(self) -> None:
        """Remove what dead writers left behind; only while nothing writes to the table."""
        self.recover()
        for kind in ("append", "batch", "touched"):
            for name in self.folder.names(f"_{kind}-*"):
                self.folder.delete(name)

    def swap_in(
        self,
        staging: str,
        ids: Sequence[int],
        kind: str,
        seen: Mapping[int, set[str]] | None = None,
        kept: Mapping[int, Sequence[str]] | None = None,
        then: Mapping[str, str] | None = None,
    ) -> None:
        """Put staged chunks in place of the live ones; ids without staged rows vanish.

        A chunk changes hands by folder renames, after all its rows are written. With
        ``seen`` (the loads that were read, per chunk), loads that arrived since stay. Files
        that are ``kept`` (``load=…/name``, per chunk) move on, as they are, beside the staged
        ones. What is to be done is written down first, so that ``recover`` can carry it on;
        the texts of the files in ``then`` are put in place with it.
        """
        staged = set(self.folder.chunk_ids(staging))
        taking = {x for loads in (seen or self.folder.loads()).values() for x in loads}
        noted = {n.split("@")[0]: n for n in self.changes()}
        noted = {x: self._change(n) for x, n in noted.items() if x in taking and not x.startswith(_OWN_LABELS)}
        plan = {
            "kind": kind,
            "facts": {x: [c["rows"], c["hash"]] for x, c in noted.items()},
            "token": uuid.uuid4().hex[:12],
            "staged": sorted(staged),
            "ids": sorted(staged | (set(ids) & set(self.chunk_ids()))),
            "seen": None if seen is None else {str(c): sorted(s) for c, s in seen.items()},
            "kept": {str(c): sorted(k) for c, k in (kept or {}).items()},
            "then": dict(then or {}),
        }
        self.folder.write_text(f"{staging}/{_COMMIT}", json.dumps(plan))
        self._carry_out(staging)

    def _carry_out(self, staging: str) -> None:
        """Do what a staged replacement has written down, or what is left of it."""
        plan = json.loads(self.folder.read_text(f"{staging}/{_COMMIT}"))
        aside = f"_old-{plan['token']}"
        seen = plan["seen"]
        self.folder.mkdirs(aside)

        def change_hands(chunk: int) -> None:
            name, new = f"chunk_id={chunk}", f"load={plan['kind']}-{plan['token']}"
            if self.folder.exists(f"{name}/{new}"):
                return
            if self.folder.exists(name) and not self.folder.exists(f"{aside}/{name}"):
                self.folder.rename(name, f"{aside}/{name}")
            taken: dict[str, tuple[int, str | None] | None] = {}
            if self.folder.exists(f"{aside}/{name}"):
                taken = self._absorbed_facts(f"{aside}/{name}")
                for part in self.folder.names(f"{aside}/{name}/load=*"):
                    label = part.rsplit("load=", 1)[1]
                    if seen is not None and label not in seen.get(str(chunk), ()):
                        self.folder.mkdirs(name)
                        self.folder.rename(part, f"{name}/load={label}")
                    elif not label.startswith(_OWN_LABELS):
                        taken[label] = plan.get("facts", {}).get(label)
                for part in plan.get("kept", {}).get(str(chunk), ()):
                    if self.folder.exists(f"{aside}/{name}/{part}"):
                        self.folder.rename(
                            f"{aside}/{name}/{part}", f"{staging}/{name}/{part.rsplit('/', 1)[1]}"
                        )
            if chunk in plan["staged"]:
                self.folder.mkdirs(name)
                if taken and not self.folder.exists(f"{name}/{_ABSORBED}"):
                    lines = [f"{x} {f[0]} {f[1] or '-'}" if f else x for x, f in sorted(taken.items())]
                    self.folder.write_text(f"{name}/{_ABSORBED}", "\n".join(lines))
                self.folder.rename(f"{staging}/{name}", f"{name}/{new}")

        self.folder.each(change_hands, plan["ids"])
        for path, text in plan.get("then", {}).items():
            if not self.folder.exists(path):
                self.folder.mkdirs(path.rsplit("/", 1)[0])
                self.folder.write_text(path, text)
        self.folder.delete(aside)
        self.folder.delete(staging)

    def replace_chunks(
        self,
        df: DataFrame,
        ids: Sequence[int],
        seen: Mapping[int, set[str]] | None = None,
        spans: Sequence[tuple[int, int]] | None = None,
        then: Mapping[str, str] | None = None,
    ) -> None:
        """Make ``df`` the whole content of the chunks ``ids`` (and of any other it touches).

        ``df`` may read those very chunks: nothing live is moved before it is written. Rows
        appended meanwhile stay: only loads that ``df`` has read, or that were there when the
        call began, are replaced, or those in ``seen``. ``spans`` (first and last
        microsecond) tell those who follow the table where rows can differ; without them it is
        anywhere in the chunks. Texts in ``then`` are put in place together with the chunks.
        """
        if seen is None:
            seen = {**self.folder.loads(), **self.loads_read(df)}
        self.recover()
        staging = fresh("staging")
        facts = self._staged(self.routed(df).hint("rebalance", F.col("chunk_id")), staging)
        touched = sorted({*ids, *self.folder.chunk_ids(staging)})
        note = self._note(f"{REPLACED}-{staging[-12:]}", touched, {**facts, "lo": None, "hi": None}, spans)
        self.swap_in(staging, ids, REPLACED, seen, then=then)
        self._shown(note)

    def stage(
        self,
        routed: DataFrame,
        staging: str,
        mode: str = "errorifexists",
        options: Mapping[str, str] | None = None,
    ) -> None:
        options = {**bloom_options(self.key, self.ts), **(options or {})}
        writer = routed.write.mode(mode).options(**options)
        with micros_timestamps(routed):
            writer.partitionBy("chunk_id").parquet(f"{self.root}/{staging}")

    def drop(self, ids: Sequence[int]) -> None:
        """Delete whole chunks, after noting how far the table is emptied."""
        if ids:
            self.folder.mkdirs(f"{_DROPPED}/below-{max(ids) + 1}")
        self.folder.each(lambda chunk: self.folder.delete(f"chunk_id={chunk}"), ids)

    def dropped_below(self) -> int | None:
        """Start, in microseconds, of what retention has not dropped; None if nothing was."""
        marks = [int(n.rsplit("below-", 1)[1]) for n in self.folder.names(f"{_DROPPED}/below-*")]
        return max(marks) * self.interval_us if marks else None
