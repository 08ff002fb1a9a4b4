"""Packing token sequences by bounded-space online best fit.

Each task keeps a fixed number of open sequences, in a bitset keyed by free space. A piece
goes where the least space is left over; if it fits nowhere, a new sequence is opened, and
when there are too many the fullest closes. Pieces come in windows no longer than the number
of open sequences, the longest first. What a task leaves half-open is packed again together
with what other tasks leave, in groups of bounded size.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidevault.llm.batches import sliced
from tidevault.llm.components import written
from tidevault.llm.vocabularies import ByteLevel

OPEN = 4096  # open sequences of a task
GROUP_ROWS = 100_000  # pieces left over that are packed together
END = 0  # the id behind each document

Placed = tuple[int, int, int]  # place of the piece among those given, sequence, offset


class BestFit:
    """Best fit with a fixed number of open sequences; gives pieces back as sequences close."""

    def __init__(self, capacity: int, most: int = OPEN):
        self.capacity, self.most = capacity, most
        self.bits = 0  # bit f: an open sequence has f tokens free
        self.of: list[list[list]] = [[] for _ in range(capacity + 1)]
        self.open, self.number = 0, 0

    def _take(self, free: int) -> list:
        found = self.of[free].pop()
        if not self.of[free]:
            self.bits &= ~(1 << free)
        self.open -= 1
        return found

    def add(self, piece: int, length: int) -> Iterator[Placed]:
        """Place a piece; yields the pieces of the sequence that closes by it, if one does."""
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            held = self._take(free)
        else:
            free, held = self.capacity, [self.number]
            self.number += 1
        held.append((piece, self.capacity - free))
        free -= length
        if not free:
            yield from self._closed(held)
            return
        self.of[free].append(held)
        self.bits |= 1 << free
        self.open += 1
        if self.open > self.most:
            yield from self._closed(self._take((self.bits & -self.bits).bit_length() - 1))

    def close(self, up_to: int) -> Iterator[Placed]:
        """Close the open sequences with no more than so many tokens free, the fullest first."""
        while self.bits:
            free = (self.bits & -self.bits).bit_length() - 1
            if free > up_to:
                break
            yield from self._closed(self._take(free))

    def left(self) -> Iterator[int]:
        """The pieces of the sequences that are still open."""
        for free in self.of:
            for held in free:
                yield from (piece for piece, _ in held[1:])

    @staticmethod
    def _closed(held: list) -> Iterator[Placed]:
        return ((piece, held[0], offset) for piece, offset in held[1:])


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of so many ids: only the first may be shorter."""
    first = n % capacity or capacity
    return [(0, min(n, first)), *((s, capacity) for s in range(first, n, capacity))]


_COLUMNS = ["doc_id", "piece", "start", "length", "ids_crc32"]
_FIELDS = [pa.field(c, pa.int64()) for c in [*_COLUMNS, "sequence_id", "offset"]]
_SCHEMA = pa.schema([*(f if f.name != "piece" else pa.field("piece", pa.int32()) for f in _FIELDS)])
_STAGED = _SCHEMA.append(pa.field("number", pa.int64()))
_KINDS = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
_workers: dict[tuple[str, str], ByteLevel] = {}


def _encoder(path: str, pattern: str) -> ByteLevel:
    if (path, pattern) not in _workers:
        _workers[path, pattern] = ByteLevel(path, pattern, specials=True)
    return _workers[path, pattern]


def _pieces(records: Iterable[pa.RecordBatch], path: str, pattern: str, capacity: int) -> Iterator[tuple]:
    """Every piece of the texts, with the partition it is read in."""
    ids_of = _encoder(path, pattern).ids
    for record in sliced(records):
        texts = pc.fill_null(record["text"].cast(pa.large_string()), "").to_pylist()
        where = record["partition"][0].as_py()
        for doc, text in zip(record["doc_id"].cast(pa.int64()).to_pylist(), texts, strict=True):
            ids = np.append(np.asarray(ids_of(text), "<u4"), np.uint32(END)).astype("<u4")
            for i, (start, length) in enumerate(cut(len(ids), capacity)):
                crc = zlib.crc32(ids[start : start + length].tobytes())
                yield where, (doc, i, start, length, crc)


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def packed(docs: DataFrame, path: str, pattern: str, capacity: int = 2048, most: int = OPEN) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece.

    A document is its ids by the ``.json`` tokenizer in ``path`` without added special
    tokens (special strings in a text become their tokens, as is the library's default),
    and the id 0. One longer than ``capacity`` is cut into pieces of ``capacity``, of which
    the first may be shorter; no other is cut.

    A null or empty text is the id 0 alone. Rows are independent: repeated rows are packed as
    often as they occur, a null doc_id stays null, other columns are not read. An empty table
    gives no rows. Sequence numbers have gaps. The tasks' pieces are written to the working
    folder before any are packed together, so that a lost executor moves none of them.
    """
    window = most

    def first(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit, where, out = BestFit(capacity, most), 0, []
        held: dict[int, tuple] = {}  # pieces whose sequence is open
        waiting: list[tuple] = []

        def place() -> None:
            at = max(held, default=-1) + 1
            for piece in sorted(waiting, key=lambda p: -p[3]):
                held[at] = piece
                out.extend(settle(fit.add(at, piece[3])))
                at += 1
            waiting.clear()

        def settle(closed: Iterable[Placed]) -> Iterator[tuple]:
            for at, sequence, offset in closed:
                yield *held.pop(at), (where << 32) + sequence, offset, None

        for where, piece in _pieces(records, path, pattern, capacity):  # noqa: B007
            waiting.append(piece)
            if len(waiting) == window:
                place()
                if out:
                    yield _rows(out, _STAGED)
                    out = []
        place()
        out += settle(fit.close(capacity // 128))
        out += [(*held[at], where, None, i) for i, at in enumerate(fit.left())]
        if out:
            yield _rows(out, _STAGED)

    located = docs.select("doc_id", "text", F.spark_partition_id().cast("long").alias("partition"))
    staged = written(located.mapInArrow(first, _KINDS + ", number long"), "packed-pieces")
    open_ = staged.where("offset IS NULL")
    groups = max(1, math.ceil(open_.count() / GROUP_ROWS))

    def again(table: pa.Table) -> pa.Table:
        order = [("length", "descending"), ("sequence_id", "ascending"), ("number", "ascending")]
        table = table.take(pc.sort_indices(table, order))
        fit, group = BestFit(capacity, most), table["group"][0].as_py()
        settled: list[Placed] = []
        for at, length in enumerate(table["length"].to_pylist()):
            settled += fit.add(at, length)
        settled += fit.close(capacity)
        at, sequence, offset = (np.array(c, np.int64) for c in zip(*settled, strict=True))
        rows = table.select(_COLUMNS).take(at)
        rows = rows.append_column("sequence_id", pa.array((1 << 62) + (group << 32) + sequence))
        return rows.append_column("offset", pa.array(offset)).cast(_SCHEMA)

    group = F.pmod(F.xxhash64("sequence_id", "number"), F.lit(groups)).alias("group")
    late = open_.select("*", group).groupBy("group").applyInArrow(again, _KINDS)
    return staged.where("offset IS NOT NULL").drop("number").unionByName(late)
