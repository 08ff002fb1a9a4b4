"""Batches of documents, and questions that they put to the whole corpus.

Batch-wise operators work in three steps. Each batch sends the distinct keys of its
documents (hashes of shingles, windows or anchors), packed by the part of the key range
they fall in. One task per part sees what all batches sent and answers each batch with the
keys that matter to it. Then each batch meets its documents again, together with its
answers. A key that is common to many documents costs one entry per batch, so no key, source
or group of copies can fill a task; parts grow in number with the input.

The documents are read once: ``numbered`` cuts them into batches by input partition and place in
it, and writes these, compressed, to the working folder. All further steps read them there, so a
batch keeps its number and its documents whatever happens to the cluster in between.
"""

from __future__ import annotations

import ctypes
import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidevault.llm.components import written

BATCH_BYTES = 4 << 20
BATCH_ROWS = 4096
ROUNDS = 6  # at most, with so much text in each at least
ROUND_BYTES = 48 << 20


def give_back() -> None:
    """Return to the system what a worker has freed: its next task may be another operator's."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library; it keeps what it has
        pass


def _sized(table: pa.Table | pa.RecordBatch) -> np.ndarray:
    lengths = pc.binary_length(table["text"].cast(pa.large_binary()))
    return np.asarray(pc.fill_null(lengths, 0)) + 64


def batched(
    tables: Iterable[pa.RecordBatch], most: int = BATCH_BYTES
) -> Iterator[tuple[int, pa.Table]]:
    """Number and cut a partition's rows into batches of bounded bytes and rows."""
    held: list[pa.Table] = []
    size, rows, number, place = 0, 0, 0, None
    for record in tables:
        if not record.num_rows:
            continue
        place = record["place"][0].as_py()
        table = pa.Table.from_batches([pa.RecordBatch.from_struct_array(record["doc"])])
        begin = 0
        for i, length in enumerate(_sized(table)):
            if rows and (size + length > most or rows == BATCH_ROWS):
                held.append(table.slice(begin, i - begin))
                yield (place << 32) + number, pa.concat_tables(held).combine_chunks()
                held, size, rows, begin, number = [], 0, 0, i, number + 1
            size, rows = size + length, rows + 1
        held.append(table.slice(begin))
    if rows:
        yield (place << 32) + number, pa.concat_tables(held).combine_chunks()


def sliced(
    records: Iterable[pa.RecordBatch], most: int = BATCH_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut record batches to bounded bytes and rows, so that what is made of them stays small."""
    for record in records:
        begin, size = 0, 0
        for i, length in enumerate(_sized(record)):
            if i > begin and (size + length > most or i - begin == BATCH_ROWS):
                yield record.slice(begin, i - begin)
                begin, size = i, 0
            size += length
        if record.num_rows > begin:
            yield record.slice(begin)


def texts_of(table: pa.Table | pa.RecordBatch) -> list[bytes]:
    """UTF-8 bytes of the texts; a null text has none."""
    return [t or b"" for t in table["text"].cast(pa.large_binary()).to_pylist()]


def located(docs: DataFrame) -> DataFrame:
    """The documents, whatever their columns are called, with their partition."""
    return docs.select(F.struct("*").alias("doc"), F.spark_partition_id().cast("long").alias("place"))


def _to_ipc(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 6))
    with pa.ipc.new_stream(sink, table.schema, options=options) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _from_ipc(data: bytes | pa.Buffer) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


ROW_SCHEMA = pa.schema(
    [
        ("batch", pa.int64()),
        ("docs", pa.binary()),
        ("part", pa.int64()),
        ("keys", pa.binary()),
        ("vals", pa.binary()),
    ]
)
BATCH_SCHEMA = pa.schema([("batch", pa.int64()), ("docs", pa.binary())])
ROW = "batch long, docs binary, part long, keys binary, vals binary"


def numbered(docs: DataFrame, most: int = BATCH_BYTES) -> DataFrame:
    """``batch, docs``: the documents in numbered batches, compressed and written."""

    def pack(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, table in batched(tables, most):
            yield pa.RecordBatch.from_pydict({"batch": [batch], "docs": [_to_ipc(table)]}, BATCH_SCHEMA)
        give_back()

    return written(located(docs).mapInArrow(pack, "batch long, docs binary"), "batches")


def rounds(docs: DataFrame) -> list[DataFrame]:
    """The documents in rounds of about as much text, by a hash of doc_id and text.

    Each row is in one round. Where every round's result is written before the next begins,
    what its batches ask and are answered takes disk for one round at a time.
    """
    n = max(1, min(ROUNDS, text_bytes(docs) // ROUND_BYTES))
    if n == 1:
        return [docs]
    at = F.pmod(F.xxhash64("doc_id", "text"), F.lit(n))
    return [docs.where(at == i) for i in range(n)]


def _each_batch(records: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    for record in records:
        for batch, docs in zip(record["batch"], record["docs"], strict=True):
            yield batch.as_py(), _from_ipc(docs.as_buffer())


def text_bytes(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def parts_for(n_keys: float, per_part: int = 2_000_000) -> int:
    return max(1, math.ceil(n_keys / per_part))


def ask(
    batches: DataFrame,
    keys_of: Callable[[pa.Table], tuple[np.ndarray, np.ndarray, np.ndarray]],
    answer: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]],
    kinds: tuple[type, type],
) -> DataFrame:
    """Send the (part, key, value) of each ``numbered`` batch to the parts; rows of answers per batch.

    ``keys_of`` gets a batch and gives the part, key and value of its distinct keys, of the
    number types ``kinds``. ``answer`` gets the keys and values of a part and gives the
    places of the entries that are answered, in ascending order, and their answers.
    """
    sent = pa.schema(
        [("part", pa.int64()), ("batch", pa.int64()), ("keys", pa.binary()), ("vals", pa.binary())]
    )

    def send(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, table in _each_batch(records):
            part, keys, vals = keys_of(table)
            order = np.argsort(part, kind="stable")
            part = part[order]
            keys, vals = keys[order].astype(kinds[0]), vals[order].astype(kinds[1])
            edges = np.flatnonzero(np.diff(part, prepend=-1, append=-1))
            out = {"part": [], "batch": [], "keys": [], "vals": []}
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                out["part"].append(int(part[a]))
                out["batch"].append(batch)
                out["keys"].append(keys[a:b].tobytes())
                out["vals"].append(vals[a:b].tobytes())
            if out["part"]:
                yield pa.RecordBatch.from_pydict(out, sent)
        give_back()

    def reply(rows: pa.Table) -> pa.Table:
        give_back()
        batch = rows["batch"].to_numpy()
        order = np.argsort(batch, kind="stable")
        blobs = rows["keys"].take(order).to_pylist()
        vals = rows["vals"].take(order).to_pylist()
        keys = np.frombuffer(b"".join(blobs), kinds[0])
        counts = [len(b) // np.dtype(kinds[0]).itemsize for b in blobs]
        places, values = answer(keys, np.frombuffer(b"".join(vals), kinds[1]))
        owner = np.repeat(batch[order], counts)[places]
        edges = np.flatnonzero(np.diff(owner, prepend=-1, append=-1))
        out = {"batch": [], "docs": [], "part": [], "keys": [], "vals": []}
        part = rows["part"][0].as_py()
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            out["batch"].append(int(owner[a]))
            out["docs"].append(None)
            out["part"].append(part)
            out["keys"].append(keys[places[a:b]].tobytes())
            out["vals"].append(values[a:b].tobytes())
        return pa.Table.from_pydict(out, ROW_SCHEMA)

    return (
        batches.mapInArrow(send, "part long, batch long, keys binary, vals binary")
        .groupBy("part")
        .applyInArrow(reply, ROW)
    )


def meet(
    batches: DataFrame,
    answers: DataFrame,
    each: Callable[[int, pa.Table, list[tuple[int, bytes, bytes]]], pa.Table],
    schema: str,
) -> DataFrame:
    """Give each batch its documents and its answers: (part, keys, values), by ``each``."""

    def join(rows: pa.Table) -> pa.Table:
        give_back()
        is_docs = rows["docs"].is_valid().to_pylist()
        table = _from_ipc(rows["docs"][is_docs.index(True)].as_buffer())
        answers = zip(*(rows[c].to_pylist() for c in ("part", "keys", "vals")), strict=True)
        return each(rows["batch"][0].as_py(), table, [a for a in answers if a[1] is not None])

    own = batches.withColumns({c: F.lit(None).cast(k) for c, k in (("part", "long"), ("keys", "binary"), ("vals", "binary"))})
    return own.unionByName(answers).groupBy("batch").applyInArrow(join, schema)


def planes(numbers: np.ndarray) -> bytes:
    """The first bytes of all numbers, then the second ones: equal bytes stand together."""
    width = numbers.dtype.itemsize
    return np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, width).T).tobytes()


def unplaned(data: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).reshape(-1).view(kind)


_CODEC = pa.Codec("zstd", 3)


def squeezed(data: bytes) -> bytes:
    """Compressed bytes, which know how long they were."""
    return len(data).to_bytes(8, "little") + _CODEC.compress(data, asbytes=True)


def unsqueezed(data: bytes) -> bytes:
    return _CODEC.decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True)


def packed_keys(keys: np.ndarray) -> bytes:
    """Ascending 64-bit keys by their differences, whose high bytes are mostly 0."""
    return squeezed(planes(np.diff(keys, prepend=np.uint64(0))))


def unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unplaned(unsqueezed(data), np.uint64), dtype=np.uint64)


def _value_planes(values: np.ndarray) -> bytes:
    return planes(np.ascontiguousarray(values, np.uint32).reshape(-1))


def packed_values(values: np.ndarray) -> bytes:
    """Columns of counts, an array of (columns, entries)."""
    return squeezed(_value_planes(values))


def unpacked_values(data: bytes, columns: int) -> np.ndarray:
    return unplaned(unsqueezed(data), np.uint32).reshape(columns, -1)


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """The part of the key range that each key falls in."""
    return (((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


def cut(keys: np.ndarray, parts: int) -> list[tuple[int, int, int]]:
    """(part, begin, end) of the parts that ascending keys fall in."""
    part = part_of(keys, parts)
    edges = np.flatnonzero(np.diff(part, prepend=-1, append=-1))
    return [(int(part[a]), int(a), int(b)) for a, b in zip(edges[:-1], edges[1:], strict=True)]


#: Keys are asked for by their bits above these; the entries found bring the lower ones along.
_LOW = np.uint64(24)
ENTRIES = "part long, batch long, keys binary, vals binary"
ENTRIES_SCHEMA = pa.schema([("part", pa.int64()), ("batch", pa.int64()), ("keys", pa.binary()), ("vals", pa.binary())])


def fetch(
    batches: DataFrame,
    known: DataFrame,
    keys_of: Callable[[pa.Table], list[np.ndarray]],
    parts: list[int],
    columns: list[int],
) -> DataFrame:
    """Let each batch fetch its own entries of tables that grow with the corpus.

    ``known`` holds the tables as ``ENTRIES``: one row a part, without batch, with its
    ascending keys and packed values, so many ``columns`` in each table. The parts of several
    tables follow each other.
    ``keys_of`` gives a batch's ascending distinct keys of each table. An answer holds all
    entries that agree with one of the batch's keys in the upper 40 bits, which are few besides
    those asked for, with the lower bits, by which ``fetched`` tells them apart.
    """
    firsts = np.cumsum([0, *parts[:-1]])

    def send(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, table in _each_batch(records):
            out, first = {"part": [], "batch": [], "keys": [], "vals": []}, 0
            for keys, n in zip(keys_of(table), parts, strict=True):
                for part, a, b in cut(keys, n):
                    out["part"].append(first + part)
                    out["batch"].append(batch)
                    out["keys"].append(packed_keys(np.unique(keys[a:b] >> _LOW)))
                    out["vals"].append(None)
                first += n
            if out["part"]:
                yield pa.RecordBatch.from_pydict(out, ENTRIES_SCHEMA)
        give_back()

    def reply(rows: pa.Table) -> pa.Table:
        give_back()
        out = {"batch": [], "docs": [], "part": [], "keys": [], "vals": []}
        part = rows["part"][0].as_py()
        batches = rows["batch"].to_pylist()
        if None in batches:
            at = batches.index(None)
            table = unpacked_keys(rows["keys"][at].as_py())
            values = unpacked_values(rows["vals"][at].as_py(), columns[np.searchsorted(firsts, part, "right") - 1])
            upper, lower = table >> _LOW, (table & ((np.uint64(1) << _LOW) - np.uint64(1))).astype(np.uint32)
            for i, batch in enumerate(batches):
                if batch is None:
                    continue
                keys = unpacked_keys(rows["keys"][i].as_py())
                begin = np.searchsorted(upper, keys)
                found = np.searchsorted(upper, keys, "right") - begin
                place = np.repeat(begin - np.cumsum(found) + found, found) + np.arange(found.sum())
                out["batch"].append(batch)
                out["docs"].append(None)
                out["part"].append(part)
                out["keys"].append(squeezed(planes(found.astype(np.uint32))))
                out["vals"].append(squeezed(planes(lower[place]) + _value_planes(values[:, place])))
        return pa.Table.from_pydict(out, ROW_SCHEMA)

    asked = batches.mapInArrow(send, ENTRIES)
    return asked.unionByName(known).groupBy("part").applyInArrow(reply, ROW)


def fetched(
    answers: list[tuple[int, bytes, bytes]], keys: list[np.ndarray], parts: list[int], widths: list[int]
) -> list[np.ndarray]:
    """The values of a batch's keys of each table, arrays of (columns, keys)."""
    blobs, out, first = {part: answer for part, *answer in answers}, [], 0
    for own, n, width in zip(keys, parts, widths, strict=True):
        values = np.zeros((width, len(own)))
        for part, a, b in cut(own, n):
            if first + part in blobs:
                found, entries = map(unsqueezed, blobs[first + part])
                upper = np.repeat(np.unique(own[a:b] >> _LOW), unplaned(found, np.uint32))
                if len(upper):
                    size = 4 * len(upper)
                    table = upper << _LOW | unplaned(entries[:size], np.uint32)
                    place = np.minimum(np.searchsorted(table, own[a:b]), len(table) - 1)
                    known = table[place] == own[a:b]
                    values[:, a:b] = unplaned(entries[size:], np.uint32).reshape(width, -1)[:, place] * known
        out.append(values)
        first += n
    return out


def tally(rows: DataFrame, count: Callable[[pa.RecordBatch], np.ndarray], shape: tuple[int, int]) -> np.ndarray:
    """Sum the counts, an array of the given (bounded) shape, of all batches of rows.

    Tasks send the counts that are not 0, which Spark adds up; the driver gets one number for
    each place of the array.
    """
    kinds = pa.schema([("place", pa.int32()), ("n", pa.int64())])

    def partial(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape, np.int64)
        for record in sliced(records):
            total += count(record)
        place = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(place.astype(np.int32)), pa.array(total.ravel()[place])], schema=kinds)

    sums = rows.mapInArrow(partial, "place int, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(shape, np.int64)
    out.reshape(-1)[sums["place"].to_numpy()] = sums["n"].to_numpy()
    return out
