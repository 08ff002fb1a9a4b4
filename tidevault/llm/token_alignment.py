"""Alignment of two tokenizers over a corpus, by inverted pair bitmaps.

Tokens of both tokenizers that end at the same byte close a group; all tokens of a group
are linked with each other. For each pair of linked ids a batch of documents keeps a
compressed bitmap of its documents: the 64-bit words that are not zero, with their places.
How often a document holds a pair is written in binary, one bitmap (plane) for each digit. Of
all batches, the planes of a pair are OR-merged and counted, which gives its documents; the
counts go back to the postings, and these return each document's scores.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidevault.llm.batches import (
    batched,
    located,
    planes,
    squeezed,
    unplaned,
    unsqueezed,
)
from tidevault.llm.components import written
from tidevault.llm.token_counts import _WHITE, loose, pieces
from tidevault.llm.vocabularies import ByteLevel, Pieces
from tidevault.llm.words import mix

PARTS = 16  # shares of the pairs
SLAB_BATCHES = 64  # batches whose postings of a share are in one task
_DOCS = 1 << 12  # documents of a batch
# Places of words: word of the batch's documents, then plane.
_PLANES = 1 << 5
_SAFE = re.compile(f"(?<=[^{_WHITE}])(?= [^{_WHITE}])")

FACTS = ["n_a", "n_b", "n_groups", "n_links"]


def _edges(counts: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(counts)))


def _spread(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """``first[i], first[i] + 1, …``, so many of each, one after the other."""
    return np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())


class _Side:
    """The tokens of one tokenizer: ids, how many each text has, and the bytes of each id."""

    def __init__(self, bytes_of: dict[int, bytes]):
        self.bytes_of = bytes_of
        self.lengths = np.zeros(max(bytes_of, default=0) + 1, np.int64)
        for i, token in bytes_of.items():
            self.lengths[i] = len(token)

    def flat(self, lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter(itertools.chain.from_iterable(lists), np.int64, int(counts.sum())), counts

    def exact(self, ids: np.ndarray, counts: np.ndarray, texts: list[bytes]) -> np.ndarray:
        """Whether the tokens of each text join to its bytes."""
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        joined = _edges(self.lengths[ids])[_edges(counts)]
        same = np.diff(joined) == sizes
        tokens = b"".join(map(self.bytes_of.__getitem__, ids.tolist()))
        if not same.all() or tokens != b"".join(texts):
            for i, text in enumerate(texts):
                same[i] = tokens[joined[i] : joined[i + 1]] == text
        return same


class Aligner:
    """Aligns texts, or parts of them, by two tokenizers."""

    def __init__(self, path_a: str, path_b: str, pattern: str):
        self._a, self._b = ByteLevel(path_a, pattern, specials=False), Pieces(path_b)
        self.a, self.b = _Side(self._a.bytes_of), _Side(self._b.bytes_of)
        self.parts = self._a.parts_at_blanks and self._b.parts_at_blanks

    def cut(self, texts: list[str]) -> tuple[list[str], list[list[int]]]:
        """Distinct parts, and those of each text in order: a blank before the text, then cut
        before blanks between visible characters, where both tokenizers end a token."""
        index: dict[str, int] = {}
        number = lambda parts: [index.setdefault(p, len(index)) for p in parts]
        if not self.parts:
            out = [number([" " + t]) if t else [] for t in texts]
            return list(index), out
        out = [number(pieces(" " + t)[1:]) if t else [] for t in texts]
        free = {i for p, i in index.items() if loose(p)}
        if free:
            for i, t in enumerate(texts):
                if not free.isdisjoint(out[i]):
                    out[i] = number(_SAFE.split(" " + t))
        return list(index), out

    def tokens(self, parts: list[str]) -> tuple[tuple[np.ndarray, np.ndarray], ...]:
        """Ids and their numbers for each part, of either tokenizer."""
        return (
            self.a.flat([self._a.ids(p) for p in parts]),
            self.b.flat(self._b.all_ids([p[1:] for p in parts])),
        )


class Aligned:
    """The groups and links of some parts: arrays by part, and the pairs of each part."""

    def __init__(self, aligner: Aligner, parts: list[str]):
        (a, n_a), (b, n_b) = aligner.tokens(parts)
        texts = [p.encode() for p in parts]
        self.exact = aligner.a.exact(a, n_a, texts) & aligner.b.exact(b, n_b, texts)
        a, b = a[np.repeat(self.exact, n_a)], b[np.repeat(self.exact, n_b)]
        self.n_a, self.n_b = n_a * self.exact, n_b * self.exact
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) * self.exact
        ends = np.cumsum(sizes)
        end_a, end_b = np.cumsum(aligner.a.lengths[a]), np.cumsum(aligner.b.lengths[b])
        both = np.intersect1d(end_a, end_b)
        self.part_of = np.searchsorted(ends, both)
        self.n_groups = np.bincount(self.part_of, minlength=len(parts))
        group_a, group_b = np.searchsorted(both, end_a), np.searchsorted(both, end_b)
        in_a, in_b = (np.bincount(g, minlength=len(both)) for g in (group_a, group_b))
        self.n_links = np.zeros(len(parts), np.int64)
        np.add.at(self.n_links, self.part_of, in_a * in_b)
        self._texts(a, b, in_a, in_b)
        self._pairs(a, b, group_a, group_b, len(both))

    def _texts(self, a: np.ndarray, b: np.ndarray, in_a: np.ndarray, in_b: np.ndarray) -> None:
        a, b = list(map(str, a.tolist())), list(map(str, b.tolist()))
        at_a, at_b = _edges(in_a).tolist(), _edges(in_b).tolist()
        groups = [
            f"{a[i] if j - i == 1 else ','.join(a[i:j])}|{b[k] if m - k == 1 else ','.join(b[k:m])}"
            for i, j, k, m in zip(at_a, at_a[1:], at_b, at_b[1:], strict=False)
        ]
        at = _edges(self.n_groups).tolist()
        self.texts = [";".join(groups[i:j]) for i, j in zip(at, at[1:], strict=False)]

    def _pairs(self, a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, n: int) -> None:
        """Pairs of different ids of each group, with how many links each stands for."""

        def distinct(group: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, ...]:
            key, times = np.unique(group << 32 | ids, return_counts=True)
            count = np.bincount(key >> 32, minlength=n)
            return key & 0xFFFFFFFF, times, count, np.cumsum(count) - count

        id_a, times_a, count_a, first_a = distinct(group_a, a)
        id_b, times_b, count_b, first_b = distinct(group_b, b)
        many = count_a * count_b
        group, place = np.repeat(np.arange(n), many), _spread(np.zeros(n, np.int64), many)
        i, j = first_a[group] + place // count_b[group], first_b[group] + place % count_b[group]
        self.pair = (id_a[i] << 32 | id_b[j]).astype(np.uint64)
        self.times = times_a[i] * times_b[j]
        self.n_pairs = np.bincount(self.part_of[group], minlength=len(self.exact))


def postings(parts: Aligned, owner: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pair, place and word of the bitmaps of a batch, in ascending order.

    ``owner`` and ``part`` are the batch's documents and their parts.
    """
    key, often = np.unique(owner * np.int64(len(parts.exact)) + part, return_counts=True)
    owner, part = key // max(1, len(parts.exact)), key % max(1, len(parts.exact))
    n = parts.n_pairs[part]
    at = _spread((np.cumsum(parts.n_pairs) - parts.n_pairs)[part], n)
    pairs, which = np.unique(parts.pair, return_inverse=True)
    key = which[at] * _DOCS + np.repeat(owner, n)
    order = np.argsort(key, kind="stable")
    key, times = key[order], (parts.times[at] * np.repeat(often, n))[order]
    if not len(key):
        none = np.empty(0, np.uint64)
        return none, np.empty(0, np.uint16), none
    first = np.flatnonzero(np.diff(key, prepend=-1))
    key, times = key[first], np.add.reduceat(times, first)
    found = []
    for plane in range(int(times.max()).bit_length()):
        has = key[(times >> plane) & 1 == 1]
        place = (has % _DOCS // 64) * _PLANES + plane
        found.append((has // _DOCS * (_DOCS // 64 * _PLANES) + place, np.uint64(1) << (has % 64).astype(np.uint64)))
    key, bits = (np.concatenate(c) for c in zip(*found, strict=True))
    order = np.argsort(key, kind="stable")
    key, bits = key[order], bits[order]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    key, word = key[first], np.bitwise_or.reduceat(bits, first)
    wide = _DOCS // 64 * _PLANES
    return pairs[key // wide], (key % wide).astype(np.uint16), word


def packed(pair: np.ndarray, place: np.ndarray, word: np.ndarray) -> bytes:
    """Bitmaps as compressed bytes, equal bytes of their numbers together."""
    return squeezed(planes(np.diff(pair, prepend=np.uint64(0))) + planes(place) + planes(word))


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = unsqueezed(data)
    n = len(raw) // 18
    pair = np.cumsum(unplaned(raw[: 8 * n], np.uint64), dtype=np.uint64)
    return pair, unplaned(raw[8 * n : 10 * n], np.uint16), unplaned(raw[10 * n :], np.uint64)


def documents(pair: np.ndarray, place: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each pair of a batch and its documents: its planes OR-merged, and the bits counted."""
    if not len(pair):
        return pair, np.empty(0, np.int64)
    at = place // _PLANES
    fresh = np.concatenate(([True], (pair[1:] != pair[:-1]) | (at[1:] != at[:-1])))
    first = np.flatnonzero(fresh)
    bits = np.bitwise_count(np.bitwise_or.reduceat(word, first)).astype(np.int64)
    pair = pair[first]
    first = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))
    return pair[first], np.add.reduceat(bits, first)


def scores(place: np.ndarray, word: np.ndarray, values: np.ndarray) -> np.ndarray:
    """What the postings return: for each document, the values of its links, added up.

    ``values`` are columns by bitmap word.
    """
    bits = np.unpackbits(word.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    entry, bit = np.nonzero(bits)
    doc = (place[entry] // _PLANES).astype(np.int64) * 64 + bit
    times = np.int64(1) << (place % _PLANES).astype(np.int64)
    out = np.zeros((len(values), int(doc.max(initial=-1)) + 1), np.int64)
    for column, value in zip(out, values, strict=True):
        np.add.at(column, doc, (value * times)[entry])
    return out


@lru_cache(maxsize=1)
def _aligner(path_a: str, path_b: str, pattern: str) -> Aligner:
    return Aligner(path_a, path_b, pattern)


_ROW = pa.schema([("batch", pa.int64()), ("part", pa.int32()), ("blob", pa.binary())])
_ROW_KINDS = "batch long, part int, blob binary"
_DOC = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in FACTS), ("groups_sha256", pa.string())])
_OUT = pa.schema(
    [("doc_id", pa.int64()), *((c, pa.int64()) for c in [*FACTS, "n_best", "count_sum"]), ("groups_sha256", pa.string())]
)


def _batch(aligner: Aligner, table: pa.Table) -> tuple[pa.Table, dict[int, bytes]]:
    """A batch's documents with what does not depend on others, and its postings by share."""
    parts, of = aligner.cut([t or "" for t in table["text"].cast(pa.large_string()).to_pylist()])
    whole = Aligned(aligner, parts)
    n = np.fromiter(map(len, of), np.int64, len(of))
    part = np.fromiter(itertools.chain.from_iterable(of), np.int64, int(n.sum()))
    owner = np.repeat(np.arange(len(of)), n)
    good = n > 0
    good[owner[~whole.exact[part]]] = False
    keep = good[owner]
    owner, part = owner[keep], part[keep]
    columns = [table["doc_id"].cast(pa.int64())]
    for c in FACTS:
        facts = np.zeros(len(of), np.int64)
        np.add.at(facts, owner, getattr(whole, c)[part])
        columns.append(pa.array(facts))
    digests = [
        hashlib.sha256(";".join(map(whole.texts.__getitem__, ids)).encode()).hexdigest() if ok else ""
        for ids, ok in zip(of, good.tolist(), strict=True)
    ]
    docs = pa.Table.from_arrays([*columns, pa.array(digests, pa.string())], schema=_DOC)
    pair, place, word = postings(whole, owner, part)
    share = mix(pair) % np.uint64(PARTS)
    out = {}
    for p in np.unique(share).tolist():
        own = share == p
        out[p] = packed(pair[own], place[own], word[own])
    return docs, out


def _ipc(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def alignment(docs: DataFrame, path_a: str, path_b: str, pattern: str) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row.

    A encodes a blank and the text, B (which adds the blank itself) the text; special strings in
    texts are plain text. A pair's count is the number of rows that hold it linked; a link is
    a best one if no pair of its A id has a higher count.

    Null and empty texts, and those whose tokens do not join to the blank and the text, have
    no tokens: zeros, and an empty digest; they count for no pair. Rows are independent:
    repeated rows count as often as they occur, a null doc_id stays null, other columns are not
    read. An empty table gives no rows. The documents are read once; their postings are
    written to the working folder.
    """

    def read(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(path_a, path_b, pattern)
        for batch, table in batched(tables):
            facts, found = _batch(aligner, table)
            rows = [(batch, None, _ipc(facts)), *((batch, p, blob) for p, blob in found.items())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ROW, strict=True)], schema=_ROW
            )

    rows = located(docs.select("doc_id", "text")).mapInArrow(read, _ROW_KINDS)
    rows = written(rows, "aligned-postings")
    facts, blobs = rows.where("part IS NULL"), rows.where("part IS NOT NULL")
    slabs = max(1, math.ceil(facts.count() / SLAB_BATCHES))
    blobs = blobs.withColumn("slab", F.pmod(F.xxhash64("batch"), F.lit(slabs)).cast("int"))

    def merge(table: pa.Table) -> pa.Table:
        found = [documents(*unpacked(b)) for b in table["blob"].to_pylist()]
        pair, n = (np.concatenate(c) for c in zip(*found, strict=True))
        order = np.argsort(pair, kind="stable")
        pair, n = pair[order], n[order]
        first = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))
        pair, n = pair[first], np.add.reduceat(n, first)
        same = [np.full(len(pair), table[c][0].as_py(), np.int32) for c in ("slab", "part")]
        ids = [(pair >> np.uint64(32)).astype(np.int32), (pair & np.uint64(0xFFFFFFFF)).astype(np.int32)]
        return pa.table([*same, *ids, n], names=["slab", "part", "a", "b", "n"])

    kinds = "slab int, part int, a int, b int, n long"
    seen = written(blobs.groupBy("slab", "part").applyInArrow(merge, kinds), "aligned-pairs")
    counts = seen.groupBy("a", "b").agg(F.sum("n").alias("count"))
    # At most as many rows for an A id as B has ids.
    top = F.max("count").over(Window.partitionBy("a"))
    counts = counts.withColumn("best", (F.col("count") == top).cast("long"))
    known = seen.select("slab", "part", "a", "b").join(counts, ["a", "b"])

    def score(own: pa.Table, known: pa.Table) -> pa.Table:
        pair = known["a"].to_numpy().astype(np.uint64) << np.uint64(32) | known["b"].to_numpy().astype(np.uint64)
        order = np.argsort(pair)
        pair, values = pair[order], [known[c].to_numpy()[order] for c in ("best", "count")]
        out = []
        for blob in own["blob"].to_pylist():
            keys, place, word = unpacked(blob)
            at = np.searchsorted(pair, keys)
            out.append(scores(place, word, np.stack([v[at] for v in values])).tobytes())
        return pa.table([own["batch"], own["part"], pa.array(out, pa.binary())], schema=_ROW)

    returned = blobs.groupBy("slab", "part").cogroup(known.groupBy("slab", "part")).applyInArrow(score, _ROW_KINDS)

    def finish(table: pa.Table) -> pa.Table:
        own = None
        for part, blob in zip(table["part"].to_pylist(), table["blob"].to_pylist(), strict=True):
            if part is None:
                own = pa.ipc.open_stream(blob).read_all()
        total = np.zeros((2, len(own)), np.int64)
        for part, blob in zip(table["part"].to_pylist(), table["blob"].to_pylist(), strict=True):
            if part is not None:
                found = np.frombuffer(blob, np.int64).reshape(2, -1)
                total[:, : found.shape[1]] += found
        columns = {c: own[c] for c in own.column_names} | {"n_best": pa.array(total[0]), "count_sum": pa.array(total[1])}
        return pa.table([columns[f.name] for f in _OUT], schema=_OUT)

    numbers = ", ".join(f"{c} long" for c in [*FACTS, "n_best", "count_sum"])
    result = f"doc_id long, {numbers}, groups_sha256 string"
    return facts.unionByName(returned).groupBy("batch").applyInArrow(finish, result)
