"""Removal of long repeated byte strings, by sorting suffixes at anchors anew in each part.

No shard builds a Burrows-Wheeler transform and none are merged (see the README).

Sorting every suffix of a corpus is not needed to find strings of 400 bytes that repeat.
Each such string has one anchor: the least of its 32-byte grams, by hash. Only suffixes that
begin at anchors are sorted (a sparse suffix array), and what precedes them, read backwards,
stands for the Burrows-Wheeler column. Consecutive strings share their anchor, one anchor
for about 185 of them.

1. Batches count the anchors' grams over the corpus (``batches``); a gram that occurs once
   anchors nothing that repeats and goes no further.
2. Each batch sends its suffixes at the other anchors, with the bytes before them, to the part
   of the gram. Equal ones of a batch go as one.
3. A part sorts them: all suffixes of a gram begin as one bucket, and each iteration parts the
   buckets by the next eight bytes, until suffixes
   stand alone or end. Where a bucket breaks, the depth is the length of the common prefix of
   two neighbours. The same is done with the bytes before. A string with its anchor at
   offset o repeats if another suffix shares the o bytes before and the 400 - o bytes from the
   anchor on: two intervals of the merged orders, bounded by smaller common prefixes.
4. The repeated strings' places go back to their batches.

A gram of more than ``HOT`` runs, such as a line that very many documents share, would fill a
part. Its strings part by themselves: each goes to the part of its own 128-bit digest, once for
each batch, and only equal ones meet.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidevault.llm.batches import ROW, ROW_SCHEMA, ask, cut, meet, numbered, parts_for, text_bytes, texts_of
from tidevault.llm.words import FACTOR, mix, powers

GRAM = 32
CHUNK = 1 << 19
HOT = 5_000  # runs of a gram that are merged in one part
_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_INVERSE = pow(FACTOR, -1, 1 << 64)
_SCATTER = np.uint64(0x2545F4914F6CDD1D)
_LOW = np.uint64((1 << 21) - 1)


def _window_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of ``k`` bytes."""
    values = _BYTES[data] * powers(len(data))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))
    # Divided by the power they begin with, equal runs agree wherever they stand.
    return mix((total[k:] - total[:-k]) * powers(len(data) - k + 1, _INVERSE))


def _sliding_least(x: np.ndarray, w: int) -> np.ndarray:
    """The least of each ``w`` consecutive numbers, from running minima of blocks of ``w``."""
    n = len(x) - w + 1
    padded = np.full(-(-len(x) // w) * w, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[w - 1 : w - 1 + n])


class Anchored:
    """The strings of ``length`` bytes of some texts, in runs with a common anchor."""

    def __init__(self, texts: list[bytes], length: int):
        self.length = length
        whole = b"".join(texts)
        self.data = np.frombuffer(whole, np.uint8)
        self.edges = np.cumsum([0] + [len(t) for t in texts])
        self.twice = np.empty(0, np.int64)  # strings known to repeat within a text
        first: dict[bytes, int] = {}
        parts = []
        for i, t in enumerate(texts):
            if len(t) >= length and first.setdefault(t, i) == i:
                for begin in range(0, len(t) - length + 1, CHUNK):
                    end = min(begin + CHUNK, len(t) - length + 1)  # strings begin, before end
                    parts.append(self._runs(int(self.edges[i]) + begin, int(self.edges[i]) + end))
        #: Texts of which an equal one is among them.
        self.copied = np.array([len(t) >= length and (first[t] != i) for i, t in enumerate(texts)], bool)
        for i, t in enumerate(texts):
            if self.copied[i]:
                self.copied[first[t]] = True
        runs = np.concatenate(parts) if parts else np.empty((0, 3), np.int64)
        self.first, self.last, self.anchor = runs.T
        self.gram = self._grams()

    def _runs(self, begin: int, end: int) -> np.ndarray:
        """First string, last string and anchor of each run of the strings begin to end."""
        data = self.data[begin : end + self.length - 1]
        key = _window_hashes(data, GRAM)
        key = (key & ~_LOW) | np.arange(len(key), dtype=np.uint64)  # of equal ones the first
        anchor = (_sliding_least(key, self.length - GRAM + 1) & _LOW).astype(np.int64)
        edges = np.flatnonzero(np.diff(anchor, prepend=-1))
        if len(edges) > 64 + len(anchor) // 8:
            return self._distinct(begin, anchor)
        last = np.append(edges[1:], len(anchor)) - 1
        return np.column_stack((edges, last, anchor[edges])) + begin

    def _distinct(self, begin: int, anchor: np.ndarray) -> np.ndarray:
        """Runs where text repeats itself all the time: of equal strings the first only."""
        data = self.data[begin : begin + len(anchor) + self.length - 1]
        hashes = _window_hashes(data, self.length)
        _, place, which, counts = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
        self.twice = np.concatenate((self.twice, begin + np.flatnonzero(counts[which] > 1)))
        place = np.sort(place)
        new = np.ones(len(place), bool)
        new[1:] = (np.diff(place) > 1) | (np.diff(anchor[place]) != 0)
        edges = np.flatnonzero(new)
        last = place[np.append(edges[1:], len(place)) - 1]
        return np.column_stack((place[edges], last, anchor[place[edges]])) + begin

    def _grams(self) -> np.ndarray:
        if not len(self.anchor):
            return np.empty(0, np.uint64)
        at = self.anchor[:, None] + np.arange(GRAM)
        values = _BYTES[self.data[at]] * powers(GRAM)[None, :]
        # Anchors are chosen for small hashes; once more scattered they part evenly.
        return mix(mix(values.sum(axis=1, dtype=np.uint64)) ^ _SCATTER)

    def context(self, i: int) -> bytes:
        """The bytes of all strings of a run."""
        return self.data[self.first[i] : self.last[i] + self.length].tobytes()

    def digests(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """128-bit digests of all strings of some runs, as two numbers each, and where they begin."""
        whole, parts, begins = memoryview(self.data), [], []
        for i in some.tolist():
            at = range(int(self.first[i]), int(self.last[i]) + 1)
            parts.append(
                b"".join(hashlib.blake2b(whole[k : k + self.length], digest_size=16).digest() for k in at)
            )
            begins.append(np.array(at, np.int32))
        both = np.frombuffer(b"".join(parts), np.uint64).reshape(-1, 2)
        return both, np.concatenate(begins or [np.empty(0, np.int32)])


def refine(start: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort strings, bucket by bucket and eight bytes at a time.

    ``start`` gives each string's bucket, ``columns`` its bytes as big-endian numbers of eight.
    Returns their order and, for each place, the bytes that the string there has in
    common with the one before it; -1 where a bucket of ``start`` begins.
    """
    order = np.argsort(start, kind="stable")
    common = np.full(len(order), 8 * columns.shape[1])
    new = np.ones(len(order), bool)
    new[1:] = start[order][1:] != start[order][:-1]
    common[new] = -1
    active = np.arange(len(order))
    for d in range(columns.shape[1]):
        bucket = np.cumsum(new[active])
        alone = new[active] & np.append(new[active][1:], True)
        active, bucket = active[~alone], bucket[~alone]
        if not len(active):
            break
        symbol = columns[order[active], d]
        turn = np.lexsort((symbol, bucket))  # stable
        order[active], symbol = order[active][turn], symbol[turn]
        apart = np.zeros(len(active), bool)
        apart[1:] = (bucket[1:] == bucket[:-1]) & (symbol[1:] != symbol[:-1])
        where = np.flatnonzero(apart)
        differ = symbol[where] ^ symbol[where - 1]
        same = np.zeros(len(where), np.int64)
        for byte in range(1, 8):
            same += (differ >> np.uint64(64 - 8 * byte)) == 0
        common[active[where]] = 8 * d + same
        new[active[where]] = True
    return order, common


def _packed(strings: list[bytes], width: int) -> np.ndarray:
    """Strings as rows of big-endian numbers of eight bytes, filled up with zeros."""
    width = -(-max(8, width) // 8) * 8
    joined = b"".join(s.ljust(width, b"\0") for s in strings)
    return np.frombuffer(joined, ">u8").astype(np.uint64).reshape(len(strings), -1)


def repeated_offsets(gram: np.ndarray, contexts: list[bytes], before: np.ndarray, times: np.ndarray, length: int):
    """(entry, first offset, last offset) of the strings that repeat.

    An entry is a run of strings around one anchor: its bytes, how many of them are before
    the anchor, and how many times it occurs.
    """
    size = np.array([len(c) for c in contexts], np.int64)
    low = length - (size - before)  # the last string's offset; ``before`` is the first one's
    after = [c[b:] for c, b in zip(contexts, before.tolist(), strict=True)]
    ahead = [c[:b][::-1] for c, b in zip(contexts, before.tolist(), strict=True)]
    right, right_common = refine(gram, _packed(after, length))
    left, left_common = refine(gram, _packed(ahead, length - GRAM))
    n = len(contexts)
    repeated = np.zeros((n, length - GRAM + 3), bool)  # a column of False at either end
    many = np.flatnonzero(times > 1)
    column = np.arange(repeated.shape[1])[None, :] - 1
    repeated[many] = (column >= low[many, None]) & (column <= before[many, None])
    of_right, of_left = np.empty(n, np.int64), np.empty(n, np.int64)
    for o in range(length - GRAM + 1):
        some = np.flatnonzero((low <= o) & (o <= before))
        if len(some) < 2:
            continue
        of_right[right] = np.cumsum(right_common < length - o)
        of_left[left] = np.cumsum(left_common < o)
        key = of_right[some] * (n + 1) + of_left[some]
        order = np.argsort(key, kind="stable")
        equal = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(some), bool)
        twice[order[1:][equal]] = True
        twice[order[:-1][equal]] = True
        repeated[some[twice], o + 1] = True
    change = np.diff(repeated.astype(np.int8), axis=1)
    entry, begin = np.nonzero(change == 1)
    _, end = np.nonzero(change == -1)
    return entry, begin, end - 1


_PARTS = pa.schema(
    [("part", pa.int64()), ("batch", pa.int64())]
    + [(c, pa.binary()) for c in ("grams", "before", "sizes", "times", "anchors", "contexts")]
)


def _same(rows: pa.Table, length: int) -> pa.Table:
    """Of a part of digests, the places of those that occur more than once."""
    digests, times, begins = (
        [np.frombuffer(b, kind) for b in rows[name].to_pylist()]
        for name, kind in (("grams", np.uint64), ("times", np.int32), ("anchors", np.int32))
    )
    count = [len(t) for t in times]
    digest, n = np.concatenate(digests).reshape(-1, 2), np.concatenate(times)
    order = np.lexsort((digest[:, 1], digest[:, 0]))
    equal = (digest[order][1:] == digest[order][:-1]).all(axis=1)
    twice = n > 1
    twice[order[1:][equal]] = True
    twice[order[:-1][equal]] = True
    out = {"batch": [], "docs": [], "part": [], "keys": [], "vals": []}
    ends = np.cumsum(count)
    for batch, own, a, b in zip(rows["batch"].to_pylist(), begins, ends - count, ends, strict=True):
        at = own[np.repeat(twice[a:b], n[a:b])]
        if len(at):
            out["batch"].append(batch)
            out["docs"].append(None)
            out["part"].append(rows["part"][0].as_py())
            out["keys"].append(at.tobytes())
            out["vals"].append((at + np.int32(length)).tobytes())
    return pa.table(out, ROW_SCHEMA)


def _merge(length: int, merges: int) -> Callable[[pa.Table], pa.Table]:
    def run(rows: pa.Table) -> pa.Table:
        if rows["part"][0].as_py() >= merges:
            return _same(rows, length)
        rows = rows.sort_by("batch")

        def numbers(name: str, kind: type) -> list[np.ndarray]:
            return [np.frombuffer(b, kind) for b in rows[name].to_pylist()]

        grams, before, sizes = numbers("grams", np.uint64), numbers("before", np.int32), numbers("sizes", np.int32)
        times, anchors = numbers("times", np.int32), numbers("anchors", np.int32)
        contexts = []
        for blob, size in zip(rows["contexts"].to_pylist(), sizes, strict=True):
            edges = np.concatenate(([0], np.cumsum(size))).tolist()
            contexts += [blob[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
        count = [len(g) for g in grams]
        owner = np.repeat(np.arange(len(grams)), count)
        grams, before, times = np.concatenate(grams), np.concatenate(before).astype(np.int64), np.concatenate(times)
        entry, low, high = repeated_offsets(grams, contexts, before, times, length)
        # Every place of an entry, in its batch's bytes.
        places = np.concatenate(anchors).astype(np.int64)
        at = np.concatenate(([0], np.cumsum(times)))
        n = times[entry]
        which = np.repeat(at[entry] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        begin = places[which] - np.repeat(high, n)
        end = places[which] - np.repeat(low, n) + length
        shard = owner[np.repeat(entry, n)]
        order = np.argsort(shard, kind="stable")
        begin, end, shard = begin[order].astype(np.int32), end[order].astype(np.int32), shard[order]
        edges = np.flatnonzero(np.diff(shard, prepend=-1, append=-1))
        out = {"batch": [], "docs": [], "part": [], "keys": [], "vals": []}
        batch = rows["batch"].to_pylist()
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            out["batch"].append(batch[shard[a]])
            out["docs"].append(None)
            out["part"].append(rows["part"][0].as_py())
            out["keys"].append(begin[a:b].tobytes())
            out["vals"].append(end[a:b].tobytes())
        return pa.table(out, ROW_SCHEMA)

    return run


def entries(batches: DataFrame, size: int, length: int) -> tuple[DataFrame, int]:
    """What batches of so many bytes in all send to the parts, and how many parts merge; those
    that follow get digests."""
    hot = HOT
    parts = parts_for(size / 150, 200_000)
    merges = parts_for(size / 150, 20_000)

    def spread(gram: np.ndarray, n: int) -> np.ndarray:
        return (((gram >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.int64)

    def keys_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        gram, counts = np.unique(Anchored(texts_of(table), length).gram, return_counts=True)
        return spread(gram, parts), gram, counts

    def answer(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        _, which = np.unique(keys, return_inverse=True)
        total = np.bincount(which, counts)[which]
        places = np.flatnonzero(total > 1)
        return places, (total[places] > hot).astype(np.uint8)

    def contexts(batch: int, table: pa.Table, answers: list) -> pa.Table:
        runs = Anchored(texts_of(table), length)
        known = np.concatenate([np.frombuffer(k, np.uint64) for _, k, _ in answers] or [np.empty(0, np.uint64)])
        is_hot = np.concatenate([np.frombuffer(v, np.uint8) for *_, v in answers] or [np.empty(0, np.uint8)]) > 0
        found: dict[tuple[int, int, bytes, int], list[int]] = {}
        for i in np.flatnonzero(np.isin(runs.gram, known[~is_hot])).tolist():
            before = int(runs.anchor[i] - runs.first[i])
            context = runs.context(i)
            key = int(runs.gram[i]), before, context
            found.setdefault(key, []).append(int(runs.anchor[i]))
        merged = sorted(found, key=lambda e: (e[0], e[2][e[1] :]))
        grams = np.array([e[0] for e in merged], np.uint64)
        part = spread(grams, merges)
        edges = np.flatnonzero(np.diff(part, prepend=-1, append=-1))
        out = {f.name: [] for f in _PARTS}
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            mine = merged[a:b]
            out["part"].append(int(part[a]))
            out["batch"].append(batch)
            out["grams"].append(grams[a:b].tobytes())
            out["before"].append(np.array([e[1] for e in mine], np.int32).tobytes())
            out["sizes"].append(np.array([len(e[2]) for e in mine], np.int32).tobytes())
            out["times"].append(np.array([len(found[e]) for e in mine], np.int32).tobytes())
            out["anchors"].append(np.array([p for e in mine for p in found[e]], np.int32).tobytes())
            out["contexts"].append(b"".join(e[2] for e in mine))
        digest, begin = runs.digests(np.flatnonzero(np.isin(runs.gram, known[is_hot])))
        order = np.lexsort((digest[:, 1], digest[:, 0]))
        digest, begin = digest[order], begin[order]
        new = np.ones(len(digest), bool)
        new[1:] = (digest[1:] != digest[:-1]).any(axis=1)
        at = np.append(np.flatnonzero(new), len(digest))
        times = np.diff(at).astype(np.int32)
        firsts = digest[new]
        for part, a, b in cut(firsts[:, 0], merges):
            out["part"].append(merges + part)
            out["batch"].append(batch)
            out["grams"].append(firsts[a:b].tobytes())
            out["times"].append(times[a:b].tobytes())
            out["anchors"].append(begin[at[a] : at[b]].tobytes())
            for name in ("before", "sizes", "contexts"):
                out[name].append(None)
        return pa.table(out, _PARTS)

    asked = ask(batches, keys_of, answer, (np.uint64, np.uint32))
    kinds = "part long, batch long, " + ", ".join(f"{f.name} binary" for f in list(_PARTS)[2:])
    return meet(batches, asked, contexts, kinds), merges


def repeats(batches: DataFrame, size: int, length: int) -> DataFrame:
    """Rows of answers for each batch: begin and end of repeated places in its joined bytes."""
    if length < GRAM:
        raise ValueError(f"repeated strings have {GRAM} bytes at least, not {length}")
    sent, merges = entries(batches, size, length)
    return sent.groupBy("part").applyInArrow(_merge(length, merges), ROW)


def _removed(table: pa.Table, answers: list, length: int) -> tuple[list[bytes], list[np.ndarray]]:
    """The texts and, for each, which of its bytes a repeated string covers."""
    texts = texts_of(table)
    edges = np.cumsum([0] + [len(t) for t in texts])
    steps = np.zeros(int(edges[-1]) + 1, np.int64)
    for _, begin, end in answers:
        np.add.at(steps, np.frombuffer(begin, np.int32), 1)
        np.add.at(steps, np.frombuffer(end, np.int32), -1)
    runs = Anchored(texts, length)
    np.add.at(steps, runs.twice, 1)
    np.add.at(steps, runs.twice + length, -1)
    gone = np.cumsum(steps)[:-1] > 0
    for i in np.flatnonzero(runs.copied):
        gone[edges[i] : edges[i + 1]] = True
    return texts, [gone[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]


def repeat_report(docs: DataFrame, length: int = 400) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row.

    A byte goes if a string of ``length`` bytes (of UTF-8) over it also starts anywhere else,
    in any row, its own included; strings are judged on the input and never cross rows.
    ``n_spans`` counts the maximal runs removed. A null text has no bytes; texts shorter
    than ``length`` keep all. Repeated rows remove each other. A null doc_id stays null;
    other columns are not read.
    """
    docs = docs.select("doc_id", "text")

    def each(batch: int, table: pa.Table, answers: list) -> pa.Table:
        texts, gone = _removed(table, answers, length)
        kept = [np.frombuffer(t, np.uint8)[~g].tobytes() for t, g in zip(texts, gone, strict=True)]
        return pa.table(
            {
                "doc_id": table["doc_id"].cast(pa.int64()),
                "n_bytes": pa.array([len(t) for t in texts], pa.int64()),
                "n_removed": pa.array([int(g.sum()) for g in gone], pa.int64()),
                "n_spans": pa.array([int((np.diff(g.astype(np.int8), prepend=0) == 1).sum()) for g in gone], pa.int64()),
                "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
            }
        )

    kinds = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    batches = numbered(docs)
    return meet(batches, repeats(batches, text_bytes(docs), length), each, kinds)


def without_repeats(docs: DataFrame, length: int = 400) -> DataFrame:
    """The documents without their repeated strings, with all their columns.

    A character goes if all of its bytes do, so that the text stays valid. ``n_chars``, where
    there is one, becomes the number of characters left. Null texts stay null.
    """
    schema = docs.schema
    has_length = "n_chars" in docs.columns and isinstance(schema["n_chars"].dataType, T.IntegralType)

    def each(batch: int, table: pa.Table, answers: list) -> pa.Table:
        texts, gone = _removed(table, answers, length)
        kept = []
        for t, g, null in zip(texts, gone, table["text"].is_null().to_pylist(), strict=True):
            data = np.frombuffer(t, np.uint8)
            if g.any():
                begins = np.flatnonzero((data & 0xC0) != 0x80)
                sizes = np.diff(begins, append=len(data))
                whole = np.add.reduceat(g.astype(np.int64), begins) == sizes
                data = data[~np.repeat(whole, sizes)]
            kept.append(None if null else data.tobytes().decode())
        text = table.schema.get_field_index("text")
        table = table.set_column(text, "text", pa.array(kept, pa.string()))
        if has_length:
            at = table.schema.get_field_index("n_chars")
            n = [None if k is None else len(k) for k in kept]
            table = table.set_column(at, "n_chars", pa.array(n, table.schema.field(at).type))
        return table

    batches = numbered(docs)
    return meet(batches, repeats(batches, text_bytes(docs), length), each, schema)
