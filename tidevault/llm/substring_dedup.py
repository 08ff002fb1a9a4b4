"""Removal of repeated word windows, by suffix trees partitioned by prefixes.

Suffixes begin at words and are compared word by word as far as they matter, for ``window``
words. They are split into groups that fit a task's memory by prefixes of variable length. Of
the pairs of words inside a window, the one with the least hash (the first of equal ones) is
its anchor. It depends on the window's words alone, so equal windows have equal anchors, and
the suffixes that begin at windows with the same anchor pair go to the same group.
Neighbouring windows mostly share their anchor and travel as one run of words. A first pass
counts the windows of every pair (in 65,536 buckets): rare ones share a group; the windows of
a frequent one travel one by one and are split by all of their words, which parts any text
that is frequent and not equal.

A group sorts its suffixes by their words and takes the common prefixes of neighbours. Where
these reach ``window`` words lie the internal nodes of the group's suffix tree that are deep
enough; the leaves below one are the places of one repeated window, and those in other than
the least document are answered. A maximal repeat is a chain of such windows, which the
documents' batch joins where they overlap.

A group knows words by 36-bit hashes and windows by their words: two windows that differ in one
word only are taken for equal once in 7 * 10**10 times, in more words hardly ever. Inside a batch
(``batches``) windows and runs are known by 64-bit hashes of their own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidevault.llm.batches import (
    ENTRIES,
    ENTRIES_SCHEMA,
    ROW,
    ROW_SCHEMA,
    _each_batch,
    give_back,
    meet,
    numbered,
    packed_keys,
    planes,
    squeezed,
    tally,
    texts_of,
    unpacked_keys,
    unplaned,
    unsqueezed,
)
from tidevault.llm.words import mix, shingles, words_of

SHORT = 2  # words of an anchor
BUCKETS = 1 << 16
GROUP = 1_500_000  # suffixes of a group
_LOW = np.uint64(28)  # bits of a word's hash that stay at home
_NONE = np.iinfo(np.int64).max


class Windows:
    """The windows of a batch's texts, with their anchors and the runs that share one.

    ``at`` is the first word of each window among all ``words``, ``text`` its text, ``hashes``
    knows it inside the batch, ``bucket`` is that of its anchor and ``anchor`` its place.
    """

    def __init__(self, texts: list[bytes], window: int) -> None:
        self.window = window
        self.words, self.edges = words_of(texts)
        n = len(self.words) - window + 1
        if n <= 0:
            self.at = self.text = self.anchor = self.bucket = np.empty(0, np.int64)
            self.hashes = np.empty(0, np.uint64)
            return
        text = np.repeat(np.arange(len(texts)), np.diff(self.edges))
        self.at = np.flatnonzero(text[:n] == text[window - 1 :])
        self.text = text[self.at]
        self.hashes = shingles(self.words, window)[self.at]
        short = min(SHORT, window)
        pairs = shingles(self.words, short)
        least, offset = pairs[:n].copy(), np.zeros(n, np.int64)
        for j in range(1, window - short + 1):
            lower = pairs[j : j + n] < least
            least[lower] = pairs[j : j + n][lower]
            offset[lower] = j
        self.anchor = (np.arange(n) + offset)[self.at]
        # the upper bits of least hashes are mostly 0
        self.bucket = (least[self.at] & np.uint64(BUCKETS - 1)).astype(np.int64)

    def runs(self, first: np.ndarray, splits: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, ...]:
        """Distinct runs, by part and owner: part, first of their windows, number of windows, owner.

        Windows of a run follow each other in ``at`` and share their anchor.
        """
        if not len(self.at):
            empty = np.empty(0, np.int64)
            return empty, empty, empty, empty
        split = splits[self.bucket]
        new = np.ones(len(self.at), bool)
        new[1:] = (self.anchor[1:] != self.anchor[:-1]) | (self.text[1:] != self.text[:-1]) | (split[1:] > 1)
        begin = np.flatnonzero(new)
        size = np.diff(begin, append=len(self.at))
        owner = owners[self.text[begin]]
        # two windows at most a window apart show all words of a run
        head, tail = self.hashes[begin], self.hashes[begin + size - 1]
        key = mix(head + mix(tail + size.astype(np.uint64)))
        order = np.lexsort((owner, key))
        only = np.ones(len(order), bool)
        only[1:] = key[order][1:] != key[order][:-1]
        mine = order[only]
        bucket = self.bucket[begin[mine]]
        part = first[bucket] + (head[mine] % splits[bucket].astype(np.uint64)).astype(np.int64)
        order = np.lexsort((begin[mine], owner[mine], part))
        mine = mine[order]
        return part[order], begin[mine], size[mine], owner[mine]


def _ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places of all ranges, one range after the other."""
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(begin - ends + size, size) + np.arange(total)


def groups_for(counts: np.ndarray, size: int = GROUP) -> tuple[np.ndarray, np.ndarray]:
    """The first group of each bucket and the number of groups it is split into."""
    splits = np.maximum(1, -(-counts // size))
    first = np.empty(len(counts), np.int64)
    group, held = 0, 0
    for b, n in enumerate(counts.tolist()):
        if splits[b] > 1 or held + n > size:
            group, held = group + (held > 0), 0
        first[b] = group
        if splits[b] > 1:
            group += int(splits[b])
        else:
            held += n
    return first, splits


def deep_nodes(words: np.ndarray, starts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Sort the suffixes of ``words`` at ``starts`` by ``depth`` words: their order and nodes.

    ``words`` are small numbers, of 32 bits at most. A node is where neighbours have ``depth`` words in common; a
    suffix that shares them with no other is a leaf, in a node of its own.
    """
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    bits = max(1, int(words.max()).bit_length())
    order, new = np.arange(len(starts)), np.zeros(len(starts), bool)
    new[0] = True
    open_, done = order.copy(), 0
    while done < depth and len(open_):
        # Suffixes that agree so far are sorted by as many more words as fit beside their number.
        group = np.cumsum(new[open_]) - 1
        more = min((64 - int(group[-1]).bit_length()) // bits, depth - done)
        mine = order[open_]
        key, at = group.astype(np.uint64), starts[mine] + done
        for i in range(more):
            key = key << np.uint64(bits) | words[at + i]
        again = np.argsort(key)
        key = key[again]
        order[open_] = mine[again]
        new[open_[1:]] |= key[1:] != key[:-1]
        alone = new.copy()
        alone[:-1] &= new[1:]
        open_, done = np.flatnonzero(~alone), done + more
    return order, np.cumsum(new) - 1


def _numbers(values: np.ndarray) -> bytes:
    return squeezed(planes(values.astype(np.uint32)))


def _uint32(data: bytes) -> np.ndarray:
    return unplaned(unsqueezed(data), np.uint32)


def _parcel(*blobs: bytes) -> bytes:
    return b"".join(len(b).to_bytes(4, "little") + b for b in blobs)


def _opened(parcel: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(parcel):
        size = int.from_bytes(parcel[at : at + 4], "little")
        out.append(parcel[at + 4 : at + 4 + size])
        at += 4 + size
    return out


def _ascending(ids: np.ndarray) -> bytes:
    """Packed ids; their order by sign and value is kept, and their differences wrap around."""
    return packed_keys(ids.view(np.uint64))


def _ids_of(data: bytes) -> np.ndarray:
    return unpacked_keys(data).view(np.int64)


def _ids(table: pa.Table) -> np.ndarray:
    """Document ids; a null one counts as larger than all others."""
    return table["doc_id"].cast(pa.int64()).fill_null(_NONE).to_numpy()


def _owned(table: pa.Table) -> tuple[list[bytes], np.ndarray]:
    """Distinct texts and the least id of each."""
    least: dict[bytes, int] = {}
    for t, i in zip(texts_of(table), _ids(table).tolist(), strict=True):
        least[t] = min(least.get(t, i), i)
    return list(least), np.array(list(least.values()), np.int64)


def _least(hashes: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes in order and the least id of each."""
    order = np.lexsort((ids, hashes))
    new = np.ones(len(order), bool)
    new[1:] = hashes[order][1:] != hashes[order][:-1]
    return hashes[order][new], ids[order][new]


def without_repeated_windows(docs: DataFrame, window: int = 13, with_text: bool = False) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row; ``kept`` if asked for.

    A word goes if a window of ``window`` words over it also starts in a document with a
    smaller doc_id; windows are judged on the input. What is kept is joined by one blank.
    A null text has no words, and a text with fewer words than the window keeps all.
    Rows with the same doc_id are one document here; rows without doc_id come after all
    others and leave each other alone. Other columns are not read.
    """
    docs = docs.select("doc_id", "text")

    def count(b: pa.RecordBatch) -> np.ndarray:
        return np.bincount(Windows(texts_of(b), window).bucket, minlength=BUCKETS)[None, :]

    first, splits = groups_for(tally(docs, count, (1, BUCKETS))[0])

    def send(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, table in _each_batch(records):
            texts, owners = _owned(table)
            own = Windows(texts, window)
            part, begin, size, owner = own.runs(first, splits, owners)
            edges = np.flatnonzero(np.diff(part, prepend=-1, append=-1))
            known, code = np.unique(own.words >> _LOW, return_inverse=True)
            number = np.empty(len(known), np.int64)
            out = {"part": [], "batch": [], "keys": [], "vals": []}
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                codes = code[_ranges(own.at[begin[a:b]], size[a:b] + window - 1)]
                used = np.zeros(len(known), bool)
                used[codes] = True
                number[used] = np.arange(np.count_nonzero(used))
                out["part"].append(int(part[a]))
                out["batch"].append(batch)
                out["keys"].append(_parcel(packed_keys(known[used]), _numbers(number[codes])))
                out["vals"].append(_parcel(_numbers(size[a:b]), _ascending(owner[a:b])))
            if out["part"]:
                yield pa.RecordBatch.from_pydict(out, ENTRIES_SCHEMA)
        give_back()

    def reply(rows: pa.Table) -> pa.Table:
        give_back()
        known, codes, sizes, owners = [], [], [], []
        for keys, vals in zip(rows["keys"], rows["vals"], strict=True):
            own, numbers = _opened(keys.as_py())
            size, owner = _opened(vals.as_py())
            known.append(unpacked_keys(own))
            codes.append(_uint32(numbers))
            sizes.append(_uint32(size).astype(np.int64))
            owners.append(_ids_of(owner))
        every = np.unique(np.concatenate(known))
        words = np.concatenate([np.searchsorted(every, k)[c].astype(np.uint32) for k, c in zip(known, codes, strict=True)])
        counts = [int(s.sum()) for s in sizes]
        size = np.concatenate(sizes)
        ids = np.repeat(np.concatenate(owners), size)
        lengths = size + window - 1
        starts = _ranges(np.cumsum(lengths) - lengths, size)
        order, node = deep_nodes(words, starts, window)
        least = np.minimum.reduceat(ids[order], np.flatnonzero(np.diff(node, prepend=-1)))
        other = np.empty(len(starts), np.int64)
        other[order] = least[node]
        out = {"batch": [], "docs": [], "part": [], "keys": [], "vals": []}
        end = 0
        for batch, n in zip(rows["batch"].to_pylist(), counts, strict=True):
            begin, end = end, end + n
            found = np.flatnonzero(other[begin:end] < ids[begin:end])
            if len(found):
                out["batch"].append(batch)
                out["docs"].append(None)
                out["part"].append(rows["part"][0].as_py())
                out["keys"].append(_numbers(np.diff(found, prepend=0)))
                out["vals"].append(_ascending(other[begin:end][found]))
        return pa.Table.from_pydict(out, ROW_SCHEMA)

    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())]
        + [("kept", pa.string())] * with_text
    )

    def each(batch: int, table: pa.Table, answers: list) -> pa.Table:
        distinct, owners = _owned(table)
        texts, ids = texts_of(table), _ids(table)
        own = Windows(texts, window)
        known, least = [own.hashes], [ids[own.text]]
        if answers:  # the runs are those that were sent: a batch's documents do not change
            sent = own if len(distinct) == len(texts) else Windows(distinct, window)
            part, begin, size, _ = sent.runs(first, splits, owners)
            for of, places, values in answers:
                a, b = np.searchsorted(part, [of, of + 1])
                found = np.cumsum(_uint32(places), dtype=np.int64)
                known.append(sent.hashes[_ranges(begin[a:b], size[a:b])[found]])
                least.append(_ids_of(values))
        hashes, lowest = _least(np.concatenate(known), np.concatenate(least))
        gone = np.zeros(0, bool)
        if len(own.at):
            gone = lowest[np.searchsorted(hashes, own.hashes)] < ids[own.text]
        steps = np.zeros(int(own.edges[-1]) + 1, np.int64)
        np.add.at(steps, own.at[gone], 1)
        np.add.at(steps, own.at[gone] + window, -1)
        removed = np.cumsum(steps)[:-1] > 0
        out = {f.name: [] for f in schema}
        for i, t in enumerate(texts):
            mine = removed[own.edges[i] : own.edges[i + 1]]
            words = t.split()
            kept = b" ".join([w for w, r in zip(words, mine.tolist(), strict=True) if not r] if mine.any() else words)
            out["n_words"].append(len(words))
            out["n_removed"].append(int(mine.sum()))
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            if with_text:
                out["kept"].append(kept.decode())
        out["doc_id"] = table["doc_id"].cast(pa.int64())
        return pa.table(out, schema)

    batches = numbered(docs)
    answers = batches.mapInArrow(send, ENTRIES).groupBy("part").applyInArrow(reply, ROW)
    kinds = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    return meet(batches, answers, each, kinds + ", kept string" * with_text)
