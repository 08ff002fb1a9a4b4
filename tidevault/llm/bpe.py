"""Byte-level BPE by dynamic programming over prefixes.

For every prefix of a piece exactly one vocabulary token can be the last of its encoding:
the token that ends there and forms a valid pair with the last token of the prefix before
it. A pair is valid if merging its joined bytes gives the same two tokens. The table of last
tokens is all there is: the encoding is read off backwards, appended bytes extend it, and an
edit only makes the prefixes behind it be computed anew.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from tidevault.llm.batches import give_back, sliced
from tidevault.llm.token_counts import Known, byte_batches, loose, pieces, safe_pieces

KEPT = 400_000  # pieces that each of a worker's two generations remembers
KEPT_PAIRS = 1_500_000
GROUP_BYTES = 2 << 20  # text whose new pieces are encoded together


def ranks_from(path: str) -> dict[bytes, int]:
    """The vocabulary of a rank file: token bytes and rank in each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Encoder:
    """Encodes pieces (matches of a pattern) with a vocabulary of ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, kept_pairs: int = KEPT_PAIRS):
        if max(ranks.values(), default=0) >= 1 << 20:
            raise ValueError("ranks have 20 bits at most: pairs are remembered by both")
        self.ranks, self.kept_pairs = ranks, kept_pairs
        self.bytes_of = {v: k for k, v in ranks.items()}
        self.tails: dict[bytes, int] = {}  # the longest token with these last three bytes
        for token in ranks:
            if len(token) > 2:
                self.tails[token[-3:]] = max(len(token), self.tails.get(token[-3:], 0))
        self.pattern = regex.compile(pattern)
        self._spines: dict[int, tuple[list, list]] = {}
        self._pairs: dict[int, bool] = {}

    def merge(self, data: bytes, down_to: int = 1) -> list[bytes]:
        """Merge bytes by rank, until that many parts are left; for the few of a token."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > down_to:
            rank, at = min(
                (self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1)
            )
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _spine(self, token: int) -> tuple[list, list]:
        """The parts that stand at a token's right and left end while it is merged.

        Each with the rank of the merge that takes it in; the token itself lasts. A token
        that merging its bytes does not give has no spines.
        """
        known = self._spines.get(token)
        if known is None:
            data = self.bytes_of[token]
            last = self.merge(data, 2)
            if len(data) == 1:
                known = [(data, 1 << 60)], [(data, 1 << 60)]
            elif len(last) != 2:
                known = [], []
            else:
                left, right = (self._spine(self.ranks[p]) for p in last)
                ends = right[0], left[1]
                known = tuple([*e[:-1], (e[-1][0], token), (data, 1 << 60)] for e in ends)
            self._spines[token] = known
        return known

    def valid(self, a: int, b: int) -> bool:
        """Whether two tokens stay as they are when their bytes are merged together.

        Follows the parts that meet at the border from the single bytes on. They would merge
        if their own merge came before either is taken in by its token; of merges with the
        same rank the one farther left comes first.
        """
        known = self._pairs.get(a << 20 | b)
        if known is None:
            if len(self._pairs) > self.kept_pairs:
                self._pairs.clear()
            known = self._pairs[a << 20 | b] = self._apart(self._spine(a)[0], self._spine(b)[1])
        return known

    def _apart(self, left: list, right: list) -> bool:
        ranks, i, j = self.ranks, 0, 0
        while True:
            (x, x_until), (y, y_until) = left[i], right[j]
            rank = ranks.get(x + y)
            if rank is not None and rank < x_until and rank <= y_until:
                return False
            if x_until <= y_until:
                if x_until == 1 << 60:
                    return True
                i += 1
            else:
                j += 1

    def extend(self, last: list[int], piece: bytes) -> list[int]:
        """Last tokens of the prefixes of a piece, of which ``last`` has the first ones."""
        ranks, tails, pairs, valid = self.ranks, self.tails, self._pairs, self.valid
        for end in range(len(last) + 1, len(piece) + 1):
            longest = tails.get(piece[end - 3 : end], 2) if end > 2 else end
            for begin in range(end - longest if end > longest else 0, end):
                token = ranks.get(piece[begin:end])
                if token is None:
                    continue
                if begin:
                    before = last[begin - 1]
                    known = pairs.get(before << 20 | token)
                    if known is None:
                        known = self._spine(token)[1] and valid(before, token)
                    if known:
                        last.append(token)
                        break
                elif self._spine(token)[1]:
                    last.append(token)
                    break
        return last

    def piece(self, data: bytes) -> list[int]:
        """Ids of one match. A match that is a token as a whole is that token."""
        whole = self.ranks.get(data)
        return [whole] if whole is not None else self.read(self.extend([], data))

    def read(self, last: list[int]) -> list[int]:
        out, end = [], len(last)
        while end:
            out.append(last[end - 1])
            end -= len(self.bytes_of[last[end - 1]])
        return out[::-1]

    def encode(self, text: str) -> list[int]:
        return [t for m in self.pattern.findall(text) for t in self.piece(m.encode())]

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        """As ``encode`` for each. Matches are taken in order, so that one begins with the
        table of the one before as far as their bytes agree."""
        found = [[m.encode() for m in self.pattern.findall(t)] for t in texts]
        ids: dict[bytes, list[int]] = {}
        before, last = b"", []
        for m in sorted(set().union(*found)):
            whole = self.ranks.get(m)
            if whole is not None:
                ids[m] = [whole]
                continue
            same = 0
            for x, y in zip(before, m, strict=False):
                if x != y:
                    break
                same += 1
            before, last = m, self.extend(last[:same], m)
            ids[m] = self.read(last)
        return [ids[f[0]] if len(f) == 1 else [t for m in f for t in ids[m]] for f in found]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class Edited:
    """A piece under edits: keeps the last tokens of its prefixes."""

    def __init__(self, encoder: Encoder, data: bytes = b""):
        self.encoder, self.data = encoder, data
        self.last = encoder.extend([], data)

    def append(self, data: bytes) -> None:
        self.replace(len(self.data), len(self.data), data)

    def replace(self, begin: int, end: int, data: bytes) -> None:
        self.data = self.data[:begin] + data + self.data[end:]
        self.last = self.encoder.extend(self.last[:begin], self.data)

    def ids(self) -> list[int]:
        """As ``Encoder.piece`` gives them for the piece as it is now."""
        whole = self.encoder.ranks.get(self.data)
        return [whole] if whole is not None else self.encoder.read(self.last)


Encoded = tuple[int, str, bytes]
_workers: dict[tuple[str, str, int], tuple[Encoder, Known]] = {}


def _encoded(texts: list[str], path: str, pattern: str, kept: int = KEPT) -> Iterator[list[Encoded]]:
    """Of each text, piece by piece: number of ids, the ids as text, the decoded bytes."""
    if (path, pattern, kept) not in _workers:
        encoder = Encoder(ranks_from(path), pattern, min(KEPT_PAIRS, 10 * kept))
        _workers[path, pattern, kept] = encoder, Known(kept)
    encoder, known = _workers[path, pattern, kept]

    def learn(new: list[str]) -> dict[str, Encoded]:
        every = zip(new, encoder.encode_all(new), strict=True)
        return {p: (len(ids), " ".join(map(str, ids)), encoder.decode(ids)) for p, ids in every}

    for group in byte_batches(texts, GROUP_BYTES):
        cut = [pieces(t) for t in group]
        new = known.lacks(set().union(*cut))
        known.update(dict.fromkeys(filter(loose, new)))
        known.update(learn([p for p in new if p not in known]))
        for c, t in zip(cut, group, strict=True):
            parts = list(map(known.__getitem__, c))
            if None in parts:
                safe = safe_pieces(t)
                parts = list(map(learn(list(set(safe))).__getitem__, safe))
            yield [p for p in parts if p[0]]
        known.age()


def round_trip(
    docs: DataFrame, path: str, pattern: str, with_ids: bool = False, kept: int = KEPT
) -> DataFrame:
    """Encode every text, decode the ids, and give digests of both.

    A Python worker remembers ``kept`` pieces in either generation, also for its next task;
    with less than the default it forgets all at the end of a task, which frees its memory.

    Returns ``doc_id, n_tokens, ids_sha256, decoded_sha256`` and, if asked for, ``ids``. A
    null text counts as empty: no ids, and the digests of nothing. Rows are independent:
    repeated rows repeat, a null doc_id stays null, other columns are not read.
    """
    fields = [
        ("doc_id", pa.int64()),
        ("n_tokens", pa.int64()),
        ("ids_sha256", pa.string()),
        ("decoded_sha256", pa.string()),
    ]
    schema = pa.schema(fields + [("ids", pa.list_(pa.int32()))] * with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, GROUP_BYTES):
            text = pc.fill_null(b["text"].cast(pa.large_string()), "").to_pylist()
            n, ids, decoded, lists = [], [], [], []
            for parts in _encoded(text, path, pattern, kept):
                numbers = " ".join([p[1] for p in parts])
                n.append(sum([p[0] for p in parts]))
                ids.append(hashlib.sha256(numbers.encode()).hexdigest())
                decoded.append(hashlib.sha256(b"".join([p[2] for p in parts])).hexdigest())
                if with_ids:
                    lists.append(list(map(int, numbers.split())))
            columns = [b["doc_id"].cast(pa.int64()), pa.array(n, pa.int64())]
            columns += [pa.array(ids, pa.string()), pa.array(decoded, pa.string())]
            if with_ids:
                columns.append(pa.array(lists, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, schema=schema)
        if kept < KEPT:
            _workers.pop((path, pattern, kept), None)
            give_back()

    kinds = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(run, kinds + ", ids array<int>" * with_ids)
