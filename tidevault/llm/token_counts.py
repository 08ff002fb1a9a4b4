"""Token counts: a tokenizer's batch encoding, of which only the lengths are kept.

Texts are split at safe boundaries: before a blank with no white space before it, or none
behind it. No match of the tokenizer's pattern and no
special string reaches over such a place, so the pieces' tokens add up to the text's. Equal
pieces are encoded once and their lengths kept for later; new pieces go to the library in
batches of equal bytes.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: White space as Unicode has it, which the tokenizer's pattern uses.
_WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_IS_WHITE = re.compile(f"[{_WHITE}]")
_SAFE = re.compile(f"(?<=[^{_WHITE}])(?= )")
_CUT = "\ud800"  # no text from UTF-8 has it
BATCH_BYTES = 256 << 10
KEPT = 250_000  # pieces that each of a worker's two generations remembers


def pieces(text: str) -> list[str]:
    """The text cut before every blank: safe unless a piece is ``loose``."""
    return text.replace(" ", _CUT + " ").split(_CUT)


def loose(piece: str) -> bool:
    """Whether a piece's blank is followed by white space, or by nothing."""
    return piece[:1] == " " and (len(piece) == 1 or bool(_IS_WHITE.match(piece, 1)))


def safe_pieces(text: str) -> list[str]:
    """The text cut at all its safe boundaries, whatever white space it has."""
    return _SAFE.split(text)


class Known(dict):
    """What is known of pieces. When there are too many, those not used since go."""

    def __init__(self, most: int):
        self.most, self.older = most, {}

    def lacks(self, keys: set[str]) -> set[str]:
        """The keys that are new, after those of the older generation are taken over."""
        new = keys.difference(self)
        old = new.intersection(self.older)
        self.update((k, self.older[k]) for k in old)
        return new - old

    def age(self) -> None:
        if len(self) > self.most:
            self.older = dict(self)
            self.clear()


def byte_batches(texts: list[str], limit: int = BATCH_BYTES) -> Iterator[list[str]]:
    """Consecutive texts of about equal bytes in UTF-8 together; a longer text is a batch of its own."""
    batch, size = [], 0
    for t in texts:
        n = len(t) if t.isascii() else len(t.encode())
        if batch and size + n > limit:
            yield batch
            batch, size = [], 0
        batch.append(t)
        size += n
    if batch:
        yield batch


def _loaded(path: str) -> Callable[[list[str]], list[int]]:
    """Lengths of texts by the library that the file belongs to."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()
    return lambda texts: [len(x) for x in model.encode_batch_fast(texts, add_special_tokens=False)]


_workers: dict[str, tuple[Callable, Known]] = {}


def lengths(texts: list[str], path: str, split: bool) -> list[int]:
    """Token counts of the texts."""
    if path not in _workers:
        _workers[path] = _loaded(path), Known(KEPT)
    encode, known = _workers[path]
    if not split:
        return [n for batch in byte_batches(texts) for n in encode(batch)]
    out = []
    for group in byte_batches(texts, 4 << 20):
        cut = [pieces(t) for t in group]
        new = known.lacks(set().union(*cut))
        known.update(dict.fromkeys(filter(loose, new)))
        new = [p for p in new if p not in known]
        for batch in byte_batches(new):
            known.update(zip(batch, encode(batch), strict=True))
        for c, t in zip(cut, group, strict=True):
            counts = list(map(known.__getitem__, c))
            if None in counts:
                counts = [n for batch in byte_batches(safe_pieces(t)) for n in encode(batch)]
            out.append(sum(counts))
        known.age()
    return out


def token_counts(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row.

    Counts are those of the whole text by the tokenizer in ``path``, without added special
    tokens; the library's default holds for special strings in texts. A null text counts as
    empty. Rows are independent: repeated rows repeat, a null doc_id stays null, other
    columns are not read. Splitting is for byte-level .json tokenizers; .model files get
    whole texts.
    """
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())]
    )
    split = path.endswith(".json")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = pc.fill_null(b["text"].cast(pa.large_string()), "")
            n = np.array(lengths(text.to_pylist(), path, split), np.int64)
            size = pc.cast(pc.binary_length(text), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"].cast(pa.int64()), size, pa.array(n), pa.array(n > limit)], schema=schema
            )

    return docs.select("doc_id", "text").mapInArrow(
        count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )
