"""Tokenizer files as vocabularies of bytes, with encoders that give arrays of ids."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable

import numpy as np


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Visible Latin-1 characters stand for themselves; the other bytes, in order, for the
    characters from U+0100 on.
    """
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteLevel:
    """A byte-level BPE ``.json`` file.

    Where its merges make every longer entry, in the order of the ids, an entry's id is its
    rank, and the faster library of ranks encodes; it gives the same ids. Any other file is
    encoded by its own library. ``specials`` says whether special strings in a text become
    their tokens or are plain text.
    """

    def __init__(self, path: str, pattern: str, specials: bool):
        with open(path, encoding="utf-8") as file:
            about = json.load(file)
        alphabet = byte_alphabet()
        special = {t["content"]: t["id"] for t in about["added_tokens"]}
        vocab = {t: i for t, i in about["model"]["vocab"].items() if t not in special}
        ranks = {bytes(map(alphabet.__getitem__, t)): i for t, i in vocab.items()}
        self.bytes_of = {i: t for t, i in ranks.items()} | {i: t.encode() for t, i in special.items()}
        self.special = special if specials else {}
        merges = [m.split(" ") if isinstance(m, str) else m for m in about["model"]["merges"]]
        made = [vocab.get(a + b, -1) for a, b in merges]
        before = about["pre_tokenizer"] or {}
        by_rank = (
            made == sorted(set(vocab.values()) - {vocab[c] for c in alphabet})
            and about["normalizer"] is None
            and before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space")
        )
        #: Whether no token reaches from a visible character over a blank to the next one.
        self.parts_at_blanks = by_rank
        self.ids = self._by_ranks(ranks, pattern) if by_rank else self._by_library(path)

    def _by_ranks(self, ranks: dict[bytes, int], pattern: str) -> Callable[[str], np.ndarray]:
        import tiktoken

        model = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=self.special)
        if self.special:
            return lambda text: model.encode_to_numpy(text, allowed_special="all")
        return model.encode_ordinary

    def _by_library(self, path: str) -> Callable[[str], np.ndarray]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(path)
        model.no_truncation()
        model.no_padding()
        model.encode_special_tokens = not self.special
        return lambda text: np.array(model.encode(text, add_special_tokens=False).ids, np.uint32)


_BYTE = re.compile("<0x([0-9A-F]{2})>")
_META = "▁"  # stands for a blank in the pieces of a .model file


class Pieces:
    """A sentence-piece ``.model`` file that puts a blank before the text."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes_of = {}
        for i, name in enumerate(names):
            byte = _BYTE.fullmatch(name)
            self.bytes_of[i] = bytes.fromhex(byte[1]) if byte else name.replace(_META, " ").encode()
        about = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            about.ParseFromString(file.read())
        norm = about.normalizer_spec
        #: Whether no piece reaches over a blank, and texts are taken as they are.
        self.parts_at_blanks = (
            not any(re.search(f"[^{_META}]{_META}", n) for n in names)
            and not norm.precompiled_charsmap
            and norm.add_dummy_prefix
            and not norm.remove_extra_whitespaces
        )

    def all_ids(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1) if texts else []
