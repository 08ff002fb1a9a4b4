import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from conftest import *  # noqa: F403
from tokenizers import Tokenizer

from tidevault.llm import bpe, token_counts
from tidevault.llm.bpe import Edited, Encoder, ranks_from, round_trip

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def texts(odd_rows):
    r = random.Random(1)
    parts = [" ", "  ", "\n", " \n", "\t", "a", "bc", "don't", "12", "!?", "é", "日本", "\x1c", "　", "<|endoftext|>"]
    made = ["".join(r.choice(parts) for _ in range(r.randint(0, 30))) for _ in range(1500)]
    return made + [t or "" for _, t in odd_rows]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks_from(RANKS), special_tokens={}
    )


def test_lengths_are_the_library_s(texts):
    model = Tokenizer.from_file(JSON)
    want = [len(x) for x in model.encode_batch(texts, add_special_tokens=False)]
    assert token_counts.lengths(texts, JSON, True) == want


def test_counts_of_odd_rows(odd_docs, odd_rows, no_docs):
    model = Tokenizer.from_file(JSON)
    got = [tuple(r) for r in token_counts.token_counts(odd_docs, JSON, 512).collect()]
    want = []
    for i, t in odd_rows:
        n = len(model.encode(t or "", add_special_tokens=False))
        want.append((i, len((t or "").encode()), n, n > 512))
    assert multiset(got) == multiset(want)  # noqa: F405
    assert token_counts.token_counts(no_docs, JSON).count() == 0


def test_whole_texts_for_piece_models(odd_docs, odd_rows):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    got = [(r.doc_id, r.n_tokens) for r in token_counts.token_counts(odd_docs, path).collect()]
    assert multiset(got) == multiset((i, len(model.encode(t or ""))) for i, t in odd_rows)  # noqa: F405


def test_batches_are_balanced():
    texts = ["x" * n for n in (10, 50, 50, 200, 5, 5)]
    assert [len("".join(b)) for b in token_counts.byte_batches(texts, 100)] == [60, 50, 200, 10]
    wide = ["é" * 30, "日" * 15, "x" * 10]  # 60, 45 and 10 bytes
    assert [len(b) for b in token_counts.byte_batches(wide, 100)] == [1, 2]


def test_pairs_need_ranks_of_20_bits():
    with pytest.raises(ValueError, match="20 bits"):
        bpe.Encoder({b"a": 0, b"b": 1 << 20}, ".")


def test_ids_are_the_library_s(texts, library):
    got = list(bpe._encoded(texts, RANKS, public_tokenizers.PATTERN))
    for t, parts in zip(texts, got, strict=True):
        assert [int(i) for p in parts for i in p[1].split()] == library.encode_ordinary(t)
        assert b"".join(p[2] for p in parts) == t.encode()


def test_round_trip_of_odd_rows(odd_docs, odd_rows, no_docs, library):
    out = round_trip(odd_docs, RANKS, public_tokenizers.PATTERN, with_ids=True)
    want = []
    for i, t in odd_rows:
        ids = library.encode_ordinary(t or "")
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        want.append((i, len(ids), digest, hashlib.sha256((t or "").encode()).hexdigest(), ids))
    assert multiset(map(tuple, out.collect())) == multiset(want)  # noqa: F405
    assert round_trip(no_docs, RANKS, public_tokenizers.PATTERN).count() == 0


def test_appends_and_edits(library):
    r = random.Random(5)
    encoder = Encoder(ranks_from(RANKS), public_tokenizers.PATTERN)
    piece = Edited(encoder)
    for _ in range(60):
        word = "".join(r.choice("theinograbcé") for _ in range(r.randint(1, 6))).encode()
        if r.random() < 0.5:
            piece.append(word)
        else:
            a = r.randrange(len(piece.data) + 1)
            piece.replace(a, min(len(piece.data), a + r.randint(0, 4)), word)
        assert piece.ids() == library._core_bpe.encode_single_piece(piece.data)
