"""Packed sequences against the tokenizer's library and the rules of the packing."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidevault.llm.packing import BestFit, cut, packed
from tidevault.llm.vocabularies import ByteLevel

PATH = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN


def ids_of(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [0]


def check(rows, docs, capacity):
    want = []
    for doc, text in docs:
        ids = np.array(ids_of(text), "<u4")
        first = len(ids) % capacity or capacity
        edges = [0, *range(first, len(ids) + 1, capacity)] if len(ids) > capacity else [0, len(ids)]
        for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
            want.append((doc, i, a, b - a, zlib.crc32(ids[a:b].tobytes())))
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)[:5]) for r in rows)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), -(-sum(w[3] for w in want) // capacity)


@pytest.mark.parametrize("capacity", [64, 2048])
def test_odd_rows_are_packed_whole(odd_docs, odd_rows, capacity):
    rows = packed(odd_docs, PATH, PATTERN, capacity).collect()
    n, least = check(rows, [(r[0], r[1]) for r in odd_rows], capacity)
    assert n <= least * 1.05 + 1


def test_few_open_sequences_still_hold_every_piece(odd_docs, odd_rows):
    rows = packed(odd_docs.repartition(7), PATH, PATTERN, 256, most=2).collect()
    check(rows, [(r[0], r[1]) for r in odd_rows], 256)


def test_real_documents_take_hardly_more_than_they_have_to(real_docs):
    rows = packed(real_docs.repartition(5), PATH, PATTERN).collect()
    docs = [(r["doc_id"], r["text"]) for r in real_docs.collect()]
    n, least = check(rows, docs, 2048)
    assert n <= least + 1


def test_an_empty_table_gives_no_rows(no_docs):
    assert packed(no_docs, PATH, PATTERN).collect() == []


def test_cuts():
    assert cut(5, 4) == [(0, 1), (1, 4)]
    assert cut(8, 4) == [(0, 4), (4, 4)]
    assert cut(3, 4) == [(0, 3)]
    assert cut(9, 4) == [(0, 1), (1, 4), (5, 4)]


def test_best_fit_takes_the_least_space_and_closes_the_fullest():
    fit = BestFit(10, most=2)
    out = []
    for at, length in enumerate([6, 8, 2]):  # free 4, free 2, then the 2 fits exactly
        out += fit.add(at, length)
    assert out == [(1, 1, 0), (2, 1, 8)]
    out = list(fit.add(3, 7))
    assert out == []  # free 4 and free 3 are open
    assert list(fit.add(4, 9)) == [(4, 2 + 1, 0)]  # a third is one too many: the fullest goes
    assert sorted(fit.left()) == [0, 3]
    assert [p[0] for p in fit.close(3)] == [3]
    assert [p[0] for p in fit.close(10)] == [0]


@pytest.mark.parametrize("seed", range(5))
def test_against_a_list_of_open_sequences(seed):
    r = random.Random(seed)
    fit, open_, most = BestFit(50, most=4), [], 4
    closed = 0
    for at in range(400):
        length = r.randint(1, 50)
        got = list(fit.add(at, length))
        fits = [f for f in open_ if f >= length]
        free = min(fits) if fits else 50
        if fits:
            open_.remove(free)
        if free > length:
            open_.append(free - length)
        if len(open_) > most:
            open_.remove(min(open_))
        closed += bool(got)
        assert fit.open == len(open_)
        assert fit.bits == sum({1 << f for f in open_})
        assert sum(map(len, fit.of)) == fit.open
    assert closed


def test_ranks_give_the_ids_of_the_library(real_docs, odd_rows):
    model = ByteLevel(PATH, PATTERN, specials=True)
    plain = ByteLevel(PATH, PATTERN, specials=False)
    library = Tokenizer.from_file(PATH)
    bare = Tokenizer.from_file(PATH)
    bare.encode_special_tokens = True
    assert model.parts_at_blanks
    texts = [r["text"] for r in real_docs.limit(60).collect()] + [r[1] for r in odd_rows]
    for t in filter(None, texts):
        assert list(model.ids(t)) == library.encode(t, add_special_tokens=False).ids
        assert list(plain.ids(t)) == bare.encode(t, add_special_tokens=False).ids


def test_another_file_is_encoded_by_its_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    model = ByteLevel.__new__(ByteLevel)
    model.special = {}
    library = Tokenizer.from_file(path)
    text = "It's <b>12</b> Äpfel"
    assert list(model._by_library(path)(text)) == library.encode(text, add_special_tokens=False).ids
