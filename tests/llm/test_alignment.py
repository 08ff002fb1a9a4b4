"""Alignment against whole texts by both libraries, and all links one by one."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidevault.llm import token_alignment as align
from tidevault.llm.vocabularies import byte_alphabet

A, B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
PATTERN = public_tokenizers.PATTERN


def brute(docs):
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    alphabet = byte_alphabet()

    def of_b(i):
        piece = b.id_to_piece(i)
        byte = re.fullmatch("<0x(..)>", piece)
        return bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()

    every, holds = [], Counter()
    for doc, text in docs:
        groups = []
        if text:
            ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            bytes_a = [bytes(alphabet[c] for c in a.id_to_token(i)) for i in ids_a]
            bytes_b = [of_b(i) for i in ids_b]
            if b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
                ends = [np.cumsum(list(map(len, x))).tolist() for x in (bytes_a, bytes_b)]
                both = sorted(set(ends[0]) & set(ends[1]))
                begin = 0
                for end in both:
                    inside = [
                        [i for i, e in zip(ids, es, strict=True) if begin < e <= end]
                        for ids, es in zip((ids_a, ids_b), ends, strict=True)
                    ] if len(both) < 400 else None
                    groups.append(inside)
                    begin = end
                if groups and groups[0] is None:  # long texts: the same by walking along
                    groups, at = [], [0, 0]
                    for end in both:
                        inside = []
                        for s, ids in enumerate((ids_a, ids_b)):
                            stop = at[s]
                            while stop < len(ids) and ends[s][stop] <= end:
                                stop += 1
                            inside.append(ids[at[s] : stop])
                            at[s] = stop
                        groups.append(inside)
        links = Counter()
        for x, y in groups:
            cx, cy = Counter(x), Counter(y)
            for i in cx:
                for j in cy:
                    links[i, j] += cx[i] * cy[j]
        holds.update(links.keys())
        every.append((doc, groups, links))
    top = defaultdict(int)
    for (i, _), n in holds.items():
        top[i] = max(top[i], n)
    out = []
    for doc, groups, links in every:
        digest = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append(
            (
                doc,
                sum(len(x) for x, _ in groups),
                sum(len(y) for _, y in groups),
                len(groups),
                sum(links.values()),
                sum(n for p, n in links.items() if holds[p] == top[p[0]]),
                sum(n * holds[p] for p, n in links.items()),
                hashlib.sha256(digest.encode()).hexdigest() if groups else "",
            )
        )
    return sorted(map(repr, out))


def rows(df):
    return sorted(repr(tuple(r)) for r in df.collect())


MORE = [(70, " leading and trailing "), (71, "a  b   c"), (72, "under▁score"), (73, " "), (74, "tab\there\n\nnew")]
MORE += [(75, "<s> </s> <unk> <0x41> <|endoftext|>"), (76, "日本語のテキスト 漢字 🎉🎉 é é"), (77, "x")]
MORE += [(78, "a b　c d e"), (79, "\x00\x01 \x7f"), (80, "don't we'll 12345 3.14")]


def test_odd_rows_align_as_by_brute_force(spark, odd_docs, odd_rows):
    more = spark.createDataFrame(MORE, "doc_id long, text string")
    docs = odd_docs.unionByName(more, allowMissingColumns=True)
    got = align.alignment(docs, A, B, PATTERN)
    assert rows(got) == brute([(r[0], r[1]) for r in odd_rows] + MORE)


def test_real_documents_align_as_by_brute_force(real_docs):
    docs = [(r["doc_id"], r["text"]) for r in real_docs.collect()]
    assert rows(align.alignment(real_docs.repartition(4), A, B, PATTERN)) == brute(docs)


def test_several_slabs_are_one(odd_docs, monkeypatch):
    whole = rows(align.alignment(odd_docs, A, B, PATTERN))
    monkeypatch.setattr(align, "SLAB_BATCHES", 1)
    assert rows(align.alignment(odd_docs, A, B, PATTERN)) == whole


def test_an_empty_table_gives_no_rows(no_docs):
    assert align.alignment(no_docs, A, B, PATTERN).collect() == []


def test_whole_texts_give_what_their_parts_give():
    aligner = align.Aligner(A, B, PATTERN)
    assert aligner.parts
    texts = [t for _, t in MORE]
    parts, of = aligner.cut(texts)
    by_part = align.Aligned(aligner, parts)
    aligner.parts = False
    whole, one = aligner.cut(texts)
    by_text = align.Aligned(aligner, whole)
    for ids, own in zip(of, one, strict=True):
        exact = all(by_part.exact[i] for i in ids)
        assert exact == by_text.exact[own[0]]
        if exact:
            assert ";".join(by_part.texts[i] for i in ids) == by_text.texts[own[0]]
            for c in align.FACTS:
                assert sum(getattr(by_part, c)[i] for i in ids) == getattr(by_text, c)[own[0]]


@pytest.mark.parametrize("seed", range(4))
def test_bitmaps_keep_documents_and_multiplicities(seed):
    r = np.random.default_rng(seed)
    held = {}
    for pair in r.integers(0, 1 << 40, 60):
        docs = r.choice(4096, r.integers(1, 500), replace=False)
        held[int(pair)] = {int(d): int(n) for d, n in zip(docs, r.integers(1, 40, len(docs)), strict=True)}
    words = defaultdict(int)
    for pair, docs in held.items():
        for d, n in docs.items():
            for plane in range(n.bit_length()):
                if n >> plane & 1:
                    words[pair, d // 64 * align._PLANES + plane] |= 1 << d % 64
    keys = sorted(words)
    pair = np.array([k[0] for k in keys], np.uint64)
    place, word = np.array([k[1] for k in keys], np.uint16), np.array([words[k] for k in keys], np.uint64)
    pair, place, word = align.unpacked(align.packed(pair, place, word))
    found = dict(zip(*(c.tolist() for c in align.documents(pair, place, word)), strict=True))
    assert found == {p: len(d) for p, d in held.items()}
    values = np.stack([np.ones(len(pair), np.int64), (pair % np.uint64(97)).astype(np.int64)])
    links, total = align.scores(place, word, values)
    for doc in range(len(links)):
        assert links[doc] == sum(d.get(doc, 0) for d in held.values())
        assert total[doc] == sum(d.get(doc, 0) * (p % 97) for p, d in held.items())
