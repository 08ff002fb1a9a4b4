"""Lexical search against all scores of all documents."""

import math
import random
import re

import numpy as np
import pytest

from tidevault.llm.lexical_search import Shard, search, terms

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def plain_terms(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lower)


def brute(docs, items, k):
    counted = [(d, plain_terms(t)) for d, t in docs]
    held = [(d, w, set(w)) for d, w in counted if w]
    n_docs, total = len(held), sum(len(w) for _, w, _ in held)
    asked = {}
    for item, text in items:
        if item is not None:
            asked.setdefault(item, set()).update(plain_terms(text))
    out = []
    for item, words in asked.items():
        scored = []
        df = {t: sum(t in s for _, _, s in held) for t in words}
        weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in words}
        for d, w, s in held:
            m = 50 + (50 * len(w) * n_docs) // total
            tf = {t: w.count(t) for t in words & s}
            score = sum(weight[t] * ((1000000000 * c) // (1000 * c + 20 * m)) for t, c in tf.items())
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return sorted(map(repr, out))


def rows(df):
    return sorted(repr(tuple(r)) for r in df.select("item_id", "rank", "doc_id", "score").collect())


def test_terms_are_those_of_the_pattern():
    text = "Ärger ÉTÉ it's a_b 12-34 \x00x\x7fy ÀB İI <|x|> 日本語　z\xa0w\x1cv"
    assert [t.decode() for t in terms(text.encode())] == plain_terms(text)
    every = "".join(map(chr, range(0x300)))
    assert [t.decode() for t in terms(every.encode())] == plain_terms(every)


ITEMS = [(1, "a b c d one"), (2, None), (3, ""), (4, "nowhere to be found xyzzy"), (5, "One two WORDS word word")]
ITEMS += [(5, "é ß one"), (None, "one two"), (6, "x word")]


@pytest.mark.parametrize("k", [1, 3, 50])
def test_all_odd_rows_rank_as_by_brute_force(spark, odd_docs, odd_rows, k):
    long = " ".join(odd_rows[-4][1].split()[:200]) if odd_rows[-4][1] else "one"
    asked = [*ITEMS, (7, long), (8, odd_rows[7][1])]
    items = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in asked], "item_id long, text string, term string, rank int, task int")
    got = search(odd_docs, items, k)
    assert rows(got) == brute([(r[0], r[1]) for r in odd_rows], asked, k)
    assert got.schema.simpleString() == "struct<item_id:bigint,rank:int,doc_id:bigint,score:bigint>"


def test_several_blocks_of_items_are_one(spark, odd_docs, monkeypatch):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    whole = rows(search(odd_docs, items, 4))
    monkeypatch.setattr("tidevault.llm.lexical_search.BLOCK_BYTES", 64)
    assert rows(search(odd_docs, items, 4)) == whole


def test_empty_tables_give_no_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert search(no_docs, items).collect() == []
    assert search(odd_docs, items.where("false")).collect() == []
    assert search(no_docs, items).schema == search(odd_docs, items).schema


def _shard(n, n_terms, seed):
    r = random.Random(seed)
    shard, docs = Shard(n_terms), []
    for d in range(n):
        found = {t: r.choice([1, 1, 1, 2, 9]) for t in range(n_terms) if r.random() < 1 / (1 + t)}
        length = sum(found.values()) + r.choice([0, 5, 300])
        if found:
            shard.add(d, found, length)
            docs.append((found, length))
    total = sum(n for _, n in docs)
    shard.index(len(docs), total)
    return shard, docs, total


def _score(doc, weights, n_docs, total):
    found, n = doc
    m = 50 + (50 * n * n_docs) // total
    return sum(w * ((1000000000 * found[t]) // (1000 * found[t] + 20 * m)) for t, w in weights.items() if t in found)


@pytest.mark.parametrize("step", [1, 8, 1000])
def test_a_query_stops_early_and_leaves_nothing_out(monkeypatch, step):
    monkeypatch.setattr("tidevault.llm.lexical_search.FIRST_STEP", step)
    least = 1 << 30
    for seed in range(12):
        shard, docs, total = _shard(600, 12, seed)
        weights = {0: 3, 4: 900, 7: 2500, 11: 0, 9: 1800}
        asked, weight = np.array(list(weights)), np.array(list(weights.values()))
        found, score = shard.best(asked, weight, 5, np.empty(0, np.int64))
        every = sorted((-_score(d, weights, len(docs), total), i) for i, d in enumerate(docs))
        got = sorted(zip((-score).tolist(), found.tolist(), strict=True))
        assert got[:5] == every[:5]
        # Whoever was left out scores strictly less than the fifth.
        assert all(-s < -got[4][0] for s, i in every if i not in set(found.tolist()))
        least = min(least, len(found))
        # A shard that cannot better what is known is left at once.
        few, _ = shard.best(asked, weight, 5, np.full(5, 1 << 50))
        assert len(few) <= len(found)
    assert least < 500 or step > 600  # such a step meets all at once


def test_what_was_found_before_bounds_the_next_shard():
    shard, docs, total = _shard(600, 12, 1)
    asked, weight = np.array([4, 7, 9]), np.array([900, 2500, 1800])
    alone = shard.best(asked, weight, 5, np.empty(0, np.int64))
    high = shard.best(asked, weight, 5, np.full(5, 1 << 50))
    assert len(high[0]) < len(alone[0])
