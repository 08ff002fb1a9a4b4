import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from conftest import *  # noqa: F403

from tidevault.llm import substring_dedup, suffix_dedup
from tidevault.llm.batches import numbered
from tidevault.llm.decontaminate import Index, clean, find, leaks
from tidevault.llm.substring_dedup import groups_for, without_repeated_windows
from tidevault.llm.suffix_dedup import repeat_report, without_repeats
from tidevault.llm.words import words_of


def spans(flags):
    return sum(f and not b for f, b in zip(flags, [False, *flags], strict=False))


def bytes_gone(rows, length):
    seen = Counter()
    for _, t in rows:
        t = (t or "").encode()
        seen.update(t[k : k + length] for k in range(len(t) - length + 1))
    out = []
    for _, t in rows:
        t = (t or "").encode()
        flags = [False] * len(t)
        for k in range(len(t) - length + 1):
            if seen[t[k : k + length]] > 1:
                flags[k : k + length] = [True] * length
        out.append(flags)
    return out


def report(rows, length):
    out = []
    for (i, t), flags in zip(rows, bytes_gone(rows, length), strict=True):
        t = (t or "").encode()
        kept = bytes(b for b, f in zip(t, flags, strict=True) if not f)
        out.append((i, len(t), sum(flags), spans(flags), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.fixture(scope="module")
def short_rows(odd_rows):
    return [r for r in odd_rows if len(r[1] or "") < 20_000]


@pytest.mark.parametrize("length", [400, 64])
def test_repeats_against_brute_force(odd_docs, short_rows, length):
    docs = odd_docs.where("text is null or length(text) < 20000")
    got = map(tuple, repeat_report(docs, length).collect())
    assert multiset(got) == multiset(report(short_rows, length))  # noqa: F405


def test_repeats_of_real_rows_and_small_chunks(real_docs, monkeypatch):
    rows = [(r.doc_id, r.text) for r in real_docs.collect()]
    got = map(tuple, repeat_report(real_docs, 400).collect())
    assert multiset(got) == multiset(report(rows, 400))  # noqa: F405
    texts = [t.encode() for _, t in rows[:20]]
    whole = suffix_dedup.Anchored(texts, 400)
    monkeypatch.setattr(suffix_dedup, "CHUNK", 700)
    cut = suffix_dedup.Anchored(texts, 400)
    windows = lambda a: {(g, s) for g, x, y in zip(a.gram, a.first, a.last, strict=True) for s in range(x, y + 1)}
    assert windows(whole) == windows(cut)


def test_texts_without_repeats_are_valid(odd_docs, short_rows, no_docs):
    docs = odd_docs.where("text is null or length(text) < 20000")
    out = without_repeats(docs, 64)
    assert out.schema == docs.schema
    want = []
    for (i, t), flags in zip(short_rows, bytes_gone(short_rows, 64), strict=True):
        kept, at = "", 0
        for c in t or "":
            n = len(c.encode())
            kept += "" if all(flags[at : at + n]) else c
            at += n
        want.append((i, None if t is None else kept))
    assert multiset((r.doc_id, r.text) for r in out.collect()) == multiset(want)  # noqa: F405
    assert all(r.text is None or r.n_chars == len(r.text) for r in out.collect())
    assert repeat_report(no_docs).count() == 0 and without_repeats(no_docs).columns == no_docs.columns


def test_merging_sorted_runs_sorts():
    r = np.random.default_rng(6)
    strings = [bytes(r.integers(97, 99, r.integers(0, 40)).tolist()) for _ in range(300)]
    bucket = r.integers(0, 4, 300)
    order, common = suffix_dedup.refine(bucket, suffix_dedup._packed(strings, 40))
    padded = [s.ljust(40, b"\0") for s in strings]
    merged = [(int(bucket[i]), padded[i]) for i in order]
    assert merged == sorted(zip(bucket.tolist(), padded, strict=True))
    for at in range(1, 300):
        (a, x), (b, y) = merged[at - 1], merged[at]
        same = next((i for i in range(40) if x[i] != y[i]), 40)
        assert common[at] == (same if a == b else -1)


def windows_gone(rows, window):
    least = {}
    last = 1 << 62
    for i, t in rows:
        w = (t or "").encode().split()
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            least[key] = min(least.get(key, last), last if i is None else i)
    out = []
    for i, t in rows:
        w = (t or "").encode().split()
        flags = [False] * len(w)
        for k in range(len(w) - window + 1):
            if least[tuple(w[k : k + window])] < (last if i is None else i):
                flags[k : k + window] = [True] * window
        kept = b" ".join(x for x, f in zip(w, flags, strict=True) if not f)
        out.append((i, len(w), sum(flags), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("size", [1_500_000, 40])
def test_windows_against_brute_force(odd_docs, odd_rows, size, monkeypatch):
    monkeypatch.setattr(substring_dedup, "GROUP", size)
    monkeypatch.setattr(substring_dedup.groups_for, "__defaults__", (size,))
    got = map(tuple, without_repeated_windows(odd_docs, 13).collect())
    assert multiset(got) == multiset(windows_gone(odd_rows, 13))  # noqa: F405


def test_windows_of_real_rows(real_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in real_docs.collect()]
    out = without_repeated_windows(real_docs, 13, with_text=True)
    assert multiset(tuple(r)[:4] for r in out.collect()) == multiset(windows_gone(rows, 13))  # noqa: F405
    assert all(hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256 for r in out.collect())
    assert without_repeated_windows(no_docs).count() == 0


def test_frequent_prefixes_are_split_and_rare_ones_share():
    first, splits = groups_for(np.array([3, 4, 25, 0, 9, 2]), 10)
    assert splits.tolist() == [1, 1, 3, 1, 1, 1]
    assert first.tolist() == [0, 0, 1, 4, 4, 5]


def test_nodes_are_where_suffixes_begin_alike():
    r = np.random.default_rng(4)
    words = r.integers(0, 3, 2000).astype(np.uint32)
    starts = r.permutation(1990)[:1500]
    order, node = substring_dedup.deep_nodes(words, starts, 7)
    found = [tuple(words[starts[i] : starts[i] + 7].tolist()) for i in order]
    assert found == sorted(found)
    assert [node[i] == node[i - 1] for i in range(1, len(found))] == [
        found[i] == found[i - 1] for i in range(1, len(found))
    ]


def test_equal_windows_go_to_one_part_and_runs_hold_all_windows(odd_rows):
    texts = list({(t or "").encode() for _, t in odd_rows})
    own = substring_dedup.Windows(texts, 13)
    anchors = {}
    for h, at, anchor in zip(own.hashes.tolist(), own.at.tolist(), own.anchor.tolist(), strict=True):
        assert at <= anchor <= at + 11
        assert anchors.setdefault(h, anchor - at) == anchor - at
    for size in (1_500_000, 30):
        first, splits = groups_for(np.bincount(own.bucket, minlength=substring_dedup.BUCKETS), size)
        part, begin, n, _ = own.runs(first, splits, np.arange(len(texts)))
        sent = {}
        for p, b, m in zip(part.tolist(), begin.tolist(), n.tolist(), strict=True):
            assert own.text[b] == own.text[b + m - 1] and own.at[b + m - 1] == own.at[b] + m - 1
            for h in own.hashes[b : b + m].tolist():
                assert sent.setdefault(h, p) == p
        assert set(sent) == set(own.hashes.tolist())
        assert len(begin) < len(sent) / 2 or size == 30


@pytest.fixture(scope="module")
def items(spark):
    return spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")


def test_retrieval_misses_nothing(items, real_docs):
    """Block maxima and essential terms find all that scoring every pair finds."""
    rows = sorted((r[0], r[1].encode()) for r in items.collect())
    index = Index(rows, 0.35)
    texts = [r.text.encode() for r in real_docs.collect()]
    texts += [b" ".join(rows[3][1].split()[::2]), b" ".join(rows[5][1].split()[:9]), b""]
    words, edges = words_of([t.lower() for t in texts])
    key = np.unique(
        np.repeat(np.arange(len(texts)), np.diff(edges)) * len(index.terms) + index.term_ids(words)
    )
    ids = index.term_ids(words)
    text = np.repeat(np.arange(len(texts)), np.diff(edges))
    key = np.unique(text[ids >= 0] * len(index.terms) + ids[ids >= 0])
    got = {(p, i) for p, i, _ in index.retrieve(key % len(index.terms), key // len(index.terms), len(texts))}
    want = set()
    for p in range(len(texts)):
        mine = ids[edges[p] : edges[p + 1]]
        for i, (own, weight) in enumerate(zip(index.own, index.weights, strict=True)):
            if weight[np.isin(own, mine)].sum() >= 0.35:
                want.add((p, i))
    assert want and got == want


def test_leaks_are_found_and_clean_texts_kept(spark, items, odd_docs, no_docs):
    rows = sorted((r[0], r[1]) for r in items.collect())
    r = random.Random(2)
    filler = " ".join("".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(700))
    words = rows[0][1].split()
    mixed = words[:]
    r.shuffle(mixed)
    docs = [
        (1, filler + " " + rows[0][1] + " " + filler),
        (2, rows[1][1].upper() + "\n" + rows[2][1]),
        (3, filler),
        (4, filler[:500] + " " + " ".join(mixed)),  # its words, not its passages
        (5, filler[:900] + " " + " ".join(words[: len(words) // 2])),
        (6, None),
        (None, rows[3][1]),
    ]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    # A-Z is lowered, other letters are not: item 1 is compared in capitals as it stands.
    got = {(x.doc_id, x.item_id) for x in leaks(frame, items).collect()}
    assert {(1, 0), (2, 2), (None, 3)} <= got
    assert not {d for d, _ in got} & {3, 4, 5, 6}
    assert {x.doc_id for x in clean(frame, items).collect()} == {3, 4, 5, 6}
    assert leaks(odd_docs, items).count() == 0 and clean(odd_docs, items).columns == odd_docs.columns
    assert leaks(no_docs, items).count() == 0
    none = items.where("false")
    assert leaks(frame, none).count() == 0 and clean(frame, none).count() == len(docs)
    odd = spark.createDataFrame([(1, None), (None, "a b"), (2, ""), (3, "Ab"), (3, "Ab")], "item_id long, text string")
    found = leaks(spark.createDataFrame([(9, "x ab y")], "doc_id long, text string"), odd).collect()
    assert [(x.doc_id, x.item_id) for x in found] == [(9, 3)]


def test_several_indexes_are_one(items, real_docs, monkeypatch):
    from tidevault.llm import decontaminate

    want = multiset(leaks(real_docs, items).collect())
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", 4000)
    assert want and multiset(leaks(real_docs, items).collect()) == want
    found = {r.doc_id for r in leaks(real_docs, items).collect()}
    assert {r.doc_id for r in clean(real_docs, items).collect()} == {r.doc_id for r in real_docs.collect()} - found


def plain_leaks(docs, items, threshold, verify):
    """The rows by dictionaries of words, passage by passage and item by item."""
    cut = lambda t: [w.encode() for w in (t or "").lower().split()] if (t or "").isascii() else (t or "").encode().lower().split()
    own = [(i, cut(t)) for i, t in {(r.item_id, r.text) for r in items if r.item_id is not None and r.text}]
    own = [(i, w) for i, w in own if w]
    df = Counter(w for _, words in own for w in set(words))
    mean, longest = sum(len(w) for _, w in own) / len(own), max(len(w) for _, w in own)
    weights = []
    for _, words in own:
        w = {
            t: np.log(1 + (len(own) - df[t] + 0.5) / (df[t] + 0.5)) * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * len(words) / mean))
            for t, n in Counter(words).items()
        }
        weights.append({t: x / sum(w.values()) for t, x in w.items()})

    def shared(part, passage):
        k = min(3, len(part))
        runs = lambda x: [tuple(x[i : i + k]) for i in range(len(x) - k + 1)]
        return np.mean([r in set(runs(passage)) for r in runs(part)]) if k else 1.0

    out = []
    for d in docs:
        words, best = cut(d.text), {}
        for begin in range(0, max(1, len(words)), longest):
            passage = words[begin : begin + 2 * longest]
            there = set(passage)
            for (i, item), w in zip(own, weights, strict=True):
                score = sum(x for t, x in w.items() if t in there)
                if score >= threshold:
                    at = max(1, len(item) * 2 // 3)
                    q, a = shared(item[:at], passage), shared(item[at:], passage)
                    if q >= verify and a >= verify:
                        best.setdefault(i, []).append((round(score, 6), round(q, 6), round(a, 6), -begin))
        out += [(d.doc_id, i, *max(x)) for i, x in best.items()]
    return out


def test_leaks_against_brute_force(spark, real_docs, items):
    some = items.collect()
    r = random.Random(4)
    rows = [(d.doc_id, d.text) for d in real_docs.collect()]
    for i, item in enumerate(some[:30]):  # copies with words left out, some too many
        words = item.text.split()
        rows.append((10**6 + i, "x " * i + " ".join(w for w in words if r.random() > i / 90) + " y" * 300))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = leaks(docs, items).collect()
    got = [(x.doc_id, x.item_id, *(round(v, 6) for v in (x.score, x.question_overlap, x.answer_overlap)), -x.first_word) for x in got]
    want = plain_leaks(docs.collect(), some, 0.7, 0.5)
    assert sorted(got) == sorted(want) and 10 < len([x for x in got if x[0] >= 10**6]) < 30


def test_best_passage_of_a_long_text():
    index = Index([(4, b"red green blue white black grey")], 0.7)
    text = b"x " * 50 + b"red green blue white black grey " + b"y " * 50
    assert [(t, i, round(s, 6)) for t, i, s, *_ in find(index, [b"", text], 0.5)] == [(1, 4, 1.0)]


def test_strings_of_a_common_gram_part(spark, odd_docs, short_rows, monkeypatch):
    """A line that all share, in surroundings of their own or of few, does not meet in one part."""
    monkeypatch.setattr(suffix_dedup, "HOT", 20)
    r = random.Random(6)
    text = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    line, around = text(90), [text(80) for _ in range(4)]
    rows = [(i, f"{text(90)}{line}{text(90)}") for i in range(300)]
    rows += [(1000 + i, f"{text(50)}{around[i % 4]}{line}{around[i % 3]}{text(50)}") for i in range(60)]
    rows += [(2000 + i, text(100 * i)) for i in range(8)] + [(3000, line * 9), (3001, line * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    sent, merges = suffix_dedup.entries(numbered(docs), 100_000, 150)
    met, apart = Counter(), Counter()
    for row in sent.collect():
        grams = np.frombuffer(row.grams, np.uint64)
        if row.part < merges:
            met.update(grams.tolist())
        else:
            apart.update(map(tuple, grams.reshape(-1, 2).tolist()))
    assert max(met.values(), default=0) <= 20 and len(apart) > 1000
    got = map(tuple, repeat_report(docs, 150).collect())
    assert multiset(got) == multiset(report(rows, 150))  # noqa: F405
    monkeypatch.setattr(suffix_dedup, "HOT", 1)
    docs = odd_docs.where("text is null or length(text) < 20000")
    got = map(tuple, repeat_report(docs, 64).collect())
    assert multiset(got) == multiset(report(short_rows, 64))  # noqa: F405
