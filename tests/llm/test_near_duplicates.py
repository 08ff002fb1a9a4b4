import os
import random
import re
from collections import Counter, defaultdict
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pytest
from conftest import *  # noqa: F403

from tidevault.llm import embeddings, ngram_join
from tidevault.llm.components import components
from tidevault.llm.embeddings import near_pairs, near_vectors
from tidevault.llm.ngram_join import Trie, bitmap, may_link, ngram_components, representatives


def roots(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text, k):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if len(w) < k:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def brute(rows, k, percent):
    """Per row: size of the set and the least id reachable; rows are told apart by place."""
    sets = [shingles(t, k) for _, t in rows]
    links = []
    for a in range(len(rows)):
        for b in range(a):
            i = len(sets[a] & sets[b])
            if i and 100 * i >= percent * len(sets[a] | sets[b]):
                links.append((a, b))
    groups = defaultdict(list)
    top = roots(range(len(rows)), links)
    for a, r in top.items():
        groups[r].append(a)
    out = []
    for a, (i, _) in enumerate(rows):
        ids = [rows[b][0] for b in groups[top[a]] if rows[b][0] is not None]
        out.append((i, len(sets[a]), min(ids, default=None)))
    return out


@pytest.mark.parametrize(("k", "percent"), [(4, 85), (5, 80)])
def test_odd_rows_against_brute_force(odd_docs, odd_rows, k, percent):
    got = [tuple(r) for r in ngram_components(odd_docs, k, percent).collect()]
    assert multiset(got) == multiset(brute(odd_rows, k, percent))  # noqa: F405


def test_real_rows_with_small_blocks(real_docs, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 3)
    rows = [(r.doc_id, r.text) for r in real_docs.collect()]
    got = [tuple(r) for r in ngram_components(real_docs, 4, 85).collect()]
    assert multiset(got) == multiset(brute(rows, 4, 85))  # noqa: F405


def test_chain_of_edits_without_a_centre(spark, monkeypatch):
    """Neighbours link, ends do not: the second round has to find what stars do not."""
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    r = random.Random(9)
    words = [f"w{i}" for i in range(120)]
    rows = []
    for i in r.sample(range(500), 40):
        rows.append((i, " ".join(words)))
        for _ in range(2):
            words[r.randrange(120)] = f"v{r.random()}"
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(x) for x in ngram_components(docs, 2, 80).collect()]
    assert multiset(got) == multiset(brute(rows, 2, 80))  # noqa: F405


def spied(monkeypatch):
    """Name and rows of the tables that the join writes, as it writes them."""
    tables, real = [], ngram_join.written

    def write(df, name):
        out = real(df, name)
        tables.append((name, out, out.count()))
        return out

    monkeypatch.setattr(ngram_join, "written", write)
    return tables


def test_sets_that_resemble_no_other_are_not_sent_to_the_second_round(spark, monkeypatch):
    """Texts of the same passages in other choices share rare n-grams, but are not alike."""
    r = random.Random(21)
    passages = [" ".join(f"w{r.randrange(10**6)}" for _ in range(25)) for _ in range(16)]
    texts = {" ".join(sorted(r.sample(passages, 5))) for _ in range(60)}
    rows = list(enumerate(sorted(texts)))
    tables = spied(monkeypatch)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(x) for x in ngram_components(docs, 4, 85).collect()]
    assert multiset(got) == multiset(brute(rows, 4, 85))  # noqa: F405
    assert len({c for *_, c in got}) == len(rows)
    sent = [n for name, _, n in tables if name == "trie-groups"]
    assert len(sent) == 2 and sent[1] == 0
    assert [n for name, _, n in tables if name == "map-groups"][0] > 100


@pytest.mark.parametrize("percent", [60, 80, 85])
def test_bitmaps_leave_no_member_out(percent):
    r = np.random.default_rng(percent)
    base = r.integers(0, 2**56, 150, dtype=np.uint64)
    sets = [np.sort(base[r.random(150) < p]) for p in (0.3, 0.45, 0.8, 0.85, 0.9, 1.0) for _ in range(8)]
    sets += [np.sort(r.integers(0, 2**56, n, dtype=np.uint64)) for n in (1, 63, 64, 65, 128, 129, 300)]
    n = np.array([len(s) + i % 5 for i, s in enumerate(sets)])  # some n-grams of its own
    component = np.array([i % 3 for i in range(len(sets))])
    rows = {"token": [7] * len(sets), "i": [0] * len(sets), "j": [0] * len(sets), "rep": range(len(sets))}
    rows |= {"component": component, "n": n, "shared": [len(s) for s in sets], "bits": [bitmap(s) for s in sets]}
    kept = set(may_link(pa.table({k: pa.array(v) for k, v in rows.items()}), percent)["rep"].to_pylist())
    common = lambda a, b: len(np.intersect1d(sets[a], sets[b]))
    pairs = [(a, b) for a in range(len(sets)) for b in range(a) if component[a] != component[b]]
    linked = {x for a, b in pairs if (100 + percent) * common(a, b) >= percent * (n[a] + n[b]) for x in (a, b)}
    assert len(linked) > 10 and linked <= kept
    if percent >= 80:  # bits tell strangers apart
        assert not kept & set(range(len(sets) - 7, len(sets)))


def test_texts_go_through_no_join_and_working_tables_go(real_docs, monkeypatch):
    tables = spied(monkeypatch)
    out = representatives(real_docs)
    paths = {name: table.inputFiles() for name, table, n in tables if n}
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert {f.rsplit("/", 2)[1].split("-")[0] for f in out.inputFiles()} == {"batches", "kept"}
    assert all(os.path.exists(urlparse(f).path) == (name == "kept") for name, files in paths.items() for f in files)
    assert out.count() > 10


def test_no_rows(no_docs):
    assert ngram_components(no_docs).count() == 0
    assert representatives(no_docs).columns == no_docs.columns


def test_one_row_of_each_group_stays(odd_docs, odd_rows):
    kept = representatives(odd_docs, 5, 80)
    assert kept.columns == odd_docs.columns
    got = Counter(r.doc_id for r in kept.collect())
    want = Counter()
    for (i, n, c), _ in zip(brute(odd_rows, 5, 80), odd_rows, strict=True):
        if i is None or not n:
            want[i] += 1
        elif i == c:
            want[i] = 1
    assert got == want


def test_trie_finds_what_pairs_do():
    r = np.random.default_rng(1)
    for _ in range(30):
        base = np.sort(r.choice(60, 25, replace=False))
        sets = [np.unique(np.append(r.choice(base, r.integers(0, 25)), r.integers(0, 60, 3))) for _ in range(30)]
        sets = [s.astype(np.uint64) for s in sets] + [np.empty(0, np.uint64)]
        sizes = np.array([len(s) + r.integers(0, 3) for s in sets])
        trie = Trie(sets, sizes)
        for i, s in enumerate(sets):
            want = []
            for j, t in enumerate(sets):
                o = len(np.intersect1d(s, t))
                if 100 * o >= 70 * (sizes[i] + sizes[j] - o):
                    want.append(j)
            assert sorted(trie.matches(s, int(sizes[i]), 70).tolist()) == want


def test_components(spark):
    r = random.Random(4)
    links = [(r.randrange(80), r.randrange(80)) for _ in range(50)] + [(i, i + 1) for i in range(100, 130)]
    got = {x.id: x.component for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert got == {n: c for n, c in roots(nodes, links).items()}


def vectors(rows):
    out = []
    for i, v, label in rows:
        usable = i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v)
        out.append(np.array(v, float) if usable and any(v) else None)
    return out


def test_vectors_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "TILE", 7)
    r = np.random.default_rng(2)
    rows = []
    for i in range(60):
        v = r.normal(size=8)
        for j in range(int(r.integers(1, 4))):
            w = v + r.normal(size=8) * r.choice([0.0, 0.1, 0.25])
            rows.append((100 * i + j, [float(np.float32(x)) for x in w], int(i % 3)))
    rows += [(7001, rows[0][1], 0), (7002, [2 * x for x in rows[0][1]], 0), (7003, rows[0][1], None)]
    rows += [(7004, None, 0), (7005, [], 0), (7006, [0.0] * 8, 0), (7007, [None] + [1.0] * 7, 0)]
    rows += [(7008, [float("nan")] * 8, 0), (7009, [1.0, 2.0], 0), (None, rows[0][1], 0), (7001, rows[0][1], 0)]
    frame = spark.createDataFrame(
        [(*x, 5) for x in rows], "vec_id long, embedding array<float>, label int, n_links int"
    )
    vs = vectors(rows)
    links = []
    for a, (_, _, label) in enumerate(rows):
        for b in range(a):
            if vs[a] is not None and vs[b] is not None and label == rows[b][2] and len(vs[a]) == len(vs[b]):
                if vs[a] @ vs[b] / np.sqrt((vs[a] @ vs[a]) * (vs[b] @ vs[b])) >= 0.93:
                    links.append((a, b))
    count = Counter(x for link in links for x in link)
    top = roots(range(len(rows)), links)
    least = {}
    for a, t in top.items():
        if rows[a][0] is not None:
            least[t] = min(least.get(t, 1 << 60), rows[a][0])
    want = []
    for a, (i, _, _) in enumerate(rows):
        c = least[top[a]] if i is not None else None
        want.append((i, count[a], c, None if i is None else c == i))
    got = [tuple(x) for x in near_vectors(frame, 0.93).collect()]
    assert multiset(got) == multiset(want)  # noqa: F405
    assert near_vectors(frame.where("false")).count() == 0


def test_bounds_leave_no_pair_out():
    r = np.random.default_rng(3)
    base = r.normal(size=(40, 64))
    x = np.concatenate([base + r.normal(size=base.shape) * s for s in (0, 0.1, 0.3, 0.37, 0.4, 0.45)])
    u = x / np.linalg.norm(x, axis=1)[:, None]
    want = {tuple(p) for p in np.argwhere(u @ u.T >= 0.93).tolist()}
    assert {tuple(p) for p in near_pairs(x, x, 0.93).tolist()} == want


def test_rows_of_one_id_or_none_link_by_their_own_texts(spark):
    """An id with two texts fuses nothing; a row without id bridges two documents."""
    r = random.Random(12)
    words = lambda n: [f"w{r.randrange(10**6)}" for _ in range(n)]
    a, b, c = words(60), words(60), words(60)
    edited = lambda t, n: " ".join(t[: len(t) - n] + words(n))
    a1, a2, bridge = " ".join(a), edited(a, 6), " ".join(c[4:])
    rows = [(5, a1), (5, " ".join(b)), (7, a2), (9, " ".join(b)), (5, ""), (5, None)]
    rows += [(20, " ".join(c)), (21, " ".join(c[8:])), (None, bridge), (None, " ".join(words(30)))]
    rows += [(30, a1), (30, " ".join(words(40))), (30, "x y z"), (31, "x y z"), (None, "x y z"), (5, a2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = [tuple(x) for x in ngram_components(docs, 2, 88).collect()]
    want = brute(rows, 2, 88)
    assert multiset(got) == multiset(want)  # noqa: F405
    apart = brute([rows[6], rows[7]], 2, 88)
    assert [w[2] for w in apart] == [20, 21] and (21, want[7][1], 20) in got
    kept = Counter(x.doc_id for x in representatives(docs, 2, 88).collect())
    # Of 5: three texts that are not alike and two without words.
    assert kept == Counter({5: 5, 20: 1, None: 3, 30: 2})


def test_very_small_and_very_large_vectors_link(spark):
    vectors = [[1e-200, 2e-200], [2e-200, 4e-200], [1e200, 2e200], [1.0, 2.0], [5e-324, 5e-324], [1e308, 1e308]]
    rows = [(i, 1, v) for i, v in enumerate(vectors)] + [(9, 1, [0.0, 0.0]), (10, 1, [1.0, float("inf")])]
    docs = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors(docs, 0.93).collect()}
    # (1, 2) and (1, 1) have a cosine of 0.949.
    assert got == {**{i: (5, 0) for i in range(6)}, 9: (0, 9), 10: (0, 10)}
