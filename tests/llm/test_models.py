import zlib

import numpy as np
import pytest
from conftest import *  # noqa: F403
from pyspark.sql import functions as F

from tidevault.llm import quality as quality_module
from tidevault.llm.quality import COST, descend, log_ratios, quality, train, vocabulary
from tidevault.llm.batches import (
    ENTRIES,
    fetch,
    fetched,
    numbered,
    packed_keys,
    packed_values,
    unpacked_keys,
    unpacked_values,
)
from tidevault.llm.toxicity import count_pairs, decent, events, toxicity

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def is_held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 0


@pytest.mark.parametrize(("score", "label", "least"), [(quality, "quality", 0.9), (toxicity, "toxic", 0.9)])
def test_held_out_accuracy(docs, labels, odd_docs, odd_rows, score, label, least):
    both = docs.select("doc_id", "text").union(odd_docs.select(F.col("doc_id") + 10**7, "text"))
    rows = score(both, labels).collect()
    assert len(rows) == docs.count() + len(odd_rows)
    truth = {r.doc_id: r[label] for r in labels.collect()}
    assert all(r.held_out == is_held_out(r.doc_id) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) >= least


@pytest.mark.parametrize(("score", "label"), [(quality, "quality"), (toxicity, "toxic")])
def test_only_rows_that_may_teach_do(spark, docs, labels, score, label):
    some = docs.where("doc_id < 300")
    turned = labels.withColumn(
        label, F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col(label)).otherwise(F.col(label))
    )
    odd = spark.createDataFrame([(None, 1, 1), (1, None, None), (2, 7, 7)], labels.schema)
    moved = some.withColumn("lang", F.lit("zz")).withColumn("y", F.lit(0))
    a = {r.doc_id: r.score for r in score(some, labels).collect()}
    b = {r.doc_id: r.score for r in score(moved, turned.where("doc_id not in (1, 2)").union(odd)).collect()}
    c = {r.doc_id: r.score for r in score(some, labels.where("doc_id not in (1, 2)")).collect()}
    assert b == c and set(a) == set(b)


@pytest.mark.parametrize("score", [quality, toxicity])
def test_without_rows_or_labels(odd_docs, odd_rows, no_docs, labels, score):
    assert score(no_docs, labels).count() == 0
    rows = score(odd_docs, labels.where("false")).collect()
    assert len(rows) == len(odd_rows) and len({round(r.score, 6) for r in rows}) == 1


def test_toxic_documents_go(docs, labels):
    bad = {r.doc_id for r in toxicity(docs, labels).collect() if r.predicted}
    kept = decent(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()} - bad


def test_descent_separates():
    r = np.random.default_rng(8)
    y = r.integers(0, 2, 200)
    rows = [np.unique(np.append(r.integers(2, 50, 8), c)).astype(np.int32) for c in y]
    ratio = np.full(50, 0.1)
    ratio[:2] = -2, 2
    w = descend(rows, y, ratio)
    margin = [w[x] @ ratio[x] + w[-1] for x in rows]
    assert np.mean((np.array(margin) > 0) == (y == 1)) == 1


def test_descent_ends_at_the_least_loss(monkeypatch):
    """Where the loss is least its slope is 0: the weights are what the violated margins pull."""
    monkeypatch.setattr(quality_module, "EPOCHS", 2000)
    r = np.random.default_rng(9)
    y = r.integers(0, 2, 40)
    rows = [np.unique(r.integers(0, 30, 8)).astype(np.int32) for _ in y]
    ratio = r.normal(size=30)
    w = descend(rows, y, ratio)
    x = np.zeros((40, 31))
    for i, f in enumerate(rows):
        x[i, f], x[i, -1] = ratio[f], 1
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    sign = np.where(y == 1, 1.0, -1.0)
    cost = COST / np.where(y == 1, y.mean(), 1 - y.mean())
    slack = np.maximum(0, 1 - sign * (x @ w))
    assert np.abs(w - (2 * cost * sign * slack) @ x).max() < 0.02


def plain_features(text):
    """Words, word pairs and byte trigrams as they are, without hashes."""
    t = (text or "").encode()
    words = t.translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))).split()
    pairs = set(zip(words, words[1:], strict=False))
    return set(words) | pairs | {(t[i : i + 3],) for i in range(len(t) - 2)}


def test_log_ratios_against_brute_force(spark, docs, odd_rows):
    """More than 2^18 features, counted over all rows though the sample has a part of them."""
    texts = [r.text for r in docs.select("text").collect()] + [t for _, t in odd_rows]
    rows = [(0, i, t, i % 3 % 2) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "one int, doc_id long, text string, y int").repartition(5)
    known = spark.sparkContext.broadcast(vocabulary(frame.where("doc_id % 4 <> 3")))
    ratio = log_ratios(frame, known, len(known.value))
    own = [plain_features(t) for t in texts]
    sampled = set().union(*(f for i, f in enumerate(own) if i % 4 != 3))
    assert len(known.value) == len(ratio) == len(sampled) > 1 << 18
    counts = {f: [1, 1] for f in sampled}
    for f, (*_, y) in zip(own, rows, strict=True):
        for x in f & sampled:
            counts[x][y] += 1
    total = np.array(list(counts.values())).sum(axis=0)
    want = {f: np.log(n[1] / total[1] * total[0] / n[0]) for f, n in counts.items()}
    for t, f in list(zip(texts, own, strict=True))[::25]:
        found, edges = known.value.features([b"", (t or "").encode()])
        assert edges[1] == 0 and len(set(found.tolist())) == len(found)
        np.testing.assert_allclose(np.sort(ratio[found]), np.sort([want[x] for x in f & sampled]), rtol=1e-4, atol=1e-5)


def test_a_sample_of_long_texts_is_smaller(spark, docs, labels, monkeypatch):
    monkeypatch.setattr(quality_module, "SAMPLE_BYTES", 60_000)
    known, ratio, w, _ = train(docs, labels)
    known, ratio, w = known.value, ratio.value, w.value
    assert 0 < len(known) < 60_000 * 2 and len(ratio) == len(known) == len(w) - 1
    assert quality(docs, labels).count() == docs.count()


def test_no_pairs_or_words_share_an_entry(spark):
    """More words and pairs than 2^18 and 2^20, each with the counts that it has by itself."""
    r = np.random.default_rng(5)
    texts = [" ".join(map(str, r.integers(0, 600_000, 4000))) for _ in range(330)]
    rows = [(t, i % 2) for i, t in enumerate(texts)]
    known, sums = count_pairs(spark.createDataFrame(rows, "text string, y int").repartition(4), [5, 3])
    pairs, words = {}, {}
    for t, y in rows:
        w = t.split()
        for p in set(zip(["", *w[:-1]], w, strict=True)):
            pairs.setdefault(p, [0, 0])[y] += 1
    for p, n in pairs.items():
        words.setdefault(p[1], [0, 0, 0])[2] += 1
        for c in (0, 1):
            words[p[1]][c] += n[c]
    got = {"pair": {}, "word": {}}
    for row in known.collect():
        keys = unpacked_keys(row.keys)
        kind = "pair" if row.part < 5 else "word"
        values = unpacked_values(row.vals, 2 if kind == "pair" else 7).T
        got[kind].update(zip(keys.tolist(), values.tolist(), strict=True))
    assert len(got["pair"]) == len(pairs) > 1 << 20 and len(words) > 1 << 18
    assert sums[0] == len(words) and sums[1] == len(pairs)
    for t, _ in rows[:20]:
        e, w = events([t.encode()]), t.split()
        for word, prior, h, k in zip(w, ["", *w[:-1]], e.word.tolist(), e.pair.tolist(), strict=True):
            assert got["pair"][k] == pairs[prior, word]
            n = got["word"][h]
            assert [n[0], n[1], n[6]] == words[word]


def test_entries_are_told_apart_by_all_bits(spark):
    """Keys that agree in their upper bits, and keys that the table has not."""
    table = np.array([5, 6, 1 << 40, (1 << 40) + 7, 1 << 63], np.uint64)
    values = np.arange(10).reshape(2, 5)
    known = spark.createDataFrame(
        [(0, None, packed_keys(table), packed_values(values))], ENTRIES
    )
    keys = np.array([4, 6, 1 << 40, (1 << 40) + 8, 1 << 62, 1 << 63], np.uint64)
    docs = spark.createDataFrame([("a",)], "text string").coalesce(1)
    answers = [(r.part, r["keys"], r.vals) for r in fetch(numbered(docs), known, lambda t: [keys], [1], [2]).collect()]
    (got,) = fetched(answers, [keys], [1], [2])
    assert got.tolist() == [[0, 1, 2, 0, 0, 4], [0, 6, 7, 0, 0, 9]]
