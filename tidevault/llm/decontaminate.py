"""Benchmark decontamination: training passages as BM25 queries on an index of test items.

The inverted index holds the test items. An item's term weights are divided by its own
score, so a passage that has all its words scores 1, and one threshold serves all items.
Every document is cut into overlapping passages, long enough that each copy of an item lies
whole in one of them. Retrieval is WAND with block maxima: items are kept in blocks; for
every block the largest weight of each term bounds what a passage can reach in it. An item's
common terms together stay below half the threshold, so only its other, essential terms
are followed, and blocks whose maxima keep the threshold out of reach are skipped, for all
passages of a batch at once. In a block that is left, the posting lists move by pivots: only an
item at which the lists before it could reach the threshold is scored. The
bounds are safe: everything above the threshold is found. What is found is verified by the
word runs of the item's first two thirds (question) and the rest (answer).

Document frequencies, the number of items, their mean and greatest length are taken by Spark
over all items, so that scores do not depend on how many indexes the items are split into.
Each index is built in a task; the driver passes one on at a time.
"""

from __future__ import annotations

import math
import pickle
from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidevault.llm.batches import sliced, texts_of
from tidevault.llm.components import written
from tidevault.llm.words import runs_in_texts, words_of

K1, B = 1.2, 0.75
BLOCK = 16
SHARD_BYTES = 8 << 20  # text of the test items in one index; more items make more indexes
RUN = 3  # words of a run in the verification


class Corpus(NamedTuple):
    """All test items with words: how many, their words together and those of the longest."""

    items: int
    words: int
    longest: int


class Index:
    """Test items, their normalised BM25 weights and the block maxima.

    ``corpus`` and ``df``, of each term's hash, are those of all items where these are but a part.
    """

    def __init__(
        self,
        items: list[tuple[int, bytes]],
        threshold: float,
        corpus: Corpus | None = None,
        df: dict[int, int] | None = None,
    ):
        words, edges = words_of([t.lower() for _, t in items])
        filled = np.flatnonzero(np.diff(edges))
        self.ids = np.array([items[i][0] for i in filled], np.int64)
        self.words = [words[edges[i] : edges[i + 1]] for i in filled]
        self.threshold = threshold
        n = len(self.words)
        lengths = [len(w) for w in self.words]
        corpus = corpus or Corpus(n, sum(lengths), max(lengths, default=1))
        self.longest = corpus.longest
        mean = corpus.words / max(1, corpus.items)
        self.terms = np.unique(np.concatenate(self.words)) if n else np.empty(0, np.uint64)
        counted = [np.unique(w, return_counts=True) for w in self.words]
        own = [np.searchsorted(self.terms, t) for t, _ in counted]
        if df is None:
            held = np.bincount(np.concatenate(own), minlength=len(self.terms)) if n else np.empty(0)
        else:
            held = np.array([df[t] for t in self.terms.tolist()], np.float64)
        idf = np.log(1 + (corpus.items - held + 0.5) / (held + 0.5))
        self.own, self.weights = own, []
        essential: list[np.ndarray] = []
        need = np.empty(n)
        for i, (_, tf) in enumerate(counted):
            w = idf[own[i]] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(self.words[i]) / mean))
            w = w / w.sum()
            order = np.argsort(w, kind="stable")
            common = order[np.cumsum(w[order]) <= threshold / 2]
            need[i] = threshold - w[common].sum() - 1e-9
            self.weights.append(w)
            essential.append(np.setdiff1d(np.arange(len(w)), common))
        # Postings of the essential terms by term and item.
        rows = sorted((int(own[i][j]) * n + i, self.weights[i][j]) for i in range(n) for j in essential[i])
        self.post = np.array([k for k, _ in rows], np.int64)
        self.post_weight = np.array([w for _, w in rows])
        # Block maxima of the essential terms, as (term, block, weight) sorted by term.
        best: dict[tuple[int, int], float] = {}
        for i in range(n):
            for j in essential[i]:
                key = int(own[i][j]), i // BLOCK
                best[key] = max(best.get(key, 0.0), self.weights[i][j])
        rows = sorted(best)
        self.post_term = np.array([t for t, _ in rows], np.int64)
        self.post_block = np.array([b for _, b in rows], np.int64)
        self.post_most = np.array([best[r] for r in rows])
        self.blocks = math.ceil(n / BLOCK)
        self.need = np.array([need[b * BLOCK : (b + 1) * BLOCK].min() for b in range(self.blocks)])
        self.first = np.searchsorted(self.post_term, np.arange(len(self.terms) + 1))

    def term_ids(self, words: np.ndarray) -> np.ndarray:
        """The index's number of each word, -1 for words that no item has."""
        if not len(self.terms):
            return np.full(len(words), -1)
        at = np.minimum(np.searchsorted(self.terms, words), len(self.terms) - 1)
        return np.where(self.terms[at] == words, at, -1)

    def pivots(self, terms: np.ndarray, block: int) -> Iterator[int]:
        """The items of a block at which the lists of a passage's terms could reach what is needed."""
        n = len(self.own)
        first, last = block * BLOCK, min(n, (block + 1) * BLOCK)
        begin, end = np.searchsorted(self.post, terms * n + first), np.searchsorted(self.post, terms * n + last)
        lists = []
        for t, a, z in zip(terms.tolist(), begin.tolist(), end.tolist(), strict=True):
            if a < z:
                lists.append([(self.post[a:z] - t * n).tolist(), 0, float(self.post_weight[a:z].max())])
        need = self.need[block]
        while lists:
            lists.sort(key=lambda x: x[0][x[1]])
            reach, pivot = 0.0, None
            for items, at, most in lists:
                reach += most
                if reach >= need:
                    pivot = items[at]
                    break
            if pivot is None:
                return
            if lists[0][0][lists[0][1]] == pivot:
                yield pivot
                pivot += 1
            for x in lists:  # lists behind the pivot skip to it, those at a scored one beyond it
                if x[0][x[1]] < pivot:
                    x[1] = bisect_left(x[0], pivot, x[1])
            lists = [x for x in lists if x[1] < len(x[0])]

    def retrieve(self, terms: np.ndarray, passage: np.ndarray, n: int) -> list[tuple[int, int, float]]:
        """(passage, item, score) of all pairs whose score reaches the threshold.

        ``terms`` are the distinct terms of the passages 0 to n, sorted by passage.
        """
        count = self.first[terms + 1] - self.first[terms]
        some = np.flatnonzero(count)
        if not len(some):
            return []
        count = count[some]
        start = self.first[terms[some]]
        post = np.repeat(start - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
        cell = np.repeat(passage[some], count) * self.blocks + self.post_block[post]
        cells, which = np.unique(cell, return_inverse=True)
        bound = np.bincount(which, self.post_most[post])
        edges = np.searchsorted(passage, np.arange(n + 1))
        out = []
        for c in cells[bound >= self.need[cells % self.blocks]]:
            p, block = int(c) // self.blocks, int(c) % self.blocks
            mine = terms[edges[p] : edges[p + 1]]
            for i in self.pivots(mine, block):
                score = float(self.weights[i][np.isin(self.own[i], mine)].sum())
                if score >= self.threshold - 1e-12:
                    out.append((p, i, score))
        return out


def _overlap(part: np.ndarray, passage: np.ndarray) -> float:
    """The share of a part's word runs that the passage has too."""
    k = min(RUN, len(part))
    if not k:
        return 1.0
    mine, _ = runs_in_texts(part, np.array([0, len(part)]), k)
    theirs, _ = runs_in_texts(passage, np.array([0, len(passage)]), k)
    return float(np.isin(mine, theirs).mean())


def find(index: Index, texts: list[bytes], verify: float) -> list[tuple[int, int, float, float, float, int]]:
    """(text, item, score, question and answer overlap, first word) of the best passage each."""
    if not len(index.ids):
        return []
    words, edges = words_of([t.lower() for t in texts])
    terms = index.term_ids(words)
    step = index.longest
    text = np.repeat(np.arange(len(texts)), np.diff(edges))
    inside = np.arange(len(words)) - edges[text]
    # Passages of two steps, one step apart: each word is in the one that begins with its
    # step and in the one before. The first passage has the number of its text's first step.
    steps = np.maximum(1, -(-np.diff(edges) // step))
    base = np.concatenate(([0], np.cumsum(steps)))
    own = base[text] + inside // step
    known = terms >= 0
    key = own[known] * len(index.terms) + terms[known]
    before = known & (inside >= step)
    key = np.unique(np.concatenate((key, (own[before] - 1) * len(index.terms) + terms[before])))
    best: dict[tuple[int, int], tuple] = {}
    for p, i, score in index.retrieve(key % len(index.terms), key // len(index.terms), int(base[-1])):
        t = int(np.searchsorted(base, p, side="right")) - 1
        begin = int(edges[t]) + (p - int(base[t])) * step
        passage = words[begin : min(begin + 2 * step, int(edges[t + 1]))]
        item = index.words[i]
        cut = max(1, len(item) * 2 // 3)
        question, answer = _overlap(item[:cut], passage), _overlap(item[cut:], passage)
        if question >= verify and answer >= verify:
            row = (score, question, answer, begin - int(edges[t]))
            best[t, i] = max(best.get((t, i), row), row, key=lambda r: (r[:3], -r[3]))
    return [(t, int(index.ids[i]), *row) for (t, i), row in sorted(best.items())]


def indexes(items: DataFrame, threshold: float) -> tuple[DataFrame, int]:
    """``shard, index``: indexes over all items, each of a bounded amount of text, and their number.

    Items without id or text are left out; of an id that comes twice each text counts.
    """
    items = items.where("item_id is not null and text is not null").select("item_id", "text").distinct()

    def terms_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            words, edges = words_of([t.lower() for t in texts_of(b)])
            each = [words[x:z] for x, z in zip(edges[:-1], edges[1:], strict=True)]
            terms = pa.array([np.unique(w).view(np.int64) for w in each], pa.list_(pa.int64()))
            columns = [b["item_id"].cast(pa.int64()), b["text"], pa.array([len(w) for w in each], pa.int64()), terms]
            yield pa.RecordBatch.from_arrays(columns, ["item_id", "text", "n", "terms"])

    kinds = "item_id long, text string, n long, terms array<long>"
    items = written(items.mapInArrow(terms_of, kinds).where("n > 0"), "items")
    totals = items.agg(F.count("n"), F.sum("n"), F.max("n"), F.sum(F.octet_length("text"))).first()
    corpus = Corpus(totals[0], totals[1] or 0, totals[2] or 1)
    shards = max(1, math.ceil(2 * (totals[3] or 0) / SHARD_BYTES))
    shard = F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)).alias("shard")
    held = items.select(shard, F.explode("terms").alias("term"))
    # Each shard gets the frequencies of its own terms, once.
    df = held.groupBy("term").agg(F.count("term").alias("df"), F.collect_set("shard").alias("shards"))
    df = df.select(F.explode("shards").alias("shard"), "term", "df")
    none = F.lit(None)
    rows = items.select(shard, "item_id", "text", none.cast("long").alias("term"), none.cast("long").alias("df"))
    rows = rows.unionByName(df.withColumns({"item_id": none.cast("long"), "text": none.cast("string")}))

    def build(table: pa.Table) -> pa.Table:
        is_item = table["term"].is_null().to_pylist()
        own, rest = table.filter(pa.array(is_item)), table.filter(pa.array([not x for x in is_item]))
        counts = dict(zip(rest["term"].to_numpy().view(np.uint64).tolist(), rest["df"].to_pylist(), strict=True))
        texts = sorted(zip(own["item_id"].to_pylist(), texts_of(own), strict=True))
        index = pickle.dumps(Index(texts, threshold, corpus, counts))
        return pa.table({"shard": table["shard"].slice(0, 1), "index": pa.array([index], pa.binary())})

    return written(rows.groupBy("shard").applyInArrow(build, "shard long, index binary"), "indexes"), shards


def _passed(items: DataFrame, threshold: float) -> Iterator[tuple[bytes, bool]]:
    """One index after the other, and whether it is the only one."""
    table, shards = indexes(items, threshold)
    for shard in range(shards):
        row = table.where(F.col("shard") == shard).first()
        yield row["index"] if row else pickle.dumps(Index([], threshold)), shards == 1


def leaks(docs: DataFrame, items: DataFrame, threshold: float = 0.7, verify: float = 0.5) -> DataFrame:
    """The test items that documents contain: one row per document row and item.

    Returns ``doc_id, item_id, score, question_overlap, answer_overlap, first_word``, the
    best passage of each pair. ``score`` is the BM25 score of the passage as a share of the
    item's own. Words are compared with A-Z lowered. Null and empty texts contain nothing,
    no items give no rows; repeated rows repeat, a null doc_id stays null; other columns are
    not read.
    """
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("item_id", pa.int64()),
            ("score", pa.float64()),
            ("question_overlap", pa.float64()),
            ("answer_overlap", pa.float64()),
            ("first_word", pa.int64()),
        ]
    )

    def search(packed: bytes):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = pickle.loads(packed)
            for b in sliced(batches):
                found = find(index, texts_of(b), verify)
                ids = b["doc_id"].to_pylist()
                rows = [(ids[t], *rest) for t, *rest in found]
                columns = list(zip(*rows, strict=True)) or [[]] * 6
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
                )

        return run

    out = None
    kinds = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double, first_word long"
    for packed, alone in _passed(items, threshold):
        found = docs.select("doc_id", "text").mapInArrow(search(packed), kinds)
        found = found if alone else written(found, "leaks")
        out = found if out is None else out.union(found)
    return out


def clean(docs: DataFrame, items: DataFrame, threshold: float = 0.7, verify: float = 0.5) -> DataFrame:
    """The documents that contain no test item, with all their columns."""

    def keep(packed: bytes):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = pickle.loads(packed)
            for b in sliced(batches):
                mask = np.ones(b.num_rows, bool)
                mask[[t for t, *_ in find(index, texts_of(b), verify)]] = False
                yield b.filter(pa.array(mask))

        return run

    schema = docs.schema
    for packed, alone in _passed(items, threshold):
        docs = docs.mapInArrow(keep(packed), schema)
        docs = docs if alone else written(docs, "clean")
    return docs

