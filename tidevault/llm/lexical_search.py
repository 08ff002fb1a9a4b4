"""Ranked lexical search by best positions.

A shard of documents holds, for each term that is asked for, a list of its documents by
falling impact. A query goes down its lists by direct accesses to the first places not seen
yet; every document met there is looked up in all lists, and the places it has in them count as
seen. A list's best position is the last before which all places are seen. No document
that has not been met can score more than the impacts at the best positions together, so a
query stops when that is strictly below the score of the last rank.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidevault.llm.batches import sliced, texts_of
from tidevault.llm.components import written

BLOCK_BYTES = 8 << 20  # queries that are sent to the documents at a time
SHARD_DOCS = 16_384
SHARD_POSTINGS = 4_000_000
FIRST_STEP = 8  # places that are looked at first in each list; twice as many in each round
_SALTS = 64

# Digits, letters and all bytes of characters beyond ASCII make terms.
_TERM_BYTES = bytes(b for b in range(256) if b > 0x7F or chr(b).isalnum())
_TABLE = bytes(ord(chr(b).lower()) if b < 0x80 and b in _TERM_BYTES else b if b > 0x7F else 0x20 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in order; only A-Z are lower-cased."""
    return text.translate(_TABLE).split()


class Shard:
    """Impact lists of some documents, over the terms that are asked for."""

    def __init__(self, n_terms: int):
        self.n_terms = n_terms
        self.ids: list[int | None] = []
        self._terms, self._counts, self._lengths, self._postings = [], [], [], 0

    def add(self, doc_id: int | None, found: dict[int, int], length: int) -> None:
        """A document of so many terms, with the numbers of those that are asked for."""
        self.ids.append(doc_id)
        self._terms.append(np.fromiter(found, np.int64, len(found)))
        self._counts.append(np.fromiter(found.values(), np.int64, len(found)))
        self._lengths.append(length)
        self._postings += len(found)

    @property
    def full(self) -> bool:
        return len(self.ids) >= SHARD_DOCS or self._postings >= SHARD_POSTINGS

    def index(self, n_docs: int, total: int) -> None:
        """Order the lists. Document by document, a posting knows its place in its list."""
        self.sizes = np.fromiter(map(len, self._terms), np.int64, len(self._terms))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.term, count = np.concatenate(self._terms), np.concatenate(self._counts)
        # 64-bit whole numbers: the length against the mean one, then the term's share.
        scale = np.array([50 + (50 * n * n_docs) // total for n in self._lengths], np.int64)
        self.impact = 1_000_000_000 * count // (1000 * count + 20 * np.repeat(scale, self.sizes))
        order = np.lexsort((-self.impact, self.term))
        self.list_sizes = np.bincount(self.term, minlength=self.n_terms)
        self.list_starts = np.cumsum(self.list_sizes) - self.list_sizes
        self.doc_at = np.repeat(np.arange(len(self.ids)), self.sizes)[order]
        self.impact_at = self.impact[order]
        self.place = np.empty(len(order), np.int64)
        self.place[order] = np.arange(len(order)) - np.repeat(self.list_starts, self.list_sizes)
        self._terms, self._counts, self._lengths = [], [], []
        self._local = np.full(self.n_terms, -1)

    def best(self, asked: np.ndarray, weight: np.ndarray, k: int, top: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores among which are all that can still come into the first ``k``.

        ``top`` holds the best scores of other shards, at most ``k``.
        """
        here = (weight > 0) & (self.list_sizes[asked] > 0)
        asked, weight = asked[here], weight[here]
        sizes, starts = self.list_sizes[asked], self.list_starts[asked]
        base = np.cumsum(sizes) - sizes
        seen = np.zeros(int(sizes.sum()), bool)
        met = np.zeros(len(self.ids), bool)
        best = np.zeros(len(asked), np.int64)  # places up to here are all seen
        docs, scores, step = [], [], FIRST_STEP
        self._local[asked] = np.arange(len(asked))
        while (best < sizes).any():
            n = np.minimum(step, sizes - best)
            places = np.repeat(best - np.cumsum(n) + n, n) + np.arange(n.sum())
            lists = np.repeat(np.arange(len(asked)), n)
            places = places[~seen[base[lists] + places]] + starts[lists[~seen[base[lists] + places]]]
            new = np.unique(self.doc_at[places])
            new = new[~met[new]]
            met[new] = True
            score = self._look_up(new, weight, base, seen)
            docs.append(new)
            scores.append(score)
            top = np.concatenate((top, score))
            top = top[np.argpartition(top, len(top) - k)[len(top) - k :]] if len(top) > k else top
            for i in np.flatnonzero(best < sizes):
                rest = seen[base[i] + best[i] : base[i] + sizes[i]]
                first = int(rest.argmin())
                best[i] += first if not rest[first] else len(rest)
            at = starts + best - 1
            bound = int((weight * np.where(best < sizes, self.impact_at[at], 0)).sum())
            if len(top) == k and top.min() > bound:
                break
            step *= 2
        self._local[asked] = -1
        if not docs:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(docs), np.concatenate(scores)

    def _look_up(self, docs: np.ndarray, weight: np.ndarray, base: np.ndarray, seen: np.ndarray) -> np.ndarray:
        """Scores of the documents by direct accesses to all lists; marks their places."""
        n = self.sizes[docs]
        postings = np.repeat(self.starts[docs] - np.cumsum(n) + n, n) + np.arange(n.sum())
        lists = self._local[self.term[postings]]
        postings, owner = postings[lists >= 0], np.repeat(np.arange(len(docs)), n)[lists >= 0]
        lists = lists[lists >= 0]
        seen[base[lists] + self.place[postings]] = True
        score = np.zeros(len(docs), np.int64)
        np.add.at(score, owner, weight[lists] * self.impact[postings])
        return score


def _counted(docs: DataFrame) -> DataFrame:
    """``term, docs, total`` of each slice of texts; the empty term has documents and lengths."""
    schema = pa.schema([("term", pa.binary()), ("docs", pa.int64()), ("total", pa.int64())])

    def count(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for record in sliced(records):
            df, n_docs, total = Counter(), 0, 0
            for text in texts_of(record):
                words = terms(text)
                df.update(set(words))
                n_docs, total = n_docs + bool(words), total + len(words)
            found = [pa.array([b"", *df]), pa.array([n_docs, *df.values()]), pa.array([total] + [0] * len(df))]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(found, schema, strict=True)], schema=schema)

    return docs.select("text").mapInArrow(count, "term binary, docs long, total long")


def _asked(items: DataFrame, item: str) -> DataFrame:
    """``item, term`` of each item, once each."""
    schema = pa.schema([("item", pa.int64()), ("term", pa.binary())])

    def split(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for record in sliced(records):
            found = [sorted(set(terms(t))) for t in texts_of(record)]
            owners = np.repeat(record["item"].to_numpy(zero_copy_only=False), list(map(len, found)))
            each = pa.array([t for f in found for t in f], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(owners, pa.int64()), each], schema=schema)

    rows = items.where(F.col(item).isNotNull()).select(F.col(item).cast("long").alias("item"), "text")
    return rows.mapInArrow(split, "item long, term binary").distinct()


def _ranked(rows: DataFrame, by: list[Column], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 50, item: str = "item_id") -> DataFrame:
    """``item_id, rank, doc_id, score`` of the ``k`` documents that score most for each item.

    The score is a sum of whole numbers over the item's terms, once each: a weight that
    falls with the documents that hold the term (all documents count), times the term's
    share, which grows with its occurrences and falls with the document's length. Equal
    scores rank by doc_id; only scores above 0 are ranked.

    Null and empty texts have no terms: such documents count for nothing and such items get
    no rows. Rows of documents are ranked one by one, repeated ones too; those without doc_id come
    last among equals. Items of equal id are one item with the terms of all; those without
    id are left out. Other columns are not read. An empty table on either side gives no rows.

    Items are sent to the documents in blocks of bounded size, one pass and one written table
    each; a block is all that the driver holds. One item has to fit a block.
    """
    spark = docs.sparkSession
    asked = written(_asked(items, item), "search-asked")
    vocabulary = asked.select("term").union(spark.createDataFrame([(bytearray(),)], "term binary")).distinct()
    counted = _counted(docs).join(vocabulary, "term", "left_semi").groupBy("term")
    known = written(counted.agg(F.sum("docs").alias("docs"), F.sum("total").alias("total")), "search-terms")
    facts = known.where(F.octet_length("term") == 0).first()
    n_docs, total = (facts["docs"], facts["total"]) if facts else (0, 0)
    kinds = "item_id long, doc_id long, score long, task long"
    if not n_docs:
        return spark.createDataFrame([], kinds).selectExpr("item_id", "0 AS rank", "doc_id", "score")
    weight = F.floor(1000 * F.log(F.lit(float(2 * n_docs + 2)) / (2 * F.col("docs") + 1).cast("double")))
    weighted = asked.join(known, "term").select("item", "term", weight.cast("long").alias("weight"))
    size = weighted.agg(F.sum(F.octet_length("term") + 16)).first()[0] or 0
    n_blocks = math.ceil(2 * size / BLOCK_BYTES)
    results = None
    block_of = F.pmod(F.xxhash64("item"), F.lit(max(1, n_blocks)))
    for block in range(n_blocks):
        rows = weighted.where(block_of == block).toArrow()  # one block, of bounded size
        if not rows.num_rows:
            continue
        found = written(_search_block(docs, rows, k, n_docs, total, kinds), "search-found")
        results = found if results is None else results.union(found)
    if results is None:
        results = spark.createDataFrame([], kinds)
    # First among some tasks, then among all: no item's window grows with the tasks alone.
    some = _ranked(results, [F.col("item_id"), F.pmod("task", F.lit(_SALTS))], k).drop("rank", "task")
    return _ranked(some, [F.col("item_id")], k).select("item_id", "rank", "doc_id", "score")


def _search_block(docs: DataFrame, rows: pa.Table, k: int, n_docs: int, total: int, kinds: str) -> DataFrame:
    """The best of each task for each item of a block."""
    vocabulary = {t: i for i, t in enumerate(sorted(set(rows["term"].to_pylist())))}
    number = np.array([vocabulary[t] for t in rows["term"].to_pylist()], np.int64)
    owner, weight = rows["item"].to_numpy(), rows["weight"].to_numpy()
    order = np.argsort(owner, kind="stable")
    owner, number, weight = owner[order], number[order], weight[order]
    edges = np.flatnonzero(np.diff(owner, prepend=owner[0] - 1))
    items = list(zip(owner[edges].tolist(), np.split(number, edges[1:]), np.split(weight, edges[1:]), strict=True))
    schema = pa.schema([(c, pa.int64()) for c in ("item_id", "doc_id", "score", "task")])

    def find(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[np.ndarray, list]] = {}
        shard, task = Shard(len(vocabulary)), 0

        def look() -> None:
            nonlocal shard
            if shard.ids:
                shard.index(n_docs, total)
                for item, asked, weights in items:
                    scores, ids = best.get(item, (np.empty(0, np.int64), []))
                    more, more_scores = shard.best(asked, weights, k, scores)
                    best[item] = _first(scores, ids, more_scores, [shard.ids[d] for d in more.tolist()], k)
            shard = Shard(len(vocabulary))

        for record in sliced(records):
            task = record["task"][0].as_py()
            for doc, text in zip(record["doc_id"].cast(pa.int64()).to_pylist(), texts_of(record), strict=True):
                words = terms(text)
                counts = Counter(words)
                found = {vocabulary[t]: counts[t] for t in counts.keys() & vocabulary.keys()}
                if found:
                    shard.add(doc, found, len(words))
                    if shard.full:
                        look()
        look()
        for item, (scores, ids) in best.items():
            if len(ids):
                same = [[item] * len(ids), ids, scores, [task] * len(ids)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in same], schema=schema)

    located = docs.select("doc_id", "text", F.spark_partition_id().cast("long").alias("task"))
    return located.mapInArrow(find, kinds)


def _first(scores: np.ndarray, ids: list, more: np.ndarray, more_ids: list, k: int) -> tuple[np.ndarray, list]:
    """The first ``k`` by falling score, then rising id, then those without."""
    scores, ids = np.concatenate((scores, more)), [*ids, *more_ids]
    if len(scores) > k:
        least = scores[np.argpartition(scores, len(scores) - k)[len(scores) - k :]].min()
        keep = np.flatnonzero(scores >= max(1, least))
    else:
        keep = np.flatnonzero(scores > 0)
    keep = sorted(keep.tolist(), key=lambda i: (-scores[i], ids[i] is None, ids[i] or 0))[:k]
    return scores[keep], [ids[i] for i in keep]
