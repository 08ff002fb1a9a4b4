"""Toxicity by two class-conditional Kneser-Ney bigram models.

Counts are of documents that hold a word or pair of words, over all labelled rows that may
teach. Each class discounts its own counts of words; what is left over goes to one backoff
for both, the number of different words that precede a word in either class. Pairs back off
to the pairs of both classes, tilted by the class's share of the word. A
rare expression so gets about the same probability from both models, and only expressions
that one class uses more often tell them apart. A text is compared by the difference of
log-likelihoods per word, over the whole and over its worst runs of words; a logistic
regression on these, fitted on a bounded sample, makes a probability of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidevault.llm.batches import (
    ENTRIES,
    cut,
    fetch,
    fetched,
    give_back,
    meet,
    numbered,
    packed_keys,
    packed_values,
    part_of,
    parts_for,
    rounds,
    sliced,
    text_bytes,
    texts_of,
    unpacked_keys,
    unpacked_values,
)
from tidevault.llm.components import noting, remove, written
from tidevault.llm.labelled import chance, held_out, logistic, taught
from tidevault.llm.words import mix, words_of

DISCOUNT = 0.75
RUNS = (1, 4, 16)  # words of a run
PAIR_BYTES, WORD_BYTES = 8, 50  # text for each different pair and word of a batch, about
LEAST_PARTS = 16
PART_ENTRIES = 1_000_000  # at most about so many pairs or words of a part
SLICE_BYTES = 1 << 20  # text that is counted at a time
PIECE = 1 << 17  # words of the texts whose differences are taken at a time
HELD_PAIRS = 500_000  # counted pairs that a task gathers before it sends them
#: Marks end words: ASCII punctuation becomes blanks.
_PLAIN = bytes(
    32 if chr(i) in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" else i for i in range(256)
)


@dataclass
class Events:
    """Words of some texts with the word before each; the first follows a mark of its own."""

    text: np.ndarray
    edges: np.ndarray
    word: np.ndarray
    prior: np.ndarray
    pair: np.ndarray


def events(texts: list[bytes]) -> Events:
    """Words, words before and pairs of them by 64-bit hashes."""
    words, edges = words_of([t.translate(_PLAIN).lower() for t in texts])
    prior = np.empty_like(words)
    prior[1:] = words[:-1]
    prior[edges[:-1][np.diff(edges) > 0]] = 0
    text = np.repeat(np.arange(len(texts)), np.diff(edges))
    return Events(text, edges, words, prior, _pair(prior, words))


def _pair(prior: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(word + mix(prior ^ np.uint64(0xA0761D6478BD642F)))


def _distinct(e: Events) -> np.ndarray:
    """Places of the first of each different pair of each text."""
    order = np.lexsort((e.pair, e.text))
    new = np.ones(len(order), bool)
    new[1:] = (e.pair[order][1:] != e.pair[order][:-1]) | (e.text[order][1:] != e.text[order][:-1])
    return order[new]


def _summed(prior: np.ndarray, word: np.ndarray, counts: np.ndarray):
    """Different pairs in order, their words, and the sums of their counts in either class."""
    pair, first, which = np.unique(_pair(prior, word), return_index=True, return_inverse=True)
    return pair, prior[first], word[first], np.stack([np.bincount(which, c, len(pair)) for c in counts])


def _counted(texts: list[bytes], y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different pairs of words with the number of texts of either class that hold them."""
    e = events(texts)
    at = _distinct(e)
    own = y[e.text[at]]
    return _summed(e.prior[at], e.word[at], np.stack([own == 0, own == 1]))[1:]


_SENT = pa.schema([("part", pa.int64())] + [(c, pa.binary()) for c in ("words", "places", "counts")])
_ENTRIES = ENTRIES + ", sums array<double>"
_WORD = ("word0", "word1", "prior0", "prior1", "next0", "next1", "before")
_COLUMNS = [2, len(_WORD)]  # of the pairs' table and of the words'


def _entry(part: int, keys: np.ndarray, values: np.ndarray, sums: list[float] | None = None) -> dict:
    return {"part": part, "batch": None, "keys": packed_keys(keys), "vals": packed_values(values), "sums": sums}


def _entries(rows: list[dict]) -> pa.Table:
    kinds = [("part", pa.int64()), ("batch", pa.int64()), ("keys", pa.binary()), ("vals", pa.binary())]
    return pa.Table.from_pylist(rows, pa.schema([*kinds, ("sums", pa.list_(pa.float64()))]))


def _tallied(parts: list[int]):
    """The pairs of a part, summed, and what they add to their words' counts."""

    def run(rows: pa.Table) -> pa.Table:
        give_back()
        prior, word = [], []
        for words, places in zip(rows["words"].to_pylist(), rows["places"].to_pylist(), strict=True):
            words, places = unpacked_keys(words), unpacked_values(places, 2)
            prior.append(words[np.cumsum(places[0])])
            word.append(words[places[1]])
        prior, word = np.concatenate(prior), np.concatenate(word)
        counts = [unpacked_values(b, 2) for b in rows["counts"].to_pylist()]
        pair, prior, word, counts = _summed(prior, word, np.concatenate(counts, axis=1))
        out = [_entry(rows["part"][0].as_py(), pair, counts)]
        keys, which = np.unique(np.concatenate((word, prior)), return_inverse=True)
        word, prior = np.split(which, 2)
        sums = [(word, counts[0]), (word, counts[1]), (prior, counts[0]), (prior, counts[1])]
        sums += [(prior, counts[0] > 0), (prior, counts[1] > 0), (word, None)]
        values = np.stack([np.bincount(of, n, len(keys)) for of, n in sums])
        out += [_entry(parts[0] + part, keys[a:b], values[:, a:b]) for part, a, b in cut(keys, parts[1])]
        return _entries(out)

    return run


def _of_words(rows: pa.Table) -> pa.Table:
    """The words of a part with their counts from all pairs, and figures of the part."""
    blobs = [unpacked_keys(b) for b in rows["keys"].to_pylist()]
    values = [unpacked_values(b, len(_WORD)) for b in rows["vals"].to_pylist()]
    keys, which = np.unique(np.concatenate(blobs), return_inverse=True)
    values = np.concatenate(values, axis=1)
    values = np.stack([np.bincount(which, v, len(keys)) for v in values])
    before = values[_WORD.index("before")]
    sums = [float((before > 0).sum()), float(before.sum())]
    for n in values[:2]:
        sums += [float(n.sum()), *(float((n == k).sum()) for k in (1, 2, 3, 4)), float((n >= 3).sum())]
    return _entries([_entry(rows["part"][0].as_py(), keys, values, sums)])


def count_pairs(rows: DataFrame, parts: list[int]) -> tuple[DataFrame, np.ndarray]:
    """All pairs and all words of the rows ``text, y`` with their counts, and sums of these.

    The tables are written to the working folder, a row for each part of the pairs and then
    of the words (``batches.fetch``), so that they grow with the rows.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def packed() -> pa.RecordBatch:
            joined = (np.concatenate([h[i] for h in held], axis=-1) for i in range(3))
            pair, prior, word, counts = _summed(*joined)
            part = part_of(pair, parts[0])
            order = np.lexsort((prior, part))
            edges = np.searchsorted(part[order], np.arange(parts[0] + 1))
            out = {name: [] for name in _SENT.names}
            for i, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                if a < b:
                    mine = order[a:b]
                    out["part"].append(i)
                    words, at = np.unique(np.concatenate((prior[mine], word[mine])), return_inverse=True)
                    at = at.reshape(2, -1)
                    at[0] = np.diff(at[0], prepend=0)
                    out["words"].append(packed_keys(words))
                    out["places"].append(packed_values(at))
                    out["counts"].append(packed_values(counts[:, mine]))
            return pa.RecordBatch.from_pydict(out, _SENT)

        for b in sliced(batches, SLICE_BYTES):
            held.append(_counted(texts_of(b), b["y"].to_numpy()))
            size += len(held[-1][0])
            if size > HELD_PAIRS:
                yield packed()
                held, size = [], 0
        if size:
            yield packed()
        held.clear()
        give_back()

    counted = (
        rows.mapInArrow(send, "part long, words binary, places binary, counts binary")
        .groupBy("part")
        .applyInArrow(_tallied(parts), _ENTRIES)
    )
    with noting() as paths:
        counted = written(counted, "toxicity-counts")
    words = counted.where(F.col("part") >= parts[0]).groupBy("part").applyInArrow(_of_words, _ENTRIES)
    words = written(words, "toxicity-words")
    sums = words.agg(*(F.sum(F.col("sums")[i]) for i in range(2 + 2 * 6))).first()
    pairs = written(counted.where(F.col("part") < parts[0]), "toxicity-pairs")
    remove(rows.sparkSession, paths)  # with each part's share of the words
    return pairs.unionByName(words).drop("sums"), np.array([s or 0.0 for s in sums])


def _within(text: np.ndarray, of: np.ndarray, at: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Of each event, the weights of its text's distinct pairs with the same ``of``."""
    order = np.lexsort((of, text))
    new = np.ones(len(order), bool)
    new[1:] = (of[order][1:] != of[order][:-1]) | (text[order][1:] != text[order][:-1])
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    return np.bincount(group[at], weight)[group] if len(at) else np.zeros(0)


def _discounts(kinds: np.ndarray) -> np.ndarray:
    """Discounts of counts of 0, 1, 2 and more, from how many counts there are of 1 to 4."""
    n = np.maximum(kinds, 1.0)
    y = n[0] / (n[0] + 2 * n[1])
    found = [k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3)]
    return np.array([0.0] + [min(max(d, 0.1), k) for k, d in enumerate(found, 1)])


@dataclass
class Found:
    """Events of a batch with the counts of its pairs and words, and the place of each event's."""

    e: Events
    keys: list[np.ndarray]
    pair: np.ndarray
    word: np.ndarray
    prior: np.ndarray
    of_pair: np.ndarray | None = None
    of_word: dict[str, np.ndarray] | None = None

    def pieces(self, most: int = PIECE) -> Iterator[tuple[int, int, Found]]:
        """First and last text, and their events, of pieces of whole texts with about so many words."""
        e, begin, n = self.e, 0, len(self.e.edges) - 1
        while True:
            end = int(np.searchsorted(e.edges, e.edges[begin] + most, "right")) - 1
            end = min(max(end, begin + 1), n)
            own = slice(e.edges[begin], e.edges[end])
            edges = e.edges[begin : end + 1] - e.edges[begin]
            events = Events(e.text[own] - begin, edges, e.word[own], e.prior[own], e.pair[own])
            yield begin, end, replace(self, e=events, pair=self.pair[own], word=self.word[own], prior=self.prior[own])
            begin = end
            if begin >= n:
                return


def sought(texts: list[bytes]) -> Found:
    """What a batch has to fetch: its different pairs and words."""
    e = events(texts)
    pairs, pair = np.unique(e.pair, return_inverse=True)
    words, at = np.unique(np.concatenate((e.word, e.prior)), return_inverse=True)
    return Found(e, [pairs, words], pair, *np.split(at, 2))


class Models:
    """Both classes' models: log-likelihood differences of events.

    A word: its discounted count in the class, and what that leaves for the shared backoff.
    A pair: its discounted count in the class, and what that leaves for the pair's
    probability in both classes together, tilted by the class's share of the word.
    """

    def __init__(self, sums: np.ndarray, parts: list[int]):
        self.parts = parts
        self.unseen = 1 / max(1.0, sums[0])
        self.before = sums[1] + 1
        of_class = sums[2:].reshape(2, 6)
        self.total = [max(1.0, s[0]) for s in of_class]
        self.discounts = [_discounts(s[1:5]) for s in of_class]
        self.left = [
            float(d[1:] @ s[[1, 2, 5]]) / t if s[0] else 1.0
            for d, s, t in zip(self.discounts, of_class, self.total, strict=True)
        ]

    def _taken(self, counts: np.ndarray, c: int) -> np.ndarray:
        return self.discounts[c][np.clip(counts, 0, 3).astype(np.int64)]

    def _words(self, counts: np.ndarray, shared: np.ndarray, c: int) -> np.ndarray:
        kept = np.maximum(counts - self._taken(counts, c), 0) / self.total[c]
        return kept + self.left[c] * shared

    def differences(self, f: Found, own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Toxic minus ordinary log-likelihood of each word, alone and after the word before.

        ``own`` is the class of each text where its counts are in the tables: they are then
        taken out, so that a row that taught is judged as one that did not.
        """
        e = f.e
        shared = ((f.of_word["before"] + self.unseen) / self.before)[f.word]
        at = _distinct(e) if own is not None else None
        parts, words = [], []
        for c in (0, 1):
            n = f.of_pair[c][f.pair]
            follow, kinds, alone = (
                f.of_word[f"{k}{c}"][i] for k, i in (("prior", f.prior), ("next", f.prior), ("word", f.word))
            )
            if own is not None:
                mine = own[e.text] == c
                follow = follow - mine * _within(e.text, e.prior, at, np.ones(len(at)))
                kinds = kinds - mine * _within(e.text, e.prior, at, (n[at] <= 1).astype(float))
                alone = alone - mine * _within(e.text, e.word, at, np.ones(len(at)))
                n = n - mine
            words.append(self._words(alone, shared, c))
            parts.append((np.maximum(n, 0), np.maximum(follow, 0), np.maximum(kinds, 0)))
        n, follow, kinds = (a + b for a, b in zip(*parts, strict=True))
        both = _interpolated(n, follow, kinds, shared)
        middle = (words[0] + words[1]) / 2
        pairs = [_interpolated(*parts[c], both * words[c] / middle) for c in (0, 1)]
        return np.log(words[1] / words[0]), np.log(pairs[1] / pairs[0])

    def features(self, texts: list[bytes], answers: list, own: np.ndarray | None = None) -> np.ndarray:
        """Per text: differences per word of the whole and of its worst runs of words."""
        f = sought(texts)
        f.of_pair, words = fetched(answers, f.keys, self.parts, _COLUMNS)
        f.of_word = dict(zip(_WORD, words, strict=True))
        out = []
        for a, b, piece in f.pieces():
            alone, after = self.differences(piece, None if own is None else own[a:b])
            columns = [_per_word(alone, piece.e, n) for n in (0, *RUNS)]
            out.append(np.column_stack(columns + [_per_word(after, piece.e, n) for n in (0, RUNS[0])]))
        return np.concatenate(out)


def _interpolated(n: np.ndarray, follow: np.ndarray, kinds: np.ndarray, backoff: np.ndarray) -> np.ndarray:
    """Discounted relative counts, the rest of the probability from the backoff."""
    seen = follow > 0.5
    of = np.maximum(follow, 1)
    rest = np.where(seen, np.clip(DISCOUNT * kinds / of, 1e-3, 1), 1)
    return np.where(seen, np.maximum(n - DISCOUNT, 0) / of, 0) + rest * backoff


def _per_word(d: np.ndarray, e: Events, run: int) -> np.ndarray:
    """The mean of each text (run 0), or of its run of words where it is largest, 0 at least."""
    total = np.concatenate(([0.0], np.cumsum(d)))
    if not run:
        return (total[e.edges[1:]] - total[e.edges[:-1]]) / np.maximum(np.diff(e.edges), 1)
    at = np.arange(len(d))
    last = np.minimum(at + run, e.edges[1:][e.text])
    worst = np.zeros(len(e.edges) - 1)
    np.maximum.at(worst, e.text, (total[last] - total[at]) / run)
    return worst


def _measured(docs: DataFrame, known: DataFrame, models: Models, each, schema) -> DataFrame:
    """``each`` of every batch with its answers from the models' tables, written.

    Questions and answers are larger than the documents, so these take turns.
    """
    out = []
    for some in rounds(docs):
        with noting() as paths:
            batches = numbered(some)
        asked = fetch(batches, known, lambda table: sought(texts_of(table)).keys, models.parts, _COLUMNS)
        met = meet(batches, asked, lambda batch, table, answers: each(table, answers), schema)
        out.append(written(met, "toxicity-round"))
        remove(docs.sparkSession, paths)
    return reduce(DataFrame.unionByName, out)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = 20_000):
    """The models' tables, the models and the weights of the regression.

    Counts come from all rows that may teach. The regression is fitted on at most about
    ``sample`` of them, chosen by a hash of doc_id.
    """
    rows = taught(docs, labels, label)
    size = text_bytes(docs)
    parts = [max(LEAST_PARTS, parts_for(size / n, PART_ENTRIES)) for n in (PAIR_BYTES, WORD_BYTES)]
    known, sums = count_pairs(rows, parts)
    models = Models(sums, parts)
    share = min(1.0, sample / max(1, labels.count()))
    chosen = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))

    def measure(table: pa.Table, answers: list) -> pa.Table:
        y = table["y"].to_numpy()
        x = models.features(texts_of(table), answers, y)
        return pa.table({"x": pa.array(list(x), pa.list_(pa.float64())), "y": pa.array(y.astype(np.int32))})

    fit = _measured(chosen, known, models, measure, "x array<double>, y int").toPandas()
    if not len(fit):
        return known, models, np.zeros(len(RUNS) + 4)
    x, y = np.stack(fit["x"].to_list()), fit["y"].to_numpy()
    order = np.lexsort((*x.T, y))  # sums do not depend on where batches were measured
    return known, models, logistic(x[order], y[order])


def _scored(docs: DataFrame, labels: DataFrame, emit, schema) -> DataFrame:
    with noting() as paths:
        known, models, weights = train(docs, labels)

    def each(table: pa.Table, answers: list) -> pa.Table:
        return emit(table, chance(models.features(texts_of(table), answers), weights))

    out = _measured(docs, known, models, each, schema)
    remove(docs.sparkSession, paths)
    return out


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row.

    Labels teach only through rows whose crc32(doc_id as text) is not divisible by 5; scores
    depend on the text alone. A null or empty text, or one of marks only, has no words and
    gets the score of no evidence. Repeated rows repeat, a null doc_id stays null and counts
    as the empty text in ``held_out``; without any label all scores are 0.5.
    Other columns are not read.
    """
    kinds = "doc_id long, held_out boolean, score double, predicted int"

    def emit(table: pa.Table, score: np.ndarray) -> pa.Table:
        ids = table["doc_id"].cast(pa.int64())
        predicted = pa.array((score >= threshold).astype(np.int32))
        return pa.Table.from_arrays(
            [ids, table["held_out"], pa.array(score), predicted], ["doc_id", "held_out", "score", "predicted"]
        )

    rows = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    return _scored(rows, labels, emit, kinds)


def decent(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns."""

    def emit(table: pa.Table, score: np.ndarray) -> pa.Table:
        return table.filter(pa.array(score < threshold))

    return _scored(docs, labels, emit, docs.schema)
