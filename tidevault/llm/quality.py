"""Text quality by naive Bayes support vectors.

Features are indicators of word n-grams (one and two words, by their 64-bit hashes) and of byte
trigrams. The vocabulary is all that a bounded sample of the labelled rows has: the linear model
is fitted on that sample, and features that it lacks would have no weight. No feature shares a
place with another. Each is scaled by the log ratio of its smoothed counts in the two classes,
counted over all labelled rows that may teach. The model has squared hinge loss and is fitted
by dual coordinate descent; the sample also gives the margins' scale as a probability.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidevault.llm.batches import sliced, texts_of
from tidevault.llm.components import written
from tidevault.llm.labelled import chance, held_out, logistic, taught
from tidevault.llm.words import mix, runs_in_texts, words_of

SMOOTHING = 1.0
COST = 1.0
EPOCHS = 12
SAMPLE_BYTES = 32 << 20  # text of all sampled rows together
_SLICE = 1 << 18  # entries of the vocabulary in one row
_TEXT_BYTES = 4 << 20


def grams(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Words, word pairs and byte trigrams of the texts, and where each text's begin and end."""
    words, edges = words_of([t.lower() for t in texts])
    two, owner = runs_in_texts(words, edges, 2)
    every = np.arange(len(texts) + 1)
    joined = np.frombuffer(b"".join(texts), np.uint8).astype(np.int32)
    text = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    at = np.flatnonzero(text[:-2] == text[2:])
    tri = joined[at] << 16 | joined[at + 1] << 8 | joined[at + 2]
    return [(mix(words), edges), (two, np.searchsorted(owner, every)), (tri, np.searchsorted(text[at], every))]


class Vocabulary:
    """Numbers of the features: first words and pairs by their hashes, then trigrams."""

    def __init__(self, hashes: np.ndarray, trigrams: np.ndarray):
        self.hashes, self.trigrams = hashes, trigrams
        self._trigram = None  # made in the worker, not sent

    def __len__(self) -> int:
        return len(self.hashes) + len(self.trigrams)

    def _hashed(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.full(len(keys), -1, np.int32)
        own, which = np.unique(keys, return_inverse=True)
        at = np.minimum(np.searchsorted(self.hashes, own), len(self.hashes) - 1)
        return np.where(self.hashes[at] == own, at, -1).astype(np.int32)[which]

    def features(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Distinct known features of all texts in a row, and where each text's begin and end."""
        if self._trigram is None:
            self._trigram = np.full(1 << 24, -1, np.int32)
            self._trigram[self.trigrams] = np.arange(len(self.hashes), len(self), dtype=np.int32)
        (one, one_edges), (two, two_edges), (tri, tri_edges) = grams(texts)
        both = self._hashed(np.concatenate((one, two)))
        one, two, tri = both[: len(one)], both[len(one) :], self._trigram[tri]
        place = np.empty(len(self), np.int32)
        out = [np.empty(0, np.int32)]
        for i in range(len(texts)):
            found = np.concatenate([x[e[i] : e[i + 1]] for x, e in ((one, one_edges), (two, two_edges), (tri, tri_edges))])
            found = found[found >= 0]
            order = np.arange(len(found), dtype=np.int32)
            place[found] = order  # of equal ones the last stays
            out.append(found[place[found] == order])
        return np.concatenate(out), np.cumsum([len(f) for f in out])

    def __getstate__(self):
        return {"hashes": self.hashes, "trigrams": self.trigrams, "_trigram": None}


def _chunked(texts: list[bytes]) -> Iterator[list[bytes]]:
    held, size = [], 0
    for t in texts:
        if held and size + len(t) > _TEXT_BYTES:
            yield held
            held, size = [], 0
        held.append(t)
        size += len(t)
    if held:
        yield held


def vocabulary(chosen: DataFrame) -> Vocabulary:
    """All features of the sampled texts, gathered in one task."""

    def gather(table: pa.Table) -> pa.Table:
        hashes, trigrams = np.empty(0, np.uint64), np.empty(0, np.int32)
        for texts in _chunked(texts_of(table)):
            (one, _), (two, _), (tri, _) = grams(texts)
            hashes = np.union1d(hashes, np.concatenate((np.unique(one), np.unique(two))))
            trigrams = np.union1d(trigrams, tri)
        rows = [(kind, x[i : i + _SLICE].tobytes()) for kind, x in enumerate((hashes, trigrams)) for i in range(0, len(x), _SLICE)]
        number = pa.array(range(len(rows)), pa.int32())
        kinds, data = zip(*rows, strict=True) if rows else ((), ())
        return pa.table({"number": number, "kind": pa.array(kinds, pa.int32()), "data": pa.array(data, pa.binary())})

    rows = chosen.groupBy("one").applyInArrow(gather, "number int, kind int, data binary").collect()
    rows.sort(key=lambda r: r["number"])
    joined = (b"".join(r["data"] for r in rows if r["kind"] == kind) for kind in (0, 1))
    return Vocabulary(*(np.frombuffer(x, t) for x, t in zip(joined, (np.uint64, np.int32), strict=True)))


def log_ratios(rows: DataFrame, known: Broadcast, size: int) -> np.ndarray:
    """Log ratio of each feature's smoothed counts in class 1 and class 0, over all rows.

    Tasks send the counts that are not 0, Spark adds them up, and the driver gets four bytes for
    each of the vocabulary's ``size`` features.
    """

    def partial(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, size), np.int64)
        for b in sliced(records):
            found, edges = known.value.features(texts_of(b))
            y = np.repeat(b["y"].to_numpy(), np.diff(edges))
            for c in (0, 1):
                total[c] += np.bincount(found[y == c], minlength=size)
        place = np.flatnonzero(total.any(axis=0))
        for i in range(0, len(place), _SLICE):
            at = place[i : i + _SLICE]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (at.astype(np.int32), *total[:, at])], ["place", "n0", "n1"])

    def pack(table: pa.Table) -> pa.Table:
        piece = table["piece"][0].as_py()
        n0, n1 = (table[c].to_numpy() for c in ("n0", "n1"))
        logs = np.zeros(min(_SLICE, size - piece * _SLICE), np.float32)
        logs[table["place"].to_numpy() - piece * _SLICE] = np.log((n1 + SMOOTHING) / (n0 + SMOOTHING))
        out = {"piece": [piece], "n0": [int(n0.sum())], "n1": [int(n1.sum())], "logs": [logs.tobytes()]}
        return pa.table(out, pa.schema([("piece", pa.int32()), ("n0", pa.int64()), ("n1", pa.int64()), ("logs", pa.binary())]))

    sums = rows.mapInArrow(partial, "place int, n0 long, n1 long").groupBy("place").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    pieces = sums.withColumn("piece", F.floor(F.col("place") / _SLICE).cast("int")).groupBy("piece")
    found = pieces.applyInArrow(pack, "piece int, n0 long, n1 long, logs binary").collect()
    out = np.zeros(size, np.float32)
    for r in found:
        logs = np.frombuffer(r["logs"], np.float32)
        out[r["piece"] * _SLICE : r["piece"] * _SLICE + len(logs)] = logs
    totals = [sum(r[c] for r in found) + SMOOTHING * size for c in ("n0", "n1")]
    return out + np.float32(np.log(totals[0] / totals[1])) if size else out


def descend(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    """Weights of the squared-hinge model on the scaled rows, the constant last.

    Dual coordinate descent: one multiplier per row, each step solves one of them exactly.
    """
    w = np.zeros(len(ratio) + 1)
    values = []
    for r in rows:
        v = np.append(ratio[r].astype(np.float64), 1.0)
        values.append(v / max(1e-9, np.sqrt(v @ v)))
    places = [np.append(r, len(ratio)) for r in rows]
    sign = np.where(y == 1, 1.0, -1.0)
    cost = COST / np.where(y == 1, max(1e-9, y.mean()), max(1e-9, 1 - y.mean()))  # classes weigh alike
    alpha = np.zeros(len(rows))
    order = np.random.default_rng(5)
    for _ in range(EPOCHS):
        most = 0.0
        for i in order.permutation(len(rows)):
            slope = sign[i] * (w[places[i]] @ values[i]) - 1 + alpha[i] / (2 * cost[i])
            new = max(0.0, alpha[i] - slope / (1 + 1 / (2 * cost[i])))
            if new != alpha[i]:
                w[places[i]] += (new - alpha[i]) * sign[i] * values[i]
                most = max(most, abs(new - alpha[i]))
                alpha[i] = new
        if most < 1e-3:
            break
    return w


def margins(found: np.ndarray, edges: np.ndarray, ratio: np.ndarray, w: np.ndarray) -> np.ndarray:
    """What the model gives each row; a row without features gets the constant alone."""
    r = ratio[found].astype(np.float64)
    n = len(edges) - 1
    row = np.repeat(np.arange(n), np.diff(edges))
    dot, square = np.bincount(row, r * w[found], n), np.bincount(row, r * r, n)
    return (dot + w[-1]) / np.sqrt(square + 1)


def _sample(rows: DataFrame, labelled: int, sample: int) -> DataFrame:
    """``one, doc_id, text, y`` of about ``sample`` rows by a hash of doc_id, fewer where texts are long."""
    hashed = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    most = int(min(1.0, sample / max(1, labelled)) * (1 << 30))
    chosen = rows.where(hashed < most)
    size = chosen.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    while size > SAMPLE_BYTES:
        most = min(most - 1, int(most * SAMPLE_BYTES / size))
        chosen = rows.where(hashed < most)
        size = chosen.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return written(chosen.select(F.lit(0).alias("one"), "doc_id", "text", "y"), "quality-sample")


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = 8192):
    """Vocabulary and log ratios, as sent to the workers, weights (the constant last) and the
    probability's scale.

    Ratios are counted over all rows that may teach; the vocabulary and the model come from about
    ``sample`` of them, chosen by a hash of doc_id, with no more than ``SAMPLE_BYTES`` of text, and are
    made in one task.
    """
    rows = taught(docs, labels, label)
    chosen = _sample(rows, labels.count(), sample)
    send = docs.sparkSession.sparkContext.broadcast  # all of bounded size
    words = vocabulary(chosen)
    size, known = len(words), send(words)
    ratios = send(log_ratios(rows, known, size))

    def fit(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        ratio, y, found = ratios.value, table["y"].to_numpy(), []
        for texts in _chunked(texts_of(table)):
            all_found, edges = known.value.features(texts)
            found += [all_found[x:z] for x, z in zip(edges[:-1], edges[1:], strict=True)]
        half = np.arange(len(y)) % 2 == 0
        # The scale comes from margins of rows that the model at hand has not seen, by its features.
        seen = np.empty(len(y))
        for part in (half, ~half):
            mine = [f for f, p in zip(found, part, strict=True) if p]
            rest = [f for f, p in zip(found, part, strict=True) if not p]
            if mine and rest:
                w = descend(mine, y[part], ratio)
                has = np.zeros(len(ratio), bool)
                has[np.concatenate(mine)] = True
                rest = [f[has[f]] for f in rest]
                seen[~part] = margins(np.concatenate(rest), np.cumsum([0] + [len(f) for f in rest]), ratio, w)
        scale = logistic(seen[:, None], y, 1e-3) if len(y) > 1 else np.array([1.0, 0.0])
        w = descend(found, y, ratio)
        return pa.table({"w": pa.array([w.tobytes()]), "scale": pa.array([scale.tobytes()])})

    model = chosen.groupBy("one").applyInArrow(fit, "w binary, scale binary").collect()
    w, scale = (np.frombuffer(x) for x in model[0]) if model else (np.zeros(size + 1), np.array([1.0, 0.0]))
    return known, ratios, send(w), scale


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row.

    Labels teach only through rows whose crc32(doc_id as text) is not divisible by 5; scores
    depend on the text alone. A null or empty text, or one without known features, gets the score of
    the constant. Repeated rows repeat, a null doc_id stays null and counts as the empty
    text in ``held_out``; without any label all scores are 0.5. Other columns are not read.
    """
    known, ratio, w, scale = train(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            found, edges = known.value.features(texts_of(b))
            score = chance(margins(found, edges, ratio.value, w.value)[:, None], scale)
            predicted = pa.array((score >= threshold).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"].cast(pa.int64()), b["held_out"], pa.array(score), predicted],
                ["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
