"""Near-duplicate vectors by int8 products of tiles, with error bounds.

Vectors of one label are compared with each other, tile by tile. A unit vector x is kept as
s * q, q of int8, with the length e of the error x - s * q. For two of them
|x.y - s_x s_y q_x.q_y| <= e_x + e_y + e_x e_y, so a product decides all pairs that are
farther than that from the threshold; the rest, and only they, are computed in double
precision. Equal vectors of a label are compared once and counted as often as they occur.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidevault.llm.components import components, written

TILE = 2048


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Int8 numbers, scale and length of the error of unit vectors."""
    s = np.abs(x).max(axis=1) / 127
    q = np.rint(x / s[:, None]).astype(np.int8)
    return q, s, np.sqrt(((x - s[:, None] * q) ** 2).sum(axis=1)) + 1e-12


def near_pairs(a: np.ndarray, b: np.ndarray, threshold: float, block: int = 512):
    """Rows (i, j) of two sets of vectors whose cosine reaches the threshold.

    Products of int8 numbers are added up in float32, exactly while a sum stays below 2**24.
    """
    la, lb = np.sqrt((a * a).sum(axis=1)), np.sqrt((b * b).sum(axis=1))
    ua, ub = a / la[:, None], b / lb[:, None]
    (qa, sa, ea), (qb, sb, eb) = quantised(ua), quantised(ub)
    exact = np.float32 if a.shape[1] * 127 * 127 < 1 << 24 else np.float64
    right = qb.astype(exact).T
    out = []
    for at in range(0, len(a), block):
        rows = slice(at, at + block)
        rough = (qa[rows].astype(exact) @ right) * sa[rows, None] * sb[None, :]
        error = ea[rows, None] + eb[None, :] + ea[rows, None] * eb[None, :] + 1e-9
        i, j = np.nonzero(rough >= threshold - error)
        sure = rough[i, j] >= threshold + error[i, j]
        open_i, open_j = i[~sure] + at, j[~sure]
        cosine = np.einsum("nd,nd->n", a[open_i], b[open_j]) / (la[open_i] * lb[open_j])
        hit = cosine >= threshold
        out += [np.column_stack((i[sure] + at, j[sure])), np.column_stack((open_i[hit], open_j[hit]))]
    return np.concatenate(out) if out else np.empty((0, 2), np.int64)


def _forest(n: int, pairs: np.ndarray) -> np.ndarray:
    """Some of the pairs that connect what all of them do."""
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    kept = []
    for k, (i, j) in enumerate(pairs.tolist()):
        i, j = find(i), find(j)
        if i != j:
            root[max(i, j)] = min(i, j)
            kept.append(k)
    return pairs[kept]


def _tile(rows: pa.Table, threshold: float) -> pa.Table:
    """Of two tiles: for each vector the number it links with, and links that connect them."""
    side = rows["side"].to_numpy()
    ids, copies = rows["rep"].to_numpy(), rows["copies"].to_numpy()
    vectors = rows["vector"].combine_chunks()
    x = vectors.values.to_numpy().reshape(len(rows), -1)
    left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    pairs = near_pairs(x[left], x[right], threshold)
    pairs = np.column_stack((left[pairs[:, 0]], right[pairs[:, 1]]))
    pairs = pairs[pairs[:, 0] != pairs[:, 1]]
    links = np.bincount(pairs[:, 0], copies[pairs[:, 1]], len(ids)).astype(np.int64)
    if (side != 2).any():  # two tiles: each pair came once
        links += np.bincount(pairs[:, 1], copies[pairs[:, 0]], len(ids)).astype(np.int64)
    some = np.flatnonzero(links)
    kept = _forest(len(ids), pairs)
    return pa.table(
        {
            "a": pa.array(np.concatenate((ids[some], ids[kept[:, 0]]))),
            "b": pa.array(
                np.concatenate((np.zeros(len(some), np.int64), ids[kept[:, 1]])),
                mask=np.concatenate((np.ones(len(some), bool), np.zeros(len(kept), bool))),
            ),
            "links": pa.array(np.concatenate((links[some], np.zeros(len(kept), np.int64)))),
        }
    )


def _power(x: Column) -> Column:
    """The power of two below a number where the number is far from 1, else 1: dividing by it is exact."""
    far = (x < 1e-100) | (x > 1e100)
    return F.when(far, F.pow(F.lit(2.0), F.greatest(F.floor(F.log2(x)), F.lit(-1022)))).otherwise(F.lit(1.0))


def near_vectors(vectors: DataFrame, threshold: float = 0.93) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row.

    Two vectors link when their labels are equal and not null, they have as many components,
    and their cosine in double precision reaches the threshold. Vectors that are null, empty
    or zero or hold null or non-finite components, and rows without vec_id, link with nothing.
    ``n_links`` counts the other rows linked with directly; rows that repeat a vec_id count
    as rows of their own. ``component_id`` is the least vec_id reachable, ``kept`` whether
    it is the row's own. Other columns are not read.

    All pairs of a label are work for the product; a label of n vectors is cut into n / 2048
    tiles and each pair of tiles is a group of its own, so no label fills a task.
    """
    v = F.col("embedding")
    # Scaled by the largest component, no square is lost to the range of a double.
    largest = F.array_max(F.transform(v, lambda x: F.abs(x.cast("double"))))
    fit = (
        F.col("label").isNotNull()
        & F.col("vec_id").isNotNull()
        & (F.size(v) > 0)
        & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & (largest > 0)
    )
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label"),
        F.when(fit, F.transform(v, lambda x: x.cast("double") / _power(largest))).alias("vector"),
    )
    classes = written(
        rows.where("vector is not null")
        .groupBy("label", "vector")
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")),
        "vectors",
    )
    sizes = classes.groupBy("label", F.size("vector").alias("dim")).agg(
        F.ceil(F.count("*") / TILE).cast("int").alias("tiles")
    )
    tiles = (
        classes.withColumn("dim", F.size("vector"))
        .join(sizes, ["label", "dim"])
        .withColumn("own", F.expr("int(pmod(xxhash64(rep), tiles))"))
        .withColumn("other", F.explode(F.expr("sequence(0, tiles - 1)")))
        .select(
            "label",
            "dim",
            F.least("own", "other").alias("i"),
            F.greatest("own", "other").alias("j"),
            F.expr("case when own = other then 2 when own < other then 0 else 1 end").alias("side"),
            "rep",
            "copies",
            "vector",
        )
    )
    # A tile meets itself in group (i, i) only; in (i, j) it is one of two sides.
    found = written(
        tiles.groupBy("label", "dim", "i", "j").applyInArrow(
            lambda t: _tile(t, threshold), "a long, b long, links long"
        ),
        "near-vectors",
    )
    counts = found.where("b is null").groupBy("a").agg(F.sum("links").alias("links"))
    linked = components(found.where("b is not null").select("a", "b"))
    reps = (
        classes.join(counts, classes["rep"] == counts["a"], "left")
        .join(linked, classes["rep"] == linked["id"], "left")
        .select(
            "label",
            "vector",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component"),
        )
    )
    return rows.join(reps, ["label", "vector"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
        (F.coalesce("component", "vec_id") == F.col("vec_id")).alias("kept"),
    )
