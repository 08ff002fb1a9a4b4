"""Jaccard join of documents on word n-grams, through prefix trees.

1. The document frequency of every n-gram is counted (``batches``). Ordered from rare to
   frequent, a set that has a partner must share one of its first ``n - ceil(t * n) + 1``
   n-grams with it. N-grams of a single document cannot be shared, so a set with too many
   of them drops out here, which most do.
2. Equal sets become one. The others are led to the n-grams of their prefix. In a first
   round every n-gram compares its members with one of them only: a star, whose size is
   linear. The hub is the member with the fewest n-grams of its own, which the copies of one
   original are nearest to. In a second round the n-grams whose members are not yet in one
   component compare all members that are not in their largest one with all members. No link
   between components is lost so, and none inside a component is needed. There most members
   resemble no one: first only bitmaps of one or two bits for each n-gram travel, which bound
   overlaps from above, and whole sets are sent for members that may still have a partner.
3. Comparing means: the sets of a group, in global order, form a trie. A probe walks it
   level by level; sets with a common beginning share the count of the overlap so far, and a
   subtree is left when that count and the length that remains cannot reach the threshold.
   Large groups are cut into blocks, pairs of blocks in the second round.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidevault.llm.batches import ask, meet, numbered, parts_for, text_bytes, texts_of
from tidevault.llm.components import components, noting, remove, written
from tidevault.llm.words import mix, runs_in_texts, shingles, words_of

BLOCK = 2048  # sets in one trie


def sets_of(texts: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of each text, sorted by text and hash, and their texts."""
    hashes, edges = words_of([t.lower() for t in texts])  # lowers A-Z only
    grams, text = runs_in_texts(hashes, edges, k)
    n = np.diff(edges)
    few = np.flatnonzero((n > 0) & (n < k))
    short = [shingles(hashes[edges[i] : edges[i + 1]], k) for i in few]
    grams, text = np.concatenate([grams, *short]), np.concatenate([text, few])
    order = np.lexsort((grams, text))
    grams, text = grams[order], text[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (text[1:] != text[:-1])
    return grams[new], text[new]


def _sums(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    total = np.concatenate((np.zeros(1, values.dtype), np.cumsum(values)))
    return total[edges[1:]] - total[edges[:-1]]


def signatures(grams: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that stand for a set."""
    return _sums(mix(grams), edges), _sums(mix(grams ^ np.uint64(0x5851F42D4C957F2D)), edges)


class Trie:
    """Sets of ascending numbers in a prefix tree, its levels kept as arrays."""

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray):
        keys = [s.astype(">u8").tobytes() for s in sets]
        self.rows = np.array(sorted(range(len(sets)), key=keys.__getitem__), np.int64)
        nodes: list[list[int]] = []  # parent, first row, last row + 1, begin, end, level
        spans = [(-1, 0, len(sets), 0, 0)]
        while spans:
            parent, a, b, depth, level = spans.pop()
            while a < b:
                head = sets[self.rows[a]]
                if depth == len(head):  # ends at the parent
                    nodes.append([parent, a, a + 1, depth, depth, level])
                    a += 1
                    continue
                c = a + 1
                while c < b and sets[self.rows[c]][depth] == head[depth]:
                    c += 1
                end = len(head)
                if c - a > 1:  # sorted, so what the first and the last share all share
                    last = sets[self.rows[c - 1]]
                    end = min(len(head), len(last))
                    apart = np.flatnonzero(head[depth:end] != last[depth:end])
                    end = depth + int(apart[0]) if len(apart) else end
                    spans.append((len(nodes), a, c, end, level + 1))
                nodes.append([parent, a, c, depth, end, level])
                a = c
        self.parent, self.first, self.last, begin, end, self.level = np.array(nodes, np.int64).reshape(-1, 6).T
        edges = [sets[self.rows[f]][x:y] for f, x, y in zip(self.first, begin, end, strict=True)]
        self.at = np.concatenate(([0], np.cumsum(end - begin)))
        self.grams = np.concatenate(edges) if edges else np.empty(0, np.uint64)
        self.leaf = self.last - self.first == 1
        size = sizes[self.rows]
        longest = np.array([len(s) for s in sets], np.int64)[self.rows]
        spans_of = list(zip(self.first, self.last, strict=True))
        self.least = np.array([size[a:b].min() for a, b in spans_of], np.int64)
        self.rest = np.array([longest[a:b].max() for a, b in spans_of], np.int64) - end
        self.children = np.argsort(self.parent, kind="stable")
        self.from_parent = np.searchsorted(self.parent[self.children], np.arange(-1, len(nodes) + 1))

    def _below(self, nodes: np.ndarray) -> np.ndarray:
        return self.children[ranges(self.from_parent[nodes + 1], self.from_parent[nodes + 2])]

    def matches(self, probe: np.ndarray, size: int, percent: int) -> np.ndarray:
        """Rows whose Jaccard similarity to the probe reaches the percentage."""
        found = []
        nodes = self._below(np.array([-1]))
        overlap = np.zeros(len(nodes), np.int64)
        while len(nodes):
            a, b = self.at[nodes], self.at[nodes + 1]
            grams = self.grams[ranges(a, b)]
            where = np.searchsorted(probe, grams)
            hit = probe[np.minimum(where, len(probe) - 1)] == grams if len(probe) else where < 0
            overlap = overlap + _sums(hit.astype(np.int64), np.concatenate(([0], np.cumsum(b - a))))
            left = np.full(len(nodes), len(probe))
            some = b > a
            left[some] = len(probe) - np.searchsorted(probe, self.grams[b[some] - 1], side="right")
            most = overlap + np.minimum(left, self.rest[nodes])
            alive = (100 + percent) * most >= percent * (size + self.least[nodes])
            nodes, overlap = nodes[alive], overlap[alive]
            leaf = self.leaf[nodes]
            found.append(self.rows[self.first[nodes[leaf]]])
            counts = self.from_parent[nodes[~leaf] + 2] - self.from_parent[nodes[~leaf] + 1]
            overlap = np.repeat(overlap[~leaf], counts)
            nodes = self._below(nodes[~leaf])
        return np.concatenate(found) if found else np.empty(0, np.int64)


def ranges(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The numbers from a[i] up to b[i], one range after another."""
    n = b - a
    return np.repeat(a - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())


def bitmap(tokens: np.ndarray) -> bytes:
    """Whether an odd number of tokens falls on each bit; a power of two of bits, no fewer than tokens.

    Bits in which two such maps differ stand for a token each, at least, that one set has alone.
    """
    width = max(64, 1 << (len(tokens) - 1).bit_length())
    places = (tokens & np.uint64(width - 1)).astype(np.int64)
    return np.packbits((np.bincount(places, minlength=width) & 1).astype(np.uint8)).tobytes()


def _folded(maps: np.ndarray, words: int) -> np.ndarray:
    """The same tokens' maps in fewer words, the last axis."""
    while maps.shape[-1] > words:
        half = maps.shape[-1] // 2
        maps = maps[..., :half] ^ maps[..., half:]
    return maps


def _grouped(rows: pa.Table, keys: list[str]):
    """The row numbers of each group in a task's rows."""
    columns = [rows[k].to_numpy() for k in keys]
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[order][1:] != c[order][:-1]
    return np.split(order, np.flatnonzero(new)[1:])


_LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _members(rows: pa.Table) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    sets = [np.frombuffer(t, np.uint64) for t in rows["tokens"].to_pylist()]
    return rows["rep"].to_numpy(), sets, rows["n"].to_numpy()


def star_links(rows: pa.Table, percent: int) -> pa.Table:
    """Links between each group's hub and its members."""
    rep, sets, n = _members(rows)
    hub = rows["hub"].to_numpy()
    out = []
    for group in _grouped(rows, ["hub", "block"]):
        probe = group[rep[group] == hub[group]][0]
        trie = Trie([sets[i] for i in group], n[group])
        near = group[trie.matches(sets[probe], int(n[probe]), percent)]
        out.append(np.column_stack((rep[near], np.full(len(near), rep[probe]))))
    pairs = np.concatenate(out)
    pairs = pairs[pairs[:, 0] != pairs[:, 1]]
    return pa.Table.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=_LINK)


def may_link(rows: pa.Table, percent: int) -> pa.Table:
    """The members of each group that may link with one of another component, by their bitmaps."""
    maps = [np.frombuffer(b, np.uint64) for b in rows["bits"].to_pylist()]
    words = np.array([len(m) for m in maps], np.int64)
    component, n, shared = (rows[c].to_numpy() for c in ("component", "n", "shared"))
    alive = np.zeros(len(maps), bool)
    for group in _grouped(rows, ["token", "i", "j"]):
        names, counts = np.unique(component[group], return_counts=True)
        walkers = group[component[group] != names[np.argmax(counts)]]
        for width in np.unique(words[group]):
            mine = group[words[group] == width]
            same = np.stack([maps[g] for g in mine])
            folds = {w: _folded(same, w) for w in np.unique(words[walkers])}
            for at in walkers:
                theirs = folds[words[at]]
                apart = np.bitwise_count(theirs ^ _folded(maps[at], theirs.shape[1])).sum(axis=1, dtype=np.int64)
                most = np.minimum((shared[mine] + shared[at] - apart) // 2, np.minimum(shared[mine], shared[at]))
                near = (100 + percent) * most >= percent * (n[mine] + n[at])
                near &= component[mine] != component[at]
                alive[mine[near]] = True
                alive[at] |= near.any()
    return rows.select(["token", "rep", "component", "i", "j"]).filter(pa.array(alive))


def cross_links(rows: pa.Table, percent: int) -> pa.Table:
    """Links between the components that meet in each group; one for each two of them."""
    rep, sets, n = _members(rows)
    component = rows["component"].to_numpy()
    out = []
    for group in _grouped(rows, ["token", "i", "j"]):
        label = component[group].copy()
        trie = Trie([sets[g] for g in group], n[group])
        # Members of the largest component need no walk: the others walk to them, from
        # whichever side they stand on.
        names, counts = np.unique(label, return_counts=True)
        walkers = np.flatnonzero(label != names[np.argmax(counts)])
        alone = [1 - len(sets[g]) / n[g] for g in group[walkers]]
        for at in walkers[np.argsort(alone, kind="stable")]:
            if (label == label[at]).all():
                break
            for other in trie.matches(sets[group[at]], int(n[group[at]]), percent):
                if label[other] != label[at]:
                    out.append((rep[group[at]], rep[group[other]]))
                    label[label == label[other]] = label[at]
    pairs = np.array(out, np.int64).reshape(-1, 2)
    return pa.Table.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=_LINK)


def frequency_sets(batches: DataFrame, size: int, k: int, percent: int) -> DataFrame:
    """Size, signature and, where a partner is possible, the ordered shared n-grams of each set.

    Each row has its batch and its place in that; ``size`` is that of all texts in bytes.
    An n-gram is written as its frequency class (7 bits) and 56 bits of its hash, so that
    their order as numbers is the global order, rare first.
    """
    parts = parts_for(size / 6)

    def split(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        high = grams >> np.uint64(32)
        return (high * np.uint64(parts)) >> np.uint64(32), grams & np.uint64(0xFFFFFFFF)

    def keys_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        texts = list(dict.fromkeys(texts_of(table)))
        grams, counts = np.unique(sets_of(texts, k)[0], return_counts=True)
        part, key = split(grams)
        return part.astype(np.int64), key, counts

    def answer(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # Keys that collide count together: an n-gram may seem more frequent, never less.
        _, which = np.unique(keys, return_inverse=True)
        df = np.bincount(which, counts)
        rank = np.minimum(127, 1 + np.log2(np.maximum(df, 1)) * 4).astype(np.uint8)
        places = np.flatnonzero(df[which] >= 2)
        return places, rank[which[places]]

    schema = pa.schema(
        [
            ("batch", pa.int64()),
            ("place", pa.int32()),
            ("doc_id", pa.int64()),
            ("n", pa.int64()),
            ("s1", pa.int64()),
            ("s2", pa.int64()),
            ("prefix", pa.list_(pa.int64())),
            ("tokens", pa.binary()),
            ("bits", pa.binary()),
        ]
    )

    def each(batch: int, table: pa.Table, answers: list) -> pa.Table:
        texts = texts_of(table)
        first: dict[bytes, int] = {}
        whole = [first.setdefault(t, i) for i, t in enumerate(texts)]
        distinct = [t if whole[i] == i else b"" for i, t in enumerate(texts)]
        grams, text = sets_of(distinct, k)
        edges = np.searchsorted(text, np.arange(len(texts) + 1))
        n = np.diff(edges)
        s1, s2 = signatures(grams, edges)
        part, key = split(grams)
        own = (part << np.uint64(32)) | key
        rank = np.zeros(len(grams), np.uint64)
        if answers:
            known = np.concatenate(
                [(np.uint64(p) << np.uint64(32)) | np.frombuffer(a, np.uint32).astype(np.uint64) for p, a, _ in answers]
            )
            value = np.concatenate([np.frombuffer(v, np.uint8) for _, _, v in answers])
            order = np.argsort(known)
            known, value = known[order], value[order]
            at = np.minimum(np.searchsorted(known, own), len(known) - 1)
            rank = np.where(known[at] == own, value[at], 0).astype(np.uint64)
        alone = _sums((rank == 0).astype(np.int64), edges)
        least = -(-percent * n // 100)
        token = (rank << np.uint64(56)) | (grams >> np.uint64(8))
        prefix, tokens, bits = [], [], []
        for i in range(len(texts)):
            if n[i] == 0 or n[i] - alone[i] < least[i]:
                prefix.append(None)
                tokens.append(None)
                bits.append(None)
                continue
            mine = np.sort(token[edges[i] : edges[i + 1]][rank[edges[i] : edges[i + 1]] > 0])
            prefix.append(mine[: n[i] - least[i] + 1 - alone[i]].astype(np.int64))
            tokens.append(mine.tobytes())
            bits.append(bitmap(mine))
        places = np.arange(len(texts), dtype=np.int32)
        columns = [np.full(len(texts), batch), places, table["doc_id"].cast(pa.int64()), n[whole], s1.astype(np.int64)[whole], s2.astype(np.int64)[whole]]
        return pa.Table.from_arrays(
            [c if isinstance(c, pa.ChunkedArray) else pa.array(c) for c in columns]
            + [pa.array(prefix, schema.field("prefix").type), pa.array(tokens, pa.binary()), pa.array(bits, pa.binary())],
            schema=schema,
        )

    answers = ask(batches, keys_of, answer, (np.uint32, np.uint16))
    columns = "batch long, place int, doc_id long, n long, s1 long, s2 long, prefix array<long>, tokens binary, bits binary"
    return meet(batches, answers, each, columns)


def _star_round(reps: DataFrame, routes: DataFrame, percent: int) -> DataFrame:
    hubs = routes.groupBy("token").agg(
        F.min(F.struct("alone", "rep", "n")).alias("hub"), F.count("*").alias("m")
    )
    near = (F.col("n") * 100 >= F.col("hub.n") * percent) & (F.col("hub.n") * 100 >= F.col("n") * percent)
    pairs = (
        routes.join(hubs.where("m > 1"), "token")
        .where((F.col("rep") != F.col("hub.rep")) & near)
        .select(F.col("hub.rep").alias("hub"), "rep")
        .distinct()
    )
    pairs = written(pairs, "star-pairs")
    counts = pairs.groupBy("hub").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    members = pairs.join(counts, "hub").select(
        "hub", "rep", F.expr("int(pmod(xxhash64(rep), blocks))").alias("block")
    )
    centres = counts.select(
        "hub", F.col("hub").alias("rep"), F.explode(F.expr("sequence(0, blocks - 1)")).alias("block")
    )
    return _links(members.union(centres), reps, ["hub", "block"], lambda t: star_links(t, percent))


def _cross_round(reps: DataFrame, routes: DataFrame, linked: DataFrame, percent: int) -> DataFrame:
    routes = routes.join(linked.withColumnRenamed("id", "rep"), "rep", "left").select(
        "token", "rep", F.coalesce("component", "rep").alias("component")
    )
    mixed = (
        routes.groupBy("token")
        .agg(
            F.count("*").alias("m"),
            F.sum(F.xxhash64("rep").cast("decimal(38,0)")).alias("who"),
            F.min("component").alias("low"),
            F.max("component").alias("high"),
        )
        .where("low <> high")
        .groupBy("m", "who")  # n-grams with the same members are worth one look
        .agg(F.min("token").alias("token"))
        .select("token", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks"))
    )
    members = routes.join(mixed, "token").withColumn(
        "own", F.expr("int(pmod(xxhash64(rep), blocks))")
    )
    pairs = members.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).select(
        "token",
        "rep",
        "component",
        F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"),
    )
    keys = ["token", "i", "j"]
    maps = reps.select("rep", "n", (F.octet_length("tokens") / 8).cast("long").alias("shared"), "bits")
    kinds = "token long, rep long, component long, i int, j int"
    near = _by_group(written(pairs, "map-groups"), maps, keys, lambda t: may_link(t, percent), kinds)
    return _links(near, reps, keys, lambda t: cross_links(t, percent))


Rows = Callable[[pa.Table], pa.Table]


def _by_group(groups: DataFrame, reps: DataFrame, keys: list[str], f: Rows, schema: str) -> DataFrame:
    """Apply ``f`` to the members of written groups, many groups to a task."""
    tasks = max(1, groups.count() // 4096)
    rows = groups.join(reps, "rep").withColumn("task", F.pmod(F.xxhash64(*keys), F.lit(tasks)))
    return rows.groupBy("task").applyInArrow(f, schema)


def _links(groups: DataFrame, reps: DataFrame, keys: list[str], f: Rows) -> DataFrame:
    groups = written(groups, "trie-groups")
    links = _by_group(groups, reps.select("rep", "n", "tokens"), keys, f, "a long, b long")
    return written(links.distinct(), "trie-links")


def _classified(batches: DataFrame, size: int, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """All rows' sets, and of each distinct one its linked group and the least doc_id in that.

    Each distinct set has a number of its own, ``rep``, whatever the ids of its rows.
    """
    sets = written(frequency_sets(batches, size, k, percent), "sets")
    classes = sets.where("n > 0").groupBy("s1", "s2").agg(F.min("doc_id").alias("least"))
    classes = written(classes.withColumn("rep", F.monotonically_increasing_id()), "classes")
    reps = written(
        sets.where("tokens is not null")
        .groupBy("s1", "s2", "n")
        .agg(*(F.first(c).alias(c) for c in ("tokens", "prefix", "bits")))
        .join(classes, ["s1", "s2"])
        .select("rep", "n", "tokens", "prefix", "bits"),
        "reps",
    )
    alone = 1 - F.octet_length("tokens") / 8 / F.col("n")  # share of n-grams no one else has
    routes = written(
        reps.select(F.explode("prefix").alias("token"), "rep", "n", alone.alias("alone")), "routes"
    )
    star = _star_round(reps, routes, percent)
    cross = _cross_round(reps, routes, components(star), percent)
    linked = written(components(star.union(cross)).withColumnRenamed("id", "rep"), "linked")
    least = linked.join(classes, "rep").groupBy("component").agg(F.min("least").alias("of_all"))
    groups = classes.join(linked.join(least, "component"), "rep", "left").select(
        "s1",
        "s2",
        F.coalesce("component", "rep").alias("group"),
        F.when(F.col("component").isNull(), F.col("least")).otherwise(F.col("of_all")).alias("component_id"),
    )
    return sets, groups


def ngram_components(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row: near-duplicates share a component.

    Two documents link when the Jaccard similarity of their sets of ``k``-word shingles,
    A-Z lowered, is ``percent`` or more. A text of fewer words is one shingle; a null text
    or one without words has none and links with nothing. ``component_id`` is the least
    doc_id reachable by links, the document's own without any. Repeated rows stay as often
    as they come. Rows without doc_id link like others, but never name a component, and
    are null there if no other row is in theirs. Other columns are not looked at.
    """
    docs = docs.select("doc_id", "text")
    sets, groups = _classified(numbered(docs), text_bytes(docs), k, percent)
    return sets.join(groups.withColumn("n_", F.lit(1)), ["s1", "s2"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def representatives(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group of near-duplicates, the least doc_id, with all its columns.

    Documents without words are not alike and all stay, and so do rows without doc_id. Of
    rows with the same doc_id one stays if they are alike; others are judged by themselves.
    """
    batches = numbered(docs)
    with noting() as paths:
        sets, groups = _classified(batches, text_bytes(docs), k, percent)
    same = ["s1", "s2"]
    rows = sets.where("doc_id is not null and n > 0").select("batch", "place", "doc_id", *same).join(groups, same)
    one = rows.where("doc_id = component_id").groupBy("doc_id", "group").agg(F.min(F.struct("batch", "place")).alias("row"))
    kept = sets.where("doc_id is null or n = 0").select("batch", "place").union(one.select("row.*"))
    places = F.concat_ws(",", F.sort_array(F.collect_list("place")).cast("array<string>")).cast("binary")
    kept = written(kept.groupBy("batch").agg(places.alias("keys")), "kept")
    remove(docs.sparkSession, paths)

    def each(batch: int, table: pa.Table, answers: list) -> pa.Table:
        # The texts stay in their compressed batches: no join carries them.
        return table.take(pa.array([int(p) for _, places, _ in answers for p in places.split(b",")], pa.int64()))

    none = [F.lit(None).cast(kind).alias(c) for c, kind in (("docs", "binary"), ("part", "long"))]
    answers = kept.select("batch", *none, "keys", F.lit(None).cast("binary").alias("vals"))
    return meet(batches, answers, each, docs.schema)
