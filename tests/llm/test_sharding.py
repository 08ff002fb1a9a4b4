import hashlib
import math
import zlib
from collections import Counter, defaultdict

from conftest import *  # noqa: F403
from pyspark.sql import functions as F

from tidevault.llm import sharding
from tidevault.llm.sharding import EIGHT, grown, place, shard_of, weight_of


def draw(tree, key):
    path = ""
    while isinstance(tree, dict):
        best = None
        for name, child in tree.items():
            p = f"{path}/{name}"
            text = f"{p}|{'null' if key is None else key}".encode()
            u = (int(hashlib.md5(text).hexdigest()[:13], 16) + 0.5) / 2**52
            cost = -math.log(u) / weight_of(child)
            if len(tree) == 1 or best is None or cost < best[0]:
                best = (cost, p, child)
        _, path, tree = best
    return int(path.rpartition("/")[2])


def check(docs):
    rows = place(docs).collect()
    texts = Counter((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    got = Counter()
    slots = defaultdict(list)
    for r in rows:
        assert (r.shard, r.grown_shard, r.law) == (draw(EIGHT, r.doc_id), draw(grown(EIGHT), r.doc_id), "key")
        assert r.grown_shard in (r.shard, 8)
        slots[r.shard].append(r.slot)
        got[r.doc_id, r["size"], r.text_crc32] += 1
    want = Counter()
    for (i, t), n in texts.items():
        data = (t or "").encode()
        want[i, len(data) + 1, None if t is None else zlib.crc32(data)] += n
    assert got == want
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))


def test_placement_of_odd_rows(odd_docs):
    check(odd_docs)


def test_placement_over_many_blocks(real_docs, monkeypatch):
    monkeypatch.setattr(sharding, "BLOCK_ROWS", 3)
    check(real_docs)


def test_no_rows(no_docs):
    assert place(no_docs).count() == 0


def test_weights_give_shares_and_confine_movement(spark):
    tree = {"r": {"a": {0: 1.0, 1: 3.0}, "b": {2: 2.0}}, "s": {"a": {3: 2.0}}}
    more = {"r": {"a": {0: 1.0, 1: 3.0}, "b": {2: 6.0}}, "s": {"a": {3: 2.0}}}
    moved = spark.range(20_000).select(
        shard_of(tree, F.col("id")).alias("x"), shard_of(more, F.col("id")).alias("y")
    )
    pairs = {(r.x, r.y): r["count"] for r in moved.groupBy("x", "y").count().collect()}
    shares = Counter()
    for (x, _), n in pairs.items():
        shares[x] += n
    for shard, weight in ((0, 1), (1, 3), (2, 2), (3, 2)):
        assert abs(shares[shard] / 20_000 - weight / 8) < 0.02
    # Rack b and so region r have grown: rows move into r, and inside r into b only.
    assert all(x == y or (x == 3 and y in (0, 1, 2)) or y == 2 for x, y in pairs)


def test_main_path_is_native(real_docs):
    plan = place(real_docs)._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))
