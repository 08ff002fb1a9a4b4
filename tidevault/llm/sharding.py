"""Shards by a hierarchical weighted hash tree, with DataFrame functions only.

A tree maps regions to racks to shards to weights. A row descends by one draw per level:
each child of the node reached draws a number from the row's key and the child's path, and
``-ln(draw) / weight`` is least for the child taken, so each child gets its share of weight.
A child's draw depends on its own path and weight alone. When weights change, rows move
only into subtrees whose weight grew and out of subtrees whose weight shrank; a shard that
comes in a region of its own takes rows only into itself.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

Tree = dict[str, dict[str, dict[int, float]]]

#: Two regions of two racks of two shards each.
EIGHT: Tree = {
    "r0": {"a": {0: 1.0, 1: 1.0}, "b": {2: 1.0, 3: 1.0}},
    "r1": {"a": {4: 1.0, 5: 1.0}, "b": {6: 1.0, 7: 1.0}},
}
BLOCK_ROWS = 4096


def grown(tree: Tree, weight: float = 1.0) -> Tree:
    """The tree with one more shard, in a region of its own."""
    shards = [s for racks in tree.values() for rack in racks.values() for s in rack]
    return tree | {f"r{len(tree)}": {"a": {max(shards) + 1: weight}}}


def weight_of(node) -> float:
    return sum(map(weight_of, node.values())) if isinstance(node, dict) else float(node)


def _digits(path: str, key: Column) -> Column:
    """52 bits of a hash as a draw strictly between 0 and 1."""
    text = F.concat(F.lit(path + "|"), F.coalesce(key.cast("string"), F.lit("null")))
    bits = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double")
    return (bits + 0.5) / F.lit(2.0**52)


def _descend(node, path: str, key: Column) -> Column:
    """The shard of a key below a node."""
    if not isinstance(node, dict):
        return F.lit(int(path.rpartition("/")[2]))
    children = [(f"{path}/{name}", child) for name, child in node.items() if weight_of(child) > 0]
    if len(children) == 1:
        return _descend(children[0][1], children[0][0], key)
    costs = [-F.ln(_digits(p, key)) / F.lit(weight_of(c)) for p, c in children]
    draws = [F.struct(cost.alias("cost"), F.lit(i).alias("i")) for i, cost in enumerate(costs)]
    taken = F.least(*draws)["i"]
    choice = None
    for i, (p, child) in enumerate(children):
        below = _descend(child, p, key)
        choice = F.when(taken == i, below) if choice is None else choice.when(taken == i, below)
    return choice


def shard_of(tree: Tree, key: Column) -> Column:
    """The shard that the tree gives to a key; a null key goes as a key of its own."""
    return _descend(tree, "", key).cast("int")


def place(docs: DataFrame, tree: Tree = EIGHT, more: Tree | None = None) -> DataFrame:
    """Shard, place in the shard and shard of the grown tree of every row.

    Returns ``doc_id, size, text_crc32, law, shard, slot, grown_shard``. ``size`` is the
    text's UTF-8 bytes plus 1, and 1 for a null text, whose ``text_crc32`` is null. Law
    ``key``: doc_id and the tree alone decide, equal texts do not stay together. Slots count
    from 0 without gaps in each shard. They are given block by block (a hash of the key), so
    no shard passes through one task; rows without doc_id share a shard, but are dealt to
    blocks by their text. Repeated rows have slots of their own. Other columns are not read.
    """
    more = more or grown(tree)
    n_shards = sum(len(rack) for racks in tree.values() for rack in racks.values())
    blocks = max(1, math.ceil(docs.count() / (n_shards * BLOCK_ROWS)))
    key = F.col("doc_id")
    block = F.pmod(F.xxhash64(F.lit(7), key, F.when(key.isNull(), F.col("text"))), F.lit(blocks))
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.encode("text", "utf-8")).alias("text_crc32"),
        shard_of(tree, key).alias("shard"),
        shard_of(more, key).alias("grown_shard"),
        block.alias("block"),
    )
    # Only rows without doc_id need their text here; the others are counted by the key alone.
    with_id = F.pmod(F.xxhash64(F.lit(7), key, F.lit(None).cast("string")), F.lit(blocks))
    counted = (
        docs.where(key.isNotNull()).select(shard_of(tree, key).alias("shard"), with_id.alias("block"))
    ).unionByName(
        docs.where(key.isNull()).select(shard_of(tree, key).alias("shard"), block.alias("block"))
    )
    before = Window.partitionBy("shard").orderBy("block")
    offsets = counted.groupBy("shard", "block").agg(F.count("*").alias("n")).select(
        "shard",
        "block",
        (F.sum("n").over(before) - F.col("n")).alias("offset"),
    )
    inside = Window.partitionBy("shard", "block").orderBy("doc_id", "text_crc32", "size")
    numbered = rows.withColumn("place", F.row_number().over(inside) - 1)
    return numbered.join(offsets, ["shard", "block"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col("offset") + F.col("place")).cast("long").alias("slot"),
        "grown_shard",
    )
