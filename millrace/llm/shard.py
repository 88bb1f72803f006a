"""Sharding by a hierarchical weighted hash tree, in DataFrame functions alone.

A row descends region, rack and shard. At each level every child draws -ln(u) / weight, with u from a hash of the row's
key and the child's name; the least draw wins. A child's draw depends on its own name and weight only, so a change of
weight moves rows into or out of that subtree and no others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Tree = list[list[int]]  # regions of racks of a number of shards
BASE: Tree = [[4, 4, 4], [4, 4, 4]]
DIGITS = 13  # hexadecimal digits of a draw


def tree(shards: int, base: Tree = BASE) -> Tree:
    """The base tree; each shard beyond it is a region of its own until the tree is laid out anew, so that it takes rows
    only into itself."""
    held = sum(map(sum, base))
    if shards < held:
        raise ValueError(f"the base tree has {held} shards")
    return [list(region) for region in base] + [[1]] * (shards - held)


def _draw(key: Column, name: str, weight: int) -> Column:
    digits = F.conv(F.substring(F.md5(F.concat(key, F.lit(name))), 1, DIGITS), 16, 10).cast("double")
    return -F.log((digits + 0.5) / float(16**DIGITS)) / float(weight)


def _descend(key: Column, node, name: str, first: int) -> tuple[Column, int]:
    """The shard under a node, and the number after its last shard. node: a number of shards, or a list of nodes."""
    if isinstance(node, list):
        weights = [sum(map(sum, x)) if x and isinstance(x, list) and isinstance(x[0], list) else sum(x) if isinstance(x, list) else x
                   for x in node]
        below = []
        for k, child in enumerate(node):
            column, first = _descend(key, child, f"{name}.{k}", first)
            below.append(column)
    else:
        weights, below = [1] * node, [F.lit(first + k) for k in range(node)]
        first += node
    if len(below) == 1:
        return below[0], first
    draws = [_draw(key, f"{name}.{k}", w) for k, w in enumerate(weights)]
    least = F.array_min(F.array(*[F.struct(d.alias("draw"), F.lit(k).alias("k")) for k, d in enumerate(draws)]))["k"]
    return F.element_at(F.array(*below), least + 1) if not isinstance(node, list) else _pick(least, below), first


def _pick(chosen: Column, below: list[Column]) -> Column:
    out = F.when(chosen == 0, below[0])
    for k, column in enumerate(below[1:-1], 1):
        out = out.when(chosen == k, column)
    return out.otherwise(below[-1])


def shard_of(key: Column, layout: Tree) -> Column:
    """The shard number of a key (text), counted from 0 in the order of the tree."""
    return _descend(key, layout, "t", 0)[0]


def shard(docs: DataFrame, shards: int = 24, base: Tree = BASE) -> DataFrame:
    """Per row of docs: doc_id, size (UTF-8 bytes and 8), text_crc32, law ('key'), shard, slot (0, 1, … in its shard),
    grown_shard (with one more shard).

    doc_id alone decides the shard; rows that share an id share it, and rows without an id go where the empty key goes.
    A null text has no bytes. Slots go by a hash of the id, then id, checksum and size, so equal rows are interchangeable.
    An empty table gives an empty one. Only doc_id and text are looked at."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(
        "doc_id", (F.length(raw) + 8).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"),
        F.lit("key").alias("law"), shard_of(key, tree(shards, base)).alias("shard"),
        shard_of(key, tree(shards + 1, base)).alias("grown_shard"),
        F.conv(F.substring(F.md5(key), 1, 3), 16, 10).cast("int").alias("part"))
    # a shard is counted off in parts, so that no task orders a whole shard
    parts = rows.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "before", F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")).drop("n")
    order = Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32", "size")
    return rows.withColumn("k", F.row_number().over(order)).join(parts, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", "law", "shard", (F.col("before") + F.col("k") - 1).alias("slot"), "grown_shard")
