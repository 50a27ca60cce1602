"""Sharding by a hierarchical weighted hash tree (operator 7), DataFrame functions only.

A tree of regions, racks and shards. At every node a row draws for each child
an exponential variable, -ln(u) / weight, with u hashed from the row's key and
the child's name, and descends into the child with the smallest draw: each
child gets rows in proportion to its weight, and a change of one child's weight
moves rows only into or out of that child. A tree grows by a new region, so all
other draws stay as they are and the new shard takes rows only into itself.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexweave.llm.common import staged


@dataclass(frozen=True)
class Node:
    name: str
    weight: float = 1.0
    shard: int | None = None
    children: tuple[Node, ...] = field(default=())


def node(name: str, children: list[Node]) -> Node:
    return Node(name, sum(c.weight for c in children), None, tuple(children))


def tree(shards: int, per_region: int = 8, per_rack: int = 4) -> Node:
    """Shards 0 to shards - 1 of equal weight in racks and regions."""
    regions = []
    for region in range(0, shards, per_region):
        racks = []
        for rack in range(region, min(region + per_region, shards), per_rack):
            leaves = [Node(f"shard{s}", 1.0, s) for s in range(rack, min(rack + per_rack, region + per_region, shards))]
            racks.append(node(f"rack{rack // per_rack}", leaves))
        regions.append(node(f"region{region // per_region}", racks))
    return node("root", regions)


def grown(root: Node, shard: int, weight: float = 1.0) -> Node:
    """The tree with one more shard in a region of its own."""
    region = node(f"region-of-{shard}", [node(f"rack-of-{shard}", [Node(f"shard{shard}", weight, shard)])])
    return node(root.name, [*root.children, region])


def draw(key: Column, child: Node) -> Column:
    """An exponential draw of rate weight, from 52 bits of a hash of key and name."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(child.name), key), 12)
    return -F.log((bits.cast("double") + 0.5) / float(1 << 52)) / child.weight


def placed(key: Column, at: Node) -> Column:
    """The shard that key reaches from a node."""
    if at.shard is not None:
        return F.lit(at.shard)
    if len(at.children) == 1:
        return placed(key, at.children[0])
    first = F.array_min(F.array(*[F.struct(draw(key, c).alias("draw"), F.lit(i).alias("child")) for i, c in enumerate(at.children)]))["child"]
    if all(c.shard is not None for c in at.children):
        return F.element_at(F.array(*[F.lit(c.shard) for c in at.children]), first + 1)
    out = F.when(first == 0, placed(key, at.children[0]))
    for i, c in enumerate(at.children[1:], 1):
        out = out.when(first == i, placed(key, c))
    return out


def shard_by_key(docs: DataFrame, root: Node, more: Node, id_col: str = "doc_id", text_col: str = "text", buckets: int = 256) -> DataFrame:
    """Law `key`: rows (id, size, text_crc32, law, shard, slot, grown_shard).

    size is the UTF-8 bytes of the text plus 1 (null: 1), text_crc32 that of
    the text (null: of the empty one). The key alone decides, so equal texts
    stay together only under equal keys; null keys share one shard. Slots
    number a shard's rows from 0 without gaps, by hashed buckets and then key;
    a bucket is 1 of `buckets` parts of a shard, so no task sorts a whole
    shard. Repeated rows get different slots. An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text).alias("text_crc32"))
    rows = rows.select("*", placed(F.col("id"), root).alias("shard"), placed(F.col("id"), more).alias("grown_shard"), F.pmod(F.xxhash64("id", "text_crc32", F.lit("slot")), F.lit(buckets)).cast("int").alias("bucket"))
    rows = staged(rows)
    counts = rows.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("shard", "bucket", (F.sum("n").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("n")).alias("before"))
    inside = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("id", "text_crc32", "size"))
    # before has shards x buckets rows at most, two ints and a long each
    out = rows.select("*", inside.alias("nth")).join(F.broadcast(before), ["shard", "bucket"])
    return out.select(F.col("id").alias(id_col), "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("before") + F.col("nth") - 1).alias("slot"), "grown_shard")
