"""Sharding by a hierarchical weighted hash tree.

A document descends region, rack and shard: at each node every child draws ln(u) / weight,
with u in (0, 1) a hash of the document's id and the child's name, and the largest draw wins.
A child's share is its share of the weights. When a weight grows, its child can only win more
often, so documents move into that subtree and nowhere else; a new shard that opens a region
of its own therefore takes documents only into itself.

The law is ``key``: the id and the tree decide, whatever else is in the table. Everything is
DataFrame expressions on ids, sizes and checksums; texts are never shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Regions and racks that a layout's first shards are dealt to in turn.
REGIONS, RACKS = 3, 4
#: Bits of the row hash that name a numbering block; 2 ** bits blocks for each shard.
BLOCK_BITS = 12
#: Repeated rows that one array lists.
RUN = 1 << 16


@dataclass(frozen=True)
class Leaf:
    """A shard's place and weight (over 0)."""

    shard: int
    region: str
    rack: str
    weight: float = 1.0


def layout(shards: int, extra: int = 0, regions: int = REGIONS, racks: int = RACKS) -> list[Leaf]:
    """``shards`` equal shards dealt to the racks in turn, and ``extra`` later ones, each in a
    region of its own, so that every later one takes documents only into itself."""
    if shards <= 0 or extra < 0:
        raise ValueError("at least one shard is needed, and no negative number of later ones")
    first = [Leaf(s, f"r{s % regions}", f"r{s % regions}/k{s // regions % racks}") for s in range(shards)]
    return first + [Leaf(s, f"own{s}", f"own{s}/k0") for s in range(shards, shards + extra)]


def _children(leaves: list[Leaf]) -> list[dict[str, list[tuple[str, float]]]]:
    """For each level, the children and their weights of every node."""
    levels: list[dict[str, dict[str, float]]] = [{}, {}, {}]
    for x in leaves:
        if not x.weight > 0:
            raise ValueError(f"shard {x.shard} has no positive weight")
        for level, (parent, child) in enumerate((("", x.region), (x.region, x.rack), (x.rack, str(x.shard)))):
            node = levels[level].setdefault(parent, {})
            node[child] = node.get(child, 0.0) + x.weight
    return [{p: sorted(c.items()) for p, c in level.items()} for level in levels]


def _draw(key: Column, name: Column, weight: Column) -> Column:
    """ln(u) / weight with u from the top 53 bits of xxhash64 of ``key|name`` (seed 42)."""
    top = F.shiftrightunsigned(F.xxhash64(F.concat(key, F.lit("|"), name)), 11)
    return F.ln((top.cast("double") + 0.5) / float(1 << 53)) / weight


def place(key: Column, leaves: list[Leaf]) -> Column:
    """The shard of a key (a string column): three descents through the tree."""
    node = F.lit("")
    for level in _children(leaves):
        nodes = F.create_map(*[x for parent, kids in level.items() for x in (
            F.lit(parent), F.array(*[F.struct(F.lit(c).alias("name"), F.lit(w).alias("weight"))
                                     for c, w in kids]))])
        kids = F.element_at(nodes, node)
        drawn = F.transform(kids, lambda c: F.struct(_draw(key, c["name"], c["weight"]).alias("draw"),
                                                     c["name"].alias("name")))
        node = F.array_max(drawn)["name"]
    return node.cast("int")


def shard(docs: DataFrame, leaves: list[Leaf], grown: list[Leaf] | None = None, *,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``size`` (UTF-8 bytes of the text plus 8), ``text_crc32``, ``law`` (key),
    ``shard``, ``slot`` (gapless from 0 within a shard) and ``grown_shard`` (the shard under
    ``grown``; null without it).

    A null id is a key of its own; a null text has no bytes, size 8 and checksum 0; rows that
    are equal in id, size and checksum get neighbouring slots; other columns are ignored; an
    empty table gives no rows. Slots follow a hash of the row, so they are the same in every
    run. Equal rows are counted before the shuffle and listed again after it, and blocks of a
    shard are numbered apart, so neither a hot id nor a large shard meets in one task.
    """
    data = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       (F.octet_length(data) + 8).cast("long").alias("size"),
                       F.crc32(data).alias("text_crc32"))
    counted = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("n"))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    placed = counted.withColumns({
        "shard": place(key, leaves),
        "grown_shard": place(key, grown) if grown else F.lit(None).cast("int"),
        "h": F.xxhash64("doc_id", "size", "text_crc32")})
    placed = placed.withColumn("block", F.shiftrightunsigned("h", 64 - BLOCK_BITS).cast("int"))
    # One row per block: at most 2 ** BLOCK_BITS for each shard, whatever the table.
    upto = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (placed.groupBy("shard", "block").agg(F.sum("n").alias("size"))
              .select("shard", "block", F.coalesce(F.sum("size").over(upto), F.lit(0)).alias("before")))
    within = (Window.partitionBy("shard", "block").orderBy("h", "doc_id", "size", "text_crc32")
              .rowsBetween(Window.unboundedPreceding, -1))
    first = placed.withColumn("first", F.coalesce(F.sum("n").over(within), F.lit(0)))
    runs = (first.join(blocks, ["shard", "block"], "left")
            .withColumn("first", F.col("first") + F.col("before"))
            .withColumn("run", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / RUN)))))
    each = F.sequence(F.col("run") * RUN, F.least(F.col("n"), (F.col("run") + 1) * RUN) - 1)
    return (runs.withColumn("k", F.explode(each))
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    (F.col("first") + F.col("k")).cast("long").alias("slot"), "grown_shard"))
