"""Hierarchical weighted hash tree: a shard for each key, by region, rack and shard draws."""

from __future__ import annotations

import dataclasses

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import discard, fits, materialize

#: Shards that the tree was first laid out for.
BASE = 8
#: Rows of a shard that are numbered in one block, on average.
BLOCK_ROWS = 16_384
#: 2 ** 52: a draw takes 13 hexadecimal digits of an MD5.
_DRAWS = float(16**13)


@dataclasses.dataclass(frozen=True)
class Node:
    """A node of the tree: an inner node has children, a leaf has a shard and a weight."""

    name: str
    children: tuple[Node, ...] = ()
    shard: int | None = None
    own: float = 1.0

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.own


def topology(shards: int, base: int = BASE, racks: int = 2, per_rack: int = 2, weights: dict[int, float] | None = None) -> Node:
    """The first ``base`` shards in regions of racks * per_rack; each later one in a region of its own.

    ``base`` is a fact of the deployment, the number of shards at first, and has
    to stay the same when shards are added: with the same base, a key moves only
    if the new region wins its first draw, so growth takes keys only into the
    new shard.  Fewer shards than base are refused, as no such tree could grow
    by that law.  Changing a weight moves keys only into, or out of, the
    subtrees that hold it.  Regions of one shard keep the law for single shards;
    the tree is flat for them, and their number adds a draw each.
    """
    if not 1 <= base <= shards:
        raise ValueError(f"a tree laid out for {base} shards can't have {shards}: give the number that there were at first as base")
    weights = weights or {}
    leaf = lambda s, path: Node(f"{path}/s{s}", shard=s, own=float(weights.get(s, 1.0)))
    regions = []
    for r, start in enumerate(range(0, base, racks * per_rack)):
        inside = range(start, min(base, start + racks * per_rack))
        kids = []
        for k, begin in enumerate(range(inside.start, inside.stop, per_rack)):
            path = f"r{r}/k{k}"
            kids.append(Node(path, tuple(leaf(s, path) for s in range(begin, min(inside.stop, begin + per_rack)))))
        regions.append(Node(f"r{r}", tuple(kids)))
    for s in range(base, shards):
        regions.append(Node(f"g{s}", (Node(f"g{s}/k0", (leaf(s, f"g{s}/k0"),)),)))
    return Node("root", tuple(regions))


def _draw(key: Column, node: Node) -> Column:
    """-ln(u) / weight for a uniform u in (0, 1) of this key and node: the least of siblings wins, with chances as the weights."""
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(node.name), key)), 1, 13)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(_DRAWS)
    return -F.log(u) / F.lit(node.weight)


def assign(key: Column, tree: Node) -> Column:
    """The shard of a key (cast to string): one weighted draw among the children of each node on the way down."""
    if not tree.children:
        return F.lit(tree.shard)
    if len(tree.children) == 1:
        return assign(key, tree.children[0])
    won = F.array_min(F.array(*[F.struct(_draw(key, c), F.lit(i)) for i, c in enumerate(tree.children)]))["col2"]
    out = F.when(won == 0, assign(key, tree.children[0]))
    for i, c in enumerate(tree.children[1:], 1):
        out = out.when(won == i, assign(key, c))
    return out


def shard_rows(docs: DataFrame, shards: int = BASE, id_col: str = "doc_id", text_col: str = "text", block_rows: int = BLOCK_ROWS, weights: dict[int, float] | None = None, base: int = BASE) -> DataFrame:
    """One row per input row: id_col, size, text_crc32, law, shard, slot, grown_shard.

    The law is ``key``: the id and the number of shards decide the shard, so a
    shard's share of rows follows its weight and equal texts with different ids
    may part.  size is the UTF-8 bytes of the text (null: none) plus 1.  slot
    numbers a shard's rows from 0 without gaps: rows fall at random into blocks
    whose number follows the table's row count, each block is numbered on its
    own and starts where the blocks before it end.  No block depends on ids or
    texts, so neither copies nor rows that share an id, or have none, meet in
    one.  A null id is a key of its own.  Rows that repeat an id go to one shard
    and get different slots.  Other columns are not looked at; an empty table
    gives an empty result.
    """
    key = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    blocks = 1 + docs.count() // (shards * block_rows)
    rows = docs.select(
        F.col(id_col).alias("_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        assign(key, topology(shards, base, weights=weights)).cast("int").alias("shard"),
        assign(key, topology(shards + 1, base, weights=weights)).cast("int").alias("grown_shard"),
        F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)).alias("_block"),
    )
    rows = materialize(rows, "assigned")  # blocks are counted and numbered from the same rows
    counts = rows.groupBy("shard", "_block").agg(F.count(F.lit(1)).alias("_n"))
    start = counts.withColumn("_start", F.sum("_n").over(W.partitionBy("shard").orderBy("_block").rowsBetween(W.unboundedPreceding, -1))).drop("_n")
    start = F.broadcast(start) if fits(shards * blocks) else start
    inside = F.row_number().over(W.partitionBy("shard", "_block").orderBy("_id", "text_crc32", "size")) - 1
    return rows.withColumn("_in", inside).join(start, ["shard", "_block"]).select(
        F.col("_id").alias(id_col), "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.coalesce("_start", F.lit(0)) + F.col("_in")).cast("long").alias("slot"), "grown_shard",
    )
