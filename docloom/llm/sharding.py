"""Hierarchical weighted hash tree: a descent through region, rack and shard levels by weighted hash draws.

A node of the tree has the weight of all shards below it. At each node that a document reaches, every child draws an
exponential variate with its weight as rate, from a digest of the document's key and the child's path, and the least
draw wins: a child is taken with the share of its weight. The descent draws for the children of the nodes on its way
alone, so its cost grows with depth and width, not with the number of shards. Changing a weight changes the draws of
that node and of those above it only: documents move out of or into subtrees whose weights change, and nowhere else.
A new shard in a region of its own, as ``topology`` adds one when its regions are full, takes documents only into
itself; in a region with others, documents that move into that region may come to any of its shards.

The tree is a small literal table (a list of children for each node); draws are native expressions over it.

Defined results: null text has size 1, a very long one its bytes and 1; a null doc_id is a key of its own; repeated rows
go to one shard and get slots of their own; slots follow a digest of id, text checksum and size, and equal rows take
slots side by side; ties of two draws go to the child that stands first; an empty table gives an empty result; other
columns, whatever their names, are ignored.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docloom.llm.common import materialize, number_copies


@dataclass(frozen=True)
class Leaf:
    """A shard with its place in the tree."""

    region: str
    rack: str
    shard: int
    weight: float = 1.0


def topology(shards: int, per_rack: int = 2, racks: int = 4) -> list[Leaf]:
    """Shards 0 to ``shards`` - 1, filling racks and regions in order, with equal weights."""
    return [Leaf(f"region{s // (per_rack * racks)}", f"rack{s // per_rack % racks}", s) for s in range(shards)]


Node = list[tuple[str, float, int, int]]


def tree(leaves: list[Leaf]) -> list[Node]:
    """Nodes from the root (0) on, each a list of children: path, weight, own number (-1: a shard), shard (-1: an inner node).

    Shards without weight, and what holds no others, are left out.
    """
    below: dict[str, dict[str, list[Leaf]]] = {}
    for x in leaves:
        if x.weight > 0:
            below.setdefault(x.region, {}).setdefault(x.rack, []).append(x)
    nodes: list[Node] = [[]]
    for region, racks in below.items():
        at = len(nodes)
        nodes.append([])
        nodes[0].append((region, sum(x.weight for some in racks.values() for x in some), at, -1))
        for rack, some in racks.items():
            nodes[at].append((f"{region}/{rack}", sum(x.weight for x in some), len(nodes), -1))
            nodes.append([(f"{region}/{rack}/{x.shard}", x.weight, -1, x.shard) for x in some])
    return nodes


DEPTH = 3


def placement(key: Column, leaves: list[Leaf]) -> Column:
    """struct(..., path, shard) of the leaf that the descent reaches (null: there is none); only native expressions."""
    nodes = tree(leaves)
    kind = "array<array<struct<path: string, weight: double, node: int, shard: int>>>"
    rows = [[{"path": p, "weight": float(w), "node": n, "shard": s} for p, w, n, s in node] for node in nodes]
    table = F.from_json(F.lit(json.dumps(rows)), kind)  # folded to one literal by the optimizer

    def draw(child: Column) -> Column:
        bits = F.conv(F.substring(F.md5(F.concat(key, F.lit("/"), child["path"])), 1, 13), 16, 10).cast("double")
        return -F.log((bits + 1.0) / float(2**52 + 1)) / child["weight"]

    def descend(number: Column) -> Column:
        drawn = F.transform(F.get(table, number), lambda c, i: F.struct(draw(c).alias("draw"), i.alias("i"), c["path"].alias("path"), c["node"].alias("node"), c["shard"].alias("shard")))
        return F.array_min(drawn)  # the least draw, then the first child

    at = F.lit(0)
    for _ in range(DEPTH - 1):
        at = descend(at)["node"]
    return descend(at)


def shard_documents(docs: DataFrame, leaves: list[Leaf], grown: list[Leaf], rows_per_bucket: int = 50_000) -> DataFrame:
    """doc_id, size, text_crc32, law, region, rack, shard, slot (gapless in each shard), grown_shard."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.encode(F.coalesce("text", F.lit("")), "utf-8")).alias("text_crc32"),
        F.lit("key").alias("law"),
        placement(key, leaves).alias("at"),
        placement(key, grown)["shard"].alias("grown_shard"),
    )
    path = F.split("at.path", "/")
    rows = rows.select("doc_id", "size", "text_crc32", "law", F.get(path, F.lit(0)).alias("region"), F.get(path, F.lit(1)).alias("rack"), F.col("at.shard").alias("shard"), "grown_shard")
    # equal rows become one with its count before they are shuffled by a key, and take slots side by side
    once = materialize(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies")), "shards")
    n = max(1, -(-once.count() // rows_per_bucket))
    told = F.concat_ws("/", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("text_crc32").cast("string"), F.col("size").cast("string"))
    dealt = once.withColumn("_key", F.md5(told)).withColumn("_bucket", F.floor(F.conv(F.substring("_key", 1, 12), 16, 10).cast("double") / float(16**12) * n).cast("long"))
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = dealt.groupBy("shard", "_bucket").agg(F.sum("copies").alias("_n")).withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = Window.partitionBy("shard", "_bucket").orderBy("_key").rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("_place", F.coalesce(F.sum("copies").over(inside), F.lit(0))).join(base, ["shard", "_bucket"])
    outer, inner = number_copies(F.col("copies"))
    each = placed.withColumn("_chunk", outer).withColumn("_copy", inner)
    return each.select(*rows.columns, (F.col("_base") + F.col("_place") + F.col("_copy")).cast("long").alias("slot"))
