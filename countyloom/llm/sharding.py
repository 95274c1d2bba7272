"""Shards from a hierarchical weighted hash tree."""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countyloom.llm.common import number_rows


@dataclass(frozen=True)
class Leaf:
    """One shard: where it stands and how much it should get."""

    region: str
    rack: str
    shard: int
    weight: float = 1.0


def topology(shards: int, per_rack: int = 2, racks: int = 2, base: int = 8) -> tuple[Leaf, ...]:
    """`base` shards in full racks and regions; each further shard stands in a region of its own (see `grow`)."""
    leaves = tuple(Leaf(f"r{s // (per_rack * racks)}", f"k{s // per_rack}", s) for s in range(min(shards, base)))
    while len(leaves) < shards:
        leaves = grow(leaves)
    return leaves


def grow(leaves: tuple[Leaf, ...], weight: float = 1.0) -> tuple[Leaf, ...]:
    """One more shard, in a region of its own: no other subtree's weight changes, so rows move only into the new shard."""
    shard = max((leaf.shard for leaf in leaves), default=-1) + 1
    return (*leaves, Leaf(f"g{shard}", f"g{shard}", shard, weight))


def place(key: Column, leaves: tuple[Leaf, ...]) -> Column:
    """The shard of each key: three descents, each to the child with the least weighted hash draw.

    A child's draw is an exponential variable from the hash of key and child, divided by the weight of the child's whole
    subtree. Draws of different children are independent and a draw depends on its own child alone, so a changed weight
    moves rows only into or out of that child's subtree.
    """
    children: dict[str, dict[str, float]] = defaultdict(lambda: defaultdict(float))
    shard_of = {}
    for leaf in leaves:
        if leaf.weight <= 0:
            continue
        region, rack = leaf.region, f"{leaf.region}/{leaf.rack}"
        path = f"{rack}/{leaf.shard}"
        if path in shard_of:
            raise ValueError(f"shard {path} is given twice")
        shard_of[path] = leaf.shard
        children[""][region] += leaf.weight
        children[region][rack] += leaf.weight
        children[rack][path] += leaf.weight
    if not shard_of:
        raise ValueError("no shard has a positive weight")
    items = []
    for node, below in sorted(children.items()):
        items += [F.lit(node), F.array(*[F.struct(F.lit(n).alias("node"), F.lit(w).alias("weight")) for n, w in sorted(below.items())])]
    tree = F.create_map(*items)

    def draw(child: Column) -> Column:
        unit = (F.shiftrightunsigned(F.xxhash64(key, child["node"]), 11).cast("double") + 0.5) / F.lit(2.0**53)
        return F.struct((-F.log(unit) / child["weight"]).alias("draw"), child["node"].alias("node"))

    node = F.lit("")
    for _ in range(3):
        node = F.array_min(F.transform(F.element_at(tree, node), draw))["node"]
    return F.element_at(F.create_map(*[F.lit(x) for pair in sorted(shard_of.items()) for x in pair]), node)


def shard_documents(docs: DataFrame, leaves: tuple[Leaf, ...], grown: tuple[Leaf, ...]) -> DataFrame:
    """Every row's shard, its gapless slot there, and its shard in the grown tree.

    A null text has size 1 and the checksum of no bytes; a null doc_id is a key like any other; repeated rows get slots
    of their own. An empty table gives no rows. Only doc_id and text are read.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"),
        place(key, leaves).alias("shard"),
        place(key, grown).alias("grown_shard"),
    )
    return number_rows(rows, "shard", ["doc_id", "size", "text_crc32"], "slot").select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )
