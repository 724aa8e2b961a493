"""Shards by a hierarchical weighted hash tree.

A tree has regions, regions have racks, racks have shards; a node weighs what the shards below it weigh.
A row descends level by level: of a node's children it takes the one with the least -ln(u) / weight, u being
a hash of the row's id and the child's path. A child's draw hangs on nothing but its own path and weight, so
a changed weight moves rows only into or out of that child, and above it only between its ancestors and
their siblings; elsewhere every row stays. A further shard opens a region of its own (`grown`), the one
subtree whose weight changes, so rows move into that shard and nowhere else (law `key`).

Slots number the rows of a shard from 0 by id: rows are dealt by range of (shard, id, place in the input),
sorted in their partition, and numbered by partition offset plus place, so no task holds a shard.

Defined cases: a NULL text has no bytes (size 1, CRC 0); rows with a NULL id count as one id, the empty one,
and share a shard, their slots come first; repeated rows get a slot each; texts, long ones too, are only
measured; an empty table gives no rows; equal texts have no say, other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from premiere.llm.common import let
from premiere.session import materialise

SLICE_ROWS = 1 << 20
_BITS = 52  # of a draw; 13 hex digits


class Shard(NamedTuple):
    region: int
    rack: int
    shard: int
    weight: float = 1.0


Tree = Sequence[Shard]


def even_tree(shards: int, per_rack: int = 2, racks: int = 2) -> list[Shard]:
    """Shards of weight 1, `per_rack` to a rack and `racks` racks to a region."""
    return [Shard(s // (per_rack * racks), s // per_rack, s) for s in range(shards)]


def grown(tree: Tree, weight: float = 1.0) -> list[Shard]:
    """The tree and one more shard, in a region and rack of its own."""
    own = Shard(*(max((getattr(s, level) for s in tree), default=-1) + 1 for level in ("region", "rack", "shard")), weight)
    return [*tree, own]


def _levels(tree: Tree) -> list[dict[tuple[str, str, int], float]]:
    """Per level the weights of (parent's path, own path, shard); weightless nodes are left out."""
    levels: list[dict[tuple[str, str, int], float]] = [{}, {}, {}]
    for s in tree:
        if s.weight <= 0:
            continue
        paths = ["", f"{s.region}", f"{s.region}/{s.rack}", f"{s.region}/{s.rack}/{s.shard}"]
        for level, nodes in enumerate(levels):
            node = (paths[level], paths[level + 1], s.shard if level == 2 else -1)
            nodes[node] = nodes.get(node, 0.0) + s.weight
    return levels


def shard_of(key: Column, tree: Tree) -> Column:
    """The shard number a key descends to; a tree without weight gives NULL."""
    text = F.coalesce(key.cast("string"), F.lit(""))

    def draw(node: Column) -> Column:
        digits = F.substring(F.md5(F.concat(text, F.lit("|"), node["path"]).cast("binary")), 1, _BITS // 4)
        u = (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(1 << _BITS))
        return F.struct((-F.log(u) / node["weight"]).alias("draw"), node["path"].alias("path"), node["shard"].alias("shard"))

    def least(nodes: Column, parent: Column) -> Column:
        return F.array_min(F.transform(F.filter(nodes, lambda n: n["parent"] == parent), draw))

    at = F.lit("")
    for nodes in _levels(tree):
        if not nodes:
            return F.lit(None).cast("int")
        listed = F.array(
            *(
                F.struct(F.lit(p).alias("parent"), F.lit(n).alias("path"), F.lit(s).alias("shard"), F.lit(w).alias("weight"))
                for (p, n, s), w in sorted(nodes.items())
            )
        )
        chosen = let(at, partial(least, listed))
        at = chosen["path"]
    return chosen["shard"]


def with_slots(rows: DataFrame) -> DataFrame:
    """Rows with `slot`, their number within `shard` by doc_id. Runs jobs when called; the rows are written.

    `rows` must be the same when read again, as a written table is.
    """
    spark = rows.sparkSession
    slices = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows.count() // SLICE_ROWS)
    order = ["shard", "doc_id", "row"]
    ranged = rows.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(slices, *order)
    # The id counts on within a partition and holds the partition's number in its upper bits.
    placed = materialise(ranged.sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "slots")
    slice_of = F.shiftright("at", 33)
    parts = placed.groupBy("shard", slice_of.alias("slice")).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    # One row per shard and slice of 2^20 rows.
    before = F.expr("coalesce(sum(n) OVER (PARTITION BY shard ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)")
    offsets = parts.select("shard", "slice", (before - F.col("first")).alias("shift"))
    joined = placed.withColumn("slice", slice_of).join(offsets, ["shard", "slice"])
    return joined.withColumn("slot", F.col("at") + F.col("shift")).drop("slice", "shift", "at", "row")


def shard_documents(docs: DataFrame, tree: Tree, later: Tree | None = None) -> DataFrame:
    """Every row's id, size, CRC-32, shard and slot, and its shard in the tree that comes `later`."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    measured = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        shard_of(F.col("doc_id"), tree).alias("shard"),
        shard_of(F.col("doc_id"), later if later is not None else tree).alias("grown_shard"),
    )
    return with_slots(materialise(measured, "measured"))
