"""Sharding by a hierarchical weighted hash tree.

Each document descends from the root through regions and racks to a shard.  At every node each child draws a waiting
time and the shortest wins.  A shard draws ``-ln(u) / weight`` with a hash ``u`` of the document's id and the shard's
number; a rack or region draws the shortest time of what is below it, which is a draw with the summed weight, so every
child gets its share of the weight.  Times depend on nothing but the id and the shard: a change of one weight moves
documents only into or out of that subtree, and a new shard, wherever it is put, takes documents only into itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, tune

# Rows of one (shard, part) group, in which rows are numbered by one task.
PART_ROWS = 100_000

# Region name -> rack name -> shard number -> weight.
Tree = dict[str, dict[str, dict[int, float]]]


def even_tree(shards: int = 24, per_rack: int = 4, racks: int = 2) -> Tree:
    """``shards`` shards of weight 1, dealt in order: a rack is filled first, then the next rack, then the next region.

    The tree of n shards is that of n - 1 with one more, for any n.
    """
    tree: Tree = {}
    for shard in range(shards):
        region, rack = divmod(shard // per_rack, racks)
        tree.setdefault(f"region{region}", {}).setdefault(f"rack{rack}", {})[shard] = 1.0
    return tree


def grown_tree(tree: Tree, weight: float = 1.0) -> Tree:
    """The tree with one more shard, in a region and rack of its own."""
    shard = 1 + max(s for racks in tree.values() for shards in racks.values() for s in shards)
    return {**tree, f"region-of-{shard}": {"rack0": {shard: weight}}}


def _draw(key: Column, shard: int, weight: float) -> Column:
    # 53 hash bits in (0, 1]; null keys hash like the name alone.
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(f"shard{shard}")), 11) + F.lit(1)) * F.lit(2.0**-53)
    return F.struct((-F.log(u) / F.lit(float(weight))).alias("d"), F.lit(shard).alias("shard"))


def _shortest(draws: list[Column]) -> Column:
    """The child that wins; equal times go to the smaller shard."""
    return draws[0] if len(draws) == 1 else F.least(*draws)


def place(key: Column, tree: Tree) -> Column:
    """The shard of a key: of the regions the one with the shortest time, of its racks, of their shards."""
    regions = [
        _shortest([_shortest([_draw(key, s, w) for s, w in shards.items()]) for shards in racks.values()])
        for racks in tree.values()
    ]
    return _shortest(regions)["shard"].cast("int")


def assign_shards(df: DataFrame, tree: Tree | None = None, grown: Tree | None = None, id_col: str = "doc_id", text_col: str = "text", part_rows: int = PART_ROWS) -> DataFrame:
    """Per row: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    ``size`` is the text's UTF-8 bytes plus 8, ``slot`` numbers the rows of a shard from 0 without gaps, ``grown_shard`` is
    the shard in the tree with one more.  A null text has 0 bytes and checksum 0; null ids share one shard; rows that
    repeat an id share its shard and get slots of their own.  Only id, size and checksum are shuffled.
    """
    tune(df.sparkSession)
    tree = even_tree() if tree is None else tree
    grown = grown_tree(tree) if grown is None else grown
    text = F.coalesce(column(text_col), F.lit(""))
    key = column(id_col).cast("bigint")
    rows = df.select(
        key.alias("doc_id"), (F.octet_length(text) + 8).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        place(key, tree).alias("shard"), place(key, grown).alias("grown_shard"),
    )
    # A shard is cut into parts by a hash of the id, or of the checksum where many rows share one id.
    shards = sum(len(s) for racks in tree.values() for s in racks.values())
    parts = max(1, -(-df.count() // (shards * part_rows)))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "text_crc32", F.lit("part")), F.lit(parts)).cast("int"))
    counts = rows.groupBy("shard", "part").agg(F.count("*").alias("n"))
    starts = counts.selectExpr("shard", "part", "sum(n) over (partition by shard order by part) - n as start")
    ranked = rows.selectExpr("*", "row_number() over (partition by shard, part order by doc_id, text_crc32, size) - 1 as at")
    return ranked.join(starts, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("at") + F.col("start")).cast("bigint").alias("slot"), "grown_shard"
    )
