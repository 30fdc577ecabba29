"""Sharding by a hierarchical weighted hash tree.

A row descends region, rack and shard. At each level every child of the chosen node draws
``-ln(u) / weight`` with ``u`` hashed from the key and the child's name, and the smallest draw wins,
so children get rows in proportion to their weights. A changed weight changes the draws of its own
path only: rows move into or out of the subtrees whose weights changed and nowhere else. A new
shard that comes as a subtree of its own therefore only takes rows.

All of it is one projection. Slots (gapless numbers in a shard) are counted per shard and stored
file, and the files' counts are summed up, so no task holds a whole shard.

A NULL key is a key of its own. Rows are never dropped: repeated rows get the same shard and
different slots. Ties between draws go to the smaller child. An empty table gives no rows.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.registry import query, stored, table, text_or_empty


class Leaf(NamedTuple):
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def even_tree(shards: int, per_rack: int = 4, per_region: int = 8) -> list[Leaf]:
    """``shards`` equal shards in racks and regions."""
    return [Leaf(s // per_region, s // per_rack, s) for s in range(shards)]


def _draw(key: Column, node: str, weight: float) -> Column:
    """Exponential variate of rate ``weight``: the first of several wins in proportion to its rate."""
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(node), key), 11).cast("double") + 0.5) * 2.0 ** -53
    return -F.log(uniform) / weight


def _winner(key: Column, nodes: dict[int, tuple[str, float]]) -> Column:
    if len(nodes) == 1:
        return F.lit(next(iter(nodes)))
    draws = [F.struct(_draw(key, name, weight).alias("draw"), F.lit(child).alias("child"))
             for child, (name, weight) in sorted(nodes.items()) if weight > 0]
    return F.least(*draws)["child"] if len(draws) > 1 else draws[0]["child"]


def place(rows: DataFrame, key: Column, tree: list[Leaf], region: str = "region", rack: str = "rack",
          shard: str = "shard") -> DataFrame:
    """``rows`` with the region, rack and shard that the key descends to.

    The three names replace columns of the same names. Weights are not negative; a weight of 0 takes no rows.
    """
    key = F.coalesce(key.cast("string"), F.lit("\0null"))
    regions: dict[int, list[Leaf]] = {}
    racks: dict[tuple[int, int], list[Leaf]] = {}
    for leaf in tree:
        if leaf.weight > 0:
            regions.setdefault(leaf.region, []).append(leaf)
            racks.setdefault((leaf.region, leaf.rack), []).append(leaf)
    total = lambda leaves: sum(x.weight for x in leaves)
    out = rows.withColumn(region, _winner(key, {r: (f"region {r}", total(x)) for r, x in regions.items()}))

    def by_case(cases: list[tuple[Column, Column]]) -> Column:
        chosen = F.when(*cases[0])
        for condition, value in cases[1:]:
            chosen = chosen.when(condition, value)
        return chosen

    out = out.withColumn(rack, by_case([
        (F.col(region) == r, _winner(key, {k: (f"rack {r} {k}", total(x)) for (own, k), x in racks.items() if own == r}))
        for r in regions]))
    return out.withColumn(shard, by_case([
        ((F.col(region) == r) & (F.col(rack) == k), _winner(key, {x.shard: (f"shard {r} {k} {x.shard}", x.weight) for x in leaves}))
        for (r, k), leaves in racks.items()]))


def number_slots(rows: DataFrame, shard: str, order: list[str], slot: str = "slot") -> DataFrame:
    """``rows``, stored once, with gapless numbers from 0 within each shard."""
    kept = stored(rows, "shards").withColumn("file_", F.col("_metadata.file_path"))
    blocks = (kept.groupBy(shard, "file_").count()
              .withColumn("before_", F.sum("count").over(
                  Window.partitionBy(shard).orderBy("file_").rowsBetween(Window.unboundedPreceding, -1)))
              .select(F.col(shard).alias("shard_"), F.col("file_").alias("block_"), F.coalesce("before_", F.lit(0)).alias("before_")))
    within = F.row_number().over(Window.partitionBy(shard, "file_").orderBy(*order)) - 1
    numbered = kept.withColumn("within_", within)
    return (numbered.join(blocks, (numbered[shard] == blocks["shard_"]) & (numbered["file_"] == blocks["block_"]))
            .withColumn(slot, (F.col("before_") + F.col("within_")).cast("long"))
            .drop("file_", "within_", "shard_", "block_", "before_"))


@query("op10_sharding")
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = text_or_empty()
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("key").alias("law"))
    tree = even_tree(16)
    placed = place(rows, F.col("doc_id"), tree)
    grown = place(placed, F.col("doc_id"), [*tree, Leaf(2, 4, 16)], "grown_region", "grown_rack", "grown_shard")
    return number_slots(grown, "shard", ["doc_id", "text_crc32", "size"]).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "region", "rack")
