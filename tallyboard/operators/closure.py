"""Ancestor closure of a directed graph by semi-naive frontier joins."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import cut_and_count, cut_lineage


def ancestors(seeds: DataFrame, edges: DataFrame, max_depth: int | None = None) -> DataFrame:
    """All (seed, ancestor) pairs, the seed itself included.

    ``seeds``: column ``node``; ``edges``: columns ``node``, ``parent`` (any type that
    can be compared, a struct for compound ids). Each round joins only the pairs found
    in the last round, drops pairs seen before (so cycles end, and so does the loop) and is
    written once to durable storage, so a lost executor does not replay the loop.
    ``max_depth`` makes a longer chain an error.
    """
    frontier = cut_lineage(seeds.select(F.col("node").alias("seed"), F.col("node").alias("anc"))
                           .distinct())
    found = frontier
    edges = cut_lineage(edges.select("node", "parent").distinct())  # scanned once, not per round
    depth = 0
    while max_depth is None or depth < max_depth:
        step = (frontier.join(edges, F.col("anc") == F.col("node"))
                .select("seed", F.col("parent").alias("anc")).distinct())
        frontier, rows = cut_and_count(step.join(found, ["seed", "anc"], "left_anti"))
        if not rows:
            return found
        found, depth = found.unionByName(frontier), depth + 1
    raise ValueError(f"graph is deeper than max_depth={max_depth}")


class ClosureChange(NamedTuple):
    """The maintained pairs, and how they differ from the earlier ones."""

    pairs: DataFrame
    removed: DataFrame
    added: DataFrame


def _grow(frontier: DataFrame, edges: DataFrame, known: DataFrame) -> DataFrame:
    """All pairs reached from ``frontier`` that are not in ``known``, the frontier included."""
    found = frontier
    while True:
        step = (frontier.join(edges, F.col("anc") == F.col("node"))
                .select("seed", F.col("parent").alias("anc")).distinct())
        frontier, rows = cut_and_count(step.join(known, ["seed", "anc"], "left_anti")
                                       .join(found, ["seed", "anc"], "left_anti"))
        if not rows:
            return found
        found = found.unionByName(frontier)


def maintain(pairs: DataFrame, seeds: DataFrame, old_edges: DataFrame, new_edges: DataFrame) -> ClosureChange:
    """The (seed, ancestor) pairs after a change of edges and seeds, by delete and rederive.

    ``pairs``: what ``ancestors`` gave for the old edges; the result is what it gives for ``seeds``
    (column ``node``) and the new edges, cycles included. Four steps, each on what is affected:

    1. Delete every pair that may have used a removed edge: seeds below its lower end, with all that was
       above its upper end. Pairs of seeds that are gone go as well.
    2. Of these bring back what one new edge gives from a pair that was left, round by round.
    3. Add what the added edges give to the seeds below them, round by round.
    4. New seeds get their closure from the new edges.

    Rounds join the pairs of the last round only and are written once, as in ``ancestors``. What was
    neither deleted nor added is read by semi-joins and never derived again. The edges are compared
    whole; NULL nodes and parents link nothing.
    """
    known_ends = F.col("node").isNotNull() & F.col("parent").isNotNull()
    old = cut_lineage(old_edges.select("node", "parent").filter(known_ends).distinct())
    new = cut_lineage(new_edges.select("node", "parent").filter(known_ends).distinct())
    seeds = cut_lineage(seeds.select(F.col("node").alias("seed")).distinct())
    gone = cut_lineage(old.join(new, ["node", "parent"], "left_anti"))
    come = cut_lineage(new.join(old, ["node", "parent"], "left_anti"))
    pairs = pairs.select("seed", "anc")
    # a seed that never was one has no pair with itself
    fresh = cut_lineage(seeds.join(pairs.filter(F.col("seed") == F.col("anc")).select("seed"), "seed", "left_anti"))
    dropped = pairs.join(seeds, "seed", "left_anti")
    kept = pairs.join(seeds, "seed", "left_semi")

    lost = (kept.join(gone, F.col("anc") == F.col("node")).select("seed", F.col("parent").alias("top")).distinct())
    above = ancestors(gone.select(F.col("parent").alias("node")), old)
    doubtful = cut_lineage(lost.join(above.select(F.col("seed").alias("top"), "anc"), "top")
                           .filter(F.col("seed") != F.col("anc")).select("seed", "anc").distinct()
                           .join(kept, ["seed", "anc"], "left_semi"))
    sure = kept.join(doubtful, ["seed", "anc"], "left_anti")
    ways = cut_lineage(doubtful.join(new, F.col("anc") == F.col("parent"))
                       .select("seed", F.col("node").alias("via"), "anc"))
    back, rows = cut_and_count(ways.join(sure.select("seed", F.col("anc").alias("via")), ["seed", "via"], "left_semi")
                               .select("seed", "anc").distinct())
    frontier = back
    while rows:
        step = (ways.join(frontier.select("seed", F.col("anc").alias("via")), ["seed", "via"], "left_semi")
                .select("seed", "anc").distinct())
        frontier, rows = cut_and_count(step.join(back, ["seed", "anc"], "left_anti"))
        back = back.unionByName(frontier)
    left = cut_lineage(sure.unionByName(back))

    started = cut_lineage(left.join(come, F.col("anc") == F.col("node"))
                          .select("seed", F.col("parent").alias("anc")).distinct()
                          .join(left, ["seed", "anc"], "left_anti"))
    grown = _grow(started, new, left).unionByName(ancestors(fresh.select(F.col("seed").alias("node")), new))
    # a pair may be deleted for one edge and come back through an added one
    added = cut_lineage(grown.join(doubtful, ["seed", "anc"], "left_anti"))
    removed = cut_lineage(dropped.unionByName(
        doubtful.join(back, ["seed", "anc"], "left_anti").join(grown, ["seed", "anc"], "left_anti")))
    return ClosureChange(left.unionByName(grown), removed, added)
