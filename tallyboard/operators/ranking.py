"""Ranking and enumeration inside groups, safe for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import cut_lineage


def top_n(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int,
          rank_col: str = "row_number") -> DataFrame:
    """First ``n`` rows of each group with their rank.

    Spark plans a window group limit for this shape: every task keeps at most ``n`` rows
    per group before the shuffle, so a group with a third of all rows stays small.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)


def enumerate_rows(df: DataFrame, group: Sequence[str], coarse: Sequence[tuple[str, bool]],
                   order: Sequence[Column], pos_col: str = "row_number") -> DataFrame:
    """1-based position of every row within its group.

    ``coarse`` lists (column, ascending) sort keys that agree with the start of ``order``:
    sorting by ``coarse`` then ``order`` must equal sorting by ``order``. Each
    (group, coarse) block is numbered on its own and shifted by the rows in the blocks
    before it, so no task ever sorts a whole group.
    """
    keys = [*group, *[c for c, _ in coarse]]
    # NULL keys become a flag and a value, so that windows and the join share one partitioning
    kinds = dict(df.dtypes)
    keyed = df.withColumns({f"_k{i}": _no_null(k, kinds[k]) for i, k in enumerate(keys)}
                           | {f"_n{i}": F.col(k).isNull() for i, k in enumerate(keys)})
    of_group = [f"_{x}{i}" for i in range(len(group)) for x in "kn"]
    of_block = [f"_{x}{i}" for i in range(len(keys)) for x in "kn"]
    by_block = []
    for i, (_, up) in enumerate(coarse, len(group)):
        by_block += [F.desc(f"_n{i}"), F.asc(f"_k{i}")] if up else [F.asc(f"_n{i}"), F.desc(f"_k{i}")]
    before = Window.partitionBy(*of_group).orderBy(*by_block).rowsBetween(Window.unboundedPreceding, -1)
    shift = (keyed.groupBy(*of_block).agg(F.count(F.lit(1)).alias("_n"))
             .withColumn("_shift", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"))
    local = F.row_number().over(Window.partitionBy(*of_block).orderBy(*order))
    return (keyed.withColumn("_local", local).join(shift, of_block)
            .withColumn(pos_col, (F.col("_shift") + F.col("_local")).cast("bigint"))
            .select(*[c for c in df.columns if c != pos_col], pos_col))


def _no_null(name: str, kind: str) -> Column:
    """The column with a value of its type in place of NULL."""
    column = F.col(name)
    if kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal"):
        return F.coalesce(column, F.lit(0).cast(kind))
    if kind in ("date", "timestamp", "timestamp_ntz"):
        return F.coalesce(column, F.lit("1970-01-01").cast(kind))
    return F.coalesce(column.cast("string"), F.lit(""))


def enumerate_sorted(df: DataFrame, group: Sequence[str], order: Sequence[Column], pos_col: str = "row_number",
                     partitions: int | None = None) -> DataFrame:
    """1-based position of every row within its group, whatever its groups and sort keys look like.

    The rows are range-partitioned by (group, order, arrival) at splitters that Spark samples from the data, so
    tasks get equal shares even where one group, hour or value holds nearly all rows. Each row notes its place in
    its partition; the rows that a group has in earlier partitions, one number per group and partition, are
    added. Rows equal in ``order`` are numbered as they come.
    """
    kinds = dict(df.dtypes)
    keyed = df.withColumns({f"_k{i}": _no_null(k, kinds[k]) for i, k in enumerate(group)}
                           | {f"_n{i}": F.col(k).isNull() for i, k in enumerate(group)})
    of_group = [f"_{x}{i}" for i in range(len(group)) for x in "kn"]
    keyed = keyed.withColumn("_run_arrival", F.monotonically_increasing_id())
    by = [*of_group, *order, "_run_arrival"]
    ranged = keyed.repartitionByRange(partitions, *by) if partitions else keyed.repartitionByRange(*by)
    placed = cut_lineage(ranged.sortWithinPartitions(*by).drop("_run_arrival").withColumn("_run_at", F.monotonically_increasing_id())
                         .withColumn("_run_part", F.shiftright("_run_at", 33)))
    runs = placed.groupBy("_run_part", *of_group).agg(F.min("_run_at").alias("_run_start"), F.count(F.lit(1)).alias("_run_rows"))
    earlier = Window.partitionBy(*of_group).orderBy("_run_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_run_before", F.coalesce(F.sum("_run_rows").over(earlier), F.lit(0))).drop("_run_rows")
    return (placed.join(runs, ["_run_part", *of_group])
            .withColumn(pos_col, (F.col("_run_at") - F.col("_run_start") + F.col("_run_before") + 1).cast("bigint"))
            .select(*[c for c in df.columns if c != pos_col], pos_col))


def enumerate_uniq(df: DataFrame, group: Sequence[str], value: str, pos: str,
                   out: str = "uniq_rank") -> DataFrame:
    """Running occurrence number of equal values, in position order."""
    return enumerate_sorted(df, [*group, value], [F.asc(pos)], out)


def enumerate_dense(df: DataFrame, group: Sequence[str], value: str, pos: str,
                    out: str = "dense_rank") -> DataFrame:
    """Index of each value by order of first appearance (not SQL ``dense_rank``)."""
    first = df.groupBy(*group, value).agg(F.min(pos).alias("_first"))
    ranked = enumerate_sorted(first, group, [F.asc("_first")], out)
    keys = [*group, value]
    ranked = ranked.select(*[F.col(k).alias(f"_v{i}") for i, k in enumerate(keys)], out)
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_v{i}"))
    return df.join(ranked, same).drop(*[f"_v{i}" for i in range(len(keys))])
