"""Aggregation shapes shared by metrics, backfills and audits."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sums(names: Iterable[str]) -> list[Column]:
    """``sum`` of each column under its own name."""
    return [F.expr(f"sum(`{n}`) AS `{n}`") for n in names]


def count_where(condition: Column, value: Column | None = None) -> Column:
    """Rows that meet ``condition``; with ``value``, only those where it is not NULL."""
    return F.count(F.when(condition, F.lit(1) if value is None else value))


def count_bank(df: DataFrame, keys: Sequence[str], bank: Mapping[str, Column],
               value: Column | None = None) -> DataFrame:
    """A pivot-like bank of conditional counts in one pass."""
    return df.groupBy(*keys).agg(*[count_where(c, value).alias(n) for n, c in bank.items()])


def users_with_days(df: DataFrame, keys: Sequence[str], user: str, day: str,
                    at_least: int, out: str) -> DataFrame:
    """Users per key active on ``at_least`` distinct days."""
    days = df.groupBy(*keys, user).agg(F.count_distinct(day).alias("_days"))
    return (days.filter(F.col("_days") >= at_least).groupBy(*keys)
            .agg(F.count(user).alias(out)))


def names_list(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Sorted array of the non-NULL values of each key (for keys with few values)."""
    return df.groupBy(*keys).agg(F.sort_array(F.collect_list(value)).alias(out))


def joined_text(df: DataFrame, keys: Sequence[str], value: str, out: str, sep: str = ",") -> DataFrame:
    """Comma list of the values of each key, sorted."""
    return names_list(df, keys, value, "_items").select(
        *keys, F.array_join("_items", sep).alias(out))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).filter(F.col("cnt") > 1)


def most_frequent(df: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` most frequent keys; ties by key."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("cnt"))
            .orderBy(F.desc("cnt"), F.asc(key)).limit(n))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its row count."""
    counted = [df.agg(F.count(F.lit(1)).alias("cnt")).select("cnt", F.lit(name).alias("tab"))
               for name, df in tables.items()]
    union = counted[0]
    for c in counted[1:]:
        union = union.unionByName(c)
    return union
