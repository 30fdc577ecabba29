"""Join helpers. No broadcast hints: Spark broadcasts by measured size only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .aggregates import sums as sums_of


def salted_inner_join(left: DataFrame, right: DataFrame, keys: Sequence[str], spread_by: Column,
                      hot_rows: int = 100_000) -> DataFrame:
    """Inner join that splits every left key of more than ``hot_rows`` rows.

    Each such key gets as many salts as tasks its rows need. Its left rows take one of them
    by ``spread_by``, its right rows are repeated once per salt; all other rows keep salt 0.
    The list of such keys has at most one row per ``hot_rows`` left rows. No row is lost
    or added, and NULL keys meet nothing, as in any inner join.
    """
    salts = F.ceil(F.col("_rows") / hot_rows).cast("int")
    hot = (left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
           .filter(F.col("_rows") > hot_rows).select(*keys, salts.alias("_salts")))
    one = F.coalesce(F.col("_salts"), F.lit(1))
    spread = left.join(hot, list(keys), "left").withColumn("_salt", F.pmod(F.xxhash64(spread_by), one).cast("int"))
    copied = right.join(hot, list(keys), "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), one - 1)))
    return spread.drop("_salts").join(copied.drop("_salts"), [*keys, "_salt"], "inner").drop("_salt")


def full_merge_sum(frames: Sequence[DataFrame], keys: Sequence[str],
                   sums: Sequence[str]) -> DataFrame:
    """N-way full join of keyed partial sums, as union plus one aggregate.

    Absent counters count as 0. One shuffle however many sides there are, and NULL
    keys meet like any other key.
    """
    padded = []
    for f in frames:
        own = set(f.columns)
        padded.append(f.select(*keys, *[
            F.expr(f"CAST({f'coalesce(`{c}`, 0)' if c in own else '0'} AS BIGINT) AS `{c}`") for c in sums]))
    union = padded[0]
    for f in padded[1:]:
        union = union.unionByName(f)
    return union.groupBy(*keys).agg(*sums_of(sums))


def prefer(first: DataFrame, second: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows of ``first`` plus the rows of ``second`` whose key ``first`` lacks."""
    known = first.select(*keys)
    return first.unionByName(second.join(known, list(keys), "left_anti"))
