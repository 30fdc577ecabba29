"""Bucketed tables: roll-ups and dimensions laid out by user, so that their joins move nothing.

Two tables of one :class:`Layout` (the same keys and number of buckets) are joined on these keys bucket by
bucket, and an aggregate by them needs no shuffle either. A join with another layout would silently shuffle one
side again, so tables are read through :func:`read_bucketed`, which refuses it; :func:`rebucket` makes a copy that fits.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKET_BYTES = 256 * 1024 * 1024


class Layout(NamedTuple):
    buckets: int
    keys: tuple[str, ...]


def layout_for(size: int, keys: Sequence[str], bucket_bytes: int = BUCKET_BYTES) -> Layout:
    """A power of two of buckets of about ``bucket_bytes`` for ``size`` bytes, so that layouts of different age divide one another."""
    return Layout(1 << max(0, math.ceil(math.log2(max(1, size / bucket_bytes)))), tuple(keys))


def layout_of(spark: SparkSession, table: str) -> Layout | None:
    """Layout of a table, None where it has no buckets."""
    said = {r["col_name"].strip(): r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    if "Num Buckets" not in said:
        return None
    keys = said["Bucket Columns"].strip("[]").split(",")
    return Layout(int(said["Num Buckets"]), tuple(k.strip().strip("`") for k in keys))


def _dealt(df: DataFrame, layout: Layout) -> DataFrame:
    """Rows as their buckets lie, so that each task writes the files of one bucket only."""
    return df.repartition(layout.buckets, *layout.keys)


def write_bucketed(df: DataFrame, table: str, path: str, layout: Layout, by_day: bool = False) -> None:
    """Create ``table`` at ``path``, sorted by its keys within each bucket; ``by_day`` partitions it by ``ldate`` besides."""
    writer = _dealt(df, layout).write.mode("overwrite").format("parquet").option("path", path)
    if by_day:
        writer = writer.partitionBy("ldate")
    writer.bucketBy(layout.buckets, *layout.keys).sortBy(*layout.keys).saveAsTable(table)


def replace_days(df: DataFrame, table: str) -> None:
    """Replace the days that ``df`` has rows for in a bucketed table partitioned by day."""
    spark = df.sparkSession
    layout = layout_of(spark, table)
    if layout is None:
        raise ValueError(f"{table} has no buckets")
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        _dealt(df, layout).select(*spark.table(table).columns).write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(key, before)


def read_bucketed(spark: SparkSession, table: str, layout: Layout) -> DataFrame:
    """Rows of a table of this layout; another one is refused."""
    own = layout_of(spark, table)
    if own != layout:
        raise ValueError(f"{table} has {own or 'no buckets'}, wanted {layout}: rebucket it")
    df = spark.table(table)
    return df.withColumn("ldate", F.col("ldate").cast("date")) if dict(df.dtypes).get("ldate") == "string" else df


def rebucket(spark: SparkSession, table: str, target: str, path: str, layout: Layout) -> None:
    """Copy ``table`` to ``target`` with another layout."""
    days = any(c.name == "ldate" and c.isPartition for c in spark.catalog.listColumns(table))
    write_bucketed(spark.table(table), target, path, layout, by_day=days)
