"""Exact distinct counts over sliding windows, from daily bitmaps that can be merged.

Members of a group get dense numbers, so a group of n members takes n / 32,768 bitmaps of 4 KB a
day whatever their ids are. A window is the union of its daily bitmaps; no member is read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .periods import Span
from .ranking import enumerate_sorted


def number_members(members: DataFrame, group: str, member: str, known: DataFrame | None = None) -> DataFrame:
    """``group``, ``member``, ``number`` (from 1, dense per group), one row per pair.

    Pairs in ``known`` keep their numbers, also when they are gone from ``members``, so that older
    bitmaps stay readable; new pairs are numbered after the greatest of their group. Numbering
    goes over sampled splitters, not a window per group: a group may hold a third of all members.
    Pairs with a NULL are left out.
    """
    pairs = members.select(group, member).filter(F.col(group).isNotNull() & F.col(member).isNotNull()).distinct()
    if known is None:
        return enumerate_sorted(pairs, [group], [F.asc(member)], "number").select(
            group, member, F.col("number").cast("bigint").alias("number"))
    known = known.select(group, member, "number")
    fresh = number_members(pairs.join(known, [group, member], "left_anti"), group, member)
    top = known.groupBy(group).agg(F.max("number").alias("_top"))
    fresh = fresh.join(top, group, "left").select(
        group, member, (F.col("number") + F.coalesce("_top", F.lit(0))).alias("number"))
    return known.unionByName(fresh)


def daily_bitmaps(seen: DataFrame, numbers: DataFrame, group: str, member: str) -> DataFrame:
    """Per (``ldate``, group, ``bucket``): the ``bitmap`` of the members seen that day.

    ``seen`` has ``ldate`` and the member, any number of rows of each. Rows meet in one hash aggregate
    by day and member before the join, so a member with a third of all rows costs one. Bitmaps are cut
    behind their last set bit: a group of ten takes two bytes a day.
    """
    once = seen.select("ldate", member).distinct()
    bits = once.join(numbers, member).select("ldate", group, F.bitmap_bucket_number("number").alias("bucket"),
                                             F.bitmap_bit_position("number").alias("_bit"))
    # dealt by their bitmap first, else each task would send 4 KB for every group it has a row of
    whole = (bits.repartition("ldate", group, "bucket").groupBy("ldate", group, "bucket")
             .agg(F.bitmap_construct_agg("_bit").alias("bitmap"), F.max("_bit").alias("_last")))
    used = F.expr("substring(bitmap, 1, CAST(_last DIV 8 AS INT) + 1)")
    return whole.select("ldate", group, "bucket", used.alias("bitmap"))


def sliding_distinct(bitmaps: DataFrame, group: str, span: Span, days: int, out: str) -> DataFrame:
    """Distinct members per (report date, group) over the trailing ``days`` of each report date.

    Reads one bitmap per group, bucket and day. Report dates are added as rows without a bitmap, and a
    range frame merges the bitmaps before each; only keys are repeated, never bitmaps. A
    window partition is one bucket of one group, at most two rows per day. Groups without a member
    in a window have no row.
    """
    rows = bitmaps.filter(span.covers(days)).select("ldate", group, "bucket", "bitmap")
    first = F.greatest("ldate", F.lit(span.start))
    last = F.least(F.date_add("ldate", days - 1), F.lit(span.end))
    dates = (rows.select(group, "bucket", F.explode(F.sequence(first, last)).alias("ldate")).distinct()
             .select("ldate", group, "bucket", F.lit(None).cast("binary").alias("bitmap"), F.lit(True).alias("_report")))
    both = rows.withColumn("_report", F.lit(False)).unionByName(dates)
    frame = (Window.partitionBy(group, "bucket").orderBy(F.unix_date("ldate")).rangeBetween(-(days - 1), 0))
    merged = both.withColumn("_merged", F.bitmap_or_agg(F.coalesce("bitmap", F.lit(bytearray(1)))).over(frame))
    return (merged.filter("_report").groupBy("ldate", group)
            .agg(F.sum(F.bitmap_count("_merged")).alias(out)))
