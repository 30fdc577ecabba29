"""Active days of a key as one integer: bit n says whether it was active n days ago.

A mask answers "on how many of the last d days" for every d up to ``MASK_DAYS`` from one row, and the
mask of a day follows from that of an earlier day and the days in between.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import DateLike, as_date

MASK_DAYS = 30
_ALL = (1 << MASK_DAYS) - 1


def _low(days: int) -> int:
    if not 1 <= days <= MASK_DAYS:
        raise ValueError(f"a mask holds 1 to {MASK_DAYS} days, not {days}")
    return (1 << days) - 1


def _aged(bits: Column, days: Column | int) -> Column:
    """``bits`` as seen ``days`` later; what is older than the mask drops out."""
    age = F.lit(days) if isinstance(days, int) else days
    shifted = F.call_function("shiftleft", bits, age.cast("int")).bitwiseAND(F.lit(_ALL))
    return F.when(age < MASK_DAYS, shifted).otherwise(F.lit(0).cast("bigint"))


def advance(seen: DataFrame, keys: Sequence[str], date: DateLike, earlier: DataFrame | None = None,
            earlier_date: DateLike | None = None) -> DataFrame:
    """Masks of ``date``: columns ``ldate``, keys, ``mask`` (bigint, never 0).

    ``seen`` has an ``ldate`` and the keys, any number of rows per key and day. With the masks of an
    earlier date only the days after it are read, however long the gap; without, the last
    ``MASK_DAYS`` days. The bits are or-ed in one hash aggregate with a partial step before its shuffle.
    Days after ``date`` and a NULL ``ldate`` count for nothing; a NULL key is a key like others.
    """
    date = as_date(date)
    if (earlier is None) != (earlier_date is None):
        raise ValueError("earlier masks and their date go together")
    ago = F.datediff(F.lit(date), F.col("ldate"))
    span = MASK_DAYS
    if earlier_date is not None:
        gap = (date - as_date(earlier_date)).days
        if gap < 1:
            raise ValueError(f"masks of {earlier_date} are not earlier than {date}")
        span = min(gap, MASK_DAYS)
    first = F.date_sub(F.lit(date), span - 1)
    bits = (seen.filter(F.col("ldate").between(first, F.lit(date)))
            .select(*keys, _aged(F.lit(1).cast("bigint"), ago).alias("mask")))
    if earlier is not None:
        bits = bits.unionByName(earlier.select(*keys, _aged(F.col("mask"), gap).alias("mask")))
    masks = bits.groupBy(*keys).agg(F.bit_or("mask").alias("mask")).filter(F.col("mask") != 0)
    return masks.select(F.lit(date).alias("ldate"), *keys, "mask")


def days_active(days: int, mask: str = "mask") -> Column:
    """On how many of the last ``days`` days, the day of the mask included."""
    return F.bit_count(F.col(mask).bitwiseAND(F.lit(_low(days))))
