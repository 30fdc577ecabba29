"""Report dates: which report a row of day ``ldate`` counts for.

A ``Span`` is an inclusive range of report dates. One day is the daily job, a longer span
is the bulk backfill; both run through the same expressions.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import DateLike, as_date
from .aggregates import sums as sums_of


@dataclass(frozen=True)
class Span:
    start: dt.date
    end: dt.date

    @staticmethod
    def of(start: DateLike, end: DateLike | None = None) -> "Span":
        s = as_date(start)
        return Span(s, s if end is None else as_date(end))

    @property
    def single(self) -> bool:
        return self.start == self.end

    def dates(self) -> list[dt.date]:
        return [self.start + dt.timedelta(n) for n in range((self.end - self.start).days + 1)]

    def covers(self, days: int = 1) -> Column:
        """Rows that at least one report of the span looks at."""
        return F.col("ldate").between(F.lit(self.start - dt.timedelta(days - 1)), F.lit(self.end))

    def on_report_dates(self, daily: DataFrame, keys: Sequence[str], sums: Sequence[str],
                        days: int = 1) -> DataFrame:
        """Trailing-window sums of ``daily`` per key, one row per report date with any row.

        ``daily`` has one row per (``ldate``, key). For one report date this is a plain
        aggregate. For many, a row is not repeated for each of its report dates: it enters
        the running sum on its day and leaves it ``days`` later.
        """
        inside = daily.filter(self.covers(days))
        if self.single:
            return inside.groupBy(*keys).agg(*sums_of(sums)).withColumn("ldate", F.lit(self.start))
        if days == 1:
            return inside.select("ldate", *keys, *sums)
        enters = F.struct(F.greatest("ldate", F.lit(self.start)).alias("ldate"), F.lit(1).alias("sign"))
        leaves = F.struct(F.date_add("ldate", days).alias("ldate"), F.lit(-1).alias("sign"))
        change = F.explode(F.array(enters, leaves)).alias("c")
        signed = [F.expr(f"`{c}` * c.sign AS `{c}`") for c in sums]
        steps = (inside.select(*keys, *sums, change).filter(F.col("c.ldate") <= F.lit(self.end))
                 .select("c.ldate", *keys, *signed, F.col("c.sign").alias("_rows"))
                 .groupBy("ldate", *keys).agg(*sums_of([*sums, "_rows"])))
        return running_total(steps, keys, [*sums, "_rows"], self.end).filter("_rows > 0").drop("_rows")


def running_total(deltas: DataFrame, keys: Sequence[str], sums: Sequence[str], end: dt.date) -> DataFrame:
    """Sum of everything up to each day, one row per key and day from its first day to ``end``.

    ``deltas`` holds at most one row per (ldate, key). A total holds until the next delta,
    so days in between are filled in without a calendar join; a key has at most as many
    deltas as there are days, so the window is small for every key.
    """
    by_day = Window.partitionBy(*keys).orderBy("ldate")
    so_far = by_day.rowsBetween(Window.unboundedPreceding, 0)
    last = F.coalesce(F.date_sub(F.lead("ldate").over(by_day), 1), F.lit(end))
    totals = [F.expr(f"sum(coalesce(`{c}`, 0))").over(so_far).alias(c) for c in sums]
    steps = deltas.select("ldate", *keys, *totals, last.alias("_last"))
    return steps.select(F.explode(F.sequence("ldate", "_last")).alias("ldate"), *keys, *sums)


def earlier_values(daily: DataFrame, keys: Sequence[str], values: Sequence[str], days: int, prefix: str) -> DataFrame:
    """``daily`` plus ``prefix`` + value: the key's value exactly ``days`` earlier, NULL where it has no row then.

    One shuffle and a range frame of a single day, not a self-join. Days may be missing; of several
    rows of a key on the earlier day the greatest value is taken. A row without ``ldate`` has no earlier one.
    """
    then = Window.partitionBy(*keys).orderBy(F.unix_date("ldate")).rangeBetween(-days, -days)
    return daily.select("*", *[F.when(F.col("ldate").isNotNull(), F.max(v).over(then)).alias(f"{prefix}{v}")
                               for v in values])
