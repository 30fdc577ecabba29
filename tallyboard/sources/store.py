"""Date-partitioned result tables with idempotent writes.

Layout: ``root/<table>/ldate=YYYY-MM-DD/*.parquet``. Writing a date replaces exactly that
date, also when the new result is empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import DateLike, as_date
from ..operators.periods import Span


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, table: str, date: DateLike | None = None) -> str:
        base = f"{self.root}/{table}"
        return base if date is None else f"{base}/ldate={as_date(date).isoformat()}"

    def _folder(self, path: str):
        """File system and path handle of ``path``."""
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def exists(self, path: str) -> bool:
        fs, p = self._folder(path)
        return fs.exists(p)

    # --- daily tables ---------------------------------------------------------
    def write_day(self, df: DataFrame, table: str, date: DateLike) -> None:
        """Replace one date. The partition folder itself is overwritten, so an empty result
        clears what an earlier run left there."""
        rows = df.filter(F.col("ldate") == F.lit(as_date(date))).drop("ldate")
        rows.write.mode("overwrite").parquet(self.path(table, date))

    def write_dates(self, df: DataFrame, table: str) -> set:
        """Replace every date that ``df`` has rows for, in one job; returns those dates.

        The dates are observed during the write itself, not by a second pass.
        """
        seen = Observation()
        # rebalance: AQE gathers small dates and splits large ones into files of the target size
        (df.observe(seen, F.collect_set("ldate").alias("dates")).hint("rebalance", "ldate")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("ldate").parquet(self.path(table)))
        return set(seen.get["dates"])

    def write_span(self, df: DataFrame, table: str, span: Span) -> None:
        """Replace every date of the span."""
        if span.single:
            return self.write_day(df, table, span.start)
        self.write_listed(df.filter(span.covers()), table, span.dates())

    def write_listed(self, df: DataFrame, table: str, dates: list) -> None:
        """Replace the listed dates; ``df`` has rows of no others.

        Dates without rows are cleared when an earlier run left rows there; otherwise an
        empty folder records that the date was computed.
        """
        written = self.write_dates(df, table)
        for d in dates:
            if d in written:
                continue
            path = self.path(table, d)
            if self.exists(path) or (not written and d == dates[-1]):
                self.write_day(df.limit(0), table, d)
            else:
                fs, folder = self._folder(path)
                fs.mkdirs(folder)

    def drop_day(self, table: str, date: DateLike) -> None:
        fs, folder = self._folder(self.path(table, date))
        fs.delete(folder, True)

    def days(self, table: str) -> list:
        """Dates that have a folder, in order."""
        fs, folder = self._folder(self.path(table))
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(as_date(n.removeprefix("ldate=")) for n in names if n.startswith("ldate="))

    def read(self, table: str, span: Span | None = None) -> DataFrame:
        df = self.spark.read.parquet(self.path(table))
        df = df.withColumn("ldate", F.col("ldate").cast("date"))
        df = df.select("ldate", *[c for c in df.columns if c != "ldate"])
        return df if span is None else df.filter(span.covers())

    def read_day(self, table: str, date: DateLike) -> DataFrame:
        return self.read(table, Span.of(date))

    def snapshot(self, table: str) -> DataFrame | None:
        """Stored rows of a table, or None when nothing was ever written."""
        return self.read(table) if self.exists(self.path(table)) else None

    # --- dimensions -------------------------------------------------------------
    def replace(self, df: DataFrame, table: str) -> None:
        """Full replacement. ``df`` must not read the table it replaces."""
        df.write.mode("overwrite").parquet(self.path(table))

    def read_dimension(self, table: str) -> DataFrame:
        return self.spark.read.parquet(self.path(table))
