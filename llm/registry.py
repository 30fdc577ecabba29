"""Queries of this package, the SQL that checks them, and helpers that the operators share."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyboard.sources.scratch import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is the equivalent DuckDB statement, if there is one."""
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared scratch folder and read it back: lineage ends here."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def per_worker(name: str, make: Callable):
    """What ``make()`` gives, made once in each Python worker process and kept between its tasks."""
    kept = sys.modules.setdefault("_llm_worker_state", types.ModuleType("_llm_worker_state")).__dict__
    if name not in kept:
        kept[name] = make()
    return kept[name]


class Memo(dict):
    """Function results by key in two generations; at most ``2 * limit`` entries are held.

    When the young generation is full it becomes the old one, so keys in steady use stay. Nothing
    depends on what is remembered: a forgotten result is worked out again.
    """

    def __init__(self, work: Callable, limit: int):
        super().__init__()
        self.work, self.limit, self.old = work, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.work(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def sorted_groups(batches, keys: list[str]):
    """The runs of rows with equal keys in batches sorted by them, as Arrow tables; one run is held at a time."""
    import numpy as np
    import pyarrow as pa

    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        if rest is not None:
            rows = pa.concat_tables([rest, rows])
        new = np.zeros(rows.num_rows, bool)
        new[0] = True
        for key in keys:
            values = rows.column(key).to_numpy()
            new[1:] |= values[1:] != values[:-1]
        starts = np.flatnonzero(new)
        rows = rows.combine_chunks()
        for a, b in zip(starts, starts[1:]):
            yield rows.slice(a, b - a)
        rest = rows.slice(starts[-1])
    if rest is not None:
        yield rest
