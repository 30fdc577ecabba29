"""Change-data capture: an append-only change log, merged when it is read.

Every change is appended once; the current state is the latest version of each key. The log
is folded into a base table from time to time, so reads stay cheap and no micro-batch ever
rewrites the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..operators.versions import latest_by_key, live_rows
from ..sources.readers import decode_json

VERSION = ("ts", "xid", "xoffset")


def changes(messages: DataFrame, database: str, table: str,
            schema: str = schemas.CHANGE_MESSAGE) -> DataFrame:
    """Changes of one table from JSON messages: its columns, ``is_deleted`` and the version."""
    row = messages.select(decode_json(F.col("value"), schema).alias("m"))
    mine = row.filter((F.col("m.database") == database) & (F.col("m.table") == table))
    deleted = F.when(F.col("m.type") == "delete", 1).otherwise(0)
    return mine.select("m.data.*", deleted.alias("is_deleted"), *[f"m.{v}" for v in VERSION])


def append_changes(stream: DataFrame, path: str, checkpoint: str, *,
                   available_now: bool = False, interval: str = "1 minute") -> StreamingQuery:
    """Append a stream of changes to the log at ``path``, exactly once."""
    writer = (stream.writeStream.format("parquet").option("path", path)
              .option("checkpointLocation", checkpoint).outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()


def initial_load(snapshot: DataFrame, ts: int = 0) -> DataFrame:
    """A full copy of the source table as changes older than any streamed one."""
    version = [F.lit(v).cast("bigint").alias(n) for n, v in zip(VERSION, (ts, -1, -1))]
    return snapshot.select("*", F.lit(0).alias("is_deleted"), *version)


def merged(parts: Sequence[DataFrame], keys: Sequence[str] = ("id",)) -> DataFrame:
    """Latest version of every key over base and log, deleted ones still marked."""
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return latest_by_key(union, list(keys), list(VERSION))


def current(parts: Sequence[DataFrame], keys: Sequence[str] = ("id",)) -> DataFrame:
    """Live rows of the table, without the bookkeeping columns."""
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return live_rows(union, list(keys), list(VERSION)).drop("is_deleted", *VERSION)


def compact(spark: SparkSession, parts: Sequence[str], target: str,
            keys: Sequence[str] = ("id",)) -> DataFrame:
    """Fold base and log into a new base at ``target`` (a new path, never one it reads).

    Delete marks are kept, so a change that arrives late cannot revive a deleted key.
    """
    if target in parts:
        raise ValueError("compact writes a new version, not one of its inputs")
    merged([spark.read.parquet(p) for p in parts], keys).write.mode("error").parquet(target)
    return spark.read.parquet(target)
