"""Continuous event ingest: decode, derive the day, append to the event table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.scalars import UTC, epoch_millis_to_date
from ..sources.readers import accepted, decode_events, rejects
from ..sources.wire import WireSchema, route, routed_events, routed_rejects


def with_day(events: DataFrame, zone: str = UTC) -> DataFrame:
    """Add ``ldate``, the day of the event time in ``zone``, as first column."""
    return events.select(epoch_millis_to_date(F.col("time"), zone).alias("ldate"), "*")


def ingest(events: DataFrame, path: str, checkpoint: str, *, zone: str = UTC,
           available_now: bool = False, interval: str = "1 minute") -> StreamingQuery:
    """Append an event stream to the table at ``path``, exactly once.

    Rows are not re-shuffled by day: a late row simply lands in the partition of its day,
    and the daily jobs pick it up when the date is run again.
    """
    writer = (with_day(events, zone).writeStream.format("parquet").partitionBy("ldate")
              .option("path", path).option("checkpointLocation", checkpoint).outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()


def ingest_messages(messages: DataFrame, events_path: str, rejects_path: str, checkpoint: str, *, zone: str = UTC,
                    schema_id: int | None = None, avro_schema: str | None = None, available_now: bool = False,
                    interval: str = "1 minute", wires: Mapping[int, WireSchema] | None = None) -> StreamingQuery:
    """Raw messages to two tables: events, and rejects with the reason; each message ends in exactly one, once.

    A micro-batch writes the folders of its own number (``ldate=<day>/batch=<id>`` and ``batch=<id>``). A batch
    that broke between its two writes, or inside one, is run again from the same offsets and overwrites them,
    so nothing is lost or counted twice. An event without a day cannot get into the event table.

    With ``wires`` the stream may carry several schemas: each message goes to the decoder of the id in its
    header, and rejects also tell that id.
    """
    if wires is not None and (schema_id is not None or avro_schema is not None):
        raise ValueError("wires name the schemas; schema_id and avro_schema are for streams of one")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch if wires is None else route(batch, wires)
        batch.persist()  # no larger than a trigger's share of the source; spills to disk
        try:
            events = decode_events(accepted(batch, schema_id), avro_schema) if wires is None else routed_events(batch)
            good = with_day(events, zone).withColumn("batch", F.lit(batch_id))
            (good.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("ldate", "batch").parquet(events_path))
            bad = rejects(batch, schema_id) if wires is None else routed_rejects(batch)
            bad.write.mode("overwrite").parquet(f"{rejects_path}/batch={batch_id}")
        finally:
            batch.unpersist()

    writer = messages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """The event table that ``ingest_messages`` writes; filters on ``ldate`` read the folders of these days only."""
    df = spark.read.parquet(path)
    return df.select(F.col("ldate").cast("date").alias("ldate"), *[c for c in df.columns if c not in ("ldate", "batch")])


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("batch")
