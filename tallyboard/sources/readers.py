"""Batch and streaming readers. Schemas are always declared, never inferred.

Connection settings come from the caller or the Spark conf; none are stored here.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas


# --- tables -----------------------------------------------------------------
def read_parquet(spark: SparkSession, path: str | Sequence[str], schema: str | None = None) -> DataFrame:
    """A table stored as any number of files, read by the whole cluster."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*([path] if isinstance(path, str) else path))


def jdbc_options(url: str, table: str, *, properties: Mapping[str, str] | None = None,
                 column: str | None = None, lower: int | None = None, upper: int | None = None,
                 partitions: int | None = None, fetch_size: int = 10_000) -> dict[str, str]:
    """Options of a JDBC read; with ``column`` the read is split into ranges of it."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **(properties or {})}
    split = (column, lower, upper, partitions)
    if any(v is not None for v in split):
        if any(v is None for v in split):
            raise ValueError("column, lower, upper and partitions go together")
        options |= {"partitionColumn": column, "lowerBound": str(lower),
                    "upperBound": str(upper), "numPartitions": str(partitions)}
    return options


def read_dimension(spark: SparkSession, source: str, schema: str, **jdbc) -> DataFrame:
    """A dimension table from Parquet, or over JDBC when ``source`` is a JDBC url.

    For JDBC pass ``table`` and optionally the range split of ``jdbc_options``.
    """
    if source.startswith("jdbc:"):
        df = spark.read.format("jdbc").options(**jdbc_options(source, **jdbc)).load()
        return schemas.conform(df, schema)
    return read_parquet(spark, source, schema)


def unescape_lines(text: Column) -> Column:
    r"""Text whose line ends were escaped by ``sinks.escape_lines``: ``\n``, ``\r`` and ``\\`` turned back."""
    out = F.replace(text, F.lit("\\\\"), F.lit("\0"))
    for mark, char in (("\\n", "\n"), ("\\r", "\r")):
        out = F.replace(out, F.lit(mark), F.lit(char))
    return F.replace(out, F.lit("\0"), F.lit("\\"))


def read_csv(spark: SparkSession, path: str, schema: str, *, header: bool = True, sep: str = ",",
             escaped: bool = False, multiline: bool = False, corrupt: str | None = None) -> DataFrame:
    r"""Delimited text with a header line to skip. Quotes are doubled inside quoted fields.

    A line with another number of fields, or a field that does not fit its type, is an error when it is
    read; all columns are parsed whatever the query selects, so none slips through. With ``corrupt`` such
    lines are kept instead, as text in that column with all others NULL where they did not parse.

    ``escaped`` reads what ``sinks.write_csv(escaped=True)`` writes: one line per row, line ends inside
    fields escaped by a backslash, files that Spark can split. ``multiline`` reads foreign files with bare
    line ends inside quotes; each such file is one task.
    """
    fields = T.StructType.fromDDL(schema)
    reader = (spark.read.option("header", header).option("sep", sep).option("quote", '"').option("escape", '"')
              .option("multiLine", multiline).option("columnPruning", False)
              .option("mode", "PERMISSIVE" if corrupt else "FAILFAST"))
    if not multiline:
        reader = reader.option("lineSep", "\n")
    if escaped:
        reader = reader.option("nullValue", "\\N")
    if corrupt:
        if corrupt in fields.names:
            raise ValueError(f"{corrupt} is a column of the file")
        reader = reader.option("columnNameOfCorruptRecord", corrupt)
    df = reader.schema(T.StructType([*fields.fields, *([T.StructField(corrupt, T.StringType())] if corrupt else [])])).csv(path)
    if not escaped:
        return df
    return df.select(*[unescape_lines(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType) and f.name != corrupt
                       else F.col(f"`{f.name}`") for f in df.schema])


def read_tsv(spark: SparkSession, path: str, schema: str, *, header: bool = False) -> DataFrame:
    """Tab-separated history snapshot."""
    return read_csv(spark, path, schema, header=header, sep="\t")


def read_escaped_tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    r"""Tab-separated text as column stores export it: ``\N`` is NULL, tab, newline, carriage return and
    backslash are escaped by a backslash, nothing is quoted. A field that does not fit its type, or a line
    with another number of fields, is an error."""
    fields = T.StructType.fromDDL(schema).fields
    parts = F.split("value", "\t", -1)

    def text(i: int) -> Column:
        raw = F.get(parts, i)
        out = F.replace(raw, F.lit("\\\\"), F.lit("\0"))
        for mark, char in (("\\t", "\t"), ("\\n", "\n"), ("\\r", "\r")):
            out = F.replace(out, F.lit(mark), F.lit(char))
        return F.when(raw != "\\N", F.replace(out, F.lit("\0"), F.lit("\\")))

    whole = F.when(F.size(parts) == len(fields), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("bad line: "), F.col("value"))))
    lines = spark.read.option("lineSep", "\n").text(path).filter(whole)
    return lines.select(*[text(i).cast(f.dataType).alias(f.name) for i, f in enumerate(fields)])


# --- event payloads -----------------------------------------------------------
def decode_json(payload: Column, schema: str = schemas.EVENT_FIELDS) -> Column:
    """One JSON object per message; fields that do not parse become NULL."""
    return F.from_json(payload.cast("string"), schema)


def strip_registry_header(payload: Column) -> Column:
    """Payload without the registry wire header (one magic byte, four bytes of schema id)."""
    return F.substring(payload, 6, 2_147_483_647)


def decode_avro(payload: Column, avro_schema: str) -> Column:
    """Avro record behind a registry header. Needs the spark-avro package."""
    from pyspark.sql.avro.functions import from_avro

    return from_avro(strip_registry_header(payload), avro_schema, {"mode": "PERMISSIVE"})


def decode_events(messages: DataFrame, avro_schema: str | None = None) -> DataFrame:
    """Messages with a ``value`` column to the 12 event columns."""
    value = F.col("value")
    record = decode_avro(value, avro_schema) if avro_schema else decode_json(value)
    names = [f.name for f in T.StructType.fromDDL(schemas.EVENT_FIELDS)]
    return messages.select(record.alias("e")).select(*[F.col(f"e.{n}").alias(n) for n in names])


def rejects(messages: DataFrame, schema_id: int | None = None) -> DataFrame:
    """Messages that ``decode_events`` can make no event of, with why; raw value and origin are kept.

    A message must decode to a JSON object with an event time. With ``schema_id`` messages are Avro
    records, and those whose registry header is missing or names another schema are rejected.
    """
    value = F.col("value")
    if schema_id is None:
        record = decode_json(value)
        reason = (F.when(value.isNull(), "empty").when(record.isNull() | ~F.coalesce(F.startswith(F.ltrim(value.cast("string")), F.lit("{")), F.lit(False)), "not an object")
                  .when(record["time"].isNull(), "no event time"))
    else:
        header = F.substring(value, 1, 5)
        wanted = F.unhex(F.lit("00" + schema_id.to_bytes(4, "big").hex()))
        reason = F.when(value.isNull(), "empty").when(header != wanted, "another schema")
    origin = [c for c in ("topic", "partition", "offset", "timestamp") if c in messages.columns]
    return messages.select(value, *origin, reason.alias("reason")).filter(F.col("reason").isNotNull())


def accepted(messages: DataFrame, schema_id: int | None = None) -> DataFrame:
    """The messages that ``rejects`` leaves: every message is in exactly one of the two."""
    value = F.col("value")
    if schema_id is None:
        starts = F.coalesce(F.startswith(F.ltrim(value.cast("string")), F.lit("{")), F.lit(False))
        return messages.filter(starts & decode_json(value)["time"].isNotNull())
    wanted = F.unhex(F.lit("00" + schema_id.to_bytes(4, "big").hex()))
    return messages.filter(F.coalesce(F.substring(value, 1, 5) == wanted, F.lit(False)))


def kafka_options(brokers: str, topics: str, group: str | None = None, *, starting: str = "earliest",
                  max_offsets: int | None = None, fail_on_data_loss: bool = True) -> dict[str, str]:
    """Options of a Kafka stream. Offsets that are gone stop it unless the caller accepts the loss; without
    ``group`` each query gets a consumer group of its own."""
    options = {"kafka.bootstrap.servers": brokers, "subscribe": topics, "startingOffsets": starting,
               "failOnDataLoss": str(fail_on_data_loss).lower()}
    if group is not None:
        options["kafka.group.id"] = group
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def kafka_events(spark: SparkSession, options: Mapping[str, str],
                 avro_schema: str | None = None) -> DataFrame:
    """Event stream from Kafka. Needs the spark-sql-kafka package."""
    return decode_events(spark.readStream.format("kafka").options(**options).load(), avro_schema)
