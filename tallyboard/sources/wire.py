"""Streams that carry records of several schemas, told apart by the id in the registry wire header.

A message is one zero byte, four bytes of schema id (big-endian) and the record. Each id has its own
decoder; a message runs through the decoder of its id only, and becomes an event or a reject with the reason.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from .readers import decode_avro, decode_json, strip_registry_header

EVENT_COLUMNS = [f.split()[0] for f in schemas.EVENT_FIELDS.split(", ")]
ORIGIN = ("topic", "partition", "offset", "timestamp")


def schema_id(value: Column) -> Column:
    """Schema id of a binary message; NULL where the header is missing or cut short."""
    header = F.hex(F.substring(value, 1, 5))
    return F.when(F.startswith(header, F.lit("00")) & (F.length(header) == 10),
                  F.conv(F.substring(header, 3, 8), 16, 10).cast("long"))


@dataclass(frozen=True)
class WireSchema:
    """How the records of one schema id are read.

    ``decode`` turns a whole message into a struct with the fields ``names``. ``renamed`` names the field that
    holds an event column, where it is called otherwise. Event columns without a field are NULL, other fields
    are left out, and values are cast to the event's types (NULL where they do not fit).
    """

    decode: Callable[[Column], Column]
    names: tuple[str, ...]
    renamed: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self):
        unknown = [c for c in self.renamed if c not in EVENT_COLUMNS] + [f for f in self.renamed.values() if f not in self.names]
        if unknown:
            raise ValueError(f"neither event columns nor fields of the record: {unknown}")

    @classmethod
    def of_json(cls, schema: str = schemas.EVENT_FIELDS, **renamed: str) -> "WireSchema":
        """The schema text is parsed by Spark, so there must be a session."""
        def decode(value: Column) -> Column:
            # what is no object is NULL beforehand: Spark's parser gives no row for it, on which field access fails
            text = strip_registry_header(value).cast("string")
            return decode_json(F.when(text.rlike(r"^\s*\{"), text), schema)

        return cls(decode, tuple(T.StructType.fromDDL(schema).names), renamed)

    @classmethod
    def of_avro(cls, avro_schema: str, **renamed: str) -> "WireSchema":
        """Needs the spark-avro package when it is run."""
        return cls(lambda value: decode_avro(value, avro_schema),
                   tuple(f["name"] for f in json.loads(avro_schema)["fields"]), renamed)

    def event(self, value: Column) -> Column:
        """The event struct of a message of this schema."""
        record = self.decode(value)
        fields = T.StructType.fromDDL(schemas.EVENT_FIELDS)
        held = {f.name: self.renamed.get(f.name, f.name) for f in fields}
        return F.struct(*[(record[held[f.name]].try_cast(f.dataType) if held[f.name] in self.names
                           else F.lit(None).cast(f.dataType)).alias(f.name) for f in fields])


def route(messages: DataFrame, wires: Mapping[int, WireSchema]) -> DataFrame:
    """Messages with ``event`` (a struct) or ``reason``, exactly one of which is not NULL, and their ``schema_id``.

    The origin (topic, partition, offset, timestamp) is kept where there is one. Reasons: ``empty``,
    ``no schema header``, ``unknown schema`` and ``no event time``, which covers records that do not decode.
    """
    if not wires:
        raise ValueError("no schema to route to")
    value, known = F.col("value"), F.col("schema_id")
    event = F  # a chain of whens; the first one starts it
    for number, wire in wires.items():
        event = event.when(known == number, wire.event(value))
    rows = messages.select("value", *[c for c in ORIGIN if c in messages.columns], schema_id(value).alias("schema_id"))
    rows = rows.withColumn("event", event)
    reason = (F.when(value.isNull(), "empty").when(known.isNull(), "no schema header")
              .when(~known.isin(list(wires)), "unknown schema").when(F.col("event.time").isNull(), "no event time"))
    rows = rows.withColumn("reason", reason)
    return rows.withColumn("event", F.when(F.col("reason").isNull(), F.col("event")))


def routed_events(routed: DataFrame) -> DataFrame:
    """The event columns of what ``route`` made events of."""
    return routed.filter(F.col("reason").isNull()).select("event.*")


def routed_rejects(routed: DataFrame) -> DataFrame:
    """The other messages, as they came, with schema id and reason."""
    return routed.filter(F.col("reason").isNotNull()).drop("event")
