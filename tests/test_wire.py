"""Several schemas in one stream."""

import json

import pytest

from tallyboard.sources import wire
from tallyboard.sources.wire import WireSchema
from tallyboard.streaming import events


@pytest.fixture
def wires(spark):
    return {7: WireSchema.of_json(), 2 ** 32 - 1: WireSchema.of_json("at BIGINT, who STRING", time="at", user_id="who")}


def framed(number, record):
    return bytearray(b"\0" + number.to_bytes(4, "big") + json.dumps(record).encode())


MESSAGES = [framed(7, {"time": 1, "user_id": "a"}), framed(2 ** 32 - 1, {"at": 2, "who": "b", "time": 9}), framed(8, {"time": 3}),
            bytearray(b"\1\0\0\0\7{}"), bytearray(b""), bytearray(b"\0\0\0\0\7"), framed(2 ** 32 - 1, {"time": 5}), framed(7, {"time": "soon"}), None,
            *(bytearray(b"\0\0\0\0\7" + b) for b in (b" \n", b"null", b"[]", b"{", b"\xff\xfe", b"[{\"time\":1}]", b"3"))]
REASONS = [None, None, "unknown schema", "no schema header", "no schema header", "no event time", "no event time", "no event time", "empty", *["no event time"] * 7]


def test_each_message_is_an_event_of_its_schema_or_a_reject(spark, wires):
    df = spark.createDataFrame([(m, i) for i, m in enumerate(MESSAGES)], "value binary, offset long")
    got = {r["offset"]: r for r in wire.route(df, wires).collect()}
    assert [got[i]["reason"] for i in range(len(MESSAGES))] == REASONS
    assert [(got[i]["event"]["time"], got[i]["event"]["user_id"]) for i in (0, 1)] == [(1, "a"), (2, "b")]
    assert all((r["event"] is None) == (r["reason"] is not None) for r in got.values())
    assert got[1]["schema_id"] == 2 ** 32 - 1 and got[3]["schema_id"] is None
    routed = wire.route(df, wires)
    assert wire.routed_events(routed).count() == 2 and wire.routed_rejects(routed).columns == ["value", "offset", "schema_id", "reason"]


def test_empty_stream_and_wrong_tables_of_schemas(spark, wires):
    none = spark.createDataFrame([], "value binary")
    assert wire.route(none, wires).count() == 0
    with pytest.raises(ValueError):
        wire.route(none, {})
    with pytest.raises(ValueError):
        WireSchema.of_json("at BIGINT", time="when")
    with pytest.raises(ValueError):
        WireSchema.of_json("at BIGINT", no_such_column="at")
    with pytest.raises(ValueError):
        events.ingest_messages(none, "", "", "", wires=wires, schema_id=7)


def test_avro_fields_are_named_by_its_schema():
    avro = json.dumps({"type": "record", "name": "e", "fields": [{"name": "at", "type": "long"}, {"name": "guid", "type": "string"}]})
    assert WireSchema.of_avro(avro, time="at").names == ("at", "guid")
