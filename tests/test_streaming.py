import datetime as dt
import json

from helpers import as_set

from tallyboard.sources.readers import decode_events
from tallyboard.streaming import cdc, events

MESSAGE = {"database": "shop", "table": "staff", "type": "insert", "ts": 1700000000, "xid": 7, "xoffset": 0,
           "data": {"id": 1, "name": "ann"}}


def change(kind, ident, name, ts, xoffset=0, table="staff"):
    return MESSAGE | {"type": kind, "ts": ts, "xoffset": xoffset, "table": table, "data": {"id": ident, "name": name}}


def drop(folder, n, rows):
    folder.mkdir(exist_ok=True)
    (folder / f"{n}.txt").write_text("\n".join(json.dumps(r) for r in rows))


def text_stream(spark, folder):
    return spark.readStream.text(str(folder))


def test_ingest_splits_days_and_resumes(spark, tmp_path):
    src, out, ck = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ck")

    def run():
        stream = decode_events(text_stream(spark, src))
        events.ingest(stream, out, ck, available_now=True).awaitTermination()
        return as_set(spark.read.parquet(out), "ldate", "guid")

    midnight = 1704067200000
    drop(src, 1, [{"guid": "a", "time": midnight - 1}, {"guid": "b", "time": midnight}])
    old, new = dt.date(2023, 12, 31), dt.date(2024, 1, 1)
    assert run() == {(old, "a"), (new, "b")}
    drop(src, 2, [{"guid": "late", "time": midnight - 5}])
    assert run() == {(old, "a"), (new, "b"), (old, "late")}
    assert run() == {(old, "a"), (new, "b"), (old, "late")}
    assert spark.read.parquet(out).count() == 3


def test_day_follows_the_zone(spark):
    df = spark.createDataFrame([(1704067200000 - 1,)], "time long")
    assert events.with_day(df).first().ldate == dt.date(2023, 12, 31)
    assert events.with_day(df, "Asia/Shanghai").first().ldate == dt.date(2024, 1, 1)


def messages(spark, rows):
    return spark.createDataFrame([(json.dumps(r),) for r in rows], "value string")


def test_sample_message(spark):
    got = cdc.changes(messages(spark, [MESSAGE]), "shop", "staff").collect()
    assert [tuple(r) for r in got] == [(1, "ann", 0, 1700000000, 7, 0)]


def test_insert_delete_update(spark):
    log = cdc.changes(messages(spark, [
        change("insert", 1, "1", 1), change("insert", 2, "2", 1), change("delete", 1, "1", 2),
        change("update", 2, "3", 3), change("insert", 9, "x", 9, table="other")]), "shop", "staff")
    assert as_set(cdc.current([log]), "id", "name") == {(2, "3")}


def test_order_within_a_second(spark):
    log = cdc.changes(messages(spark, [change("update", 1, "new", 5, 2), change("update", 1, "old", 5, 1)]), "shop", "staff")
    assert as_set(cdc.current([log]), "name") == {("new",)}


def test_snapshot_log_and_compaction(spark, tmp_path):
    src, log, ck = tmp_path / "in", str(tmp_path / "log"), str(tmp_path / "ck")
    base = spark.createDataFrame([(1, "one"), (2, "two"), (3, "three")], "id long, name string")
    cdc.initial_load(base).write.parquet(str(tmp_path / "base0"))

    def run():
        stream = cdc.changes(text_stream(spark, src), "shop", "staff")
        cdc.append_changes(stream, log, ck, available_now=True).awaitTermination()

    drop(src, 1, [change("update", 2, "TWO", 10), change("delete", 3, "three", 11)])
    run()
    folded = cdc.compact(spark, [str(tmp_path / "base0"), log], str(tmp_path / "base1"))
    assert as_set(cdc.current([folded]), "id", "name") == {(1, "one"), (2, "TWO")}
    drop(src, 2, [change("update", 3, "late", 5), change("insert", 4, "four", 12)])
    run()
    now = cdc.current([folded, spark.read.parquet(log)])
    assert as_set(now, "id", "name") == {(1, "one"), (2, "TWO"), (4, "four")}  # the late change stays dead
