import datetime as dt

import pytest
from helpers import DAY, as_set
from pyspark.sql import functions as F

from tallyboard import schemas
from tallyboard.operators.periods import Span
from tallyboard.sources import readers, sinks
from tallyboard.sources.scratch import scratch_path, scratch_root
from tallyboard.sources.store import Store

D1, D2, D3 = DAY - dt.timedelta(2), DAY - dt.timedelta(1), DAY
TRICKY = ['plain', 'with "quotes"', 'ends with \\', 'a^b', 'comma, here', '表格与文档', "it's", "", None]


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), "ldate date, k long")


def test_rerun_replaces_one_date_only(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.write_day(frame(spark, (D2, 1)), "t", D2)
    store.write_day(frame(spark, (D3, 2)), "t", D3)
    store.write_day(frame(spark, (D3, 3), (D2, 99)), "t", D3)
    assert as_set(store.read("t"), "ldate", "k") == {(D2, 1), (D3, 3)}
    assert as_set(store.read_day("t", D2), "k") == {(1,)}


def test_empty_result_clears_the_date(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.write_day(frame(spark, (D3, 2)), "t", D3)
    store.write_day(frame(spark, (D3, 2)).limit(0), "t", D3)
    assert store.read_day("t", D3).count() == 0


def test_span_write_clears_dates_without_rows(spark, tmp_path):
    store, span = Store(spark, str(tmp_path)), Span.of(D1, D3)
    store.write_span(frame(spark, (D1, 1), (D2, 2), (D3, 3)), "t", span)
    store.write_span(frame(spark, (D1, 7), (D3, 8)), "t", span)
    assert as_set(store.read("t"), "ldate", "k") == {(D1, 7), (D3, 8)}
    assert store.exists(store.path("t", D2))
    store.write_span(frame(spark, (D1, 7)).limit(0), "t", span)
    assert store.read("t").count() == 0 and store.read("t").columns == ["ldate", "k"]


def test_span_without_any_rows_is_readable(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.write_span(frame(spark, (D1, 7)).limit(0), "t", Span.of(D1, D3))
    assert store.read("t").count() == 0
    assert store.snapshot("never written") is None


def test_dates_outside_the_span_are_not_written(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.write_span(frame(spark, (D1, 1), (D3, 3)), "t", Span.of(D1, D2))
    assert as_set(store.read("t"), "ldate") == {(D1,)}


def test_reading_one_day_prunes_partitions(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.write_span(frame(spark, (D1, 1), (D2, 2), (D3, 3)), "t", Span.of(D1, D3))
    assert len(store.read_day("t", D2).inputFiles()) == 3  # what the table has
    plan = store.read_day("t", D2)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ldate" in plan


def test_text_survives_csv_and_parquet(spark, tmp_path):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TRICKY)], "i int, t string")
    sinks.write_csv(df, f"{tmp_path}/csv")
    got = dict(readers.read_csv(spark, f"{tmp_path}/csv", "i int, t string").collect())
    assert got == {i: t for i, t in enumerate(TRICKY)} | {7: got[7]} and not got[7]
    df.write.parquet(f"{tmp_path}/pq")
    assert dict(readers.read_parquet(spark, f"{tmp_path}/pq").collect()) == dict(enumerate(TRICKY))


def test_csv_export_writes_lists_as_text(spark, tmp_path):
    sinks.write_csv(spark.createDataFrame([(1, ["a", "b"])], "i int, l array<string>"), f"{tmp_path}/csv")
    assert as_set(readers.read_csv(spark, f"{tmp_path}/csv", "i int, l string"), "i", "l") == {(1, "a,b")}


def test_tsv_snapshot(spark, tmp_path):
    (tmp_path / "s.tsv").write_text("1\ta b\n2\tc\n")
    assert as_set(readers.read_tsv(spark, f"{tmp_path}/s.tsv", "i int, t string"), "i", "t") == {(1, "a b"), (2, "c")}


def test_insert_overwrite_leaves_other_dates(spark, tmp_path):
    sinks.create_partitioned_table(spark, "insert_test", "k BIGINT", f"{tmp_path}/x")
    sinks.insert_overwrite(frame(spark, (D2, 1), (D3, 2)), "insert_test")
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    sinks.insert_overwrite(frame(spark, (D3, 5)), "insert_test")
    assert as_set(spark.table("insert_test"), "k") == {(1,), (5,)}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before


def test_jdbc_options():
    o = readers.jdbc_options("jdbc:x", "users", column="id", lower=0, upper=100, partitions=8)
    assert o["partitionColumn"] == "id" and o["numPartitions"] == "8" and o["dbtable"] == "users"
    with pytest.raises(ValueError):
        readers.jdbc_options("jdbc:x", "users", column="id")


class FakeConnection:
    """Records what a JDBC connection is asked to do."""

    def __init__(self, fails=False):
        self.calls, self.fails = [], fails

    def prepareStatement(self, sql):
        self.calls.append(sql)
        return self

    def setDate(self, index, value):
        self.calls.append((index, value))

    def executeUpdate(self):
        if self.fails:
            raise RuntimeError("refused")

    def close(self):
        self.calls.append("closed")


def test_jdbc_day_is_deleted_by_parameter():
    c = FakeConnection()
    sinks.jdbc_delete_day(c, "t", DAY)
    assert c.calls == ["DELETE FROM t WHERE ldate = ?", (1, DAY), "closed"]
    c = FakeConnection(fails=True)
    with pytest.raises(RuntimeError):
        sinks.jdbc_delete_day(c, "t", DAY)
    assert c.calls[-1] == "closed"


def test_kafka_options():
    o = readers.kafka_options("b:9092", "events", "g", max_offsets=10)
    assert o["subscribe"] == "events" and o["kafka.group.id"] == "g" and o["failOnDataLoss"] == "true" and o["maxOffsetsPerTrigger"] == "10"


def test_json_payload_with_bad_message(spark):
    df = spark.createDataFrame([('{"guid":"g","time":5,"file_type":2}',), ("not json",), ('{"guid":"h","extra":1}',)], "value string")
    assert as_set(readers.decode_events(df), "guid", "time", "file_type") == {
        ("g", 5, 2), (None, None, None), ("h", None, None)}


def test_registry_header_is_stripped(spark):
    df = spark.createDataFrame([(bytearray(b"\x00\x00\x00\x00\x07payload"),)], "value binary")
    assert bytes(df.select(readers.strip_registry_header(F.col("value")).alias("v")).first().v) == b"payload"


def test_dimension_reader_takes_parquet(spark, sf_dir):
    df = readers.read_dimension(spark, f"{sf_dir}/nation.parquet", "n_nationkey INT, n_name STRING")
    assert df.count() == 25


def test_conform_refuses_missing_columns(spark):
    with pytest.raises(ValueError):
        schemas.conform(spark.range(1), "id BIGINT, other STRING")


def test_scratch_is_the_shared_folder(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_other_schema_ids_are_rejected(spark):
    df = spark.createDataFrame([(bytearray(b"\x00\x00\x00\x00\x07payload"), 1), (bytearray(b"\x00\x00\x00\x00\x08x"), 2), (bytearray(b"x"), 3), (None, 4)],
                               "value binary, offset long")
    assert as_set(readers.accepted(df, 7), "offset") == {(1,)}
    assert as_set(readers.rejects(df, 7), "offset", "reason") == {(2, "another schema"), (3, "another schema"), (4, "empty")}


def test_escaped_tsv_refuses_short_lines(spark, tmp_path):
    (tmp_path / "x.tsv").write_text("1\ta\n2\n")
    with pytest.raises(Exception, match="bad line"):
        readers.read_escaped_tsv(spark, f"{tmp_path}/x.tsv", "i int, t string").collect()


def test_a_streams_folder_is_refused(spark, tmp_path):
    (tmp_path / "t" / "_spark_metadata").mkdir(parents=True)
    with pytest.raises(ValueError, match="belongs to a stream"):
        sinks.write_events(spark.range(1).selectExpr("current_date() AS ldate", "id"), f"{tmp_path}/t")


ODD = ['q"uote', 'back\\', 'a^b', '档', 'x\ny', 'x\r\ny', '\\n', '\\N', '', None, ' pad ', 'a,b', '\\\\n\n', '"', '\n']


def test_odd_texts_survive_an_escaped_csv_on_one_line_each(spark, tmp_path):
    rows = [(i, t, t) for i, t in enumerate(ODD)]
    sinks.write_csv(spark.createDataFrame(rows, "i int, t string, u string").coalesce(1), f"{tmp_path}/c", escaped=True)
    assert len(spark.read.option("lineSep", "\n").text(f"{tmp_path}/c").collect()) == len(rows) + 1
    assert as_set(readers.read_csv(spark, f"{tmp_path}/c", "i int, t string, u string", escaped=True), "i", "t", "u") == set(rows)


def test_line_ends_in_a_plain_csv_need_multiline_and_fail_without(spark, tmp_path):
    rows = [(i, t, 1) for i, t in enumerate(ODD) if t and t != "\n"]
    sinks.write_csv(spark.createDataFrame(rows, "i int, t string, n int"), f"{tmp_path}/c")
    assert as_set(readers.read_csv(spark, f"{tmp_path}/c", "i int, t string, n int", multiline=True), "i", "t") == {(i, t) for i, t, _ in rows}
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        readers.read_csv(spark, f"{tmp_path}/c", "i int, t string, n int").count()


def test_corrupt_lines_are_kept_as_text(spark, tmp_path):
    (tmp_path / "c.csv").write_text("i,t\n1,a\nx,b\n3\n4,d,e\n")
    got = readers.read_csv(spark, f"{tmp_path}/c.csv", "i int, t string", corrupt="bad")
    assert {r.bad for r in got.collect()} == {None, "x,b", "3", "4,d,e"}
    with pytest.raises(ValueError):
        readers.read_csv(spark, f"{tmp_path}/c.csv", "i int, t string", corrupt="t")
