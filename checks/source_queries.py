"""Readers, writers and streams: data goes out and comes back, and must be unchanged."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyboard import schemas
from tallyboard.functions.scalars import day
from tallyboard.operators.periods import Span
from tallyboard.plans import usage
from tallyboard.plans.org import org_edges
from tallyboard.plans.files import live_files
from tallyboard.sources import readers, sinks
from tallyboard.sources.scratch import scratch_path
from tallyboard.sources.store import Store
from tallyboard.sources.wire import WireSchema
from tallyboard.streaming import cdc, events as stream
from tallyboard.streaming.replica import Replica

from . import fixtures as fx
from .metric_queries import FILE_COUNTS, counts_sql
from .model_sql import D, with_model
from .registry import query

EVENT_COLS = ("event_type, guid, user_id, device_id, file_type, sub_type, time, action_name, action_param, "
              "user_agent, extend_info, team_id")


def as_messages(df):
    """Rows as JSON messages, the way a topic would carry them."""
    return df.select(F.to_json(F.struct("*")).alias("value"))


@query("S1_event_stream", with_model(f"SELECT {EVENT_COLS} FROM ev"))
def s1(spark, sf):
    """The decoder of the event stream; files stand in for the broker, values are binary."""
    root = scratch_path(spark, "stream")
    values = as_messages(fx.shape_events(raw_stream(spark, sf)).drop("ldate")).select(
        F.col("value").cast("binary").alias("value"))
    (readers.decode_events(values).writeStream.format("parquet").option("path", f"{root}/events")
     .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination())
    return readers.read_parquet(spark, f"{root}/events", schemas.EVENT)


@query("S2_registry_header", with_model("SELECT guid, user_id, time FROM ev"))
def s2(spark, sf):
    """The wire header is taken off; the Avro decoder itself needs a package that is not here,
    so the record behind the header is JSON."""
    header = F.unhex(F.lit("0000000007"))
    framed = as_messages(fx.events(spark, sf).drop("ldate")).select(
        F.concat(header, F.col("value").cast("binary")).alias("value"))
    record = readers.decode_json(readers.strip_registry_header(F.col("value")))
    return framed.select(record.alias("e")).select("e.guid", "e.user_id", "e.time")


def wires():
    return {7: WireSchema.of_json(),
            300: WireSchema.of_json("at BIGINT, who BIGINT, guid STRING, extra STRING", time="at", user_id="who")}


def wire_messages(rows):
    """Events of two schemas (JSON stands in for Avro), of one that is unknown, and messages without a header,
    cut short in it, with a record that does not decode, or NULL."""
    e, millis = F.col("event_id"), F.unix_millis(F.col("ts").cast("timestamp"))
    guid = e.cast("string").alias("guid")
    old = F.to_json(F.struct(millis.alias("at"), F.col("user_id").alias("who"), guid, F.lit("x").alias("extra")))
    new = F.to_json(F.struct(F.col("event_type"), guid, F.col("user_id").cast("string").alias("user_id"), millis.alias("time")))
    framed = lambda header, text: F.concat(F.unhex(F.lit(header)), text.cast("binary"))
    kind = e % 8
    return rows.select(
        F.when(kind == 0, framed("0000000007", new)).when(kind == 1, framed("000000012C", old)).when(kind == 2, framed("0000000008", new))
        .when(kind == 3, new.cast("binary")).when(kind == 4, F.unhex(F.lit("000000"))).when(kind == 5, framed("0000000007", F.lit("no json")))
        .when(kind == 6, framed("0000000007", old)).alias("value"), e.alias("offset"))


@query("S2_several_schemas", """
    SELECT ['event', 'event', 'unknown schema', 'no schema header', 'no schema header', 'no event time', 'no event time', 'empty'][event_id % 8 + 1] AS kind,
      CASE WHEN event_id % 8 < 2 THEN CAST(event_id AS VARCHAR) END AS guid, CASE WHEN event_id % 8 < 2 THEN CAST(user_id AS VARCHAR) END AS user_id,
      CASE WHEN event_id % 8 = 0 THEN event_type END AS event_type, CASE WHEN event_id % 8 < 2 THEN CAST(ts AS DATE) END AS ldate,
      CASE WHEN event_id % 8 >= 2 THEN event_id END AS origin, CAST(CASE event_id % 8 WHEN 2 THEN 8 WHEN 5 THEN 7 WHEN 6 THEN 7 END AS BIGINT) AS schema_id
    FROM events""")
def s2_several(spark, sf):
    """One stream of several schemas into the event table and the table of rejects."""
    root = scratch_path(spark, "wires")
    stream.ingest_messages(wire_messages(raw_stream(spark, sf)), f"{root}/events", f"{root}/rejects", f"{root}/checkpoint",
                           wires=wires(), available_now=True).awaitTermination()
    none = lambda kind: F.lit(None).cast(kind)
    events = stream.read_events(spark, f"{root}/events").select(
        F.lit("event").alias("kind"), "guid", "user_id", "event_type", "ldate", none("long").alias("origin"), none("long").alias("schema_id"))
    return events.unionByName(stream.read_rejects(spark, f"{root}/rejects").select(
        F.col("reason").alias("kind"), none("string").alias("guid"), none("string").alias("user_id"), none("string").alias("event_type"),
        none("date").alias("ldate"), F.col("offset").alias("origin"), "schema_id"))


@query("S3_json_payload", with_model(f"SELECT {EVENT_COLS} FROM ev"))
def s3(spark, sf):
    return readers.decode_events(as_messages(fx.events(spark, sf).drop("ldate")))


@query("S4_dimension_parquet", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def s4(spark, sf):
    return readers.read_dimension(spark, f"{sf}/customer.parquet", "c_custkey BIGINT, c_name STRING, c_acctbal DOUBLE")


@query("S5_edge_scan", with_model("SELECT node_type AS nt, node_id AS ni, parent_type AS pt, parent_id AS pi FROM edg WHERE NOT is_removed"))
def s5(spark, sf):
    return org_edges(fx.edges(spark, sf)).select(
        F.col("node.type").alias("nt"), F.col("node.id").alias("ni"),
        F.col("parent.type").alias("pt"), F.col("parent.id").alias("pi"))


@query("S6_file_scan", with_model("SELECT guid, name, CAST(type AS VARCHAR) AS file_type, created_at, 'space' AS file_loc FROM fil"))
def s6(spark, sf):
    return live_files(fx.file_source(spark, sf, 2), "space").select("guid", "name", "file_type", "created_at", "file_loc")


@query("S7_csv_with_header", with_model("SELECT node_type, node_id, parent_type, parent_id, is_removed FROM edg"))
def s7(spark, sf):
    path = scratch_path(spark, "edges-csv")
    sinks.write_csv(fx.edges(spark, sf), path)
    return readers.read_csv(spark, path, schemas.EDGE).drop("version", "order", "is_link")


NOTE_SQL = """CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 7 = 1 THEN '' ELSE
    ' 文"档" ^,' || chr(10) || event_type || chr(13) || chr(10) || chr(92) || 'n ' || chr(92) END"""


@query("S7_csv_line_ends", f"SELECT event_id, {NOTE_SQL} AS note, event_type FROM events")
def s7_line_ends(spark, sf):
    """Quotes, separators, line ends, backslashes, blanks, empty and NULL fields, one line per row."""
    path, e = scratch_path(spark, "notes-csv"), F.col("event_id")
    note = F.concat(F.lit(' 文"档" ^,\n'), F.col("event_type"), F.lit("\r\n\\n \\"))
    df = fx.table(spark, sf, "events").select("event_id", F.when(e % 7 == 1, "").when(e % 7 > 1, note).alias("note"), "event_type")
    sinks.write_csv(df, path, escaped=True)
    return readers.read_csv(spark, path, "event_id long, note string, event_type string", escaped=True)


@query("S7_csv_corrupt_lines", """SELECT event_id, CASE WHEN event_id % 5 = 0 THEN event_id || ',one,two' ELSE NULL END AS bad FROM events
    WHERE event_id % 5 <> 0 UNION ALL SELECT event_id, event_id || ',one,two' FROM events WHERE event_id % 5 = 0""")
def s7_corrupt(spark, sf):
    """Lines with a field too many are set aside as text."""
    path, e = scratch_path(spark, "bad-csv"), F.col("event_id")
    lines = F.concat(e.cast("string"), F.when(e % 5 == 0, F.lit(",one,two")).otherwise(F.lit(",one")))
    fx.table(spark, sf, "events").select(lines.alias("value")).write.text(path)
    return readers.read_csv(spark, path, "event_id long, note string", header=False, corrupt="bad").select("event_id", "bad")


@query("S8_tsv_snapshot", with_model("SELECT guid, name, type, sub_type, created_at, created_by FROM fil"))
def s8(spark, sf):
    path = scratch_path(spark, "files-tsv")
    sinks.write_csv(fx.file_source(spark, sf, 2), path, header=False, sep="\t")
    return readers.read_tsv(spark, path, schemas.FILE_SOURCE).drop("deleted_at")


@query("S8_escaped_tsv", """SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 7 = 1 THEN '' ELSE
    'q" ' || chr(92) || 'N ' || chr(92) || chr(9) || event_type || chr(10) || chr(92) || 'n' || chr(13) || chr(92) END AS note, ts FROM events""")
def s8_escaped(spark, sf):
    """Quotes, backslashes, tabs, line ends, empty and NULL fields through the escaped dialect."""
    path = scratch_path(spark, "escaped-tsv")
    note = F.concat(F.lit('q" \\N \\\t'), F.col("event_type"), F.lit("\n\\n\r\\"))
    e = F.col("event_id")
    df = fx.table(spark, sf, "events").select("event_id", F.when(e % 7 == 1, "").when(e % 7 > 1, note).alias("note"), "ts")
    sinks.write_escaped_tsv(df, path)
    return readers.read_escaped_tsv(spark, path, "event_id long, note string, ts timestamp_ntz")


@query("S9_csv_export", with_model(counts_sql(FILE_COUNTS, "file_type <> 0 AND team_id IS NOT NULL", "team", 1)))
def s9(spark, sf):
    path = scratch_path(spark, "report-csv")
    sinks.write_csv(usage.usage(fx.workspace(spark, sf), usage.FILE_BY_TEAM, Span.of(fx.DATE)), path)
    return readers.read_csv(spark, path, schemas.RESULTS[usage.FILE_BY_TEAM.table])


@query("S10_partitioned_events", with_model(f"SELECT ldate, {EVENT_COLS} FROM ev WHERE ldate = {D}"))
def s10(spark, sf):
    path = scratch_path(spark, "events")
    sinks.write_events(fx.events(spark, sf), path)
    return readers.read_parquet(spark, path, schemas.STORED_EVENT).filter(F.col("ldate") == day(fx.DATE))


M01_DAYS = " UNION ALL ".join(
    counts_sql(FILE_COUNTS, "file_type <> 0 AND team_id IS NOT NULL", "team", 1, day=d) for d in ("DATE '2024-01-14'", D))


def stored_days(spark, sf) -> Store:
    """Two dates written, one of them twice."""
    store, ws, table = Store(spark, scratch_path(spark, "store")), fx.workspace(spark, sf), usage.FILE_BY_TEAM.table
    for d in ("2024-01-14", fx.DATE, fx.DATE):
        store.write_day(usage.usage(ws, usage.FILE_BY_TEAM, Span.of(d)), table, d)
    return store


@query("S11_idempotent_daily_write", with_model(M01_DAYS))
def s11(spark, sf):
    return stored_days(spark, sf).read(usage.FILE_BY_TEAM.table)


@query("S12_dimension_replace", with_model("SELECT * FROM fdim"))
def s12(spark, sf):
    store = Store(spark, scratch_path(spark, "dimension"))
    for _ in range(2):
        store.replace(fx.files(spark, sf), "files")
    return store.read_dimension("files")


@query("S14_read_one_day", with_model(counts_sql(FILE_COUNTS, "file_type <> 0 AND team_id IS NOT NULL", "team", 1)))
def s14(spark, sf):
    return stored_days(spark, sf).read_day(usage.FILE_BY_TEAM.table, fx.DATE)


@query("S15_insert_overwrite", with_model("SELECT CAST(ldate AS VARCHAR) AS ldate, user_id, count(*) AS n FROM ev GROUP BY ALL"))
def s15(spark, sf):
    path = scratch_path(spark, "external")
    table = "external_" + path.rsplit("-", 1)[1]
    sinks.create_partitioned_table(spark, table, "user_id STRING, n BIGINT", path)
    counts = fx.events(spark, sf).groupBy("ldate", "user_id").agg(F.count(F.lit(1)).alias("n"))
    sinks.insert_overwrite(counts, table)
    sinks.insert_overwrite(counts.filter(F.col("ldate") == day(fx.DATE)), table)  # leaves other dates alone
    return spark.table(table)


@query("S16_many_files", with_model("SELECT CAST(ldate AS VARCHAR) AS ldate, count(*) AS n FROM ev GROUP BY 1"))
def s16(spark, sf):
    path = scratch_path(spark, "shards")
    sinks.write_events(fx.events(spark, sf), path)
    days = readers.read_parquet(spark, path, schemas.STORED_EVENT).groupBy("ldate").agg(F.count(F.lit(1)).alias("n"))
    return days.select(F.col("ldate").cast("string").alias("ldate"), "n")


# --- streams -----------------------------------------------------------------------------
def raw_stream(spark, sf):
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    # a glob, since a stream takes a folder or a pattern but no single file
    return spark.readStream.schema(schema).parquet(f"{sf}/events.parque[t]")


@query("K1_event_ingest", with_model(f"SELECT ldate, {EVENT_COLS} FROM ev"))
def k1(spark, sf):
    """JSON messages through the ingest stream into the day-partitioned event table."""
    root = scratch_path(spark, "ingest")
    messages = as_messages(fx.shape_events(raw_stream(spark, sf)).drop("ldate"))
    stream.ingest(readers.decode_events(messages), f"{root}/events", f"{root}/checkpoint",
                  available_now=True).awaitTermination()
    return spark.read.schema(schemas.STORED_EVENT).parquet(f"{root}/events").select(
        "ldate", *EVENT_COLS.split(", "))


@query("K1_rejects", """SELECT CASE WHEN event_id % 5 IN (0, 1, 2) THEN 'event' WHEN event_id % 5 = 3 THEN 'not an object' ELSE 'no event time' END AS kind,
    count(*) AS messages FROM events GROUP BY 1""")
def k1_rejects(spark, sf):
    """Every message is an event or a reject with its reason."""
    e = F.col("event_id")
    good = F.to_json(F.struct(F.col("event_type"), (e * 1000).alias("time")))
    messages = fx.table(spark, sf, "events").select(
        F.when(e % 5 == 3, "not json").when(e % 5 == 4, '{"guid":"g"}').otherwise(good).alias("value"), e.alias("offset"))
    events = readers.decode_events(readers.accepted(messages)).select(F.lit("event").alias("kind"))
    return events.unionByName(readers.rejects(messages).select(F.col("reason").alias("kind"))).groupBy("kind").agg(F.count(F.lit(1)).alias("messages"))


def mixed_messages(rows):
    """Three of five messages are events; one is no JSON, one has no time."""
    e = F.col("event_id")
    good = F.to_json(F.struct(F.col("event_type"), F.unix_millis(F.col("ts").cast("timestamp")).alias("time"), e.cast("string").alias("guid")))
    return rows.select(F.when(e % 5 == 3, "not json").when(e % 5 == 4, '{"guid":"g"}').otherwise(good).alias("value"), e.alias("offset"))


@query("K1_two_sinks", """SELECT CASE WHEN event_id % 5 IN (0, 1, 2) THEN 'event' WHEN event_id % 5 = 3 THEN 'not an object' ELSE 'no event time' END AS kind,
    CASE WHEN event_id % 5 IN (0, 1, 2) THEN CAST(ts AS DATE) END AS ldate, count(*) AS messages FROM events GROUP BY ALL""")
def k1_two_sinks(spark, sf):
    """One stream into the event table and the table of rejects."""
    root = scratch_path(spark, "two-sinks")
    stream.ingest_messages(mixed_messages(raw_stream(spark, sf)), f"{root}/events", f"{root}/rejects", f"{root}/checkpoint",
                           available_now=True).awaitTermination()
    events = stream.read_events(spark, f"{root}/events").select(F.lit("event").alias("kind"), "ldate")
    rejected = stream.read_rejects(spark, f"{root}/rejects").select(F.col("reason").alias("kind"), F.lit(None).cast("date").alias("ldate"))
    return events.unionByName(rejected).groupBy("kind", "ldate").agg(F.count(F.lit(1)).alias("messages"))


def change_messages(rows):
    """Inserts for all events, then an update of each third user and a delete of each fifth."""
    u, e = F.col("user_id"), F.col("event_id")
    kind = F.when(u % 5 == 0, F.when(e % 2 == 0, "insert").otherwise("delete")).otherwise(
        F.when(e % 2 == 0, "insert").otherwise("update"))
    return rows.select(F.to_json(F.struct(
        F.when(e % 10 == 9, "other").otherwise("app").alias("database"), F.lit("member").alias("table"),
        kind.alias("type"), F.floor(e / 10).alias("ts"), e.alias("xid"), F.lit(0).alias("xoffset"),
        F.struct(u.alias("id"), F.concat(F.lit("n"), e.cast("string")).alias("name")).alias("data"))).alias("value"))


LATEST_CHANGES = """
    SELECT user_id AS id, 'n' || event_id AS name, user_id % 5 = 0 AND event_id % 2 = 1 AS gone FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events WHERE event_id % 10 <> 9)
    WHERE r = 1"""


@query("K2_change_capture", f"SELECT id, name FROM ({LATEST_CHANGES}) WHERE NOT gone")
def k2(spark, sf):
    root = scratch_path(spark, "cdc")
    changes = cdc.changes(change_messages(raw_stream(spark, sf)), "app", "member")
    cdc.append_changes(changes, f"{root}/log", f"{root}/checkpoint", available_now=True).awaitTermination()
    return cdc.current([spark.read.parquet(f"{root}/log")])


@query("K3_snapshot_then_changes", f"""
    SELECT coalesce(l.id, c.c_custkey) AS id, coalesce(l.name, c.c_name) AS name
    FROM customer c FULL JOIN ({LATEST_CHANGES}) l ON l.id = c.c_custkey WHERE NOT coalesce(gone, false)""")
def k3(spark, sf):
    """Full copy first, changes on top, folded into a new base, read back."""
    root = scratch_path(spark, "replica")
    copy = fx.table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    cdc.initial_load(copy, ts=-1).write.parquet(f"{root}/base-0")
    changes = cdc.changes(change_messages(raw_stream(spark, sf)), "app", "member")
    cdc.append_changes(changes, f"{root}/log", f"{root}/checkpoint", available_now=True).awaitTermination()
    cdc.compact(spark, [f"{root}/base-0", f"{root}/log"], f"{root}/base-1")
    return cdc.current([spark.read.parquet(f"{root}/base-1")])


@query("K3_replica_lifecycle", f"""
    SELECT coalesce(l.id, c.c_custkey) AS id, coalesce(l.name, c.c_name) AS name
    FROM customer c FULL JOIN ({LATEST_CHANGES}) l ON l.id = c.c_custkey WHERE NOT coalesce(gone, false)""")
def k3_lifecycle(spark, sf):
    """Full copy, a stream of changes, a fold, a second stream on top of it, another fold, old versions trimmed."""
    root = scratch_path(spark, "versions")
    table = Replica(spark, root)
    table.load(fx.table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")), ts=-1)
    for half in (1, 0):  # the later half of each pair of events first: versions decide, not arrival
        rows = raw_stream(spark, sf).filter(F.col("event_id") % 2 == half)
        table.append(cdc.changes(change_messages(rows), "app", "member"), f"{root}/checkpoint-{half}", stream=f"half-{half}",
                     available_now=True).awaitTermination()
        table.fold()
    table.trim(keep=0)
    return table.state()
