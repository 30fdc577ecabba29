"""Bucketed tables, the versioned replica, the two sinks of the ingest, and enumeration over sampled splitters."""

import datetime as dt
import json
import random
import uuid
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.function_queries import DAY
from tallyboard.operators import ranking
from tallyboard.plans import usage
from tallyboard.plans.rollups import activity_rollup
from tallyboard.sources import buckets, folders
from tallyboard.sources.readers import accepted
from tallyboard.streaming import cdc, events
from tallyboard.streaming.replica import Replica


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or ["*"]).collect()), key=str)


# --- F19: buckets

def shuffles_below_joins(df):
    """Exchanges of the inputs of each join, from the executed plan as text."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("+- == Initial Plan ==")[0]


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_bucketed_rollup_meets_the_bridge_without_a_shuffle(spark, sf_dir, tmp_path, no_broadcast):
    layout = buckets.Layout(8, ("user_id",))
    a, b = f"a_{uuid.uuid4().hex}", f"b_{uuid.uuid4().hex}"
    buckets.write_bucketed(activity_rollup(fx.events(spark, sf_dir)), a, f"{tmp_path}/a", layout, by_day=True)
    buckets.write_bucketed(fx.user_dep(spark, sf_dir), b, f"{tmp_path}/b", layout)
    assert buckets.layout_of(spark, a) == layout
    activity, bridge = buckets.read_bucketed(spark, a, layout), buckets.read_bucketed(spark, b, layout)
    joined = activity.filter(DAY.covers(7)).groupBy("user_id").agg(F.sum("acts").alias("n")).join(bridge, "user_id")
    plan = shuffles_below_joins(joined)
    assert "Exchange" not in plan and "SortMergeJoin" in plan and "SelectedBucketsCount: 8 out of 8" in plan
    plain = activity_rollup(fx.events(spark, sf_dir)).filter(DAY.covers(7)).groupBy("user_id").agg(F.sum("acts").alias("n"))
    assert rows(joined, "user_id", "department_id", "n") == rows(plain.join(fx.user_dep(spark, sf_dir), "user_id"), "user_id", "department_id", "n")
    # the metric itself: users and the final groups are shuffled, roll-up and bridge are not
    ws = replace(fx.workspace(spark, sf_dir, "user_dep"), activity=activity, user_dep=bridge)
    metric = usage.usage(ws, usage.PRODUCT_BY_DEPARTMENT, DAY)
    assert shuffles_below_joins(metric).count("Exchange") == 2
    assert rows(metric) == rows(usage.usage(fx.workspace(spark, sf_dir, "user_dep"), usage.PRODUCT_BY_DEPARTMENT, DAY))


def test_other_layouts_are_refused_and_rebucketed(spark, tmp_path):
    df = spark.createDataFrame([(dt.date(2024, 1, d), f"u{u}", d * u) for d in (1, 2) for u in range(20)], "ldate date, user_id string, n long")
    name, copy, plain = (f"t_{uuid.uuid4().hex}" for _ in range(3))
    buckets.write_bucketed(df, name, f"{tmp_path}/t", buckets.Layout(4, ("user_id",)), by_day=True)
    wanted = buckets.Layout(8, ("user_id",))
    with pytest.raises(ValueError, match="rebucket"):
        buckets.read_bucketed(spark, name, wanted)
    buckets.rebucket(spark, name, copy, f"{tmp_path}/c", wanted)
    assert rows(buckets.read_bucketed(spark, copy, wanted), "ldate", "user_id", "n") == rows(df)
    df.write.option("path", f"{tmp_path}/p").saveAsTable(plain)
    with pytest.raises(ValueError, match="no buckets"):
        buckets.read_bucketed(spark, plain, wanted)
    with pytest.raises(ValueError):
        buckets.replace_days(df, plain)
    buckets.replace_days(df.filter("ldate = DATE'2024-01-02'").limit(3).withColumn("n", F.lit(-1).cast("long")), copy)
    after = buckets.read_bucketed(spark, copy, wanted)
    assert after.filter("n = -1").count() == 3 and after.count() == 23
    assert buckets.layout_for(0, ["k"]).buckets == 1 and buckets.layout_for(5 * buckets.BUCKET_BYTES, ["k"]).buckets == 8


# --- K2/K3: versions

CHANGES = "id long, name string, is_deleted int, ts long, xid long, xoffset long"


def log(spark, table, changed, n, stream="main"):
    """A finished batch, as the stream writes it."""
    spark.createDataFrame(changed, CHANGES).write.mode("overwrite").parquet(f"{table.root}/log/{stream}/batch={n}")


@pytest.fixture
def table(spark, tmp_path):
    t = Replica(spark, str(tmp_path / "replica"))
    t.load(spark.createDataFrame([(i, f"s{i}") for i in range(5)], "id long, name string"))
    return t


def test_fold_gives_each_reader_one_state(spark, table):
    log(spark, table, [(1, "one", 0, 10, 1, 0), (2, "gone", 1, 10, 2, 0)], 0)
    before = table.state()  # started before the fold
    want = [(0, "s0"), (1, "one"), (3, "s3"), (4, "s4")]
    assert rows(before) == want
    assert table.fold().folded == {"main": 0} and rows(table.state()) == want
    log(spark, table, [(1, "late", 0, 5, 9, 0), (2, "late", 0, 9, 9, 0), (3, "three", 0, 11, 1, 0)], 1)
    assert rows(before) == want  # still the state of its manifest
    assert rows(table.state()) == [(0, "s0"), (1, "one"), (3, "three"), (4, "s4")]  # late changes revive nothing
    assert rows(table.state(version=1)) == [(i, f"s{i}") for i in range(5)] and rows(table.state(version=2)) == want
    with pytest.raises(LookupError):
        table.state(version=9)
    with pytest.raises(ValueError):
        table.load(spark.createDataFrame([], "id long, name string"))


def test_crash_between_base_and_manifest_changes_nothing(spark, table, monkeypatch):
    log(spark, table, [(1, "one", 0, 10, 1, 0)], 0)
    monkeypatch.setattr(Replica, "_commit", lambda *a: (_ for _ in ()).throw(OSError("power")))
    with pytest.raises(OSError):
        table.fold()
    monkeypatch.undo()
    assert table.manifest().version == 1 and table.pending() == {"main": [0]} and (1, "one") in rows(table.state())
    assert len(folders.names(spark, f"{table.root}/base")) == 2  # the crashed one lies there unread
    assert table.fold().version == 3 and (1, "one") in rows(table.state())
    table.trim(keep=0)
    assert len(folders.names(spark, f"{table.root}/base")) == 1 and (1, "one") in rows(table.state())


def test_replayed_and_unfinished_batches(spark, table):
    log(spark, table, [(1, "one", 0, 10, 1, 0)], 0)
    table.fold()
    log(spark, table, [(1, "one", 0, 10, 1, 0)], 0)  # a replay after its fold
    assert table.pending() == {"main": []} and table.fold().version == 2
    log(spark, table, [(1, "half", 0, 99, 1, 0)], 1)
    folders.remove(spark, f"{table.root}/log/main/batch=1/_SUCCESS")  # still being written
    assert table.pending() == {"main": []} and (1, "one") in rows(table.state())


def test_reads_do_not_grow_with_the_log(spark, table):
    for n in range(6):
        log(spark, table, [(n, f"v{n}", 0, 100 + n, 1, 0)], n)
        if n % 2:
            table.fold()
            table.trim(keep=1)
        manifest = table.manifest()
        assert len(table._paths(manifest, table.pending(manifest))) <= 2
    assert folders.names(spark, f"{table.root}/log/main") == ["batch=4", "batch=5"]  # what only the newest version holds
    assert len(folders.names(spark, f"{table.root}/base")) == 2 and len(rows(table.state())) == 6
    kept = [n for n in folders.names(spark, f"{table.root}/versions") if n.endswith(".json")]
    assert len(kept) == 2


def test_two_folds_at_once(spark, table, monkeypatch):
    log(spark, table, [(1, "one", 0, 10, 1, 0)], 0)
    folders.claim(spark, f"{table.root}/versions/00000002.claim")  # another fold has begun
    assert table.fold().version == 3
    with pytest.raises(Exception, match="already exists|FileAlreadyExists"):
        folders.claim(spark, f"{table.root}/versions/00000003.claim")


def test_replica_follows_a_stream_over_a_restart(spark, table, tmp_path):
    src = tmp_path / "in"
    src.mkdir()

    def drop(n, *messages):
        (src / f"{n}.txt").write_text("\n".join(json.dumps(m) for m in messages))
        changes = cdc.changes(spark.readStream.text(str(src)), "shop", "staff")
        table.append(changes, str(tmp_path / "ck"), available_now=True).awaitTermination()

    def message(kind, ident, name, ts):
        return {"database": "shop", "table": "staff", "type": kind, "ts": ts, "xid": 1, "xoffset": 0, "data": {"id": ident, "name": name}}

    drop(1, message("insert", 7, "g", 5), message("update", 1, "b", 6))
    table.fold()
    drop(2, message("delete", 7, "g", 8))
    assert table.pending() == {"main": [1]} and rows(table.state()) == [(0, "s0"), (1, "b"), (2, "s2"), (3, "s3"), (4, "s4")]


# --- K1: two sinks

def test_ingest_of_events_and_rejects_survives_a_break_between_its_writes(spark, tmp_path, monkeypatch):
    src, ev, rj, ck = tmp_path / "in", str(tmp_path / "ev"), str(tmp_path / "rj"), str(tmp_path / "ck")
    src.mkdir()
    day = 1704067200000

    def run():
        events.ingest_messages(spark.readStream.text(str(src)), ev, rj, ck, available_now=True).awaitTermination()

    good = [json.dumps({"guid": f"g{i}", "time": day + i * 40_000_000}) for i in range(7)]
    bad = ["", "no json", "[1]", '{"guid":"x"}', '{"time":"soon"}']
    (src / "1.txt").write_text("\n".join(good[:4] + bad[:3]))
    run()
    (src / "2.txt").write_text("\n".join(good[4:] + bad[3:]))
    whole = events.rejects
    monkeypatch.setattr(events, "rejects", lambda *a: (_ for _ in ()).throw(RuntimeError("broken between the writes")))
    with pytest.raises(Exception, match="broken between"):
        run()
    monkeypatch.setattr(events, "rejects", whole)
    assert events.read_events(spark, ev).count() == 7 and events.read_rejects(spark, rj).count() == 3
    run()
    got = events.read_events(spark, ev)
    assert sorted(r["guid"] for r in got.collect()) == [f"g{i}" for i in range(7)] and got.filter("ldate IS NULL").count() == 0
    assert sorted(r["value"] for r in events.read_rejects(spark, rj).collect()) == sorted(bad)
    assert {r["ldate"] for r in got.collect()} == {dt.date(2024, 1, 1 + i * 40_000_000 // 86_400_000) for i in range(7)}
    run()
    assert events.read_events(spark, ev).count() + events.read_rejects(spark, rj).count() == 12
    plan = got.filter("ldate = DATE'2024-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "ldate" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_accepted_and_rejected_are_apart(spark):
    values = spark.createDataFrame([(v,) for v in (None, "", "{}", '{"time":1}', " {\"time\":2}")], "value string")
    assert accepted(values).count() + events.rejects(values).count() == 5


# --- W1-W3: splitters from the data

def hot_hour(spark):
    rng = random.Random(2)
    data = [(i, rng.choice(["a", None]) if i % 50 == 0 else "a", 12 if i % 10 else rng.randrange(24), rng.randrange(5)) for i in range(40_000)]
    return data, spark.createDataFrame(data, "id long, g string, hour int, v int").repartition(7, "v")


def shares(monkeypatch):
    """Rows of each task's partition, as the enumerations store them from now on."""
    stored, cut = [], ranking.cut_lineage
    monkeypatch.setattr(ranking, "cut_lineage", lambda df: stored.append(cut(df)) or stored[-1])
    return lambda: [r["count"] for r in stored[0].groupBy("_run_part").count().collect()]


def test_enumeration_of_a_hot_hour_is_even_and_right(spark, monkeypatch):
    data, df = hot_hour(spark)
    sizes = shares(monkeypatch)
    got = ranking.enumerate_sorted(df, ["g"], [F.desc("hour"), F.asc("id")], "pos", partitions=10)
    want = []
    for g in ("a", None):
        own = sorted((r for r in data if r[1] == g), key=lambda r: (-r[2], r[0]))
        want += [(r[0], k) for k, r in enumerate(own, 1)]
    assert sorted((r["id"], r["pos"]) for r in got.select("id", "pos").collect()) == sorted(want)
    assert len(sizes()) >= 8 and max(sizes()) <= 2 * len(data) / 10


def test_equal_rows_are_split_and_numbered_once(spark, monkeypatch):
    sizes = shares(monkeypatch)
    same = spark.range(20_000).select(F.lit(1).alias("g"), F.lit(1).alias("v"))
    got = ranking.enumerate_sorted(same, ["g"], [F.asc("v")], "pos", partitions=8)
    assert rows(got.agg(F.min("pos"), F.max("pos"), F.countDistinct("pos"))) == [(1, 20_000, 20_000)]
    assert max(sizes()) <= 5_000
    empty = ranking.enumerate_sorted(same.limit(0), ["g"], [F.asc("v")], "pos")
    assert empty.count() == 0 and empty.columns == ["g", "v", "pos"]


def test_dense_and_uniq_over_splitters(spark):
    data, df = hot_hour(spark)
    placed = ranking.enumerate_sorted(df, ["g"], [F.asc("hour"), F.asc("id")], "pos")
    dense = {r["id"]: r["d"] for r in ranking.enumerate_dense(placed, ["g"], "v", "pos", "d").collect()}
    uniq = {r["id"]: r["u"] for r in ranking.enumerate_uniq(placed, ["g"], "v", "pos", "u").collect()}
    for g in ("a", None):
        first, seen = {}, {}
        for r in sorted((r for r in data if r[1] == g), key=lambda r: (r[2], r[0])):
            first.setdefault(r[3], len(first) + 1)
            seen[r[3]] = seen.get(r[3], 0) + 1
            assert (dense[r[0]], uniq[r[0]]) == (first[r[3]], seen[r[3]])
