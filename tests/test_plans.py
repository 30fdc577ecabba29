"""Shapes that must hold at scale, read from the physical plans."""

import re

import pytest

from checks import fixtures as fx
from tallyboard.operators.periods import Span
from tallyboard.plans import jobs, usage
from tallyboard.plans.rollups import activity_rollup
from tallyboard.sources.sinks import write_events


@pytest.fixture(scope="module")
def ws(spark, sf_dir, tmp_path_factory):
    """Stored tables, the way a cluster would read them."""
    root = str(tmp_path_factory.mktemp("tables"))
    write_events(fx.events(spark, sf_dir), f"{root}/events")
    parts = {"users": fx.users, "membership": fx.membership, "files": fx.files, "user_dep": fx.user_dep}
    for name, make in parts.items():
        make(spark, sf_dir).write.parquet(f"{root}/{name}")
    read = {n: spark.read.parquet(f"{root}/{n}") for n in (*parts, "events")}
    stored = {t: jobs.JOBS[t](fx.workspace(spark, sf_dir, "membership"), Span.of(fx.DATE))
              for t in ("enterprise_7d_user_statistic_by_global", "enterprise_td_usage_statistic_by_global")}
    from tallyboard.plans.model import Workspace

    return Workspace(**read, snapshot=stored.get)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


@pytest.mark.parametrize("span", [Span.of(fx.DATE), Span.of("2024-01-12", fx.DATE)], ids=["day", "bulk"])
@pytest.mark.parametrize("table", list(jobs.JOBS))
def test_no_nested_loops_no_python_no_forced_broadcast(ws, no_broadcast, table, span):
    text = plan(jobs.JOBS[table](ws, span))
    for word in ("CartesianProduct", "NestedLoop", "Python", "Pandas", "BroadcastHashJoin"):
        assert word not in text


def test_day_filter_prunes_partitions_and_columns(ws, no_broadcast):
    text = plan(usage.usage(ws, usage.FILE_BY_TEAM, Span.of(fx.DATE)))
    scan = next(line for line in text.splitlines() if "FileScan" in line and "events" in line)
    assert re.search(r"PartitionFilters: \[isnotnull\(ldate#\d+\), \(ldate#\d+ = 2024-01-15\)\]|"
                     r"PartitionFilters: \[isnotnull\(ldate#\d+\), \(ldate#\d+ >= 2024-01-15\), \(ldate#\d+ <= 2024-01-15\)\]", scan)
    assert "user_agent" not in scan and "extend_info" not in scan and "device_id" not in scan


def test_events_are_counted_before_any_join(ws, no_broadcast):
    """Between the event scan and the first join there is a complete aggregate."""
    lines = plan(usage.usage(ws, usage.COLLAB_30D_BY_MEMBER, Span.of(fx.DATE))).splitlines()
    at = next(i for i, line in enumerate(lines) if "FileScan" in line and "action_name" in line)
    depth = len(lines[at]) - len(lines[at].lstrip(" :+-"))
    above, limit = [], depth
    for line in reversed(lines[:at]):
        indent = len(line) - len(line.lstrip(" :+-"))
        if indent < limit:
            limit = indent
            above.append(line)
    kinds = [re.search(r"(HashAggregate|SortMergeJoin|Exchange)", line) for line in above]
    assert [m.group(1) for m in kinds if m][:4] == ["HashAggregate", "Exchange", "HashAggregate", "SortMergeJoin"]
    # team and user grouping reuses the join's partitioning: one shuffle per side, no third
    assert sum("Exchange" in line for line in lines) == 2


def test_rollup_is_one_shuffle(ws):
    text = plan(activity_rollup(ws.events))
    assert text.count("Exchange") == 1 and "partial_sum" in text


@pytest.fixture()
def small_skew_limits(spark, no_broadcast):
    """Limits that make AQE see skew in test-sized data."""
    limits = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2000",
              "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
              "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1000",
              "spark.sql.adaptive.coalescePartitions.enabled": "false",
              "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in limits}
    for k, v in limits.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def final_plan(df):
    df.collect()
    return plan(df)


def test_spark_splits_a_hot_user_in_the_raw_enrichment(spark, ws, small_skew_limits):
    from pyspark.sql import functions as F

    from tallyboard.plans.model import enrich_events

    hot = ws.events.withColumn("user_id", F.when(F.col("time") % 3 == 0, "7").otherwise(F.col("user_id")))
    hot = hot.repartition(8)  # several map tasks, as a real table has
    assert "skew=true" in final_plan(enrich_events(hot, ws.users))


def test_spark_splits_a_hot_department_in_the_org_view(spark, small_skew_limits):
    from helpers import edges

    from tallyboard.plans.org import organizations

    pairs = [((10, d), (9, 1)) for d in range(20)] + [((11, u), (10, 3 if u % 3 else u % 20)) for u in range(3000)]
    assert "skew=true" in final_plan(organizations(edges(spark, pairs).repartition(8)))


def test_spark_splits_a_file_seen_by_everyone(spark, ws, small_skew_limits):
    """One guid in a third of the (team, file) rows: the join with the file dimension."""
    from pyspark.sql import functions as F

    from tallyboard.plans import rankings

    n = 6000
    events = spark.range(n).select(
        F.lit(fx.DATE).cast("date").alias("ldate"), F.col("id").cast("string").alias("user_id"),
        F.when(F.col("id") % 3 == 0, "shared").otherwise(F.concat(F.lit("g"), F.col("id"))).alias("guid"),
        F.lit(2).alias("file_type"), F.lit("view_file").alias("action_name"))
    users = spark.range(n).select("id", F.col("id").alias("team_id"), F.lit("n").alias("name"), F.lit(1).alias("is_seat"))
    files = events.select("guid", F.lit("name").alias("name"), F.lit("2").alias("file_type"), F.lit("0").alias("file_subtype")).distinct()
    big = ws.with_(events=events.repartition(8), users=users, files=files)
    df = rankings.hot_files(big, Span.of(fx.DATE))
    assert "skew=true" in final_plan(df) and df.count() == n
