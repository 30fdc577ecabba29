"""Ranking, joins and aggregates against brute force."""

import random
from collections import defaultdict

import pytest
from helpers import as_set
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyboard.functions import scalars as s
from tallyboard.operators import aggregates, ranking
from tallyboard.operators.joins import full_merge_sum, prefer, salted_inner_join
from tallyboard.operators.versions import latest_by_key


def grouped(spark, n=600, seed=1):
    """One group holds most rows; values repeat."""
    rnd = random.Random(seed)
    rows = [("hot" if rnd.random() < 0.7 else rnd.choice("abc"), i, rnd.randrange(20), rnd.choice("xyz")) for i in range(n)]
    rows += [(None, n + i, 1, None) for i in range(5)]
    return rows, spark.createDataFrame(rows, "g string, id int, v int, val string")


def positions(rows):
    groups = defaultdict(list)
    for r in sorted(rows, key=lambda r: (-r[2], r[1])):
        groups[r[0]].append(r)
    return {r[1]: i + 1 for g in groups.values() for i, r in enumerate(g)}, groups


def test_enumerate_rows_equals_brute_force(spark):
    rows, df = grouped(spark)
    got = ranking.enumerate_rows(df, ["g"], [("v", False)], [F.desc("v"), F.asc("id")], "pos")
    assert dict(got.select("id", "pos").collect()) == positions(rows)[0]


def test_dense_and_uniq_follow_first_appearance(spark, monkeypatch):
    whole = ranking.enumerate_sorted
    monkeypatch.setattr(ranking, "enumerate_sorted", lambda *a: whole(*a, partitions=40))  # many partitions, to cross their borders
    rows, df = grouped(spark)
    pos, groups = positions(rows)
    dense, uniq = {}, {}
    for members in groups.values():
        first, seen = {}, defaultdict(int)
        for r in members:
            dense[r[1]] = first.setdefault(r[3], len(first) + 1)
            seen[r[3]] += 1
            uniq[r[1]] = seen[r[3]]
    placed = ranking.enumerate_rows(df, ["g"], [("v", False)], [F.desc("v"), F.asc("id")], "pos")
    got_dense = ranking.enumerate_dense(placed, ["g"], "val", "pos").select("id", "dense_rank").collect()
    got_uniq = ranking.enumerate_uniq(placed, ["g"], "val", "pos").select("id", "uniq_rank").collect()
    assert dict(got_dense) == dense and dict(got_uniq) == uniq


def test_top_n_is_cut_before_the_shuffle(spark):
    _, df = grouped(spark)
    top = ranking.top_n(df, ["g"], [F.desc("v"), F.asc("id")], 3)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan
    assert top.groupBy("g").count().filter("count > 3").count() == 0


@pytest.mark.parametrize("hot_rows", [1, 50, 10**9])
def test_salted_join_keeps_every_row(spark, hot_rows):
    rows, df = grouped(spark)
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("a", 3), ("none", 4)], "g string, w int")
    got = salted_inner_join(df, right, ["g"], F.col("id"), hot_rows=hot_rows)
    want = {(r[1], w) for r in rows for g, w in [("hot", 1), ("hot", 2), ("a", 3)] if r[0] == g}
    assert as_set(got, "id", "w") == want and got.count() == len(want)


def test_salted_join_takes_compound_keys(spark):
    left = spark.range(300).select(F.struct((F.col("id") % 2).alias("a"), F.lit("x").alias("b")).alias("k"), "id")
    right = spark.range(3).select(F.struct(F.col("id").alias("a"), F.lit("x").alias("b")).alias("k"), F.col("id").alias("w"))
    got = salted_inner_join(left, right, ["k"], F.col("id"), hot_rows=10)
    assert as_set(got, "id", "w") == {(i, i % 2) for i in range(300)} and got.count() == 300


def test_full_merge_sum(spark):
    a = spark.createDataFrame([("x", 1), ("x", None), (None, 5)], "k string, m int")
    b = spark.createDataFrame([("y", 2), (None, 7)], "k string, n int")
    assert as_set(full_merge_sum([a, b], ["k"], ["m", "n"]), "k", "m", "n") == {("x", 1, 0), ("y", 0, 2), (None, 5, 7)}


def test_prefer_keeps_duplicates_of_one_side(spark):
    a = spark.createDataFrame([("x", 1), ("x", 2)], "k string, m int")
    b = spark.createDataFrame([("x", 3), ("y", 4), ("y", 5)], "k string, m int")
    assert sorted(map(tuple, prefer(a, b, ["k"]).collect())) == [("x", 1), ("x", 2), ("y", 4), ("y", 5)]


def test_latest_by_key_compares_versions_left_to_right(spark):
    df = spark.createDataFrame([(1, 5, 1, "a"), (1, 5, 2, "b"), (1, 4, 9, "c"), (2, 1, 1, None)], "k int, t int, o int, v string")
    assert as_set(latest_by_key(df, ["k"], ["t", "o"]), "k", "v") == {(1, "b"), (2, None)}


def test_most_frequent_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "k string")
    assert [tuple(r) for r in aggregates.most_frequent(df, "k", 2).collect()] == [("c", 2), ("a", 1)]


def test_names_list_drops_nulls(spark):
    df = spark.createDataFrame([(1, "b"), (1, None), (1, "a"), (2, None)], "k int, v string")
    assert {r.k: r.o for r in aggregates.names_list(df, ["k"], "v", "o").collect()} == {1: ["a", "b"], 2: []}


def test_substring_and_tokens(spark):
    df = spark.createDataFrame([("a,b,c", "aa,bbb,cccc")], "a string, b string")
    r = df.select(s.substring_count(F.col("a"), ",").alias("n"), s.nth_token(F.col("b"), ",", 2).alias("second"),
                  s.nth_token(F.col("b"), ",", 3).alias("third"), s.nth_token(F.col("b"), ",", 4).alias("none")).first()
    assert tuple(r) == (2, "bbb", "cccc", None)


def test_id_cast_is_tolerant(spark):
    df = spark.createDataFrame([("12",), ("x",), ("007",), (None,)], "a string")
    assert [r.n for r in df.select(s.normal_id(F.col("a")).alias("n")).collect()] == ["12", None, "7", None]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Shanghai", "America/New_York"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    df = spark.createDataFrame([(1710054000123,)], "t long")  # 2024-03-10 07:00:00.123 UTC, a DST change in New York
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        r = df.select(s.epoch_millis_to_local(F.col("t")).cast("string").alias("a"),
                      s.local_to_epoch_millis(s.epoch_millis_to_local(F.col("t"))).alias("b")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert tuple(r) == ("2024-03-10 07:00:00", 1710054000000)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(-5, 12), st.integers(1, 4)), min_size=1, max_size=25))
def test_sliding_sums_equal_brute_force(spark, rows):
    import datetime as dt

    from tallyboard.operators.periods import Span

    base, days = dt.date(2024, 1, 10), 4
    span = Span(base, base + dt.timedelta(6))
    df = spark.createDataFrame([(k, base + dt.timedelta(d), n) for k, d, n in rows], "k int, ldate date, n int")
    daily = df.groupBy("ldate", "k").agg(F.sum("n").alias("n"))
    got = as_set(span.on_report_dates(daily, ["k"], ["n"], days), "ldate", "k", "n")
    want = set()
    for day in span.dates():
        for key in range(4):
            hits = [n for k, d, n in rows if k == key and 0 <= (day - (base + dt.timedelta(d))).days < days]
            if hits:
                want.add((day, key, sum(hits)))
    assert got == want
