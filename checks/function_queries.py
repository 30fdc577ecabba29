"""Scalar functions."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from tallyboard.functions import scalars as s
from tallyboard.functions.scores import active_score, auto_saves, saved_days
from tallyboard.plans import usage
from tallyboard.plans.rollups import activity_rollup
from tallyboard.sources.buckets import Layout, read_bucketed, write_bucketed
from tallyboard.sources.scratch import scratch_path

from . import fixtures as fx
from .metric_queries import DAY, M12_SQL, product_sql, totals
from .model_sql import with_model
from .registry import query


def timed(spark, sf):
    return fx.events(spark, sf).select("user_id", "guid", "time", "ldate")


@query("F1_epoch_to_date", with_model("SELECT time, CAST(make_timestamp(time * 1000) AS DATE) AS d FROM ev"))
def f1(spark, sf):
    return timed(spark, sf).select("time", s.epoch_millis_to_date(F.col("time")).alias("d"))


@query("F2_epoch_to_datetime", with_model("SELECT time, make_timestamp((time // 1000) * 1000000) AS t FROM ev"))
def f2(spark, sf):
    return timed(spark, sf).select("time", s.epoch_millis_to_local(F.col("time")).alias("t"))


@query("F3_add_days", with_model("SELECT time, ldate - 6 AS first FROM ev"))
def f3(spark, sf):
    return timed(spark, sf).select("time", F.date_add("ldate", -6).alias("first"))


@query("F4_shifted_zone_date", with_model("SELECT guid, created_at, CAST(make_timestamp((created_at + 8 * 3600) * 1000000) AS DATE) AS d FROM fil"))
def f4(spark, sf):
    return fx.file_source(spark, sf, 2).select(
        "guid", "created_at", s.epoch_seconds_to_date(F.col("created_at")).alias("d"))


@query("F5_month_key", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month FROM orders")
def f5(spark, sf):
    return fx.table(spark, sf, "orders").select("o_orderkey", s.month_key(F.to_date("o_orderdate")).alias("month"))


@query("F6_unix_timestamp", "SELECT o_orderkey, CAST(epoch(CAST(o_orderdate AS DATE)) AS BIGINT) AS t FROM orders")
def f6(spark, sf):
    return fx.table(spark, sf, "orders").select(
        "o_orderkey", s.epoch_seconds_of_date(F.to_date("o_orderdate")).alias("t"))


@query("F7_if_and_case", "SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity > 25 THEN 'large' ELSE 'small' END AS size FROM lineitem")
def f7(spark, sf):
    return fx.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_quantity") > 25, "large").otherwise("small").alias("size"))


@query("F8_coalesce", with_model("SELECT id, coalesce(team_id, 0) AS team FROM usr"))
def f8(spark, sf):
    return fx.users(spark, sf).select("id", s.zero_if_null(F.col("team_id")).alias("team"))


@query("F9_guarded_ratio", """
    SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 0.0::DOUBLE WHEN p_partkey % 4 = 0 THEN NULL
                           ELSE (p_size % 3)::DOUBLE / (p_partkey % 4) END AS share,
           CASE WHEN p_size % 3 = p_partkey % 4 THEN 0.0::DOUBLE WHEN p_partkey % 4 = 0 THEN NULL
                ELSE (p_size % 3 - p_partkey % 4)::DOUBLE / (p_partkey % 4) END AS change FROM part""")
def f9(spark, sf):
    a, b = F.col("p_size") % 3, F.col("p_partkey") % 4
    return fx.table(spark, sf, "part").select("p_partkey", s.share(a, b).alias("share"), s.change(a, b).alias("change"))


@query("F10_json_raw_token", with_model("""
    SELECT extend_info, regexp_extract(extend_info, '"status":\\s*("[^"]*"|[^,}\\s]+)', 1) AS token, count(*) AS n
    FROM ev GROUP BY ALL"""))
def f10(spark, sf):
    return (fx.events(spark, sf).withColumn("token", s.json_raw_token(F.col("extend_info"), "status"))
            .groupBy("extend_info", "token").agg(F.count(F.lit(1)).alias("n")))


@query("F11_json_value", "SELECT event_id, props->>'$.k' AS k FROM events")
def f11(spark, sf):
    return fx.table(spark, sf, "events").select("event_id", s.json_value(F.col("props"), "k").alias("k"))


@query("F12_try_cast", "SELECT c_custkey, CAST(TRY_CAST(substr(c_name, 10) AS BIGINT) AS VARCHAR) AS good, "
                       "CAST(TRY_CAST(c_name AS BIGINT) AS VARCHAR) AS bad FROM customer")
def f12(spark, sf):
    return fx.table(spark, sf, "customer").select(
        "c_custkey", s.normal_id(F.substring("c_name", 10, 100)).alias("good"), s.normal_id(F.col("c_name")).alias("bad"))


@query("F13_concat_split_element", with_model("""
    SELECT id, CASE WHEN team_id IS NULL THEN NULL ELSE name || '^' || team_id END AS both,
           string_split(name || '^' || id, '^')[2] AS second FROM usr"""))
def f13(spark, sf):
    name, ident, team = F.col("name"), F.col("id").cast("string"), F.col("team_id").cast("string")
    return fx.users(spark, sf).select(
        "id", F.concat(name, F.lit("^"), team).alias("both"),
        F.element_at(F.split(F.concat(name, F.lit("^"), ident), "\\^"), 2).alias("second"))


@query("F14_split_part_length_regexp", "SELECT page_id, split_part(url, '/', 3) AS host, CAST(length(url) AS INTEGER) AS n, "
                                       "regexp_matches(url, '^https') AS secure FROM pages")
def f14(spark, sf):
    return fx.table(spark, sf, "pages").select(
        "page_id", F.split_part("url", F.lit("/"), F.lit(3)).alias("host"), F.length("url").alias("n"),
        F.col("url").rlike("^https").alias("secure"))


@query("F15_text_functions", """
    SELECT c_custkey, split_part(c_name, '#', 1) AS head, CAST(strpos(c_name, '#') AS INTEGER) AS at, left(c_name, 4) AS four,
           replace(c_name, '#', '-') AS dashed, reverse(c_name) AS back FROM customer""")
def f15(spark, sf):
    n = F.col("c_name")
    return fx.table(spark, sf, "customer").select(
        "c_custkey", F.substring_index(n, "#", 1).alias("head"), F.locate("#", n).alias("at"),
        F.left(n, F.lit(4)).alias("four"), F.replace(n, F.lit("#"), F.lit("-")).alias("dashed"), F.reverse(n).alias("back"))


@query("F16_substring_count_nth_token", """
    SELECT page_id, CAST((length(html) - length(replace(html, '<p>', ''))) // 3 AS INTEGER) AS paragraphs,
           nullif(split_part(url, '/', 4), '') AS token FROM pages""")
def f16(spark, sf):
    return fx.table(spark, sf, "pages").select(
        "page_id", s.substring_count(F.col("html"), "<p>").alias("paragraphs"), s.nth_token(F.col("url"), "/", 4).alias("token"))


@query("F17_explode_split", "SELECT page_id, unnest(string_split(url, '/')) AS piece FROM pages")
def f17(spark, sf):
    return fx.table(spark, sf, "pages").select("page_id", F.explode(F.split("url", "/")).alias("piece"))


@query("F18_parallel_arrays", """
    SELECT page_id, i AS pos, string_split(url, '/')[i] AS piece, CAST(length(string_split(url, '/')[i]) AS INTEGER) AS n
    FROM (SELECT page_id, url, unnest(range(1, len(string_split(url, '/')) + 1)) AS i FROM pages)""")
def f18(spark, sf):
    pieces = F.split("url", "/")
    zipped = F.arrays_zip(pieces.alias("piece"), F.transform(pieces, F.length).alias("n"))
    return (fx.table(spark, sf, "pages").select("page_id", F.posexplode(zipped))
            .select("page_id", (F.col("pos") + 1).cast("bigint").alias("pos"), "col.piece", "col.n"))


def bucketed_workspace(spark, sf, buckets=16):
    """Roll-up and bridge stored in buckets of the user, read back with the check of their layout."""
    layout, root = Layout(buckets, ("user_id",)), scratch_path(spark, "buckets")
    activity, bridge = (f"{name}_{uuid.uuid4().hex}" for name in ("activity", "user_dep"))
    write_bucketed(activity_rollup(fx.events(spark, sf)), activity, f"{root}/activity", layout, by_day=True)
    write_bucketed(fx.user_dep(spark, sf), bridge, f"{root}/user_dep", layout)
    ws = fx.workspace(spark, sf, "user_dep")
    return replace(ws, activity=read_bucketed(spark, activity, layout), user_dep=read_bucketed(spark, bridge, layout))


@query("F19_hash_buckets", product_sql("department"))
def f19(spark, sf):
    """Bucket numbers are not observable; what is, is that the department metric over bucketed tables has the same rows."""
    return usage.usage(bucketed_workspace(spark, sf), usage.PRODUCT_BY_DEPARTMENT, DAY)


@query("F20_month_arithmetic", """
    SELECT o_orderkey, CAST(month(o_orderdate) AS INTEGER) AS m, CAST(date_trunc('month', o_orderdate) AS DATE) AS first,
           CAST(CAST(date_trunc('month', o_orderdate) AS DATE) + INTERVAL 1 MONTH AS DATE) AS next,
           CAST(strptime(strftime(o_orderdate, '%Y-%m-%d'), '%Y-%m-%d') AS DATE) AS parsed FROM orders""")
def f20(spark, sf):
    d = F.to_date("o_orderdate")
    return fx.table(spark, sf, "orders").select(
        "o_orderkey", F.month(d).alias("m"), F.trunc(d, "month").alias("first"),
        F.add_months(F.trunc(d, "month"), 1).alias("next"),
        F.to_date(F.date_format(d, "yyyy-MM-dd"), "yyyy-MM-dd").alias("parsed"))


@query("F21_scores", with_model(f"""
    SELECT team_id, file_views + (add_collaborations + public_shares + comments + use_ats) * 5 + create_objs * 10 AS active_score,
           (file_views + create_objs * 30 + public_shares * 10 + add_collaborations * 15 + comments * 3)::DOUBLE / 1440 AS save_time,
           add_collaborations * 7 + public_shares * 10 + comments * 15 AS auto_saves FROM ({M12_SQL})"""))
def f21(spark, sf):
    rows = totals(fx.workspace(spark, sf)).withColumn("create_files", F.col("create_objs"))
    return rows.select("team_id", active_score().alias("active_score"), saved_days().alias("save_time"),
                       auto_saves().alias("auto_saves"))
