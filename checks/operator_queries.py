"""Relational operators: predicates, joins, aggregates, rankings, set operations, closure."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tallyboard.functions import predicates as p
from tallyboard.functions.scalars import day
from tallyboard.operators import aggregates as agg
from tallyboard.operators import ranking
from tallyboard.operators.closure import ancestors
from tallyboard.operators.joins import full_merge_sum, prefer, salted_inner_join
from tallyboard.operators.masks import advance, days_active
from tallyboard.operators.periods import Span, earlier_values, running_total
from tallyboard.operators.versions import latest_by_key, live_rows
from tallyboard.plans import enterprise, files, org, quality, reach, reports, usage
from tallyboard.plans.model import enrich_events, user_teams
from tallyboard.sources.scratch import cut_lineage, scratch_path
from tallyboard.sources.store import Store

from . import fixtures as fx
from .metric_queries import (COLLAB_COUNTS, COLLAB_ROWS, D, FILE_COUNTS, FILE_ROWS, H1_FULL, M12_SQL, ORG_VIEW,
                             SEAT_SUMS, SEATS_NOW, TD_COUNTS, counts_sql, h1_full_df, totals)
from .model_sql import with_model
from .registry import query

DAY = Span.of(fx.DATE)


# --- P: projections and predicates ---------------------------------------------------
def team_days(spark, sf, condition):
    """Distinct (team, user, day)."""
    days = fx.events(spark, sf).filter(condition).select("user_id", "ldate").distinct()
    return days.join(user_teams(fx.users(spark, sf)), "user_id")


def per_user(name: str, where_sql: str, condition, extra: str = ""):
    """Register a filter and count its rows per user."""
    @query(name, with_model(f"SELECT user_id, count(*) AS n FROM ev WHERE {where_sql} GROUP BY user_id"))
    def run(spark, sf):
        return (fx.events(spark, sf).filter(condition()).groupBy("user_id")
                .agg(F.count(F.lit(1)).alias("n")))


@query("P1_constant_date", with_model(f"SELECT {D} AS ldate, id FROM usr"))
def p1(spark, sf):
    return fx.users(spark, sf).select(day(fx.DATE).alias("ldate"), "id")


per_user("P2_single_day", f"ldate = {D}", lambda: p.on_day(fx.DATE))
per_user("P3_trailing_7_days", f"ldate BETWEEN {D} - 6 AND {D}", lambda: p.trailing(fx.DATE, 7))
per_user("P3_trailing_30_days", f"ldate BETWEEN {D} - 29 AND {D}", lambda: p.trailing(fx.DATE, 30))
per_user("P4_all_history", f"ldate <= {D}", lambda: p.up_to(fx.DATE))
per_user("P5_look_back_1", f"ldate = {D} - 1", lambda: p.days_before(fx.DATE, 1))
per_user("P5_look_back_7", f"ldate = {D} - 7", lambda: p.days_before(fx.DATE, 7))


@query("P6_null_rejection", with_model("SELECT team_id, count(*) AS n FROM usr WHERE team_id IS NOT NULL GROUP BY 1"))
def p6(spark, sf):
    return fx.users(spark, sf).filter(p.has_team()).groupBy("team_id").agg(F.count(F.lit(1)).alias("n"))


per_user("P7_clean_rows", "file_type <> 0", p.clean)
per_user("P8_in_list", "file_type = 2 AND sub_type IN (-1, -3, -4)", lambda: p.product("sheets"))


@query("P9_disjunction", with_model(f"SELECT user_id, count(*) AS n FROM eva WHERE {COLLAB_ROWS} GROUP BY user_id"))
def p9(spark, sf):
    from tallyboard.plans.rollups import ROWS, weighted

    return (weighted(fx.events(spark, sf)).filter(ROWS["collaboration"]()).groupBy("user_id")
            .agg(F.count(F.lit(1)).alias("n"))
            .join(user_teams(fx.users(spark, sf)), "user_id", "left_semi"))


@query("P10_not_in", with_model("SELECT CAST(id AS VARCHAR) AS department_id, name AS department_name FROM dep "
                                "WHERE team_id = 4 AND name NOT IN ('NATION_14')"))
def p10(spark, sf):
    return reports.team_departments(fx.departments(spark, sf), 4, ["NATION_14"])


@query("P11_having", with_model(f"""
    SELECT team_id, count(user_id) AS deep_active_uv FROM (
      SELECT team_id, user_id, count(DISTINCT ldate) AS days FROM eva
      WHERE ldate BETWEEN {D} - 6 AND {D} AND team_id IS NOT NULL GROUP BY ALL HAVING count(DISTINCT ldate) >= 3)
    GROUP BY team_id"""))
def p11(spark, sf):
    return agg.users_with_days(team_days(spark, sf, p.trailing(fx.DATE, 7)), ["team_id"], "user_id", "ldate", 3, "deep_active_uv")


@query("P12_regex_and_path", with_model("""
    SELECT client_user_id, count(*) AS n FROM logs
    WHERE length(guid) = 16 AND NOT regexp_matches(user_agent, 'MobileShell')
      AND split_part(s_url_path, '/', 2) IN ('docs', 'sheets', 'folder', 'space', 'slides', 'forms')
    GROUP BY client_user_id"""))
def p12(spark, sf):
    log = fx.client_log(spark, sf, "web")
    page = F.split_part("s_url_path", F.lit("/"), F.lit(2))
    return (log.filter((F.length("guid") == 16) & ~F.col("user_agent").rlike("MobileShell")
                       & page.isin("docs", "sheets", "folder", "space", "slides", "forms"))
            .groupBy("client_user_id").agg(F.count(F.lit(1)).alias("n")))


@query("P13_projection", "SELECT p_partkey AS id, p_size + p_partkey AS total FROM part")
def p13(spark, sf):
    return fx.table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), (F.col("p_size") + F.col("p_partkey")).alias("total"))


# --- J: joins ---------------------------------------------------------------------------
@query("J1_left_enrichment", with_model("SELECT team_id, user_name, count(*) AS n FROM eva GROUP BY ALL"))
def j1(spark, sf):
    return (enrich_events(fx.events(spark, sf), fx.users(spark, sf)).groupBy("team_id", "user_name")
            .agg(F.count(F.lit(1)).alias("n")))


@query("J2_bridge_fan_out", with_model(
    f"SELECT department_id, count(*) AS n FROM ev JOIN ud USING (user_id) WHERE ldate = {D} GROUP BY department_id"))
def j2(spark, sf):
    per = fx.events(spark, sf).filter(p.on_day(fx.DATE)).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return per.join(fx.user_dep(spark, sf), "user_id").groupBy("department_id").agg(F.sum("n").alias("n"))


@query("J3_seat_filter", with_model("SELECT user_id, count(*) AS n FROM ev JOIN seats USING (user_id) GROUP BY user_id"))
def j3(spark, sf):
    seats = user_teams(fx.users(spark, sf), seats_only=True)
    return (fx.events(spark, sf).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
            .join(seats, "user_id", "left_semi"))


@query("J4_seats_by_membership", with_model(
    "SELECT team_id, member_count, activated_seats FROM seats_now", seats_now=SEATS_NOW))
def j4(spark, sf):
    return (enterprise.seats_and_activity(fx.workspace(spark, sf, "membership"), DAY)
            .select("team_id", "member_count", "activated_seats"))


@query("J5_left_join_chain", with_model("SELECT * FROM seats_now", seats_now=SEATS_NOW))
def j5(spark, sf):
    return (enterprise.seats_and_activity(fx.workspace(spark, sf, "membership"), DAY)
            .select("ldate", "team_id", "member_count", "activated_seats", "active_uv", "deep_active_uv"))


J6 = ("SELECT coalesce(a.user_id, b.user_id) AS user_id, coalesce(a.n, 0) + coalesce(b.n, 0) AS n FROM "
      f"(SELECT user_id, count(*) AS n FROM ev WHERE ldate = {D} GROUP BY 1) a FULL JOIN "
      f"(SELECT user_id, count(*) AS n FROM ev WHERE ldate = {D} - 1 GROUP BY 1) b ON a.user_id = b.user_id")


@query("J6_full_join_of_days", with_model(J6))
def j6(spark, sf):
    ev = fx.events(spark, sf)
    sides = [ev.filter(c).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
             for c in (p.on_day(fx.DATE), p.days_before(fx.DATE, 1))]
    return full_merge_sum(sides, ["user_id"], ["n"])


@query("J7_metric_to_metric", with_model(f"""
    SELECT a.team_id, a.n, t.create_objs FROM (
      SELECT team_id, count(*) AS n FROM eva WHERE ldate = {D} AND team_id IS NOT NULL GROUP BY team_id) a
    LEFT JOIN ({M12_SQL}) t ON t.team_id = a.team_id"""))
def j7(spark, sf):
    ws = fx.workspace(spark, sf)
    per = (ws.events.filter(p.on_day(fx.DATE)).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
           .join(user_teams(ws.users), "user_id").groupBy("team_id").agg(F.sum("n").alias("n")))
    return per.join(totals(ws).select("team_id", "create_objs"), "team_id", "left")


@query("J8_member_to_departments", with_model(f"""
    SELECT a.user_id, a.n, department_id FROM (SELECT user_id, count(*) AS n FROM ev WHERE ldate = {D} GROUP BY 1) a
    LEFT JOIN ud ON ud.user_id = a.user_id"""))
def j8(spark, sf):
    per = fx.events(spark, sf).filter(p.on_day(fx.DATE)).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return per.join(fx.user_dep(spark, sf), "user_id", "left")


@query("J9_five_way_full_join", with_model(H1_FULL))
def j9(spark, sf):
    return h1_full_df(spark, sf)


@query("J10_anti_join_union", with_model("SELECT guid, file_loc FROM fdim"))
def j10(spark, sf):
    current = files.live_files(fx.file_source(spark, sf, 2), "space")
    legacy = files.live_files(fx.file_source(spark, sf, 3), "desktop")
    return prefer(current, legacy, ["guid"]).select("guid", "file_loc")


@query("J11_full_join_org", with_model(f"SELECT team_id, count(user_id) AS users, count(*) AS n FROM ({ORG_VIEW}) GROUP BY team_id"))
def j11(spark, sf):
    return (org.organizations(fx.edges(spark, sf)).groupBy("team_id")
            .agg(F.count("user_id").alias("users"), F.count(F.lit(1)).alias("n")))


@query("J12_allow_list", with_model(
    "SELECT id, name FROM usr WHERE CAST(id AS VARCHAR) IN (SELECT user_id FROM ud JOIN dep "
    "ON CAST(dep.id AS VARCHAR) = ud.department_id WHERE dep.team_id = 4 AND dep.name NOT IN ('NATION_14'))"))
def j12(spark, sf):
    ws = fx.workspace(spark, sf, "user_dep", "departments")
    allowed = reports.allowed_users(ws, 4, ["NATION_14"]).select(F.col("user_id").cast("bigint").alias("id"))
    return ws.users.join(allowed, "id", "left_semi").select("id", "name")


@query("J13_recursive_closure", with_model(
    "SELECT department_id, count(*) AS users FROM ud GROUP BY department_id"))
def j13(spark, sf):
    return fx.user_dep(spark, sf).groupBy("department_id").agg(F.count(F.lit(1)).alias("users"))


@query("J13_maintained_closure", with_model("SELECT user_id, department_id FROM ud"))
def j13_maintained(spark, sf):
    """Yesterday's bridge, from a graph with other edges, brought up to today's edges."""
    now = fx.edges(spark, sf)
    is_user, n = F.col("node_type") == org.USER, F.col("node_id")
    moved = F.when(is_user & (n % 4 == 0), 100 + (n + 3) % 25).when(~is_user & (n % 6 == 0), 100 + n % 10).otherwise(F.col("parent_id"))
    old = (now.withColumn("parent_id", moved.cast("bigint"))
           .withColumn("parent_type", F.when(~is_user & (n % 6 == 0), org.DEPARTMENT).otherwise(F.col("parent_type")).cast("int"))
           .withColumn("is_removed", F.when(n % 9 == 0, ~F.col("is_removed")).otherwise(F.col("is_removed"))))
    old = cut_lineage(old)
    bridge, _ = org.update_user_departments(org.user_departments(old), org.bridge_closure(old), old, now)
    return bridge


@query("J14_multi_key_join", with_model("""
    SELECT a.ldate, a.user_id, a.file_type, a.n, b.m FROM
      (SELECT ldate, user_id, file_type, count(*) AS n FROM ev WHERE action_name = 'view_file' GROUP BY ALL) a
    JOIN (SELECT ldate, user_id, file_type, count(*) AS m FROM ev WHERE action_name = 'comment' GROUP BY ALL) b
      ON a.ldate = b.ldate AND a.user_id = b.user_id AND a.file_type = b.file_type"""))
def j14(spark, sf):
    keys = ["ldate", "user_id", "file_type"]
    ev = fx.events(spark, sf)
    views = ev.filter(p.action(p.VIEW)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    comments = ev.filter(p.action(p.COMMENT)).groupBy(*keys).agg(F.count(F.lit(1)).alias("m"))
    return views.join(comments, on=keys)


@query("J15_two_step_lookup", with_model("""
    SELECT usr.id, ud.department_id, dep.name AS department_name FROM usr
    LEFT JOIN ud ON ud.user_id = CAST(usr.id AS VARCHAR)
    LEFT JOIN dep ON CAST(dep.id AS VARCHAR) = ud.department_id"""))
def j15(spark, sf):
    ws = fx.workspace(spark, sf, "user_dep", "departments")
    names = ws.departments.select(F.col("id").cast("string").alias("department_id"), F.col("name").alias("department_name"))
    people = ws.users.select("id", F.col("id").cast("string").alias("user_id"))
    return (people.join(ws.user_dep, "user_id", "left").join(names, "department_id", "left")
            .select("id", "department_id", "department_name"))


@query("J_salted_hot_key", "SELECT l_suppkey, l_linenumber, s_name, l_orderkey FROM lineitem JOIN supplier ON s_suppkey = l_suppkey")
def j_salted(spark, sf):
    """Every supplier key is of more than 100 rows is split here, so the salting path itself is compared."""
    left = fx.table(spark, sf, "lineitem").select("l_suppkey", "l_linenumber", "l_orderkey")
    right = fx.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    return salted_inner_join(left, right, ["l_suppkey"], F.col("l_orderkey"), hot_rows=100)


# --- A: aggregates ------------------------------------------------------------------------
def team_sums(spark, sf, bank, condition, value=None):
    """Count per user first, so that the join to teams meets counts and not events."""
    per = agg.count_bank(fx.events(spark, sf).filter(condition), ["user_id"], bank, value)
    return (per.join(user_teams(fx.users(spark, sf)), "user_id").groupBy("team_id")
            .agg(*[F.sum(c).alias(c) for c in bank]))


@query("A1_count_non_null_guid", with_model(f"SELECT team_id, {FILE_COUNTS} FROM eva WHERE file_type <> 0 AND team_id IS NOT NULL GROUP BY team_id"))
def a1(spark, sf):
    bank = {"create_files": p.creates_file(), "import_files": p.imports_file(), "upload_files": p.uploads_cloud_file()}
    return team_sums(spark, sf, bank, p.clean(), F.col("guid"))


@query("A2_count_rows", with_model(f"SELECT team_id, {COLLAB_COUNTS} FROM eva WHERE team_id IS NOT NULL GROUP BY team_id"))
def a2(spark, sf):
    bank = {"add_collaborations": p.action(p.ADD_COLLABORATOR), "use_ats": p.action(p.AT),
            "public_shares": p.shares_publicly(), "comments": p.action(p.COMMENT),
            "file_views": p.action(p.VIEW), "create_files": p.creates_file()}
    return team_sums(spark, sf, bank, F.lit(True))


@query("A3_count_bank", with_model(f"SELECT user_id, {TD_COUNTS} FROM eva WHERE ldate <= {D} AND action_name <> 'unknown' "
                                   "AND action_name <> 'import_obj' GROUP BY user_id"))
def a3(spark, sf):
    from tallyboard.plans.enterprise import TOTAL_SOURCES
    from tallyboard.plans.rollups import user_counts

    ws = fx.workspace(spark, sf)
    counts = user_counts(ws, "to_date", list(TOTAL_SOURCES.values()), Span.of(fx.DATE), 15)
    return counts.select("user_id", *[F.col(s).alias(n) for n, s in TOTAL_SOURCES.items()])


@query("A4_exact_distinct", with_model("SELECT team_id, count(DISTINCT user_id) AS uv, count(DISTINCT guid) AS files FROM eva WHERE team_id IS NOT NULL GROUP BY team_id"))
def a4(spark, sf):
    pairs = (fx.events(spark, sf).select("user_id", "guid").distinct()
             .join(user_teams(fx.users(spark, sf)), "user_id"))
    return pairs.groupBy("team_id").agg(
        F.count_distinct("user_id").alias("uv"), F.count_distinct("guid").alias("files"))


@query("A5_two_level_aggregate", with_model("""
    SELECT team_id, count(*) AS users FROM (SELECT team_id, user_id, count(DISTINCT ldate) AS d FROM eva
      WHERE team_id IS NOT NULL GROUP BY ALL) WHERE d >= 20 GROUP BY team_id"""))
def a5(spark, sf):
    return agg.users_with_days(team_days(spark, sf, F.lit(True)), ["team_id"], "user_id", "ldate", 20, "users")


def window_uv_sql(days: int, last: str) -> str:
    return f"""
    SELECT r.d AS ldate, team_id, count(DISTINCT user_id) AS active_uv
    FROM (SELECT CAST(unnest(generate_series(DATE '2024-01-05', DATE '{last}', INTERVAL 1 DAY)) AS DATE) AS d) r
    JOIN eva ON eva.ldate BETWEEN r.d - {days - 1} AND r.d WHERE team_id IS NOT NULL GROUP BY ALL"""


def register_bitmap_uv(days: int, last: str = "2024-02-10"):
    @query(f"A4_bitmap_distinct_{days}d", with_model(window_uv_sql(days, last)))
    def run(spark, sf):
        """From stored daily bitmaps; the last report dates are after the last event."""
        span, store = Span.of("2024-01-05", last), Store(spark, scratch_path(spark, "bitmaps"))
        reach.refresh_bitmaps(store, fx.workspace(spark, sf), span, days)
        return reach.active_users(store, span, days)


register_bitmap_uv(7)
register_bitmap_uv(30)


@query("A5_active_day_masks", with_model(f"""
    SELECT user_id, count(DISTINCT CASE WHEN ldate > {D} - 7 THEN ldate END) AS days_7, count(DISTINCT ldate) AS days_30
    FROM ev WHERE ldate BETWEEN {D} - 29 AND {D} GROUP BY user_id"""))
def a5_masks(spark, sf):
    """Masks of the day from those of five days before and the days in between."""
    ev = fx.events(spark, sf)
    before = advance(ev, ["user_id"], "2024-01-10")
    masks = advance(ev, ["user_id"], fx.DATE, before, "2024-01-10")
    return masks.select("user_id", days_active(7).cast("bigint").alias("days_7"), days_active(30).cast("bigint").alias("days_30"))


@query("A6_select_distinct", with_model("SELECT DISTINCT user_id, file_type, sub_type FROM ev"))
def a6(spark, sf):
    return fx.events(spark, sf).select("user_id", "file_type", "sub_type").distinct()


@query("A7_group_count", with_model("SELECT guid, count(1) AS file_views FROM ev WHERE action_name = 'view_file' GROUP BY guid"))
def a7(spark, sf):
    return fx.events(spark, sf).filter(p.action(p.VIEW)).groupBy("guid").agg(F.count(F.lit(1)).alias("file_views"))


@query("A8_sum_null_as_zero", with_model("SELECT user_id, CAST(sum(coalesce(CASE WHEN file_type = 2 THEN sub_type END, 0)) AS BIGINT) AS s FROM ev GROUP BY user_id"))
def a8(spark, sf):
    from tallyboard.functions.scalars import zero_if_null

    return fx.events(spark, sf).groupBy("user_id").agg(
        F.sum(zero_if_null(F.when(F.col("file_type") == 2, F.col("sub_type")))).alias("s"))


@query("A9_partials_to_team", with_model("SELECT team_id, count(*) AS n FROM eva WHERE team_id IS NOT NULL GROUP BY team_id"))
def a9(spark, sf):
    per = fx.events(spark, sf).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return per.join(user_teams(fx.users(spark, sf)), "user_id").groupBy("team_id").agg(F.sum("n").alias("n"))


@query("A10_collect_array", with_model("SELECT user_id, array_to_string(list_sort(list(department_id)), ',') AS deps, count(*) AS n "
                                    "FROM ud GROUP BY user_id"))
def a10(spark, sf):
    lists = agg.names_list(fx.user_dep(spark, sf), ["user_id"], "department_id", "deps")
    return lists.select("user_id", F.array_join("deps", ",").alias("deps"), F.size("deps").cast("bigint").alias("n"))


@query("A11_running_total", with_model("""
    SELECT d.ldate, u.user_id, CAST(count(*) FILTER (WHERE ev.ldate <= d.ldate) AS BIGINT) AS n
    FROM (SELECT DISTINCT ldate FROM ev) d
    JOIN (SELECT user_id, min(ldate) AS first FROM ev GROUP BY 1) u ON d.ldate >= u.first
    JOIN ev ON ev.user_id = u.user_id GROUP BY d.ldate, u.user_id"""))
def a11(spark, sf):
    deltas = fx.events(spark, sf).groupBy("ldate", "user_id").agg(F.count(F.lit(1)).alias("n"))
    return running_total(deltas, ["user_id"], ["n"], dt.date(2024, 1, 30))


@query("A12_padded_union_sum", with_model("""
    SELECT user_id, CAST(sum(views) AS BIGINT) AS views, CAST(sum(ats) AS BIGINT) AS ats FROM (
      SELECT user_id, count(*) AS views, 0 AS ats FROM ev WHERE action_name = 'view_file' GROUP BY 1
      UNION ALL SELECT user_id, 0, count(*) FROM ev WHERE action_name = 'at' GROUP BY 1) GROUP BY user_id"""))
def a12(spark, sf):
    ev = fx.events(spark, sf)
    parts = [ev.filter(p.action(a)).groupBy("user_id").agg(F.count(F.lit(1)).alias(n))
             for a, n in ((p.VIEW, "views"), (p.AT, "ats"))]
    return full_merge_sum(parts, ["user_id"], ["views", "ats"])


@query("A13_seats_as_of", with_model(f"""
    SELECT DATE '1998-04-01' AS mm, {SEAT_SUMS} FROM seat_orders
    WHERE order_start_date <= DATE '1998-03-31' AND order_end_date >= DATE '1998-03-31'
      AND NOT regexp_matches(order_type, '升级')"""))
def a13(spark, sf):
    return reports.seats_as_of(fx.seat_orders(spark, sf), "1998-03-31")


@query("A14_duplicate_keys", with_model("SELECT user_id, guid, count(*) AS cnt FROM ev GROUP BY ALL HAVING count(*) > 1"))
def a14(spark, sf):
    return agg.duplicate_keys(fx.events(spark, sf), ["user_id", "guid"])


@query("A15_min_max", with_model("SELECT user_id, min(time) AS first, max(time) AS last FROM ev GROUP BY user_id"))
def a15(spark, sf):
    return fx.events(spark, sf).groupBy("user_id").agg(F.min("time").alias("first"), F.max("time").alias("last"))


@query("A16_joined_text", with_model("SELECT user_id, string_agg(department_id, ',' ORDER BY department_id) AS deps FROM ud GROUP BY user_id"))
def a16(spark, sf):
    return org.department_lists(fx.user_dep(spark, sf))


# --- W: enumeration and versions ---------------------------------------------------------------
def numbered(spark, sf):
    """Position of every event of a day by time, over splitters sampled from the data."""
    raw = fx.table(spark, sf, "events").select(
        "event_id", "event_type", F.to_date("ts").alias("ldate"), F.col("ts").cast("timestamp_ntz").alias("ts"))
    return ranking.enumerate_sorted(raw, ["ldate"], [F.asc("ts"), F.asc("event_id")], "pos")


POS = "SELECT event_id, event_type, CAST(ts AS DATE) AS ldate, row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts, event_id) AS pos FROM events"


@query("W1_row_number", f"SELECT event_id, ldate, pos FROM ({POS})")
def w1(spark, sf):
    return numbered(spark, sf).select("event_id", "ldate", "pos")


@query("W1_hot_hour", """
    SELECT event_id, row_number() OVER (ORDER BY CASE WHEN event_id % 10 = 0 THEN hour(ts) ELSE 12 END, event_id) AS pos FROM events""")
def w1_hot(spark, sf):
    """Nine of ten rows share one group and one sort key; blocks by value would be one task."""
    raw = fx.table(spark, sf, "events").select(
        "event_id", F.lit(1).alias("g"), F.when(F.col("event_id") % 10 == 0, F.hour("ts")).otherwise(12).alias("hour"))
    return ranking.enumerate_sorted(raw, ["g"], [F.asc("hour"), F.asc("event_id")], "pos").select("event_id", "pos")


@query("W2_enumerate_dense", f"""
    SELECT event_id, dense_rank() OVER (PARTITION BY ldate ORDER BY first) AS dense_rank FROM (
      SELECT *, min(pos) OVER (PARTITION BY ldate, event_type) AS first FROM ({POS}))""")
def w2(spark, sf):
    return (ranking.enumerate_dense(numbered(spark, sf), ["ldate"], "event_type", "pos")
            .select("event_id", "dense_rank"))


@query("W3_enumerate_uniq", f"SELECT event_id, row_number() OVER (PARTITION BY ldate, event_type ORDER BY pos) AS uniq_rank FROM ({POS})")
def w3(spark, sf):
    return (ranking.enumerate_uniq(numbered(spark, sf), ["ldate"], "event_type", "pos")
            .select("event_id", "uniq_rank"))


@query("W4_latest_per_group", with_model("""
    SELECT user_id, guid, time, action_name FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id, guid ORDER BY time DESC, action_name DESC) AS r FROM ev) WHERE r = 1"""))
def w4(spark, sf):
    rows = fx.events(spark, sf).select("user_id", "guid", "time", "action_name")
    return latest_by_key(rows, ["user_id", "guid"], ["time", "action_name"])


@query("W5_latest_version_live", """
    SELECT o_custkey, o_orderkey, o_totalprice FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders)
    WHERE r = 1 AND o_orderstatus <> 'F'""")
def w5(spark, sf):
    rows = fx.table(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", "o_totalprice", "o_orderdate",
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("is_deleted"))
    return (live_rows(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"])
            .select("o_custkey", "o_orderkey", "o_totalprice"))


@query("W6_period_over_period", with_model("""
    SELECT a.ldate, a.team_id, a.uv, coalesce(b.uv, 0) AS before_uv,
           CASE WHEN a.uv - coalesce(b.uv, 0) = 0 THEN 0.0::DOUBLE WHEN coalesce(b.uv, 0) = 0 THEN NULL
                ELSE (a.uv - b.uv)::DOUBLE / b.uv END AS change_ratio
    FROM uvs a LEFT JOIN uvs b ON b.team_id = a.team_id AND b.ldate = a.ldate - 7""",
    uvs="SELECT ldate, team_id, count(DISTINCT user_id) AS uv FROM eva WHERE team_id IS NOT NULL GROUP BY ALL"))
def w6(spark, sf):
    from tallyboard.functions.scalars import change, zero_if_null

    seen = fx.events(spark, sf).select("ldate", "user_id").distinct()
    uv = (seen.join(user_teams(fx.users(spark, sf)), "user_id").groupBy("ldate", "team_id")
          .agg(F.count("user_id").alias("uv")))
    both = earlier_values(uv, ["team_id"], ["uv"], 7, "before_").withColumn("before_uv", zero_if_null(F.col("before_uv")))
    return both.withColumn("change_ratio", change(F.col("uv"), F.col("before_uv")))


# --- L: sorts and limits -------------------------------------------------------------------------
VIEWS = "SELECT team_id, guid, count(*) AS views FROM eva WHERE team_id IS NOT NULL AND guid IS NOT NULL GROUP BY ALL"


def team_views(spark, sf):
    ev = fx.events(spark, sf).filter(F.col("guid").isNotNull())
    return (ev.groupBy("user_id", "guid").agg(F.count(F.lit(1)).alias("views"))
            .join(user_teams(fx.users(spark, sf)), "user_id").groupBy("team_id", "guid").agg(F.sum("views").alias("views")))


@query("L1_top_n_per_group", with_model(f"""
    SELECT team_id, guid, views, CAST(r AS INTEGER) AS row_number FROM (
      SELECT *, row_number() OVER (PARTITION BY team_id ORDER BY views DESC, guid) AS r FROM ({VIEWS})) WHERE r <= 10"""))
def l1(spark, sf):
    return ranking.top_n(team_views(spark, sf), ["team_id"], [F.desc("views"), F.asc("guid")], 10)


@query("L2_global_limit", with_model(f"SELECT * FROM ({VIEWS}) ORDER BY team_id, views DESC, guid LIMIT 100"))
def l2(spark, sf):
    return team_views(spark, sf).orderBy(F.asc("team_id"), F.desc("views"), F.asc("guid")).limit(100)


@query("L3_global_sort", with_model(f"SELECT * FROM ({VIEWS}) ORDER BY team_id, views DESC, guid"))
def l3(spark, sf):
    return team_views(spark, sf).orderBy(F.asc("team_id"), F.desc("views"), F.asc("guid"))


@query("L4_frequency_top_10", with_model("SELECT user_id, count(*) AS cnt FROM ud GROUP BY 1 ORDER BY cnt DESC, user_id LIMIT 10"))
def l4(spark, sf):
    return agg.most_frequent(fx.user_dep(spark, sf), "user_id", 10)


# --- U: set operations ---------------------------------------------------------------------------
@query("U1_tagged_union", with_model("SELECT *, 'file' AS source FROM fil UNION ALL SELECT *, 'file_legacy' FROM leg"))
def u1(spark, sf):
    return files.all_files(fx.file_source(spark, sf, 2), fx.file_source(spark, sf, 3)).drop("deleted_at")


@query("U2_union_regroup", with_model("""
    SELECT created_by, CAST(sum(n) AS BIGINT) AS n FROM (
      SELECT created_by, count(*) AS n FROM fil GROUP BY 1 UNION ALL SELECT created_by, count(*) FROM leg GROUP BY 1)
    GROUP BY created_by"""))
def u2(spark, sf):
    parts = [fx.file_source(spark, sf, k).groupBy("created_by").agg(F.count(F.lit(1)).alias("n")) for k in (2, 3)]
    return full_merge_sum(parts, ["created_by"], ["n"])


def _count_sql(inner: str, tab: str) -> str:
    return f"SELECT count(1) AS cnt, '{tab}' AS tab FROM ({inner})"


@query("U3_row_count_audit", with_model(" UNION ALL ".join([
    _count_sql(counts_sql(FILE_COUNTS, "file_type <> 0 AND team_id IS NOT NULL", "team", 1), "file_by_team"),
    _count_sql(counts_sql(FILE_COUNTS, FILE_ROWS, "member", 1), "file_by_member"),
    _count_sql(counts_sql(COLLAB_COUNTS, COLLAB_ROWS, "member", 30, True), "collaboration_30d_by_member")])))
def u3(spark, sf):
    ws = fx.workspace(spark, sf)
    return quality.table_row_counts({
        "file_by_team": usage.usage(ws, usage.FILE_BY_TEAM, DAY),
        "file_by_member": usage.usage(ws, usage.FILE_BY_MEMBER, DAY),
        "collaboration_30d_by_member": usage.usage(ws, usage.COLLAB_30D_BY_MEMBER, DAY)}, DAY)


# --- X: stored functions ----------------------------------------------------------------------------
@query("X1_department_list", with_model("SELECT user_id, string_agg(department_id, ',' ORDER BY department_id) AS deps FROM ud GROUP BY user_id"))
def x1(spark, sf):
    return org.department_lists(fx.user_dep(spark, sf))


@query("X2_department_ancestors", with_model("""
    SELECT DISTINCT d AS department_id, CAST(a AS BIGINT) AS ancestor_id FROM up""",
    **{"up(d, pt, a)": """
    SELECT node_id, parent_type, parent_id FROM edg WHERE node_type = 10
    UNION SELECT up.d, edg.parent_type, edg.parent_id FROM up
    JOIN edg ON edg.node_type = up.pt AND edg.node_id = up.a AND edg.node_type IN (9, 10)"""}))
def x2(spark, sf):
    graph = org.org_edges(fx.edges(spark, sf)).filter(F.col("node.type") != org.USER)
    pairs = ancestors(graph.select("node"), graph)
    return (pairs.filter(F.col("seed") != F.col("anc"))
            .select(F.col("seed.id").alias("department_id"), F.col("anc.id").alias("ancestor_id")))


@query("X3_regex_filter", "SELECT page_id, url FROM pages WHERE regexp_matches(url, '[0-9]{2}')")
def x3(spark, sf):
    return fx.table(spark, sf, "pages").select("page_id", "url").filter(F.col("url").rlike("[0-9]{2}"))


@query("X4_substring_functions", """
    SELECT page_id, CAST(length(url) - length(replace(url, '/', '')) AS INTEGER) AS slashes,
           nullif(split_part(url, '/', 3), '') AS host FROM pages""")
def x4(spark, sf):
    from tallyboard.functions.scalars import nth_token, substring_count

    url = F.col("url")
    return fx.table(spark, sf, "pages").select(
        "page_id", substring_count(url, "/").alias("slashes"), nth_token(url, "/", 3).alias("host"))
