"""Metric tables, views, history, reports and pipelines."""

from __future__ import annotations

from contextlib import suppress

from pyspark.sql import functions as F

from tallyboard.operators.periods import Span
from tallyboard.plans import (enterprise, files, history, jobs, org, quality, rankings, reports,
                              scores, usage)
from tallyboard.plans.model import enrich_events
from tallyboard.sources.scratch import scratch_path
from tallyboard.sources.store import Store

from . import fixtures as fx
from .model_sql import CUT, D, with_model
from .registry import ORACLES, query

DAY = Span.of(fx.DATE)

# --- relations -----------------------------------------------------------------
EVENT_COLS = ("ldate, event_type, guid, user_id, device_id, file_type, sub_type, time, action_name, "
              "action_param, user_agent, extend_info, team_id, user_name")


@query("D1_events_all_view", with_model(f"SELECT {EVENT_COLS} FROM eva"))
def d1(spark, sf):
    return enrich_events(fx.events(spark, sf), fx.users(spark, sf))


@query("D2_user_dep", with_model("SELECT user_id, department_id FROM ud"))
def d2(spark, sf):
    return org.user_departments(fx.edges(spark, sf))


@query("D3_files", with_model("SELECT * FROM fdim"))
def d3(spark, sf):
    return fx.files(spark, sf)


# --- usage -----------------------------------------------------------------------
CREATES_FILE = "(action_name = 'create_obj' AND file_type <> 1)"
UPLOADS = "(action_name = 'upload_obj' AND file_type = 3)"
FILE_COUNTS = f"""
    count(CASE WHEN {CREATES_FILE} THEN guid END) AS create_files,
    count(CASE WHEN action_name = 'import_obj' THEN guid END) AS import_files,
    count(CASE WHEN {UPLOADS} THEN guid END) AS upload_files"""
COLLAB_COUNTS = f"""
    count(CASE WHEN action_name = 'add_collaborator' THEN 1 END) AS add_collaborations,
    count(CASE WHEN action_name = 'at' THEN 1 END) AS use_ats,
    count(CASE WHEN action_name = 'public_share' AND shared THEN 1 END) AS public_shares,
    count(CASE WHEN action_name = 'comment' THEN 1 END) AS comments,
    count(CASE WHEN action_name = 'view_file' THEN 1 END) AS file_views,
    count(CASE WHEN {CREATES_FILE} THEN 1 END) AS create_files"""
FILE_ROWS = f"file_type <> 0 AND ({CREATES_FILE} OR action_name = 'import_obj' OR {UPLOADS}) AND team_id IS NOT NULL"
COLLAB_ROWS = f"""file_type <> 0 AND team_id IS NOT NULL AND (
    action_name IN ('add_collaborator', 'at', 'comment', 'view_file')
    OR (action_name = 'public_share' AND shared) OR {CREATES_FILE})"""
PRODUCTS = {"docxs": "0, -2", "sheets": "-1, -3, -4", "tables": "-8", "ppts": "-5, -10", "docs": "-6",
            "clouds": None, "others": "-7, -9"}


def product_case(name: str, extra: str = "", kind: str = "file_type", sub: str = "sub_type") -> str:
    codes = PRODUCTS[name]
    test = f"{kind} = 3" if codes is None else f"{kind} = 2 AND {sub} IN ({codes})"
    return f"count(CASE WHEN {extra}{test} THEN guid END)"


PRODUCT_COUNTS = ("count(CASE WHEN file_type IN (2, 3) THEN guid END) AS create_objs, "
                  + ", ".join(f"{product_case(n)} AS create_{n}" for n in PRODUCTS))
PRODUCT_ROWS = "file_type IN (2, 3) AND action_name IN ('create_obj', 'upload_obj') AND team_id IS NOT NULL"


def ratio_sql(a: str, b: str) -> str:
    return f"CASE WHEN {a} = 0 THEN 0.0::DOUBLE WHEN {b} = 0 THEN NULL ELSE ({a})::DOUBLE / {b} END"


def _keys(grain: str) -> str:
    return {"team": "team_id", "department": "team_id, department_id", "member": "team_id, user_id"}[grain]


def _source(grain: str, seats: bool = False) -> str:
    src = "eva"
    if grain == "department":
        src += " JOIN ud USING (user_id)"
    if seats:
        src += " JOIN seats USING (user_id)"
    return src


def days_sql(days: int, day: str = D) -> str:
    return f"ldate BETWEEN {day} - {days - 1} AND {day}"


def counts_sql(counts: str, rows: str, grain: str, days: int, seats: bool = False, day: str = D) -> str:
    keys = _keys(grain)
    return (f"SELECT {day} AS ldate, {keys}, {counts} FROM {_source(grain, seats)} "
            f"WHERE {days_sql(days, day)} AND {rows} GROUP BY {keys}")


def product_sql(grain: str) -> str:
    inner = counts_sql(PRODUCT_COUNTS, PRODUCT_ROWS, grain, 7)
    cols = ", ".join(f"create_{n}, {ratio_sql(f'create_{n}', 'create_objs')} AS create_{n}_ratio" for n in PRODUCTS)
    return with_model(f"SELECT ldate, {_keys(grain)}, create_objs, {cols} FROM ({inner})")


def register_usage(prefix: str, metric: usage.UsageMetric, sql: str) -> None:
    parts = ("user_dep",) if metric.grain == "department" else ()

    @query(f"{prefix}_{metric.table}", sql)
    def run(spark, sf):
        return usage.usage(fx.workspace(spark, sf, *parts), metric, DAY)


register_usage("M01", usage.FILE_BY_TEAM, with_model(
    counts_sql(FILE_COUNTS, "file_type <> 0 AND team_id IS NOT NULL", "team", 1)))
register_usage("M02", usage.FILE_BY_DEPARTMENT, with_model(counts_sql(FILE_COUNTS, FILE_ROWS, "department", 1)))
register_usage("M03", usage.FILE_BY_MEMBER, with_model(counts_sql(FILE_COUNTS, FILE_ROWS, "member", 1)))
register_usage("M04", usage.COLLAB_BY_TEAM, with_model(
    counts_sql(COLLAB_COUNTS, "team_id IS NOT NULL", "team", 1)))
register_usage("M05", usage.COLLAB_BY_DEPARTMENT, with_model(counts_sql(COLLAB_COUNTS, COLLAB_ROWS, "department", 1)))
register_usage("M06", usage.COLLAB_BY_MEMBER, with_model(counts_sql(COLLAB_COUNTS, COLLAB_ROWS, "member", 1, True)))
register_usage("M07", usage.COLLAB_30D_BY_MEMBER, with_model(
    counts_sql(COLLAB_COUNTS, COLLAB_ROWS, "member", 30, True)))
register_usage("M08", usage.PRODUCT_BY_TEAM, product_sql("team"))
register_usage("M09", usage.PRODUCT_BY_DEPARTMENT, product_sql("department"))
register_usage("M10", usage.PRODUCT_BY_MEMBER, product_sql("member"))


@query("M01_seven_day_variant", with_model(
    counts_sql(FILE_COUNTS, "file_type <> 0 AND team_id IS NOT NULL", "team", 7)))
def m01_7d(spark, sf):
    return usage.usage(fx.workspace(spark, sf), usage.FILE_BY_TEAM.window(7), DAY)


# --- M11, M12 ------------------------------------------------------------------------
def seats_sql(day: str) -> str:
    return f"""
    SELECT {day} AS ldate, t1.team_id, member_count, activated_seats,
           coalesce(active_uv, 0) AS active_uv, coalesce(deep_active_uv, 0) AS deep_active_uv
    FROM (SELECT team_id, count(is_seat) AS activated_seats FROM usr
          WHERE created_at <= {day} AND is_seat = 1 AND team_id IS NOT NULL AND deleted_at IS NULL GROUP BY team_id) t1
    JOIN (SELECT target_id AS team_id, member_count FROM mem WHERE category IN (2, 3, 4)) m ON m.team_id = t1.team_id
    LEFT JOIN (SELECT team_id, count(DISTINCT user_id) AS active_uv FROM eva
               WHERE {days_sql(7, day)} AND team_id IS NOT NULL GROUP BY team_id) t2 ON t2.team_id = t1.team_id
    LEFT JOIN (SELECT team_id, count(user_id) AS deep_active_uv FROM (
                   SELECT team_id, user_id, count(DISTINCT ldate) AS n FROM eva
                   WHERE {days_sql(7, day)} AND team_id IS NOT NULL GROUP BY ALL) WHERE n >= 3
               GROUP BY team_id) t3 ON t3.team_id = t1.team_id"""


def _change(v: str) -> str:
    return ratio_sql(f"({v} - before_7d_{v})", f"before_7d_{v}")


SEATS_NOW, SEATS_BEFORE = seats_sql(D), seats_sql(f"({D} - 7)")
M11_BODY = f"""
    SELECT ldate, team_id, member_count, activated_seats,
           {ratio_sql('activated_seats', 'member_count')} AS activated_seats_ratio,
           before_7d_activated_seats, {_change('activated_seats')} AS activated_seats_change_ratio,
           active_uv, {ratio_sql('active_uv', 'member_count')} AS active_uv_ratio,
           before_7d_active_uv, {_change('active_uv')} AS active_uv_change_ratio,
           deep_active_uv, before_7d_deep_active_uv, {_change('deep_active_uv')} AS deep_active_uv_change_ratio
    FROM (SELECT a.*, coalesce(b.activated_seats, 0) AS before_7d_activated_seats,
                 coalesce(b.active_uv, 0) AS before_7d_active_uv,
                 coalesce(b.deep_active_uv, 0) AS before_7d_deep_active_uv
          FROM seats_now a LEFT JOIN seats_before b ON a.team_id = b.team_id)"""


@query("M11_enterprise_7d_user_statistic_by_global",
       with_model(M11_BODY, seats_now=SEATS_NOW, seats_before=SEATS_BEFORE))
def m11(spark, sf):
    ws = fx.workspace(spark, sf, "membership")
    before = enterprise.seats_and_activity(ws, Span.of("2024-01-08"))
    return enterprise.seats_and_activity(ws.with_(snapshot=lambda t: before), DAY, strict=False)


@query("M11_from_masks", with_model(M11_BODY, seats_now=SEATS_NOW, seats_before=SEATS_BEFORE))
def m11_masks(spark, sf):
    """The daily run of a store that keeps active-day masks, after a run a week before."""
    store = Store(spark, scratch_path(spark, "masks"))
    run = jobs.Backfill(fx.workspace(spark, sf, "membership"), store, carry_masks=True)
    for d in ("2024-01-08", fx.DATE):
        run.run(d, tasks=[enterprise.USERS_TABLE])
    return store.read_day(enterprise.USERS_TABLE, fx.DATE)


TD_COUNTS = (
    "count(CASE WHEN action_name = 'create_obj' AND file_type IN (2, 3) THEN guid END) AS create_objs, "
    + ", ".join(
        product_case(n, f"action_name = '{'upload_obj' if n == 'clouds' else 'create_obj'}' AND ") + f" AS create_{n}"
        for n in PRODUCTS)
    + """, count(CASE WHEN action_name = 'view_file' THEN 1 END) AS file_views,
    count(CASE WHEN action_name = 'add_collaborator' THEN 1 END) AS add_collaborations,
    count(CASE WHEN action_name = 'at' THEN 1 END) AS use_ats,
    count(CASE WHEN action_name = 'public_share' AND shared THEN guid END) AS public_shares,
    count(CASE WHEN action_name = 'comment' THEN 1 END) AS comments""")
M12_SQL = f"""SELECT {D} AS ldate, team_id, {TD_COUNTS} FROM eva
    WHERE ldate BETWEEN DATE '2024-01-01' AND {D} AND team_id IS NOT NULL
      AND action_name IN ('create_obj', 'view_file', 'add_collaborator', 'at', 'public_share', 'comment', 'upload_obj')
    GROUP BY team_id"""


def totals(ws):
    """Yesterday's total from a bulk run since the first day, then one more day on top."""
    stored = enterprise.usage_to_date(ws, Span.of(fx.FIRST_DATE, "2024-01-14"))
    return enterprise.usage_to_date(ws.with_(snapshot=lambda t: stored), DAY)


@query("M12_enterprise_td_usage_statistic_by_global", with_model(M12_SQL))
def m12(spark, sf):
    return totals(fx.workspace(spark, sf))


# --- rankings --------------------------------------------------------------------------
def hot_sql(days: int, n: int) -> str:
    return with_model(f"""
    SELECT * FROM (
      SELECT {D} AS ldate, team_id, v.guid, name, file_type AS type, file_subtype AS sub_type, file_views,
             CAST(row_number() OVER (PARTITION BY team_id ORDER BY file_views DESC, v.guid, name, file_type, file_subtype)
                  AS INTEGER) AS row_number
      FROM (SELECT team_id, guid, count(*) AS file_views FROM eva
            WHERE {days_sql(days)} AND file_type IN (2, 3) AND action_name = 'view_file' AND team_id IS NOT NULL
            GROUP BY team_id, guid) v
      JOIN fdim ON fdim.guid = v.guid
      WHERE name IS NOT NULL AND file_type IS NOT NULL AND file_subtype IS NOT NULL) WHERE row_number <= {n}""")


@query("M13_file_1d_hot_statistic_by_global", hot_sql(1, 100))
def m13(spark, sf):
    return rankings.hot_files(fx.workspace(spark, sf, "files"), DAY, 1)


@query("M14_file_7d_hot_statistic_by_global", hot_sql(7, 100))
def m14(spark, sf):
    return rankings.hot_files(fx.workspace(spark, sf, "files"), DAY, 7)


SPACES = f"""
    SELECT {D} AS ldate, team_id, e.guid, name, max(make_timestamp((time // 1000) * 1000000)) AS updated_at
    FROM eva e LEFT JOIN fdim ON fdim.guid = e.guid
    WHERE ldate <= {D} AND e.file_type = 1 AND e.sub_type = 2 AND team_id IS NOT NULL
    GROUP BY team_id, e.guid, name"""


@query("M15_space_1d_updated_statistic_by_global", with_model(
    f"SELECT * FROM ({SPACES}) ORDER BY team_id, updated_at DESC, guid NULLS LAST, name NULLS LAST LIMIT 100"))
def m15(spark, sf):
    return rankings.updated_spaces(fx.workspace(spark, sf, "files"), DAY)


@query("M15_per_team_variant", with_model(f"""
    SELECT ldate, team_id, guid, name, updated_at FROM (
      SELECT *, row_number() OVER (PARTITION BY team_id ORDER BY updated_at DESC, guid NULLS LAST, name NULLS LAST) AS r
      FROM ({SPACES})) WHERE r <= 10"""))
def m15_team(spark, sf):
    return rankings.updated_spaces(fx.workspace(spark, sf, "files"), DAY, n=10, per_team=True)


@query("M16_usage_1d_download_by_member", with_model(f"""
    SELECT {D} AS ldate, team_id, department_id, a.user_id, user_name, file_views, create_files, create_spaces,
           create_dirs, use_ats, add_collaborations, public_shares, comments,
           file_views + create_files * 10 + (add_collaborations + public_shares + comments + use_ats) * 5 AS active_score,
           import_files, upload_files
    FROM (SELECT team_id, user_id, user_name, {COLLAB_COUNTS.replace('AS create_files', 'AS create_acts')}, {FILE_COUNTS},
                 count(CASE WHEN action_name = 'create_obj' AND file_type = 1 AND sub_type = 1 THEN guid END) AS create_dirs,
                 count(CASE WHEN action_name = 'create_obj' AND file_type = 1 AND sub_type = 2 THEN guid END) AS create_spaces
          FROM eva WHERE ldate = {D} AND team_id IS NOT NULL AND file_type <> 0 AND (
              action_name IN ('create_obj', 'import_obj', 'add_collaborator', 'at', 'comment', 'view_file')
              OR {UPLOADS} OR (action_name = 'public_share' AND shared))
          GROUP BY team_id, user_id, user_name) a
    LEFT JOIN ud ON ud.user_id = a.user_id"""))
def m16(spark, sf):
    return usage.member_usage_download(fx.workspace(spark, sf, "user_dep"), DAY)


@query("M17_creation_1d_download_by_global", with_model(f"""
    SELECT {D} AS ldate, t1.*, total_create_objs, total_add_collaborations, member_count, activated_seats, deep_active_uv
    FROM (SELECT team_id, {PRODUCT_COUNTS},
                 count(CASE WHEN action_name = 'create_obj' AND file_type = 1 AND sub_type = 1 THEN guid END) AS create_dirs,
                 count(CASE WHEN action_name = 'create_obj' AND file_type = 1 AND sub_type = 2 THEN guid END) AS create_spaces
          FROM eva WHERE {days_sql(7)} AND file_type <> 0 AND action_name IN ('create_obj', 'upload_obj')
            AND team_id IS NOT NULL GROUP BY team_id) t1
    LEFT JOIN (SELECT team_id, member_count, activated_seats, deep_active_uv FROM seats_now) t2 ON t2.team_id = t1.team_id
    LEFT JOIN (SELECT team_id, create_objs AS total_create_objs, add_collaborations AS total_add_collaborations
               FROM totals) t3 ON t3.team_id = t1.team_id""", seats_now=SEATS_NOW, totals=M12_SQL))
def m17(spark, sf):
    ws = fx.workspace(spark, sf, "membership")
    tables = {enterprise.USERS_TABLE: enterprise.seats_and_activity(ws, DAY), enterprise.TOTALS_TABLE: totals(ws)}
    return enterprise.creation_download(ws.with_(snapshot=tables.get), DAY)


# --- score views ---------------------------------------------------------------------------
SCORE = "file_views + create_files * 10 + (add_collaborations + public_shares + comments + use_ats) * 5 AS active_score"


@query("V1_active_users_7d", with_model(
    f"SELECT ldate, team_id, user_id, {SCORE} FROM ({counts_sql(COLLAB_COUNTS, COLLAB_ROWS, 'member', 1, True)})"))
def v1(spark, sf):
    return scores.active_users(usage.usage(fx.workspace(spark, sf), usage.COLLAB_BY_MEMBER, DAY))


@query("V2_active_users_30d", with_model(
    f"SELECT ldate, team_id, user_id, {SCORE} FROM ({counts_sql(COLLAB_COUNTS, COLLAB_ROWS, 'member', 30, True)})"))
def v2(spark, sf):
    return scores.active_users(usage.usage(fx.workspace(spark, sf), usage.COLLAB_30D_BY_MEMBER, DAY))


@query("V3_save_time", with_model(f"""
    SELECT ldate, team_id, (file_views + create_objs * 30 + public_shares * 10 + add_collaborations * 15
                            + comments * 3)::DOUBLE / (60 * 24) AS save_time FROM ({M12_SQL})"""))
def v3(spark, sf):
    return scores.save_time(totals(fx.workspace(spark, sf)))


@query("V4_auto_saves", with_model(f"""
    SELECT ldate, team_id, add_collaborations * 7 + public_shares * 10 + comments * 15 AS auto_saves FROM ({M12_SQL})"""))
def v4(spark, sf):
    return scores.auto_save_count(totals(fx.workspace(spark, sf)))


ORG_VIEW = """
    SELECT team_id, t1.department_id, user_id
    FROM (SELECT parent_id AS team_id, node_id AS department_id FROM edg WHERE parent_type = 9 AND node_type = 10) t1
    FULL JOIN (SELECT parent_id AS department_id, CAST(node_id AS VARCHAR) AS user_id FROM edg
               WHERE parent_type = 10 AND node_type = 11) t2 ON t1.department_id = t2.department_id"""


@query("V5_organizations_view", with_model(ORG_VIEW))
def v5(spark, sf):
    return org.organizations(fx.edges(spark, sf))


# --- history ---------------------------------------------------------------------------------
H1_FULL = f"""
    SELECT team_id, CAST(sum(coalesce(a, 0)) AS BIGINT) AS add_collaborations, CAST(sum(coalesce(n, 0)) AS BIGINT) AS use_ats,
           CAST(sum(coalesce(s, 0)) AS BIGINT) AS public_shares, CAST(sum(coalesce(c, 0)) AS BIGINT) AS comments, {CUT} AS ldate
    FROM (SELECT id AS user_id, team_id FROM usr WHERE team_id IS NOT NULL) t1
    FULL JOIN (SELECT user_id, count(*) AS a FROM permissions WHERE ldate = {CUT} GROUP BY 1) t2 ON t1.user_id = t2.user_id
    FULL JOIN (SELECT user_id, count(*) AS n FROM notifications WHERE ldate = {CUT} GROUP BY 1) t3 ON t1.user_id = t3.user_id
    FULL JOIN (SELECT user_id, count(*) AS s FROM share_events WHERE ldate <= {CUT} AND end_mode <> 'private' GROUP BY 1) t4
      ON t1.user_id = t4.user_id
    FULL JOIN (SELECT user_id, count(*) AS c FROM old_comments WHERE ldate = {CUT} GROUP BY 1) t5 ON t1.user_id = t5.user_id
    GROUP BY team_id"""


def h1_full_df(spark, sf):
    c = fx.full_copies(spark, sf)
    return history.collaboration_full_load(
        fx.dated_users(spark, sf, fx.CUTOFF), c["permissions"], c["notifications"],
        c["share_events"], c["comments"], fx.CUTOFF)


@query("H1_collaboration_full_load", with_model(H1_FULL))
def h1_full(spark, sf):
    return h1_full_df(spark, sf)


def h1_range_sql(first: str, last: str) -> str:
    return f"""
    SELECT team_id, count(CASE WHEN action_name = 'add_collaborator' THEN 1 END) AS add_collaborations,
           count(CASE WHEN action_name = 'at' THEN 1 END) AS use_ats,
           count(CASE WHEN action_name = 'public_share' AND extend_info->>'$.status' = '1' THEN guid END) AS public_shares,
           count(CASE WHEN action_name = 'comment' THEN 1 END) AS comments, {last} AS ldate
    FROM eva WHERE ldate BETWEEN {first} AND {last} AND team_id IS NOT NULL
      AND action_name IN ('add_collaborator', 'at', 'public_share', 'comment') GROUP BY team_id"""


@query("H1_collaboration_range", with_model(h1_range_sql("DATE '2024-01-11'", D)))
def h1_range(spark, sf):
    return history.collaboration_range(fx.events(spark, sf), fx.dated_users(spark, sf, fx.DATE), "2024-01-11", fx.DATE)


@query("H1_collaboration_daily", with_model(h1_range_sql(D, D)))
def h1_daily(spark, sf):
    return history.collaboration_range(fx.events(spark, sf), fx.dated_users(spark, sf, fx.DATE), fx.DATE, fx.DATE)


FILE_PAGES = ", ".join(f"'{p}'" for p in history.FILE_PAGES)
H2_FULL = f"""
    SELECT team_id, flag, count(*) AS file_views, {CUT} AS ldate FROM (
      SELECT client_user_id, 'web.events' AS flag FROM logs WHERE ldate <= {CUT} AND length(guid) = 16 AND (
        (web_type = '$pageview' AND NOT regexp_matches(user_agent, 'MobileShell')
           AND split_part(s_url_path, '/', 2) IN ({FILE_PAGES}) AND split_part(s_url_path, '/', 3) IS NOT NULL)
        OR (web_type = 'app_webview' AND regexp_matches(user_agent, 'MobileShell')))
      UNION ALL
      SELECT client_user_id, 'app.wxevents' FROM logs WHERE ldate <= {CUT} AND length(guid) = 16 AND wx_type = 'wx_openfile'
      UNION ALL
      SELECT client_user_id, 'app.appevent' FROM logs
      WHERE ldate <= {CUT} AND length(guid) = 16 AND app_type IN ('appView', 'app_webview')) l
    JOIN usr ON CAST(usr.id AS VARCHAR) = l.client_user_id AND team_id IS NOT NULL GROUP BY team_id, flag"""
H2_RANGE = f"""
    SELECT team_id, 'service_events' AS flag, count(*) AS file_views, {D} AS ldate FROM eva
    WHERE ldate BETWEEN DATE '2024-01-11' AND {D} AND action_name = 'view_file' AND team_id IS NOT NULL GROUP BY team_id"""


def h2_full_df(spark, sf):
    logs = [fx.client_log(spark, sf, s) for s in ("web", "wx", "app")]
    return history.views_full_load(*logs, fx.dated_users(spark, sf, fx.CUTOFF), fx.CUTOFF, "MobileShell")


def h2_range_df(spark, sf):
    return history.views_range(fx.events(spark, sf), fx.dated_users(spark, sf, fx.DATE), "2024-01-11", fx.DATE)


@query("H2_file_views_full_load", with_model(H2_FULL))
def h2_full(spark, sf):
    return h2_full_df(spark, sf)


@query("H2_file_views_range", with_model(H2_RANGE))
def h2_range(spark, sf):
    return h2_range_df(spark, sf)


H3_PRODUCTS = ", ".join(product_case(n, "", "type") + f" AS create_{n}" for n in PRODUCTS)
H3_OLD = ", ".join(
    ("CAST(0 AS BIGINT)" if codes is None else f"count(CASE WHEN type IN ({codes}) THEN guid END)") + f" AS create_{n}"
    for n, codes in PRODUCTS.items())
H3_SQL = f"""
    SELECT team_id, {", ".join(f"CAST(sum(create_{n}) AS BIGINT) AS create_{n}" for n in ("objs", *PRODUCTS))}, {CUT} AS ldate
    FROM (SELECT team_id, count(CASE WHEN type IN (2, 3) THEN guid END) AS create_objs, {H3_PRODUCTS}
          FROM (SELECT DISTINCT created_by, type, sub_type, guid FROM svc_files WHERE ldate = {CUT} AND type IN (2, 3)) f
          JOIN usr ON usr.id = f.created_by AND team_id IS NOT NULL GROUP BY team_id
          UNION ALL
          SELECT team_id, count(guid) AS create_objs, {H3_OLD}
          FROM (SELECT DISTINCT team_id, user_id, type, guid FROM old_files
                WHERE ldate = {CUT} AND type >= -10 AND type <= 0 AND team_id IS NOT NULL) GROUP BY team_id)
    GROUP BY team_id"""


def h3_df(spark, sf):
    new, legacy = fx.old_files(spark, sf)
    return history.creations_full(new, legacy, fx.dated_users(spark, sf, fx.CUTOFF), fx.CUTOFF)


@query("H3_creations_by_product", with_model(H3_SQL))
def h3(spark, sf):
    return h3_df(spark, sf)


def _sum_or_zero(columns: str, present: tuple[str, ...]) -> str:
    return ", ".join(c if c in present else f"0 AS {c}" for c in columns.split())


SEED_COLUMNS = ("create_objs create_docxs create_sheets create_tables create_ppts create_docs create_clouds create_others "
                "file_views add_collaborations use_ats public_shares comments")
_CREATES = tuple(c for c in SEED_COLUMNS.split() if c.startswith("create"))
_ACTS = ("add_collaborations", "use_ats", "public_shares", "comments")


@query("H4_seed_totals", with_model(f"""
    SELECT {CUT} AS ldate, team_id, {", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in SEED_COLUMNS.split())} FROM (
      SELECT team_id, {_sum_or_zero(SEED_COLUMNS, ("file_views",))} FROM h2 WHERE ldate <= {CUT}
      UNION ALL SELECT team_id, {_sum_or_zero(SEED_COLUMNS, _CREATES)} FROM h3 WHERE ldate = {CUT}
      UNION ALL SELECT team_id, {_sum_or_zero(SEED_COLUMNS, _ACTS)} FROM h1 WHERE ldate <= {CUT}) GROUP BY team_id""",
    h1=H1_FULL, h2=f"{H2_FULL} UNION ALL {H2_RANGE}", h3=H3_SQL))
def h4(spark, sf):
    views = h2_full_df(spark, sf).unionByName(h2_range_df(spark, sf))
    return history.seed_totals(h3_df(spark, sf), views, h1_full_df(spark, sf), fx.CUTOFF)


@query("H5_creations_to_date", with_model(f"""
    SELECT team_id, count(CASE WHEN type IN (2, 3) THEN guid END) AS create_objs, {H3_PRODUCTS}
    FROM (SELECT * FROM fil UNION ALL SELECT * FROM leg) f
    JOIN usr ON CAST(usr.id AS VARCHAR) = f.created_by AND team_id IS NOT NULL GROUP BY team_id"""))
def h5(spark, sf):
    return history.creations_to_date(fx.file_source(spark, sf, 2), fx.file_source(spark, sf, 3), fx.users(spark, sf))


# --- reports ------------------------------------------------------------------------------------
TEAM, OUTSIDE = 4, ("NATION_14",)
ALLOWED = "SELECT DISTINCT user_id FROM ud JOIN dep ON CAST(dep.id AS VARCHAR) = ud.department_id WHERE team_id = 4 AND name NOT IN ('NATION_14')"


@query("R1_login_days", with_model("""
    SELECT s.user_id, user_name, deps, count(*) AS login_dates
    FROM (SELECT DISTINCT ldate, user_id, user_name FROM eva
          WHERE ldate BETWEEN DATE '2024-01-01' AND DATE '2024-01-31' AND team_id = 4) s
    JOIN (SELECT user_id, string_agg(name, ',' ORDER BY name) AS deps FROM ud
          JOIN dep ON CAST(dep.id AS VARCHAR) = ud.department_id WHERE team_id = 4 AND name NOT IN ('NATION_14')
          GROUP BY user_id) d ON d.user_id = s.user_id
    GROUP BY s.user_id, user_name, deps"""))
def r1(spark, sf):
    ws = fx.workspace(spark, sf, "user_dep", "departments")
    return (reports.login_days(ws, TEAM, "2024-01-01", "2024-01-31", OUTSIDE)
            .withColumn("deps", F.array_join("deps", ",")))


def report_sql(keys: str, when: str) -> str:
    members = "SELECT team_id, CAST(id AS VARCHAR) AS user_id FROM usr WHERE team_id = 4"
    if "department_id" in keys:
        members = f"""SELECT m.team_id, m.user_id, ud.department_id, dep.name AS department_name FROM ({members}) m
            LEFT JOIN ud ON ud.user_id = m.user_id LEFT JOIN dep ON CAST(dep.id AS VARCHAR) = ud.department_id"""
    return with_model(f"""
    SELECT * FROM (
      SELECT {keys}, count(CASE WHEN ft = 2 AND st IN (0, -2) THEN guid END) + count(CASE WHEN ft = 2 AND st = -6 THEN guid END) AS docs,
             count(CASE WHEN ft = 2 AND st IN (-1, -3, -4) THEN guid END) AS sheets,
             count(CASE WHEN ft = 1 AND st = 1 THEN guid END) AS dirs, count(CASE WHEN ft = 1 AND st = 2 THEN guid END) AS spaces
      FROM ({members}) t1
      LEFT JOIN (SELECT created_by, guid, CAST(file_type AS BIGINT) AS ft, CAST(file_subtype AS BIGINT) AS st FROM fdim
                 WHERE {when}) t2 ON t1.user_id = t2.created_by
      JOIN ({ALLOWED}) t3 ON t3.user_id = t1.user_id
      GROUP BY {keys}) WHERE docs + sheets + dirs + spaces > 0""")


LOCAL_DAY = "CAST(make_timestamp((created_at + 8 * 3600) * 1000000) AS DATE)"
TO_DATE = f"{LOCAL_DAY} <= DATE '2024-01-10'"
IN_MONTH = f"strftime({LOCAL_DAY}, '%Y-%m') = '2024-01'"
BY_DEP = "team_id, department_id, department_name"


def _creations(spark, sf, **options):
    ws = fx.workspace(spark, sf, "user_dep", "departments", "files")
    return reports.team_creations(ws, TEAM, outside=OUTSIDE, **options)


@query("R2_team_creations_to_date", report_sql("team_id", TO_DATE))
def r2(spark, sf):
    return _creations(spark, sf, last="2024-01-10")


@query("R3_team_creations_in_month", report_sql("team_id", IN_MONTH))
def r3(spark, sf):
    return _creations(spark, sf, first="2024-01-01", last="2024-01-31")


@query("R4_department_creations_to_date", report_sql(BY_DEP, TO_DATE))
def r4(spark, sf):
    return _creations(spark, sf, last="2024-01-10", by_department=True)


@query("R5_department_creations_in_month", report_sql(BY_DEP, IN_MONTH))
def r5(spark, sf):
    return _creations(spark, sf, first="2024-01-01", last="2024-01-31", by_department=True)


@query("R6_allowed_users", with_model(ALLOWED))
def r6(spark, sf):
    return reports.allowed_users(fx.workspace(spark, sf, "user_dep", "departments"), TEAM, OUTSIDE)


SEAT_SUMS = """
    CAST(sum(CASE WHEN order_type = '新增' THEN total_seats ELSE 0 END) AS BIGINT) AS new_seats,
    CAST(sum(CASE WHEN order_type IN ('增购', '云SDK') THEN total_seats ELSE 0 END) AS BIGINT) AS expand_seats,
    CAST(sum(total_seats) AS BIGINT) AS total_seats"""


@query("R7_seats_by_month", with_model(f"""
    SELECT CAST(m.mm AS DATE) + 1 AS mm, {SEAT_SUMS} FROM seat_orders
    JOIN (SELECT unnest(generate_series(TIMESTAMP '1996-01-01', TIMESTAMP '1999-12-01', INTERVAL 1 MONTH)) AS mm) m
      ON order_end_date >= CAST(m.mm AS DATE) AND order_start_date <= last_day(CAST(m.mm AS DATE))
    WHERE NOT regexp_matches(order_type, '升级') GROUP BY m.mm"""))
def r7(spark, sf):
    return reports.seats_by_month(fx.seat_orders(spark, sf), "1996-01", "1999-12")


# --- audits and pipeline ---------------------------------------------------------------------------
@query("Q1_duplicate_guids", with_model("""
    SELECT guid, count(*) AS cnt FROM (SELECT guid FROM fil UNION ALL SELECT guid FROM leg) GROUP BY guid HAVING count(*) > 1"""))
def q1_dups(spark, sf):
    return quality.duplicate_file_guids(files.all_files(fx.file_source(spark, sf, 2), fx.file_source(spark, sf, 3)))


def backfill_sql(body) -> str:
    return " UNION ALL ".join(body(f"DATE '2024-01-{d:02d}'") for d in (13, 14, 15))


@query("B1_backfill_product", with_model(
    "SELECT ldate, team_id, create_objs, create_docxs, create_clouds FROM ("
    + backfill_sql(lambda day: counts_sql(PRODUCT_COUNTS, PRODUCT_ROWS, "team", 7, day=day)) + ")"))
def b1(spark, sf):
    """Three report dates computed in bulk through the roll-ups, stored and read back."""
    store = Store(spark, scratch_path(spark, "backfill"))
    ws = fx.workspace(spark, sf)
    table = "file_7d_product_statistic_by_global"
    jobs.Backfill(ws, store).run("2024-01-13", "2024-01-15", [table])
    return store.read(table).select("ldate", "team_id", "create_objs", "create_docxs", "create_clouds")


def _repaired(spark, sf, task, first: str, events_of_first=lambda events: events):
    """Rows of 2024-01-15 after an earlier run that saw other events, or left a gap."""
    store = Store(spark, scratch_path(spark, "backfill"))
    ws = fx.workspace(spark, sf, "files")
    jobs.Backfill(ws.with_(events=events_of_first(ws.events)), store).run(first, tasks=[task])
    jobs.Backfill(ws, store).run(fx.DATE, tasks=[task])
    return store.read_day(task, fx.DATE)


def _late(events):
    return events.filter("ldate <> date'2024-01-12' OR pmod(hash(time, user_id), 5) <> 0")


def _resumed(spark, sf, task):
    """Rows of 2024-01-15 from a run that broke after its first date and was started again under its name."""
    store = Store(spark, scratch_path(spark, "backfill"))
    ws = fx.workspace(spark, sf, "files")

    def broken(task, date, rows):
        if date == DAY.end:
            raise InterruptedError("the run breaks before this date counts as finished")

    run = dict(ws=ws, store=store, bulk=False, name="resumed")
    with suppress(InterruptedError):
        jobs.Backfill(**run, serve=broken).run("2024-01-14", fx.DATE, [task])
    jobs.Backfill(**run).run("2024-01-14", fx.DATE, [task])
    return store.read_day(task, fx.DATE)


for _id, _task in (("M07", usage.COLLAB_30D_BY_MEMBER.table), ("M08", usage.PRODUCT_BY_TEAM.table),
                   ("M14", rankings.HOT_7D), ("M15", rankings.SPACES)):
    _sql = ORACLES[f"{_id}_{_task}"]
    query(f"B1_backfill_after_gap_{_id}", _sql)(lambda spark, sf, t=_task: _repaired(spark, sf, t, "2024-01-03"))
    query(f"B1_resumed_run_{_id}", _sql)(lambda spark, sf, t=_task: _resumed(spark, sf, t))
    query(f"B1_late_rows_{_id}", _sql)(lambda spark, sf, t=_task: _repaired(spark, sf, t, "2024-01-14", _late))
