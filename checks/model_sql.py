"""The logical inputs as DuckDB CTEs, written independently of the Spark adapter."""

from __future__ import annotations

import re

D = "DATE '2024-01-15'"
CUT = "DATE '2024-01-10'"

# (name, body); later entries may use earlier ones.
_CTES: dict[str, str] = {
    "raw_ev": """
        SELECT event_id AS e, CAST(props->>'$.k' AS INTEGER) AS k, ts, user_id, event_type FROM events""",
    "ev": """
        SELECT CAST(ts AS DATE) AS ldate, event_type,
               CASE WHEN e % 97 = 0 THEN NULL ELSE CAST(e % 300 + 300 * (e // 3000) AS VARCHAR) END AS guid,
               CAST(user_id AS VARCHAR) AS user_id, 'd' || (e % 7) AS device_id,
               CAST(CASE WHEN event_type = 'error' THEN 0 ELSE 1 + (e + k) % 3 END AS INTEGER) AS file_type,
               CAST(CASE WHEN event_type = 'error' THEN 0
                         WHEN 1 + (e + k) % 3 = 2 THEN -(e % 11)
                         WHEN 1 + (e + k) % 3 = 1 THEN 1 + e % 2 ELSE 0 END AS INTEGER) AS sub_type,
               epoch_us(ts) // 1000 AS time,
               CASE event_type WHEN 'signup' THEN 'create_obj' WHEN 'view' THEN 'view_file'
                    WHEN 'purchase' THEN CASE k % 3 WHEN 0 THEN 'import_obj' WHEN 1 THEN 'upload_obj' ELSE 'add_collaborator' END
                    WHEN 'click' THEN CASE k % 3 WHEN 0 THEN 'comment' WHEN 1 THEN 'at' ELSE 'public_share' END
                    ELSE 'unknown' END AS action_name,
               CAST(NULL AS VARCHAR) AS action_param,
               CASE WHEN e % 3 = 0 THEN 'MobileShell/1.0' ELSE 'Browser/1.0' END AS user_agent,
               CASE WHEN event_type = 'click' AND k % 3 = 2
                    THEN CASE WHEN k % 2 = 0 THEN '{"status":1}' ELSE '{"status":"1"}' END
                    ELSE '{}' END AS extend_info,
               CAST(0 AS BIGINT) AS team_id
        FROM raw_ev""",
    "usr": """
        SELECT c_custkey AS id, c_name AS name,
               CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_custkey % 10 END AS team_id,
               CASE WHEN c_custkey % 3 <> 0 THEN 1 ELSE 0 END AS is_seat,
               CAST(DATE '2023-12-01' + CAST(c_custkey % 60 AS INTEGER) AS TIMESTAMP) AS created_at,
               CASE WHEN c_custkey % 11 = 0 THEN TIMESTAMP '2024-01-10' END AS deleted_at
        FROM customer""",
    "mem": """
        SELECT CAST(n_nationkey AS BIGINT) AS target_id, 1 + n_nationkey % 4 AS category,
               CAST(5 * (n_nationkey + 1) AS BIGINT) AS member_count FROM nation""",
    "dep": """
        SELECT CAST(100 + n_nationkey AS BIGINT) AS id, n_name AS name,
               CAST(n_nationkey % 10 AS BIGINT) AS team_id FROM nation""",
    "edg": """
        SELECT 11 AS node_type, c_custkey AS node_id, 10 AS parent_type, 100 + c_custkey % 25 AS parent_id,
               c_custkey % 13 = 0 AS is_removed FROM customer
        UNION ALL
        SELECT 11, c_custkey, 10, 100 + (c_custkey + 7) % 25, c_custkey % 13 = 0 FROM customer WHERE c_custkey % 5 = 0
        UNION ALL
        SELECT 10, 100 + n_nationkey, CASE WHEN n_nationkey < 4 THEN 9 ELSE 10 END,
               CASE WHEN n_nationkey < 4 THEN 900 + n_nationkey % 2 ELSE 100 + n_nationkey // 4 END, false
        FROM nation""",
    "walk(u, pt, pid)": """
        SELECT node_id, parent_type, parent_id FROM edg WHERE node_type = 11 AND NOT is_removed
        UNION
        SELECT w.u, edg.parent_type, edg.parent_id FROM walk w
        JOIN edg ON edg.node_type = w.pt AND edg.node_id = w.pid AND edg.node_type IN (9, 10) AND NOT edg.is_removed""",
    "ud": """
        SELECT DISTINCT CAST(u AS VARCHAR) AS user_id, CAST(pid AS VARCHAR) AS department_id FROM walk""",
    "parts": """
        SELECT p_partkey AS k, CAST(p_partkey AS VARCHAR) AS guid,
               CASE WHEN p_partkey % 50 = 48 THEN NULL ELSE p_name END AS name,
               CAST(2 + (p_partkey % 4) // 2 AS INTEGER) AS type, CAST(-(p_partkey % 11) AS INTEGER) AS sub_type,
               CAST(1704067200 + p_partkey * 600 AS BIGINT) AS created_at,
               CAST(p_partkey % 15 + 15 * (p_partkey // 200) AS VARCHAR) AS created_by FROM part""",
    "fil": "SELECT * EXCLUDE (k) FROM parts WHERE k % 2 = 0",
    "leg": "SELECT * EXCLUDE (k) FROM parts WHERE k % 3 = 0",
    "fdim": """
        SELECT guid, name, CAST(type AS VARCHAR) AS file_type, CAST(sub_type AS VARCHAR) AS file_subtype,
               created_at, created_by, CAST(-1 AS BIGINT) AS updated_at, 'null' AS updated_by,
               CAST(-1 AS BIGINT) AS deleted_at, 'null' AS deleted_by, file_loc
        FROM (SELECT *, 'space' AS file_loc FROM fil
              UNION ALL SELECT *, 'desktop' FROM leg WHERE guid NOT IN (SELECT guid FROM fil))""",
    "eva": """
        SELECT ev.* EXCLUDE (team_id), usr.team_id, usr.name AS user_name,
               regexp_extract(ev.extend_info, '"status":\\s*("[^"]*"|[^,}\\s]+)', 1) = '1' AS shared
        FROM ev LEFT JOIN usr ON ev.user_id = CAST(usr.id AS VARCHAR)""",
    "seats": "SELECT CAST(id AS VARCHAR) AS user_id FROM usr WHERE is_seat = 1 AND team_id IS NOT NULL",
    # --- older systems
    "permissions": f"SELECT o_custkey + 20 AS user_id, {CUT} AS ldate FROM orders",
    "notifications": f"SELECT l_suppkey AS user_id, {CUT} AS ldate FROM lineitem",
    "old_comments": f"SELECT conv_id AS user_id, {CUT} AS ldate FROM conversations",
    "share_events": """
        SELECT user_id, CASE WHEN event_id % 3 = 0 THEN 'private' ELSE 'public' END AS end_mode,
               CAST(ts AS DATE) AS ldate FROM events""",
    "logs": """
        SELECT CAST(ts AS DATE) AS ldate, CAST(user_id AS VARCHAR) AS client_user_id,
               CASE WHEN event_id % 5 = 0 THEN CAST(event_id % 300 + 300 * (event_id // 3000) AS VARCHAR)
                    ELSE lpad(CAST(event_id % 300 + 300 * (event_id // 3000) AS VARCHAR), 16, '0') END AS guid,
               CASE WHEN event_id % 3 = 0 THEN 'MobileShell/1.0' ELSE 'Browser/1.0' END AS user_agent,
               (['$pageview','app_webview','click','$pageview'])[1 + (event_id // 2) % 4] AS web_type,
               (['wx_openfile','wx_share','wx_openfile','wx_login'])[1 + (event_id // 2) % 4] AS wx_type,
               (['appView','app_webview','appStart','appView'])[1 + (event_id // 2) % 4] AS app_type,
               '/' || (['docs','sheets','folder','home','space','login','slides','forms'])[1 + (event_id // 8) % 8]
                   || '/' || lpad(CAST(event_id % 300 + 300 * (event_id // 3000) AS VARCHAR), 16, '0') AS s_url_path
        FROM events""",
    "svc_files": f"""
        SELECT p_partkey % 15 + 15 * (p_partkey // 200) AS created_by, CAST(1 + p_partkey % 3 AS INTEGER) AS type,
               CAST(-(p_partkey % 11) AS INTEGER) AS sub_type, CAST(p_partkey // 2 AS VARCHAR) AS guid, {CUT} AS ldate
        FROM part""",
    "old_files": f"""
        SELECT CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE o_custkey % 10 END AS team_id, o_custkey AS user_id,
               CAST(2 - o_orderkey % 14 AS INTEGER) AS type, 'L' || (o_orderkey // 3) AS guid, {CUT} AS ldate
        FROM orders""",
    "seat_orders": """
        SELECT (['新增','增购','云SDK','升级','续费'])[1 + o_orderkey % 5] AS order_type,
               CAST(1 + o_orderkey % 50 AS INTEGER) AS total_seats, CAST(o_orderdate AS DATE) AS order_start_date,
               CAST(o_orderdate AS DATE) + CAST(o_orderkey % 400 AS INTEGER) AS order_end_date FROM orders""",
}


def _key(name: str) -> str:
    return name.split("(")[0]


def with_model(body: str, **local: str) -> str:
    """Prefix ``body`` with the CTEs it mentions (directly or not), then ``local`` ones."""
    named = {_key(n): n for n in _CTES}
    needed: set[str] = set()
    todo = [body, *local.values()]
    while todo:
        words = set(re.findall(r"\w+", todo.pop()))
        for w in words & named.keys() - needed:
            needed.add(w)
            todo.append(_CTES[named[w]])
    parts = [f"{n} AS ({sql})" for n, sql in _CTES.items() if _key(n) in needed]
    parts += [f"{n} AS ({sql})" for n, sql in local.items()]
    if not parts:
        return body
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + body
