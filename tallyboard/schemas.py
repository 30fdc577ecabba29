"""Declared schemas of the logical inputs and of every result table.

Schemas are DDL strings: readers pass them to Spark so that nothing is inferred, and ``conform`` puts a
frame into the declared column order and types before it is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


# --- event stream -----------------------------------------------------------
EVENT_FIELDS = (
    "event_type STRING, guid STRING, user_id STRING, device_id STRING, "
    "file_type INT, sub_type INT, time BIGINT, action_name STRING, "
    "action_param STRING, user_agent STRING, extend_info STRING, team_id BIGINT"
)
EVENT = (EVENT_FIELDS)
STORED_EVENT = ("ldate DATE, " + EVENT_FIELDS)

# --- dimensions -------------------------------------------------------------
USERS = (
    "id BIGINT, name STRING, team_id BIGINT, is_seat INT, "
    "created_at TIMESTAMP_NTZ, deleted_at TIMESTAMP_NTZ"
)
MEMBERSHIP = (
    "target_id BIGINT, category INT, member_count BIGINT, deleted_at TIMESTAMP_NTZ"
)
DEPARTMENTS = ("id BIGINT, name STRING, team_id BIGINT")
EDGE = (
    "node_type INT, node_id BIGINT, parent_type INT, parent_id BIGINT, "
    "version BIGINT, `order` BIGINT, is_link BOOLEAN, is_removed BOOLEAN"
)
FILE_SOURCE = (
    "guid STRING, name STRING, type INT, sub_type INT, created_at BIGINT, "
    "created_by STRING, deleted_at TIMESTAMP_NTZ"
)
USER_DEP = ("user_id STRING, department_id STRING")
FILES = (
    "guid STRING, name STRING, file_type STRING, file_subtype STRING, "
    "created_at BIGINT, created_by STRING, updated_at BIGINT, updated_by STRING, "
    "deleted_at BIGINT, deleted_by STRING, file_loc STRING"
)
SEAT_ORDERS = (
    "order_type STRING, total_seats INT, order_start_date DATE, order_end_date DATE"
)

# --- change messages --------------------------------------------------------
CHANGE_MESSAGE = (
    "database STRING, table STRING, type STRING, ts BIGINT, xid BIGINT, "
    "xoffset BIGINT, data STRUCT<id: BIGINT, name: STRING>"
)

# --- result tables (first column is the report date) -------------------------
PRODUCTS = ("docxs", "sheets", "tables", "ppts", "docs", "clouds", "others")
FILE_COUNTS = ("create_files", "import_files", "upload_files")
COLLAB_COUNTS = (
    "add_collaborations", "use_ats", "public_shares", "comments", "file_views", "create_files",
)
TOTAL_COUNTS = (
    "create_objs", *(f"create_{p}" for p in PRODUCTS),
    "file_views", "add_collaborations", "use_ats", "public_shares", "comments",
)

_GRAIN_KEYS = {
    "team": "team_id BIGINT",
    "department": "team_id BIGINT, department_id STRING",
    "member": "team_id BIGINT, user_id STRING",
}


def _result(grain: str, *columns: str) -> str:
    return (", ".join(["ldate DATE", _GRAIN_KEYS[grain], *columns]))


def _longs(names) -> list[str]:
    return [f"{n} BIGINT" for n in names]


def _product_columns() -> list[str]:
    cols = ["create_objs BIGINT"]
    for p in PRODUCTS:
        cols += [f"create_{p} BIGINT", f"create_{p}_ratio DOUBLE"]
    return cols


_HOT = ("guid STRING", "name STRING", "type STRING", "sub_type STRING",
        "file_views BIGINT", "row_number INT")

RESULTS: dict[str, str] = {
    "file_7d_statistic_by_global": _result("team", *_longs(FILE_COUNTS)),
    "file_7d_statistic_by_department": _result("department", *_longs(FILE_COUNTS)),
    "file_7d_statistic_by_member": _result("member", *_longs(FILE_COUNTS)),
    "collaboration_7d_statistic_by_global": _result("team", *_longs(COLLAB_COUNTS)),
    "collaboration_7d_statistic_by_department": _result("department", *_longs(COLLAB_COUNTS)),
    "collaboration_7d_statistic_by_member": _result("member", *_longs(COLLAB_COUNTS)),
    "collaboration_30d_statistic_by_member": _result("member", *_longs(COLLAB_COUNTS)),
    "file_7d_product_statistic_by_global": _result("team", *_product_columns()),
    "file_7d_product_statistic_by_department": _result("department", *_product_columns()),
    "file_7d_product_statistic_by_member": _result("member", *_product_columns()),
    "enterprise_7d_user_statistic_by_global": _result(
        "team",
        "member_count BIGINT", "activated_seats BIGINT", "activated_seats_ratio DOUBLE",
        "before_7d_activated_seats BIGINT", "activated_seats_change_ratio DOUBLE",
        "active_uv BIGINT", "active_uv_ratio DOUBLE", "before_7d_active_uv BIGINT",
        "active_uv_change_ratio DOUBLE", "deep_active_uv BIGINT",
        "before_7d_deep_active_uv BIGINT", "deep_active_uv_change_ratio DOUBLE",
    ),
    "enterprise_td_usage_statistic_by_global": _result("team", *_longs(TOTAL_COUNTS)),
    "file_1d_hot_statistic_by_global": _result("team", *_HOT),
    "file_7d_hot_statistic_by_global": _result("team", *_HOT),
    "space_1d_updated_statistic_by_global": _result(
        "team", "guid STRING", "name STRING", "updated_at TIMESTAMP_NTZ"),
    "usage_1d_download_by_member": (
        "ldate DATE, team_id BIGINT, department_id STRING, user_id STRING, user_name STRING, "
        + ", ".join(_longs((
            "file_views", "create_files", "create_spaces", "create_dirs", "use_ats",
            "add_collaborations", "public_shares", "comments", "active_score",
            "import_files", "upload_files")))),
    "creation_1d_download_by_global": _result("team", *_longs((
        "create_objs", "create_docxs", "create_sheets", "create_tables", "create_ppts",
        "create_docs", "create_clouds", "create_dirs", "create_spaces", "create_others",
        "total_create_objs", "total_add_collaborations", "member_count",
        "activated_seats", "deep_active_uv"))),
}


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """Project ``df`` onto a declared schema: its order, its types, nothing else."""
    schema = T.StructType.fromDDL(ddl)
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing from frame: {missing}")
    return df.selectExpr(*[f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema])
