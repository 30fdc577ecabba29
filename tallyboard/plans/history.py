"""Backfills that seed the cumulative table from older systems."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import predicates as p
from ..functions.scalars import DateLike, day, json_value, normal_id
from ..operators.aggregates import count_bank, sums
from ..operators.joins import full_merge_sum
from ..schemas import PRODUCTS, TOTAL_COUNTS

COLLAB_SUMS = ("add_collaborations", "use_ats", "public_shares", "comments")
CREATE_SUMS = ("create_objs", *(f"create_{n}" for n in PRODUCTS))

# First path segment of pages that show a file (fixed values).
FILE_PAGES = ("doc", "spreadsheet", "docs", "sheet", "sheets", "slides", "docx", "mindmaps",
              "forms", "whiteboard", "presentation", "folder", "space")
GUID_LENGTH = 16


def _snapshot(table: DataFrame, date: DateLike) -> DataFrame:
    return table.filter(p.on_day(date))


def _team_users(users: DataFrame, date: DateLike) -> DataFrame:
    return (_snapshot(users, date).filter(F.col("team_id").isNotNull())
            .select(F.col("id").cast("string").alias("user_id"), "team_id"))


# --- collaboration ------------------------------------------------------------
def collaboration_full_load(users: DataFrame, permissions: DataFrame, notifications: DataFrame,
                            share_events: DataFrame, comments: DataFrame, date: DateLike) -> DataFrame:
    """Totals up to ``date`` from daily full copies of the source tables.

    Acts of users without a team, or unknown, end up in one row with a NULL team.
    """
    def per_user(rows: DataFrame, out: str, user: str = "user_id") -> DataFrame:
        return (rows.groupBy(normal_id(F.col(user)).alias("user_id"))
                .agg(F.count(F.lit(1)).alias(out)))

    shared = share_events.filter(p.up_to(date) & (F.col("end_mode") != "private"))
    members = _team_users(users, date)
    merged = full_merge_sum(
        [members.select("user_id"),
         per_user(_snapshot(permissions, date), "add_collaborations"),
         per_user(_snapshot(notifications, date), "use_ats"),
         per_user(shared, "public_shares"),
         per_user(_snapshot(comments, date), "comments")],
        ["user_id"], COLLAB_SUMS)
    return (merged.join(members, "user_id", "left").groupBy("team_id")
            .agg(*sums(COLLAB_SUMS))
            .withColumn("ldate", day(date)))


def collaboration_range(events: DataFrame, users: DataFrame, start: DateLike, end: DateLike) -> DataFrame:
    """Totals of the events of start..end, labelled with ``end``; one day when both are equal.

    The share status is read as a JSON value here, so ``1`` and ``"1"`` both count.
    """
    shared = p.action(p.PUBLIC_SHARE) & (json_value(F.col("extend_info"), "status") == "1")
    per_user = (events.filter(F.col("ldate").between(day(start), day(end)))
                .filter(p.action(p.ADD_COLLABORATOR, p.AT, p.PUBLIC_SHARE, p.COMMENT))
                .groupBy(normal_id(F.col("user_id")).alias("user_id"))
                .agg(F.count_if(p.action(p.ADD_COLLABORATOR)).alias("add_collaborations"),
                     F.count_if(p.action(p.AT)).alias("use_ats"),
                     F.count(F.when(shared, F.col("guid"))).alias("public_shares"),
                     F.count_if(p.action(p.COMMENT)).alias("comments")))
    return (per_user.join(_team_users(users, end), "user_id").groupBy("team_id")
            .agg(*sums(COLLAB_SUMS)).withColumn("ldate", day(end)))


# --- file views -----------------------------------------------------------------
def web_file_view(mobile_shell: str) -> Column:
    """A web log row that shows a file: a page view outside the mobile shell, or the shell's
    own web view. ``mobile_shell`` is a pattern found in the shell's user agent."""
    in_shell = F.col("user_agent").rlike(mobile_shell)
    page = F.split_part(F.col("s_url_path"), F.lit("/"), F.lit(2))
    rest = F.split_part(F.col("s_url_path"), F.lit("/"), F.lit(3))
    return (((F.col("event_type") == "$pageview") & ~in_shell & page.isin(*FILE_PAGES) & rest.isNotNull())
            | ((F.col("event_type") == "app_webview") & in_shell))


def views_full_load(web: DataFrame, wx: DataFrame, app: DataFrame, users: DataFrame,
                    date: DateLike, mobile_shell: str, user_col: str = "client_user_id") -> DataFrame:
    """File views up to ``date`` from three client logs, per team and source."""
    sources: Mapping[str, tuple[DataFrame, Column]] = {
        "web.events": (web, web_file_view(mobile_shell)),
        "app.wxevents": (wx, F.col("event_type") == "wx_openfile"),
        "app.appevent": (app, F.col("event_type").isin("appView", "app_webview")),
    }
    parts = None
    for flag, (log, shows_file) in sources.items():
        part = (log.filter(p.up_to(date) & (F.length("guid") == GUID_LENGTH) & shows_file)
                .groupBy(normal_id(F.col(user_col)).alias("user_id"))
                .agg(F.count(F.lit(1)).alias("file_views")).withColumn("flag", F.lit(flag)))
        parts = part if parts is None else parts.unionByName(part)
    return (parts.join(_team_users(users, date), "user_id").groupBy("team_id", "flag")
            .agg(F.sum("file_views").alias("file_views")).withColumn("ldate", day(date)))


def views_range(events: DataFrame, users: DataFrame, start: DateLike, end: DateLike,
                flag: str = "service_events") -> DataFrame:
    """File views of start..end from the service event table."""
    per_user = (events.filter(F.col("ldate").between(day(start), day(end)) & p.action(p.VIEW))
                .groupBy(normal_id(F.col("user_id")).alias("user_id"))
                .agg(F.count(F.lit(1)).alias("file_views")))
    return (per_user.join(_team_users(users, end), "user_id").groupBy("team_id")
            .agg(F.sum("file_views").alias("file_views"))
            .select("team_id", F.lit(flag).alias("flag"), "file_views", day(end).alias("ldate")))


# --- creations ------------------------------------------------------------------
def _bank(type_col: str, sub_col: str) -> dict[str, Column]:
    return {"create_objs": p.any_product(type_col),
            **{f"create_{n}": p.product(n, type_col, sub_col) for n in PRODUCTS}}


def creations_full(files: DataFrame, legacy_files: DataFrame, users: DataFrame, date: DateLike,
                   users_date: DateLike | None = None) -> DataFrame:
    """Files by product from two file systems, as of their copies of ``date``.

    The older system stores the product code in ``type`` and the team on the file itself.
    """
    owned = (_snapshot(files, date).filter(p.any_product("type"))
             .select("created_by", "type", "sub_type", "guid").distinct())
    per_user = count_bank(owned.withColumn("user_id", normal_id(F.col("created_by"))),
                          ["user_id"], _bank("type", "sub_type"), F.col("guid"))
    new = (per_user.join(_team_users(users, users_date or date), "user_id")
           .select("team_id", *CREATE_SUMS))

    old = (_snapshot(legacy_files, date)
           .filter(F.col("type").between(-10, 0) & F.col("team_id").isNotNull())
           .select("team_id", "user_id", "type", "guid").distinct()
           .withColumn("kind", F.lit(p.DOCUMENT)))
    bank = {n: c for n, c in _bank("kind", "type").items() if n != "create_clouds"}
    old = count_bank(old, ["team_id"], bank, F.col("guid")).withColumn("create_clouds", F.lit(0))
    return (new.unionByName(old).groupBy("team_id")
            .agg(*sums(CREATE_SUMS)).withColumn("ldate", day(date)))


def creations_to_date(current: DataFrame, legacy: DataFrame, users: DataFrame) -> DataFrame:
    """Files by product from both current file tables, through the team of their creator."""
    from .files import all_files
    from .model import user_teams

    made = all_files(current, legacy).withColumn("user_id", normal_id(F.col("created_by")))
    per_user = count_bank(made, ["user_id"], _bank("type", "sub_type"), F.col("guid"))
    return (per_user.join(user_teams(users), "user_id").groupBy("team_id")
            .agg(*sums(CREATE_SUMS)))


# --- merge ----------------------------------------------------------------------
def seed_totals(creations: DataFrame, views: DataFrame, collaborations: DataFrame,
                date: DateLike) -> DataFrame:
    """First row of the cumulative table: views and collaborations up to ``date`` summed,
    creations of the copy taken on ``date``."""
    merged = full_merge_sum(
        [views.filter(p.up_to(date)), creations.filter(p.on_day(date)),
         collaborations.filter(p.up_to(date))],
        ["team_id"], TOTAL_COUNTS)
    return merged.select(day(date).alias("ldate"), "team_id", *TOTAL_COUNTS)
