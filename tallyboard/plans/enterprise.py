"""Team-level seat activation, active users, cumulative usage and creation report."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import predicates as p
from ..functions.scalars import change, first_day_at_or_after, share, zero_if_null
from ..operators.aggregates import sums as sums_of
from ..operators.periods import Span, earlier_values, running_total
from ..schemas import PRODUCTS, RESULTS, TOTAL_COUNTS, conform
from .model import Workspace, user_teams
from .rollups import user_active_days, user_counts

USERS_TABLE = "enterprise_7d_user_statistic_by_global"
TOTALS_TABLE = "enterprise_td_usage_statistic_by_global"
CREATION_TABLE = "creation_1d_download_by_global"

WINDOW_DAYS = 7
DEEP_ACTIVE_DAYS = 3


class MissingSnapshot(RuntimeError):
    """A strict job found no earlier rows of its own table."""


def _earlier(ws: Workspace, table: str, first: dt.date, last: dt.date, strict: bool) -> DataFrame | None:
    rows = ws.snapshot(table)
    if rows is not None:
        rows = rows.filter(F.col("ldate").between(F.lit(first), F.lit(last)))
    if strict and (rows is None or rows.isEmpty()):
        raise MissingSnapshot(f"{table} has no rows between {first} and {last}")
    return rows


def activated_seats(users: DataFrame, span: Span) -> DataFrame:
    """Per (report date, team): live seats created before the midnight that opens the date."""
    seats = (users.filter((F.col("is_seat") == 1) & F.col("team_id").isNotNull()
                          & F.col("deleted_at").isNull())
             .withColumn("from", F.greatest(first_day_at_or_after(F.col("created_at")),
                                            F.lit(span.start)))
             .filter(F.col("from") <= F.lit(span.end))
             .groupBy("team_id", "from").agg(F.count(F.lit(1)).alias("n")))
    return (seats.withColumn("ldate", F.explode(F.sequence("from", F.lit(span.end))))
            .groupBy("ldate", "team_id").agg(F.sum("n").alias("activated_seats")))


def seats_and_activity(ws: Workspace, span: Span, strict: bool = False) -> DataFrame:
    """Seats, active and deep-active users, each against the value seven days earlier.

    A team with several enterprise membership rows gets a row for each.
    """
    members = (ws.need("membership")
               .filter(F.col("category").isin(*p.ENTERPRISE_CATEGORIES) & F.col("deleted_at").isNull())
               .select(F.col("target_id").alias("team_id"), "member_count"))
    active = (user_active_days(ws, span, WINDOW_DAYS).join(user_teams(ws.users), "user_id")
              .groupBy("ldate", "team_id")
              .agg(F.count("user_id").alias("active_uv"),
                   F.count_if(F.col("active_days") >= DEEP_ACTIVE_DAYS).alias("deep_active_uv")))
    now = (activated_seats(ws.users, span).join(members, "team_id")
           .join(active, ["ldate", "team_id"], "left")
           .select("ldate", "team_id", zero_if_null(F.col("member_count")).alias("member_count"),
                   "activated_seats", zero_if_null(F.col("active_uv")).alias("active_uv"),
                   zero_if_null(F.col("deep_active_uv")).alias("deep_active_uv")))

    values = ("activated_seats", "active_uv", "deep_active_uv")
    stored = _earlier(ws, USERS_TABLE, span.start - dt.timedelta(WINDOW_DAYS),
                      min(span.start - dt.timedelta(1), span.end - dt.timedelta(WINDOW_DAYS)), strict)
    both = now.withColumn("_now", F.lit(True))
    if stored is not None:
        both = both.unionByName(
            stored.select("ldate", F.col("team_id").cast("bigint").alias("team_id"), *values,
                          F.lit(False).alias("_now")), allowMissingColumns=True)
    out = (earlier_values(both, ["team_id"], values, WINDOW_DAYS, "before_7d_").filter("_now")
           .select(*now.columns, *[zero_if_null(F.col(f"before_7d_{v}")).alias(f"before_7d_{v}") for v in values]))
    out = out.select(
        "*", *[change(F.col(v), F.col(f"before_7d_{v}")).alias(f"{v}_change_ratio") for v in values],
        share(F.col("activated_seats"), F.col("member_count")).alias("activated_seats_ratio"),
        share(F.col("active_uv"), F.col("member_count")).alias("active_uv_ratio"))
    return conform(out, RESULTS[USERS_TABLE])


TOTAL_SOURCES = {
    "create_objs": "td_create_objs", **{f"create_{n}": f"td_create_{n}" for n in PRODUCTS},
    "public_shares": "td_public_shares",
    **{c: c for c in ("file_views", "add_collaborations", "use_ats", "comments")},
}


def usage_to_date(ws: Workspace, span: Span, strict: bool = False) -> DataFrame:
    """Cumulative usage per team: the stored total of the day before plus each new day.

    Without a stored total, counting starts at the first date of the span.
    """
    sums = list(TOTAL_COUNTS)
    new = (user_counts(ws, "to_date", list(TOTAL_SOURCES.values()), span, 1)
           .join(user_teams(ws.users), "user_id")
           .select("ldate", "team_id", *[F.col(s).alias(n) for n, s in TOTAL_SOURCES.items()]))
    eve = span.start - dt.timedelta(1)
    stored = _earlier(ws, TOTALS_TABLE, eve, eve, strict)
    if stored is not None:
        new = new.unionByName(stored.select(
            F.lit(span.start).alias("ldate"), F.col("team_id").cast("bigint").alias("team_id"),
            *[zero_if_null(F.col(c)).cast("bigint").alias(c) for c in sums]))
    deltas = new.groupBy("ldate", "team_id").agg(*sums_of(sums))
    total = deltas if span.single else running_total(deltas, ["team_id"], sums, span.end)
    return conform(total, RESULTS[TOTALS_TABLE])


def creation_download(ws: Workspace, span: Span) -> DataFrame:
    """Seven-day creations with cumulative totals and seats of the same report date."""
    own = ["create_objs", *(f"create_{n}" for n in PRODUCTS), "create_dirs", "create_spaces"]
    made = (user_counts(ws, "creation", own, span, WINDOW_DAYS)
            .join(user_teams(ws.users), "user_id")
            .groupBy("ldate", "team_id").agg(*sums_of(own)))

    def same_day(table: str) -> DataFrame:
        rows = ws.snapshot(table)
        if rows is None:
            raise MissingSnapshot(f"{CREATION_TABLE} needs {table} of the same dates")
        return rows.filter(span.covers()).withColumn("team_id", F.col("team_id").cast("bigint"))

    seats = same_day(USERS_TABLE).select(
        "ldate", "team_id", "member_count", "activated_seats", "deep_active_uv")
    totals = same_day(TOTALS_TABLE).select(
        "ldate", "team_id", F.col("create_objs").alias("total_create_objs"),
        F.col("add_collaborations").alias("total_add_collaborations"))
    out = made.join(seats, ["ldate", "team_id"], "left").join(totals, ["ldate", "team_id"], "left")
    return conform(out, RESULTS[CREATION_TABLE])
