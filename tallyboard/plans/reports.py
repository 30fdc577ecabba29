"""One-off exports for a single team, and the seat-order report."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import predicates as p
from ..functions.scalars import DateLike, as_date, day, zero_if_null
from ..operators.aggregates import count_bank, names_list
from ..schemas import PRODUCTS
from .model import Workspace, enrich_events

# Departments left out of the allow-list (fixed values).
OUTSIDE_DEPARTMENTS = ("家长", "学生")
# Seat order types (fixed values): new, expansion, cloud SDK; upgrades are not counted.
NEW_ORDER = "新增"
EXPANSION_ORDERS = ("增购", "云SDK")
UPGRADE_PATTERN = "升级"

_EPOCH = dt.date(1970, 1, 1)


def team_departments(departments: DataFrame, team: int, outside: Sequence[str]) -> DataFrame:
    return (departments.filter((F.col("team_id") == team) & ~F.col("name").isin(*outside))
            .select(F.col("id").cast("string").alias("department_id"),
                    F.col("name").alias("department_name")))


def allowed_users(ws: Workspace, team: int, outside: Sequence[str] = OUTSIDE_DEPARTMENTS) -> DataFrame:
    """Users in any department of the team that is not left out, once each."""
    deps = team_departments(ws.need("departments"), team, outside)
    return ws.need("user_dep").join(deps, "department_id").select("user_id").distinct()


def login_days(ws: Workspace, team: int, start: DateLike, end: DateLike,
               outside: Sequence[str] = OUTSIDE_DEPARTMENTS) -> DataFrame:
    """Days with any event per user, with the names of the user's departments."""
    deps = names_list(ws.need("user_dep").join(
        team_departments(ws.need("departments"), team, outside), "department_id"),
        ["user_id"], "department_name", "deps")
    seen = (ws.events.filter(F.col("ldate").between(day(start), day(end)))
            .select("ldate", "user_id", F.lit(None).cast("bigint").alias("team_id")).distinct())
    days = (enrich_events(seen, ws.users).filter(F.col("team_id") == team)
            .groupBy("user_id", "user_name").agg(F.count("ldate").alias("login_dates")))
    return days.join(deps, "user_id").select("user_id", "user_name", "deps", "login_dates")


def created_between(first: DateLike | None, last: DateLike, shift_hours: int):
    """File creation date in the report zone within first..last, as a range on the raw epoch
    seconds, so that it reaches the scan."""
    def opens(d: dt.date) -> int:
        return (d - _EPOCH).days * 86400 - shift_hours * 3600

    upper = F.col("created_at") < opens(as_date(last) + dt.timedelta(1))
    return upper if first is None else (F.col("created_at") >= opens(as_date(first))) & upper


def team_creations(ws: Workspace, team: int, last: DateLike, first: DateLike | None = None,
                   by_department: bool = False, outside: Sequence[str] = OUTSIDE_DEPARTMENTS,
                   shift_hours: int = 8) -> DataFrame:
    """Documents, sheets, folders and spaces made by the allowed users of a team.

    To date (``first`` None) or within first..last; per team, or per department of the
    creator with its name.
    """
    kind, sub = F.col("file_type").cast("int"), F.col("file_subtype").cast("int")
    files = (ws.need("files").filter(created_between(first, last, shift_hours))
             .select(F.col("created_by").alias("user_id"), "guid",
                     kind.alias("file_type"), sub.alias("sub_type")))
    bank = {n: p.product(n) for n in PRODUCTS if n in ("docxs", "docs", "sheets")}
    bank["dirs"] = p.file_type(p.FOLDER_OR_SPACE) & (F.col("sub_type") == p.FOLDER)
    bank["spaces"] = p.file_type(p.FOLDER_OR_SPACE) & (F.col("sub_type") == p.SPACE)
    made = count_bank(files, ["user_id"], bank, F.col("guid"))

    members = (ws.users.filter(F.col("team_id") == team)
               .select("team_id", F.col("id").cast("string").alias("user_id"))
               .join(allowed_users(ws, team, outside), "user_id", "left_semi"))
    keys = ["team_id"]
    if by_department:
        names = ws.need("departments").select(F.col("id").cast("string").alias("department_id"),
                                              F.col("name").alias("department_name"))
        members = members.join(ws.need("user_dep"), "user_id", "left").join(names, "department_id", "left")
        keys += ["department_id", "department_name"]
    sums = members.join(made, "user_id", "left").groupBy(*keys).agg(
        *[F.sum(zero_if_null(F.col(c))).alias(c) for c in bank])
    out = sums.select(*keys, (F.col("docxs") + F.col("docs")).alias("docs"), "sheets", "dirs", "spaces")
    return out.filter(F.col("docs") + F.col("sheets") + F.col("dirs") + F.col("spaces") > 0)


# --- seat orders ------------------------------------------------------------------
def _seat_sums():
    seats, kind = F.col("total_seats"), F.col("order_type")
    return [F.sum(F.when(kind == NEW_ORDER, seats).otherwise(0)).alias("new_seats"),
            F.sum(F.when(kind.isin(*EXPANSION_ORDERS), seats).otherwise(0)).alias("expand_seats"),
            F.sum(seats).alias("total_seats")]


def _counted(orders: DataFrame) -> DataFrame:
    return orders.filter(~F.col("order_type").rlike(UPGRADE_PATTERN))


def seats_as_of(orders: DataFrame, date: DateLike) -> DataFrame:
    """Seats of the orders in force on ``date``; labelled with the next day."""
    live = (F.col("order_start_date") <= day(date)) & (F.col("order_end_date") >= day(date))
    return (_counted(orders).filter(live).groupBy(F.date_add(day(date), 1).alias("mm"))
            .agg(*_seat_sums()))


def seats_by_month(orders: DataFrame, first_month: str, last_month: str) -> DataFrame:
    """Seats of the orders in force at any time in each month; labelled with day 2 of it.

    Each order is repeated for the months it covers, at most as many as are asked for, so
    there is no range join.
    """
    lo, hi = day(f"{first_month}-01"), day(f"{last_month}-01")
    start = F.greatest(F.trunc("order_start_date", "month"), lo)
    end = F.least(F.trunc("order_end_date", "month"), hi)
    return (_counted(orders).select("order_type", "total_seats", start.alias("lo"), end.alias("hi"))
            .filter(F.col("lo") <= F.col("hi"))
            .withColumn("month", F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 MONTH"))))
            .groupBy(F.date_add("month", 1).alias("mm")).agg(*_seat_sums()))
