"""Hot files and recently updated spaces."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import predicates as p
from ..functions.scalars import DateLike, epoch_millis_to_local
from ..operators.periods import Span
from ..operators.ranking import top_n
from ..schemas import RESULTS, conform
from .model import Workspace, user_teams
from .rollups import user_touches

HOT_1D = "file_1d_hot_statistic_by_global"
HOT_7D = "file_7d_hot_statistic_by_global"
SPACES = "space_1d_updated_statistic_by_global"


def hot_files(ws: Workspace, span: Span, days: int = 1, n: int = 100) -> DataFrame:
    """The ``n`` most viewed files of each team.

    Files that are unknown to the file dimension, or lack a name or type there, are left
    out before ranking. Ties go to the smaller guid.
    """
    views = (user_touches(ws, span, days).join(user_teams(ws.users), "user_id")
             .groupBy("ldate", "team_id", "guid").agg(F.sum("views").alias("file_views")))
    known = (ws.need("files").select("guid", "name", F.col("file_type").alias("type"),
                                     F.col("file_subtype").alias("sub_type"))
             .na.drop())
    ranked = top_n(views.join(known, "guid"), ["ldate", "team_id"],
                   [F.desc("file_views"), F.asc("guid"), F.asc("name"), F.asc("type"), F.asc("sub_type")], n)
    return conform(ranked, RESULTS[HOT_1D if days == 1 else HOT_7D])


def _space_rows(ws: Workspace, span: Span) -> DataFrame:
    """(ldate, user, guid, space_time) rows that decide the last act on each report date."""
    keys = ["ldate", "user_id", "guid", "space_time"]
    if ws.touches is not None:
        rows = ws.touches.filter(F.col("space_time").isNotNull())
    else:
        rows = (ws.events.filter(p.file_type(p.FOLDER_OR_SPACE) & (F.col("sub_type") == p.SPACE))
                .withColumnRenamed("time", "space_time"))
    if ws.spaces is None:
        return rows.filter(F.col("ldate") <= F.lit(span.end)).select(*keys)
    eve = F.lit(span.start - dt.timedelta(1))
    return (rows.filter(span.covers()).select(*keys)
            .unionByName(ws.spaces.filter(F.col("ldate") == eve).select(*keys)))


def space_state(ws: Workspace, date: DateLike) -> DataFrame:
    """Per (user, guid): time of the last act on a space up to ``date``.

    One row per user and space ever touched. Stored daily, it spares the next day's list
    the pass over all history; a day that is run again must be followed by the later ones.
    """
    return fold_spaces(ws, Span.of(date))


def fold_spaces(ws: Workspace, span: Span) -> DataFrame:
    """``space_state`` of the last date of ``span``, from the state before it and its days."""
    return (_space_rows(ws, span).groupBy("user_id", "guid").agg(F.max("space_time").alias("space_time"))
            .select(F.lit(span.end).alias("ldate"), "user_id", "guid", "space_time"))


def _space_touches(ws: Workspace, span: Span) -> DataFrame:
    """Per (report date, user, guid): time of the last act on a space, all history."""
    rows = _space_rows(ws, span)
    last = F.max("space_time").alias("space_time")
    if span.single:
        return rows.groupBy("user_id", "guid").agg(last).withColumn("ldate", F.lit(span.start))
    # everything before the span folds into its first date, then each value holds until the next
    daily = (rows.withColumn("from", F.greatest("ldate", F.lit(span.start)))
             .groupBy("user_id", "guid", "from").agg(last))
    own = Window.partitionBy("user_id", "guid").orderBy("from")
    until = F.coalesce(F.date_sub(F.lead("from").over(own), 1), F.lit(span.end))
    running = F.max("space_time").over(own.rowsBetween(Window.unboundedPreceding, 0))
    return (daily.select("user_id", "guid", running.alias("space_time"), "from", until.alias("until"))
            .withColumn("ldate", F.explode(F.sequence("from", "until"))).drop("from", "until"))


def updated_spaces(ws: Workspace, span: Span, n: int = 100, per_team: bool = False) -> DataFrame:
    """Latest act on each space, teams in order, newest first; ``n`` rows per report date.

    The cut is over all teams together; ``per_team`` cuts each team on its own. Ties go to
    the smaller guid.
    """
    order = [F.asc("team_id"), F.desc("updated_at"), F.asc_nulls_last("guid")]

    def cut(rows: DataFrame, order) -> DataFrame:
        if per_team:
            return top_n(rows, ["ldate", "team_id"], order[1:], n)
        return rows.orderBy(*order).limit(n) if span.single else top_n(rows, ["ldate"], order, n)

    touched = (_space_touches(ws, span).join(user_teams(ws.users), "user_id")
               .groupBy("ldate", "team_id", "guid").agg(F.max("space_time").alias("space_time"))
               .filter(F.col("space_time").isNotNull())
               .select("ldate", "team_id", "guid",
                       epoch_millis_to_local(F.col("space_time"), ws.zone).alias("updated_at")))
    # A space yields a row per name it has, next to each other in the order, so the first n
    # rows come from the first n spaces: cut before the names are looked up, and once more after.
    named = (cut(touched, order).drop("row_number")
             .join(ws.need("files").select("guid", "name"), "guid", "left").distinct())
    return conform(cut(named, [*order, F.asc_nulls_last("name")]), RESULTS[SPACES])
