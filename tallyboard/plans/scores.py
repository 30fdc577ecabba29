"""Score views over stored metric rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.scores import active_score, auto_saves, saved_days


def active_users(member_collaboration: DataFrame) -> DataFrame:
    """Activity score per member, over the 1-day, 7-day or 30-day collaboration table."""
    return member_collaboration.select("ldate", "team_id", "user_id",
                                       active_score().alias("active_score"))


def save_time(totals: DataFrame) -> DataFrame:
    return totals.select("ldate", "team_id", saved_days().alias("save_time"))


def auto_save_count(totals: DataFrame) -> DataFrame:
    return totals.select("ldate", "team_id", auto_saves().alias("auto_saves"))
